"""SimHash near duplicates against a plain version."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starledger.llm import components, queries, simhash

xxhash = pytest.importorskip("xxhash")

DOCS = "doc_id long, text string"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_print(text, size=4):
    words = WORDS.findall((text or "").translate(FOLD))
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """(doc_id, fingerprint) rows to the smallest doc_id that links lead to."""
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    known = [(d, p) for d, p in prints if d is not None]
    for i, (a, x) in enumerate(known):
        for b, y in known[: i + 1]:
            if (x ^ y).bit_count() <= 4:
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {d: root(d) for d, _ in known}


def check(spark, rows):
    found = simhash.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    prints = [(d, plain_print(t)) for d, t in rows]
    component = plain_components(prints) | {None: None}
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in found), key=str)
    assert got == sorted(((d, f"{p:016x}", component[d]) for d, p in prints), key=str)


def corpus(seed, n=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["The", "THE", "Ünder", "é", "日本"]
    texts = []
    for _ in range(n):
        text = [rng.choice(words) for _ in range(rng.choice([1, 3, 4, 5, 40, 300]))]
        texts.append(" ".join(text))
        for _ in range(rng.choice([0, 1, 4])):
            edited = list(text)
            for _ in range(rng.choice([1, 2, 5])):
                edited[rng.randrange(len(edited))] = rng.choice(words)
            texts.append(rng.choice([" ", "\n", "\t\x0b "]).join(edited))
    return texts


EDGES = [None, "", " \n\x0b", "one", "ONE", "a b c", "A  B\tC ", "x" * 50_000, "long text " * 9_000, "a\x1cb c d", "a b"]


def test_fingerprints_of_any_text():
    texts = EDGES + corpus(1)
    found = simhash.fingerprints_of(pa.array(texts)).tolist()
    assert found == [plain_print(t) for t in texts]


def test_counts_beyond_one_lane_and_one_part(monkeypatch):
    monkeypatch.setattr(simhash, "PART", 1000)
    text = " ".join(f"v{i % 977}" for i in range(5_000))
    assert simhash.fingerprints_of(pa.array([text, "a", text])).tolist() == [plain_print(t) for t in (text, "a", text)]


@pytest.mark.parametrize("seed", [0, 1])
def test_near_duplicates_lose_no_link(spark, seed):
    rows = list(enumerate(EDGES + corpus(seed), start=1))
    random.Random(seed).shuffle(rows)
    check(spark, rows)


def test_repeated_and_missing_ids(spark):
    texts = corpus(3, 12)
    rows = [(i % 7, t) for i, t in enumerate(texts)] + [(None, texts[0]), (None, None), (3, None)]
    check(spark, rows + rows[:5])


def test_empty_table_other_columns_and_narrow_ids(spark):
    empty = spark.createDataFrame([], DOCS)
    assert simhash.near_duplicates(empty).collect() == []
    rows = spark.createDataFrame([(1, "a b"), (2, "A b")], "doc_id int, text string")
    named = ["print", "component", "sig", "rep", "a b.c"]
    rows = rows.select("*", *[F.lit(0).alias(n) for n in named])
    found = simhash.near_duplicates(rows).collect()
    assert {(r.doc_id, r.component_id) for r in found} == {(1, 1), (2, 1)}


def chained(rng, n):
    """Fingerprints of which many share signatures and only some are near."""
    base = rng.getrandbits(64)
    return list({base ^ sum(1 << b for b in rng.sample(range(22, 64), rng.randint(0, 9))) for _ in range(n)})


@pytest.mark.parametrize("block", [8, 2048])
def test_signatures_with_many_components(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = random.Random(block)
    prints = [p for _ in range(4) for p in chained(rng, 60)]
    rows = [(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)]
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, size: docs.select("doc_id", "print"))
    found = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, print long")).collect()
    expected = plain_components(list(enumerate(prints)))
    assert {r.doc_id: r.component_id for r in found} == expected
    assert len(set(expected.values())) > 20


@pytest.mark.parametrize("distance", [0, 1, 2, 4, 6])
def test_near_fingerprints_share_a_signature(spark, distance):
    rng = random.Random(distance)
    pairs = []
    for _ in range(200):
        a = rng.getrandbits(64)
        b = a ^ sum(1 << i for i in rng.sample(range(64), rng.randint(0, distance)))
        pairs.append([x - (1 << 64) if x >> 63 else x for x in (a, b)])
    rows = spark.createDataFrame(pairs, "a long, b long")
    common = F.arrays_overlap(simhash.signatures(F.col("a"), distance), simhash.signatures(F.col("b"), distance))
    assert rows.where(~common).count() == 0


def test_one_link_for_two_components():
    bits = np.array([0, 1, 3, 1 << 40, (1 << 40) + 1], np.int64)
    pairs = simhash._pairs(np.zeros(5, np.int64), bits, np.array([7, 7, 7, 9, 9]), 4)
    assert pairs.to_pylist() == [{"a": 7, "b": 9}]


def test_no_table_that_grows_with_the_documents_is_broadcast(spark, monkeypatch):
    """A file of fingerprints is sized far below its 64 signatures a row."""
    plans, write = [], simhash.materialize

    def noted(df, label):
        plans.append((label, df._jdf.queryExecution().executedPlan().toString()))
        return write(df, label)

    for module in (simhash, components):
        monkeypatch.setattr(module, "materialize", noted)
    rows = [(i % 70, text) for i, text in enumerate(corpus(5, 30))]
    out = simhash.near_duplicates(spark.createDataFrame(rows, DOCS))
    plans.append(("result", out._jdf.queryExecution().executedPlan().toString()))
    assert {"shared-signatures", "links", "placed-prints"} <= {label for label, _ in plans}
    assert [label for label, plan in plans if "Broadcast" in plan] == []


def test_query_against_the_plain_version(spark):
    sf = "/root/testdata/sf0.001"
    found = queries.QUERIES["op13_simhash"](spark, sf).collect()
    texts = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    prints = [(r.doc_id, plain_print(r.text)) for r in texts]
    component = plain_components(prints)
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in found} == {
        (d, f"{p:016x}", component[d]) for d, p in prints
    }
    assert len(found) == len(texts)
