"""Operators across documents: joins, repeats, decontamination, packing, files, neighbours."""

import hashlib
import json
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from starledger.llm import decontaminate, jaccard, neighbours, packing, repeats, token_files
from starledger.llm.components import components
from starledger.llm.encode import Encoder
from starledger.llm.words import WordHasher

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")

DOCS = "doc_id long, text string"
SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _documents(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet")


def _texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def _edited(rng, words, share):
    return [rng.choice(words) if rng.random() < share else w for w in words]


def _corpus(seed=0, n=120):
    """Random texts with exact copies, near copies of graded likeness, and edge cases."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["The", "of", "Ünder"]
    rows = []
    for _ in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([2, 3, 5, 8, 12, 30, 80, 200]))]
        rows.append(" ".join(words))
        if rng.random() < 0.5:
            for share in rng.sample([0, 0.005, 0.01, 0.02, 0.03, 0.05, 0.1], 3):
                rows.append(" ".join(_edited(rng, words, share)))
    rows += [None, "", "  \n", "the of", "THE  of", "x" * 70_000, "long " * 20_000]
    return list(enumerate(rows, start=1))


# --- words ------------------------------------------------------------------------------


def test_word_hashes_follow_the_words():
    rng = random.Random(2)
    texts = ["".join(rng.choice("aAbé \t\n\x0b.") for _ in range(rng.randint(0, 30))) for _ in range(500)]
    texts += [None, "", " "]
    seen = {}
    for words in WordHasher(fold=True).slices(pa.array(texts)):
        for row in range(words.rows):
            expected = WORDS.findall((texts[words.first + row] or "").translate(FOLD))
            own = words.hash[words.doc == row].tolist()
            assert len(own) == len(expected)
            for word, value in zip(expected, own):
                assert seen.setdefault(value, word) == word
    assert len(set(seen.values())) == len(seen)


# --- n-gram Jaccard join ----------------------------------------------------------------


def _plain_components(rows):
    sets = {}
    for doc, text in rows:
        w = WORDS.findall((text or "").translate(FOLD))
        sets[doc] = {tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) > 3 else {tuple(w)} - {()}
    parent = {doc: doc for doc in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
                    low, high = sorted((root(a), root(b)))
                    parent[high] = low
    return {doc: (len(sets[doc]), root(doc)) for doc in sets}


@pytest.mark.parametrize("seed", [0, 1])
def test_join_loses_no_link(spark, seed):
    rows = _corpus(seed)
    found = jaccard.jaccard_join(spark.createDataFrame(rows, DOCS)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == _plain_components(rows)
    assert len(found) == len(rows)


def test_a_dense_group_is_compared_across_its_blocks(spark, monkeypatch):
    # Copies of one text with own edits: many share signatures and only some link.
    rng = random.Random(4)
    base = [f"v{i}" for i in range(60)]
    rows = [(i, " ".join(_edited(rng, base, 0.02))) for i in range(150)]
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    found = jaccard.jaccard_join(spark.createDataFrame(rows, DOCS)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == _plain_components(rows)


def test_copies_at_both_ends_of_a_signature_settle_nothing_else(spark):
    # The second and third text of each four link; the first and its copy link with neither.
    rows = []
    for i in range(0, 240, 4):
        common = [f"w{i}x{k}" for k in range(9)]
        texts = [[*common, "a", f"a{i}"], [*common, f"b{i}"], common, [*common, "a", f"a{i}"]]
        rows += [(i + k, " ".join(words)) for k, words in enumerate(texts)]
    found = jaccard.jaccard_join(spark.createDataFrame(rows, DOCS)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == _plain_components(rows)


def test_signatures_are_shared_by_all_similar_sets():
    rng = random.Random(7)
    classes = jaccard.Classes()
    for _ in range(400):
        size = rng.choice([6, 7, 9, 11, 12, 15, 17, 20, 40, 90, 300])
        a = rng.sample(range(10**9), size)
        b = list(a)
        while True:
            c = list(b)
            change = rng.random()
            if change < 0.4:
                c[rng.randrange(len(c))] = rng.randrange(10**9)
            elif change < 0.7:
                c.pop(rng.randrange(len(c)))
            else:
                c.append(rng.randrange(10**9))
            common = len(set(a) & set(c))
            if 100 * common < 85 * (len(set(a)) + len(set(c)) - common):
                break
            b = c
        own = []
        for x in (a, b):
            sets = jaccard.Shingles.__new__(jaccard.Shingles)
            sets.hash = np.unique(np.array(x, np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            sets.size, sets.first = np.array([len(sets.hash)]), np.array([0])
            sets.doc = np.zeros(len(sets.hash), np.int64)
            own.append(set(jaccard.signatures(sets, classes)[1].tolist()))
        assert set(a) == set(b) or own[0] & own[1], (size, a, b)


def test_join_of_odd_rows(spark):
    rows = [(None, "a b c d e", 1), (None, "a b c d e", 1), (5, "a b c d e", 1), (5, "z y x w v", 1),
            (7, "z y x w v", 1), (9, "a b c d e", 1), (9, "a b c d e", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id long")
    found = sorted((r.doc_id or -1, r.component_id) for r in jaccard.jaccard_join(docs).collect())
    assert found == [(-1, None), (-1, None), (5, 5), (5, 5), (7, 5), (9, 5), (9, 5)]
    assert jaccard.jaccard_join(docs.limit(0)).collect() == []


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (3, 2)]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    got = {r.id: r.component for r in found}
    assert len(found) == len(got) == 41 + 60
    assert all(got[i] == 0 for i in range(41)) and all(got[i] == 100 for i in range(100, 160))


# --- repeated passages ------------------------------------------------------------------


def _plain_removal(rows, window):
    first, out = {}, []
    for doc, text in rows:
        w = WORDS.findall(text or "")
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            if doc is not None:
                first[key] = min(first.get(key, doc), doc)
    for doc, text in rows:
        w = WORDS.findall(text or "")
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if doc is not None and first[tuple(w[i : i + window])] < doc:
                gone[i : i + window] = [True] * window
        out.append((doc, len(w), sum(gone), " ".join(x for x, y in zip(w, gone) if not y)))
    return out


def _order(row):
    return (row[0] is None, row[0] or 0, row[1:])


@pytest.mark.parametrize("bits", [28, 20])
def test_removal_equals_brute_force_at_any_sketch_size(spark, monkeypatch, bits):
    monkeypatch.setattr(repeats, "BITS", bits)
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(30)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for doc in range(120):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([0, 5, 12, 13, 14, 60]))]
        if rng.random() < 0.4:
            at = rng.randint(0, len(words))
            words[at:at] = passage[rng.randint(0, 30) : rng.randint(31, 60)]
        rows.append((doc, rng.choice([" ", "\n ", "\t"]).join(words)))
    rows += [(5, rows[5][1]), (None, " ".join(passage)), (200, None), (201, ""), (202, "same " * 40),
             (203, "same " * 30), (204, rows[3][1]), (205, "é " * 20_000)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], DOCS + ", marks string").repartition(3)
    found = [tuple(r) for r in repeats.remove_repeats(docs).collect()]
    assert sorted(found, key=_order) == sorted(_plain_removal(rows, repeats.WINDOW), key=_order)


def test_removal_of_no_rows(spark):
    assert repeats.remove_repeats(spark.createDataFrame([], DOCS)).collect() == []


def test_repeats_query_against_brute_force(spark):
    from starledger.llm.queries import QUERIES

    rows = sorted(_texts(_documents(spark)).items())
    expected = {
        doc: (n, gone, hashlib.sha256(kept.encode()).hexdigest())
        for doc, n, gone, kept in _plain_removal(rows, repeats.WINDOW)
    }
    found = QUERIES["op7_repeats"](spark, SF).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in found} == expected


# --- decontamination --------------------------------------------------------------------


def _plain_alignment(a, b):
    best = 0
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            match = decontaminate.MATCH if a[i - 1] == b[j - 1] else decontaminate.MISMATCH
            gap = max(table[i - 1][j], table[i][j - 1]) + decontaminate.GAP
            table[i][j] = max(0, table[i - 1][j - 1] + match, gap)
            best = max(best, table[i][j])
    return best


def test_alignment_score_equals_the_plain_table():
    rng = random.Random(8)
    for _ in range(300):
        a, b = ([rng.randint(0, 3) for _ in range(rng.randint(1, 14))] for _ in "ab")
        score, equal, aligned, first, last = decontaminate.align(np.array(a), np.array(b))
        assert score == _plain_alignment(a, b)
        if score:
            assert equal <= aligned and 0 <= first <= last < len(b)


def test_edited_copies_are_found_and_clean_documents_left(spark):
    rng = random.Random(6)
    vocabulary = [f"t{i}" for i in range(300)] + ["the", "of", "and"] * 60
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([15, 30, 60])))) for i in range(12)]
    items += [(50, ""), (51, None), (None, "some item without id")]
    docs, truth = [], set()
    for doc in range(150):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([0, 40, 300]))]
        if doc % 3 == 0:
            item, text = rng.choice(items[:12])
            leak = [w.upper() + rng.choice(["", ",", "."]) for w in _edited(rng, text.split(), 0.1)]
            at = rng.randint(0, len(words))
            words[at:at] = leak
            truth.add((doc, item))
        docs.append((doc, " ".join(words), 0.0))
    docs += [(900, None, 0.0), (901, "", 0.0)]
    found = decontaminate.find_leaks(
        spark.createDataFrame(docs, DOCS + ", score double"),
        spark.createDataFrame(items, "item_id long, text string"),
    ).collect()
    assert {(r.doc_id, r.item_id) for r in found} == truth
    assert all(r.score > 0.5 and r.first_word <= r.last_word for r in found)


def test_blocks_of_seeds_find_the_same(spark, monkeypatch):
    docs, items = _documents(spark), spark.read.parquet(f"{SF}/benchmark.parquet")
    whole = sorted(map(tuple, decontaminate.find_leaks(docs, items).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_SEEDS", 300)
    assert sorted(map(tuple, decontaminate.find_leaks(docs, items).collect())) == whole
    assert decontaminate.find_leaks(docs, items.limit(0)).collect() == []
    assert decontaminate.find_leaks(docs.limit(0), items).collect() == []


def test_scores_of_many_equal_single_alignments(monkeypatch):
    monkeypatch.setattr(decontaminate, "CELLS", 100)
    rng = np.random.default_rng(9)
    text, flat = rng.integers(0, 4, 400), rng.integers(0, 4, 300)
    firsts, lengths = rng.integers(0, 270, 80), rng.integers(1, 30, 80)
    low = rng.integers(0, 380, 80)
    high = np.minimum(low + rng.integers(1, 60, 80), 400)
    scores = decontaminate.best_scores(flat, firsts, lengths, text, low, high)
    for f, n, a, b, score in zip(firsts, lengths, low, high, scores):
        assert score == decontaminate.align(flat[f : f + n], text[a:b])[0]


@pytest.mark.parametrize("hits", [1 << 18, 50])
def test_parts_that_many_items_share_are_found(spark, monkeypatch, hits):
    monkeypatch.setattr(decontaminate, "HITS", hits)
    copied = [f"c{i}" for i in range(40)]
    passage = [f"p{i}" for i in range(60)]
    items = [(i, " ".join(copied)) for i in range(12)]
    items += [(100 + i, " ".join(passage + [f"q{i}x{k}" for k in range(15)])) for i in range(12)]
    edited = copied[14:30]
    edited[4] = edited[9] = edited[13] = "other"  # 13 of 16 words are equal
    docs = [(1, " ".join(["x"] * 50 + copied[20:34] + ["y"] * 50)), (2, " ".join(passage)),
            (3, " ".join(edited)), (4, "x y z " + " ".join(copied[20:24]))]
    found = decontaminate.find_leaks(
        spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    truth = [(d, i) for d in (1, 3) for i in range(12)] + [(2, 100 + i) for i in range(12)]
    assert sorted((r.doc_id, r.item_id) for r in found) == sorted(truth)


def test_a_stock_phrase_of_a_short_item_is_no_leak(spark):
    items = [(1, "one of the most famous rivers"), (2, "at the end of day"),
             (3, "what is one of the largest lakes in northern italy"), (4, "so be it")]
    docs = [(1, "this is one of the most common words"), (2, "they met at the end of may"),
            (3, "which is one of the largest towns"), (4, "be it so"),
            (11, "the rhine is One of the most famous rivers."),
            (13, "what is one of the largest lakes of northern italy"), (14, "So be it!")]
    found = decontaminate.find_leaks(
        spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(11, 1), (13, 3), (14, 4)]


# --- token files and packing ------------------------------------------------------------


@pytest.mark.parametrize("values", [[0], [5, 5, 5], list(range(1000)), [0, 2**40, 2**62], []])
def test_elias_fano_round_trip(values):
    one = token_files.EliasFano.encode(np.array(values, np.uint64))
    assert one.values().tolist() == values
    assert [one.select(i) for i in range(len(values))] == values


def test_elias_fano_of_many_values_stays_small():
    rng = np.random.default_rng(0)
    values = np.cumsum(rng.integers(1, 3000, 20_000))
    one = token_files.EliasFano.encode(values)
    assert [one.select(i) for i in range(0, 20_000, 97)] == values[::97].tolist()
    bound = 2 + np.log2(values[-1] / len(values))
    assert 8 * (len(one.low) + len(one.high)) <= (bound + 0.1) * len(values)


TRICKY = ["don't stop", " a  b", "a\n\nb ", "x.y,z!?", "<|endoftext|> a", "É\u00a0x \u2009 y", "ΑΣ ΣΑ",
          "e\u0301,e", "l\u2019été", "１２", "\x1ca", "中文 。", "a" * 300, "_a_b", "½x", "\ufeffa"]


@pytest.mark.parametrize(
    ("name", "joined", "fold"),
    [("word_bpe_49k.json", False, True), ("byte_bpe_50k.json", True, False)],
)
def test_pieces_give_the_ids_of_whole_texts(name, joined, fold, monkeypatch):
    rng = random.Random(3)
    letters = [*TRICKY, " ", "\n", "'s", "B", "23", "$$", "ß", "×", "…", "<", "İ"]
    texts = TRICKY + ["".join(rng.choices(letters, k=rng.randint(0, 8))) for _ in range(3000)]
    path = public_tokenizers.path(name)
    encoder = Encoder(path, 1, joined, fold)
    plain = tokenizers.Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    expected = [e.ids + [1] for e in plain.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):
        got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(pa.array(texts))]
        assert got == expected
    assert encoder.encode(pa.array([None], pa.string())) == [np.array([1], "<u4").tobytes()]


def _ids(texts, name):
    plain = tokenizers.Tokenizer.from_file(public_tokenizers.path(name))
    plain.encode_special_tokens = True
    encoded = plain.encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [e.ids + [1] for e in encoded]


def test_token_files_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_BYTES", 4000)
    rows = [(9, "last"), (-3, "first one"), (4, None), (5, ""), (None, "no id"), (4, None), (6, "w " * 5000)]
    rows += [(100 + i, f"text {i} " * (i % 50)) for i in range(300)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], DOCS + ", start int").repartition(4)
    path = str(tmp_path / "files")
    token_files.write_tokens(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    found = token_files.read_tokens(spark, path).orderBy("start").collect()
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0))
    ids = _ids([t for _, t in rows], "word_bpe_49k.json")
    assert [r.doc_id for r in found] == [doc for doc, _ in rows]
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in found] == ids
    assert [r.start for r in found] == [0, *np.cumsum([len(x) for x in ids])[:-1].tolist()]
    content = spark.read.format("binaryFile").load(path).where("length > 1").first().content
    file = token_files.TokenFile(content)
    assert json.loads(content[: token_files.HEADER])["n_docs"] == file.n_docs
    assert sum(len(file.ids(i)) for i in range(file.n_docs)) == file.header["n_tokens"]


def test_token_files_of_no_rows(spark, tmp_path):
    path = str(tmp_path / "files")
    token_files.write_tokens(
        spark.createDataFrame([], DOCS), path, public_tokenizers.path("word_bpe_49k.json")
    )
    assert token_files.read_tokens(spark, path).collect() == []


def test_hilbert_neighbours_are_one_step_apart():
    for dimensions, bits in ((2, 4), (3, 3)):
        side = 1 << bits
        cells = np.stack(np.meshgrid(*[np.arange(side)] * dimensions), -1).reshape(-1, dimensions)
        index = packing.hilbert_index(cells, bits)
        assert sorted(index.tolist()) == list(range(side**dimensions))
        walk = cells[np.argsort(index)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_packing_places_every_id_once(spark):
    rows = [(i, f"some words number {i} " * (i % 40)) for i in range(150)]
    rows += [(None, "no id"), (500, None), (501, ""), (502, "word " * 9000), (3, "again")]
    docs = spark.createDataFrame([(*r, 5) for r in rows], DOCS + ", length int").repartition(3)
    found = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")).collect()
    expected = defaultdict(list)
    for (doc, _), ids in zip(rows, _ids([t for _, t in rows], "byte_bpe_50k.json")):
        expected[doc].append(ids)
    sequences, tokens = defaultdict(list), 0
    by_doc = defaultdict(lambda: defaultdict(list))
    for r in found:
        assert len(r.ids) == 4 * r.length > 0
        sequences[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id][r.doc_tokens].append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
        tokens += r.length
    for doc, texts in expected.items():
        for ids in texts:
            same = [x for x in texts if len(x) == len(ids)]
            pieces = sorted(by_doc[doc][len(ids)])
            assert sum((p for _, p in pieces), []) == ids or len(same) > 1
    for places in sequences.values():
        places.sort()
        ends = [a + n for a, n in places]
        assert [a for a, _ in places] == [0, *ends[:-1]] and ends[-1] <= packing.LENGTH
        assert ends[-1] & (ends[-1] - 1) == 0  # full or a power of two: no padding
    assert tokens == sum(len(x) for texts in expected.values() for x in texts)
    assert packing.pack(docs.limit(0), public_tokenizers.path("byte_bpe_50k.json")).collect() == []


def test_similar_documents_share_sequences(spark):
    english, german = "the cat sat on the mat with", "der hund und die katze sitzen auf"
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices((english if i % 2 else german).split(), k=60))) for i in range(200)]
    docs = spark.createDataFrame(rows, DOCS).coalesce(1)
    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")).collect()
    kinds = defaultdict(list)
    for p in pieces:
        kinds[p.sequence_id].append(p.doc_id % 2)
    pure = sum(max(v.count(0), v.count(1)) for v in kinds.values()) / len(pieces)
    assert pure > 0.8


# --- neighbours -------------------------------------------------------------------------


def test_neighbours_of_a_small_table_are_exact(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(100, 8)).astype(np.float32).tolist()
    rows = [(i, v) for i, v in enumerate(vectors)]
    rows += [(200 + i, vectors[0]) for i in range(40)]  # ties
    rows += [(300, None), (301, [0.0] * 8), (302, [float("nan")] * 8), (303, [1.0, None] * 4),
             (304, [float("inf")] * 8), (305, [1.0] * 3), (None, vectors[1]), (20, vectors[20])]
    table = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<float>, rank int")
    found = neighbours.nearest(table, F.col("vec_id") % 20 == 0, k=5).collect()
    usable = {i: np.array(v, float) for i, v in rows[:140]}
    got = defaultdict(list)
    for r in sorted(found, key=lambda r: r["rank"]):
        got[r.query_id].append((r["rank"], r.vec_id))
        assert r.score == pytest.approx(usable[r.query_id] @ usable[r.vec_id], abs=1e-12)
    assert set(got) == {i for i in usable if i % 20 == 0}
    for query, hits in got.items():
        others = sorted((round(-float(usable[query] @ v), 9), i) for i, v in usable.items() if i != query)
        assert hits == [(n, i) for n, (_, i) in enumerate(others[:5], start=1)]


def test_neighbours_of_no_rows(spark):
    table = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    assert neighbours.nearest(table, F.col("vec_id") > 0).collect() == []


def test_recall_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "VECTOR_BLOCK", 150)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 10)
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    found = neighbours.nearest(rows, F.col("vec_id") % 20 == 0).collect()
    vectors = {r.vec_id: np.array(r.embedding, float) for r in rows.collect()}
    ids = np.array(sorted(vectors))
    matrix = np.stack([vectors[i] for i in ids])
    got = defaultdict(set)
    for r in found:
        got[r.query_id].add(r.vec_id)
    hits = []
    for query in (i for i in ids.tolist() if i % 20 == 0):
        scores = matrix @ vectors[query]
        order = [i for i in ids[np.lexsort((ids, -scores))].tolist() if i != query][:20]
        assert len(got[query]) == 20
        hits.append(len(got[query] & set(order)) / 20)
    assert np.mean(hits) >= 0.9


# --- the pipeline -----------------------------------------------------------------------


def test_pipeline_against_its_parts(spark):
    texts = _texts(_documents(spark))
    kept = dict(_plain_components(sorted(texts.items())))
    near = {doc for doc, (_, component) in kept.items() if doc == component}
    docs = _documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
    rows = {r.doc_id: r for r in docs.collect()}
    items = [r.text.lower() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {d for d in near if not any(item in texts[d].lower() for item in items)}
    assert set(rows) <= near and len(rows) >= 0.97 * len(clean)
    for row in rows.values():
        assert "@" not in row.text or "@" in texts[row.doc_id]
        assert row.n_chars == len(row.text)
    pieces = corpus_pipeline.run(spark, SF).collect()
    ids = dict(zip(rows, _ids([r.text for r in rows.values()], "byte_bpe_50k.json")))
    whole = defaultdict(list)
    for p in pieces:
        part = ids[p.doc_id][p.start : p.start + p.length]
        assert p.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        whole[p.doc_id].append(p.length)
    assert {d: sum(v) for d, v in whole.items()} == {d: len(x) for d, x in ids.items()}


def _plain_kept(rows, size, percent):
    """The smallest ids of groups linked by shingles of `size` words and `percent` likeness."""
    sets, group = {}, {}
    for doc, text in rows:
        w = WORDS.findall((text or "").translate(FOLD))
        sets[doc] = {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} - {()}
        group[doc] = {doc}
    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            union = len(sets[a]) + len(sets[b]) - common
            if a < b and common and 100 * common >= percent * union and group[a] is not group[b]:
                group[a] |= group[b]
                for doc in group[b]:
                    group[doc] = group[a]
    return {doc for doc in sets if doc == min(group[doc])}


def test_near_copies_of_the_pipeline_have_five_words_and_80_percent(spark):
    words = [f"s{i}" for i in range(100)]
    edited = [*words[:30], "one", *words[31:60], "two", *words[61:]]  # 86 of 106 by five words
    rows = [*_corpus(3), (1001, " ".join(words)), (1002, " ".join(edited))]
    docs = spark.createDataFrame(rows, DOCS)
    kept = {r.doc_id for r in corpus_pipeline.one_of_each(spark, docs, SF).collect()}
    assert kept == _plain_kept(rows, 5, 80)
    assert 1001 in kept and 1002 not in kept


def test_pipeline_stages_on_odd_rows(spark, tmp_path):
    base = "der hund und die katze sitzen auf der matte im garten hinter dem haus " * 3
    rows = [(1, base, "de", "s", 9), (2, base, "de", "s", 9), (3, None, "de", "s", None), (None, base, None, None, 9),
            (4, "123", "de", "s", 3), (5, base + " mail me@x.org", "de", "s", 9)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema)
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for table in (docs, docs.limit(0)):
        kept = table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, kept, str(tmp_path))
        if table is docs:
            assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 1]
        corpus_pipeline.STAGES[-1][1](spark, kept, str(tmp_path)).count()


@pytest.mark.parametrize("cells", [1, 3, 1 << 20])
def test_texts_of_other_cells_are_not_shuffled(spark, monkeypatch, cells):
    """Rows go by their id, whatever shares a cell; repeated and missing ids too."""
    monkeypatch.setattr(corpus_pipeline, "CELLS", cells)
    rows = [(i % 40, f"text {i}", i) for i in range(60)] + [(None, "no id", 60)]
    ids = spark.createDataFrame([(3,), (25,), (99,), (None,)], "doc_id long")
    for kind in ("long", "int"):
        docs = spark.createDataFrame(rows, f"doc_id {kind}, text string, n int")
        out = corpus_pipeline._without_ids(docs, ids)
        assert out.columns == docs.columns
        assert sorted(map(tuple, out.collect()), key=str) == sorted((r for r in rows if r[0] not in (3, 25)), key=str)
    # The first part of the union has all rows of other cells, and no shuffle of them.
    plan = out._jdf.queryExecution().executedPlan().toString()
    first = plan[: plan.index("LeftSemi")]
    assert "BroadcastHashJoin" in first and "hashpartitioning(doc_id" not in first
