"""Cross-tokenizer alignment against a plain version."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starledger.llm import alignment, queries
from starledger.llm.alignment import Csr

tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
public_tokenizers = pytest.importorskip("public_tokenizers")

FIRST, SECOND = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
DOCS = "doc_id long, text string"


class Plain:
    """Whole texts, token by token."""

    def __init__(self):
        self.a = tokenizers.Tokenizer.from_file(FIRST)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=SECOND)
        self.spelled = alignment.byte_level()

    def tokens(self, text):
        if not text:
            return [], []
        first = [(i, bytes(map(self.spelled.get, self.a.id_to_token(i)))) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        second = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            raw = bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()
            second.append((i, raw))
        whole = (" " + text).encode()
        same = all(b"".join(raw for _, raw in side) == whole for side in (first, second))
        return (first, second) if same else ([], [])

    def groups(self, text):
        ends = []
        sides = self.tokens(text)
        for side in sides:
            at, out = 0, []
            for _, raw in side:
                at += len(raw)
                out.append(at)
            ends.append(out)
        cuts = sorted(set(ends[0]) & set(ends[1]))
        found = [([], []) for _ in cuts]
        for k, side in enumerate(sides):
            for (i, _), end in zip(side, ends[k]):
                found[int(np.searchsorted(cuts, end))][k].append(i)
        return found


def plain_rows(texts):
    plain = Plain()
    every = [plain.groups(t) for t in texts]
    links = [Counter((a, b) for own, other in groups for a in own for b in other) for groups in every]
    holds = Counter(pair for found in links for pair in found)
    most = defaultdict(int)
    for (a, _), n in holds.items():
        most[a] = max(most[a], n)
    rows = []
    for groups, found in zip(every, links):
        text = ";".join("|".join(",".join(map(str, side)) for side in group) for group in groups)
        rows.append(
            (
                sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), sum(found.values()),
                sum(n for pair, n in found.items() if holds[pair] == most[pair[0]]),
                sum(n * holds[pair] for pair, n in found.items()),
                hashlib.sha256(text.encode()).hexdigest() if groups else "",
            )
        )
    return rows


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")

EDGES = [
    None, "", " ", "  ", "a", " a ", "a  b   c", "\n", "a\nb\n\n c\t d", "x" * 3000, "<|endoftext|> <s> </s> <0x0A>", "a▁b",
    "日本語のテキスト、 少し", "emoji 👩‍👩‍👧 é é", "1234567890 12 3,456", "\x00\x01 a", "ﬁ ½  　x", "don't it's",
]


def corpus(seed, n=40):
    rng = random.Random(seed)
    words = ["the", "The", "tokenizer", "alignment", "über", "naïve", "Größe", "x1", "zzqx", "foo_bar", "https://a.b/c", "été", "—", "…", "日本"]
    gaps = [" "] * 12 + ["  ", "\n", ", ", ". ", "\t", "-"]
    return ["".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.choice([1, 5, 60, 400]))) for _ in range(n)]


def check(found, rows):
    expected = Counter(zip((d for d, _ in rows), plain_rows([t for _, t in rows])))
    assert Counter((r.doc_id, tuple(r[c] for c in COLUMNS)) for r in found) == expected


def test_products_of_sparse_matrices(monkeypatch):
    monkeypatch.setattr(alignment, "ENTRIES", 7)
    rng = np.random.default_rng(1)
    for _ in range(30):
        n, m, k = rng.integers(1, 9, 3)
        a, b = rng.integers(0, 3, (n, m)), rng.integers(0, 3, (k, m))
        sparse = [Csr.counted(*np.array([(i, j) for (i, j), v in np.ndenumerate(x) for _ in range(v)], int).reshape(-1, 2).T, *x.shape) for x in (a, b)]
        product = sparse[0].product(sparse[1].transposed())
        dense = np.zeros((n, k), int)
        dense[np.repeat(np.arange(n), np.diff(product.starts)), product.columns] = product.values
        assert (dense == a @ b.T).all() and (product.values != 0).all()


@pytest.mark.parametrize("texts", [EDGES, corpus(0)])
def test_encoders_agree_with_whole_texts(texts):
    plain = Plain()
    encoders = alignment.ByteEncoder(FIRST), alignment.PieceEncoder(SECOND)
    for text in filter(None, texts):
        spaced = pa.array([" " + text])
        assert alignment._ids(encoders[0], spaced)[0].tolist() == plain.a.encode(" " + text, add_special_tokens=False).ids
        assert alignment._ids(encoders[1], spaced)[0].tolist() == plain.b.encode(text)


def test_random_characters():
    rng = random.Random(5)
    plain, encoder = Plain(), alignment.PieceEncoder(SECOND)
    pool = [*range(0, 0x250), *range(0x2000, 0x2070), 0x2581, 0x3000, 0xFEFF, 0xFFFD, 0x1F600, *range(0x4E00, 0x4E20)]
    for _ in range(300):
        text = "".join(rng.choice([" ", "a", chr(rng.choice(pool))]) for _ in range(rng.randint(1, 40)))
        assert alignment._ids(encoder, pa.array([" " + text]))[0].tolist() == plain.b.encode(text)


@pytest.mark.parametrize("links, entries", [(1 << 20, 1 << 21), (50, 40)])
def test_alignment_of_any_corpus(spark, monkeypatch, links, entries):
    monkeypatch.setattr(alignment, "LINKS", links)
    monkeypatch.setattr(alignment, "ENTRIES", entries)
    rows = list(enumerate(EDGES + corpus(1) + corpus(2, 5) + corpus(2, 5)))
    rows += [(None, "the tokenizer"), (None, None), rows[30], rows[30]]
    found = alignment.align(spark.createDataFrame(rows, DOCS), FIRST, SECOND).collect()
    check(found, rows)


def test_groups_that_never_meet():
    """A text without common ends is one group, whose links are many."""
    a, b = (alignment.Side(np.arange(n) % 5, np.zeros(n, np.int64), np.full(n, size), 9) for n, size in ((300, 7), (700, 3)))
    a.length[0] -= 1
    a.length[-1] += 1
    found = alignment.Aligned.__new__(alignment.Aligned)
    found.rows, found.sides = 1, [a, b]
    ends = set(np.cumsum(a.length).tolist()) & set(np.cumsum(b.length).tolist())
    assert found.n_groups == len(ends)
    pairs = Counter()
    for doc, pair, times in found.links():
        pairs.update(dict(zip(pair.tolist(), times.tolist())))
    plain = Counter(int(x) * 9 + int(y) for g, x in zip(found.groups[0], a.ids) for h, y in zip(found.groups[1], b.ids) if g == h)
    assert pairs == plain and found.counts()[3].tolist() == [sum(plain.values())]


def test_empty_table_and_other_columns(spark):
    assert alignment.align(spark.createDataFrame([], DOCS), FIRST, SECOND).collect() == []
    rows = spark.createDataFrame([(1, "the tokenizer"), (2, "the")], "doc_id int, text string")
    named = rows.select("*", *[F.lit("x").alias(c) for c in ("pair", "chunk", "n_a", "row", "a b.c")])
    check(alignment.align(named, FIRST, SECOND).collect(), [(1, "the tokenizer"), (2, "the")])
    counts = alignment.pair_counts(named, FIRST, SECOND).collect()
    assert max(r.n_docs for r in counts) == 2 and any(r.best for r in counts)
    texts = {r.doc_id: r.groups for r in alignment.groups(named, FIRST, SECOND).collect()}
    assert texts[1].startswith(texts[2] + ";")


def test_query_against_the_plain_version(spark):
    sf = "/root/testdata/sf0.001"
    found = queries.QUERIES["op11_alignment"](spark, sf).collect()
    texts = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    check(found, [tuple(r) for r in texts])
