"""Alignment of two tokenizers' ids over the same bytes, by products of sparse matrices.

The matrices are compressed sparse rows built by hand; products go by Gustavson's rule, row
by row: a row of A·B is the sum of the rows of B that A's row names.

1. Token-byte incidence. A has a row for each token of the first tokenizer and a column for
   each byte of the text, B the same for the second. A·Bᵀ holds the overlap links: pairs of
   tokens, and how many bytes they share.
2. Where neither of two neighbouring tokens of A links with a token that the other links
   with, both tokenizers end a token: this cuts the text into groups.
3. Group incidence. G has a row for each distinct id of a document and a column for each
   group, with the number of occurrences; G_A·G_Bᵀ holds the shared-group links of every
   id pair of the document.

How many documents hold an id pair is a corpus-wide count. Documents are taken in chunks of
some LINKS pairs: a chunk's distinct pairs are counted once and meet the corpus counts by a
join, so frequent pairs are rows of chunks, not of documents. The counts come back to their
chunk, a group of bounded size.

The first tokenizer (a tokenizers file, byte-level) encodes a space and the text, the second
(a sentencepiece file, which adds the space itself) the text, both without special tokens.
Texts that are null or empty, and those whose joined tokens differ from a space and the
text, have no tokens: zeros, and an empty groups text. Repeated rows, also of one doc_id or
none, are documents of their own. Other columns are not looked at. A very long text is a
slice of its own; its products are taken in ranges of rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.llm.base import map_arrow, quoted, utf8
from starledger.llm.encode import Encoder, Table, worker_state
from starledger.llm.words import Powers, mix
from starledger.sources.shared import materialize

#: Id pairs of documents in one chunk; a document with more is spread over several.
LINKS = 1 << 20
#: Entries that a product multiplies out at once.
ENTRIES = 1 << 21
#: Text bytes aligned at once; longer documents form a slice of their own.
SLICE_BYTES = 1 << 20

# --- Sparse matrices --------------------------------------------------------------------


@dataclass
class Csr:
    """Compressed sparse rows: row i has `columns` and `values` from starts[i] to starts[i + 1]."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    @property
    def height(self) -> int:
        return len(self.starts) - 1

    @classmethod
    def counted(cls, rows: np.ndarray, columns: np.ndarray, height: int, width: int) -> Csr:
        """How often each (row, column) occurs."""
        spots, values = np.unique(rows * width + columns, return_counts=True)
        starts = np.searchsorted(spots, np.arange(height + 1) * width)
        return cls(starts, spots % width, values, width)

    def transposed(self) -> Csr:
        rows = np.repeat(np.arange(self.height), np.diff(self.starts))
        order = np.argsort(self.columns, kind="stable")
        starts = np.concatenate([[0], np.cumsum(np.bincount(self.columns, minlength=self.width))])
        return Csr(starts, rows[order], self.values[order], self.height)

    def row_ranges(self, other: Csr, entries: int) -> Iterator[tuple[int, int]]:
        """Ranges of rows whose products with `other` multiply out to some `entries` each."""
        work = np.concatenate([[0], np.cumsum(np.diff(other.starts)[self.columns])])[self.starts]
        low = 0
        while low < self.height:
            high = int(np.searchsorted(work, work[low] + entries, side="right")) - 1
            high = min(max(high, low + 1), self.height)
            yield low, high
            low = high

    def times(self, other: Csr, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows, columns and values of the rows `low` to `high` of the product, in order."""
        first, last = int(self.starts[low]), int(self.starts[high])
        named = self.columns[first:last]
        length = other.starts[named + 1] - other.starts[named]
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(other.starts[named] - ends + length, length) + np.arange(total)
        row = np.repeat(np.arange(low, high), np.diff(self.starts[low : high + 1]))
        spots = np.repeat(row, length) * other.width + other.columns[at]
        values = np.repeat(self.values[first:last], length) * other.values[at]
        if (spots[1:] < spots[:-1]).any():
            order = np.argsort(spots)
            spots, values = spots[order], values[order]
        heads = np.flatnonzero(np.append(True, spots[1:] != spots[:-1])) if total else np.zeros(0, np.int64)
        spots = spots[heads]
        values = np.add.reduceat(values, heads) if total else values
        return spots // other.width, spots % other.width, values

    def product(self, other: Csr) -> Csr:
        """The whole product."""
        none = np.zeros(0, np.int64)
        parts = [(none, none, none)]
        parts += [self.times(other, low, high) for low, high in self.row_ranges(other, ENTRIES)]
        rows, columns, values = map(np.concatenate, zip(*parts))
        starts = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=self.height))])
        return Csr(starts, columns, values, other.width)


# --- Tokenizers -------------------------------------------------------------------------


class TokenBytes:
    """The bytes of every id of a vocabulary, one after another."""

    def __init__(self, entries: list[bytes]):
        self.length = np.fromiter(map(len, entries), np.int64, len(entries))
        self.start = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(entries), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        length = self.length[ids]
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(ends) else 0
        return self.data[np.repeat(self.start[ids] - ends + length, length) + np.arange(total)]


def byte_level() -> dict[str, int]:
    """The byte of each character in which byte-level vocabularies are written.

    Printable bytes of Latin-1 stand for themselves, the others in order for the characters
    from 256 on.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteEncoder(Encoder):
    """A byte-level BPE of the tokenizers library."""

    def __init__(self, path: str):
        super().__init__(path, end=0, joined_spaces=True, fold=False)
        self.bytes = worker_state(f"{path} bytes", self._bytes)

    def _bytes(self) -> TokenBytes:
        spelled = byte_level()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        entries = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            known = all(c in spelled for c in token)
            entries[i] = bytes(spelled[c] for c in token) if known else token.encode()
        return TokenBytes(entries)


class PieceEncoder(Encoder):
    """A sentencepiece model; no piece has a space behind another character.

    So a text falls into pieces before each run of spaces, which encode apart with the same
    result. The texts given begin with the space that the model adds.
    """

    def __init__(self, path: str):
        import sentencepiece

        make = lambda: sentencepiece.SentencePieceProcessor(model_file=path)
        self.model = worker_state(path, make)
        self.table = worker_state(f"{path} pieces", Table)
        self.bytes = worker_state(f"{path} bytes", self._bytes)
        self.dtype, self.end = np.dtype("<u4"), np.array([0], "<u4").tobytes()
        self.powers = Powers(0xD6E8FEB86659FD93)
        self.values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        if any("▁" in self.model.id_to_piece(i).lstrip("▁") for i in range(self.model.vocab_size())):
            raise ValueError(f"{path} has pieces with a space inside")

    def _bytes(self) -> TokenBytes:
        model, entries = self.model, []
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            entries.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
        return TokenBytes(entries)

    def _starts(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        space = data == 32
        begins = space.copy()
        begins[1:] &= ~space[:-1]
        begins[bounds[:-1][bounds[:-1] < len(data)]] = True
        return np.flatnonzero(begins)

    @staticmethod
    def _odd(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Texts that hold the model's own sign for a space."""
        odd = np.zeros(len(bounds) - 1, bool)
        at = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81))
        odd[np.searchsorted(bounds, at, side="right") - 1] = True
        return odd

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.uint32) for ids in self.model.encode([t[1:] for t in texts], num_threads=1)]

    def _new(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        raw = data.tobytes()
        pieces = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
        lone = np.array([self.model.piece_to_id("▁")], np.uint32)
        # Each piece begins with a space, and the model adds one of its own.
        encoded = self._ids([piece.decode() for piece in pieces])
        return [lone if piece == b" " else ids for piece, ids in zip(pieces, encoded)]


# --- Groups and links of some documents -------------------------------------------------


def _ids(encoder: Encoder, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the texts, one after another, and the number of each text's."""
    found = encoder.encode(texts)  # an end id closes each text
    count = np.fromiter(map(len, found), np.int64, len(found)) // 4
    every = np.frombuffer(b"".join(found), "<u4").astype(np.int64)
    keep = np.ones(len(every), bool)
    keep[np.cumsum(count) - 1] = False
    return every[keep], count - 1


@dataclass
class Side:
    """The tokens of one tokenizer: id, document, and length in bytes."""

    ids: np.ndarray
    doc: np.ndarray
    length: np.ndarray
    vocabulary: int

    def incidence(self) -> Csr:
        """A row for each token, a column for each byte."""
        starts = np.concatenate([[0], np.cumsum(self.length)])
        total = int(starts[-1])
        return Csr(starts, np.arange(total), np.ones(total, np.int64), total)


class Aligned:
    """Tokens of both sides of some documents, and what their matrices give."""

    def __init__(self, texts: pa.Array, first: Encoder, second: Encoder):
        self.rows = len(texts)
        filled = pc.greater(pc.fill_null(pc.binary_length(texts), 0), 0).to_numpy(zero_copy_only=False)
        spaced = pc.binary_join_element_wise(pa.scalar(" "), pc.fill_null(texts, ""), pa.scalar(""))
        data, bounds = utf8(spaced)
        sides = [_ids(encoder, spaced) for encoder in (first, second)]
        kept = filled
        for encoder, (ids, count) in zip((first, second), sides):
            kept = kept & self._same(encoder.bytes, ids, count, data, bounds)
        self.sides = []
        for encoder, (ids, count) in zip((first, second), sides):
            doc = np.repeat(np.arange(self.rows), count)
            own = kept[doc]
            ids, doc = ids[own], doc[own]
            self.sides.append(Side(ids, doc, encoder.bytes.length[ids], len(encoder.bytes.length)))

    @staticmethod
    def _same(table: TokenBytes, ids, count, data, bounds) -> np.ndarray:
        """Documents whose joined token bytes are their text."""
        rows = len(bounds) - 1
        doc = np.repeat(np.arange(rows), count)
        same = np.bincount(doc, table.length[ids], rows).astype(np.int64) == np.diff(bounds)
        joined = table.joined(ids[same[doc]])
        own = np.repeat(same, np.diff(bounds))
        differs = np.flatnonzero(own)[joined != data[own]]
        same[np.searchsorted(bounds, differs, side="right") - 1] = False
        return same

    @cached_property
    def overlaps(self) -> Csr:
        """Bytes that each pair of tokens shares."""
        a, b = (side.incidence() for side in self.sides)
        return a.product(b.transposed())

    @cached_property
    def groups(self) -> tuple[np.ndarray, np.ndarray]:
        """The group of each token of either side, numbered over all documents."""
        links = self.overlaps
        if not links.height:
            return (np.zeros(0, np.int64),) * 2
        first, last = links.columns[links.starts[:-1]], links.columns[links.starts[1:] - 1]
        begins = np.append(True, first[1:] > last[:-1])
        own = np.cumsum(begins) - 1
        other = np.zeros(len(self.sides[1].ids), np.int64)
        other[links.columns] = np.repeat(own, np.diff(links.starts))
        return own, other

    @cached_property
    def n_groups(self) -> int:
        return int(self.groups[0][-1]) + 1 if len(self.groups[0]) else 0

    def counts(self) -> tuple[np.ndarray, ...]:
        """Tokens of either side, groups, and links of each document."""
        a, b = (np.bincount(side.doc, minlength=self.rows) for side in self.sides)
        per_a, per_b = (np.bincount(group, minlength=self.n_groups) for group in self.groups)
        doc = np.zeros(self.n_groups, np.int64)
        doc[self.groups[0]] = self.sides[0].doc
        links = np.zeros(self.rows, np.int64)
        np.add.at(links, doc, per_a * per_b)
        return a, b, np.bincount(doc, minlength=self.rows), links

    def texts(self) -> list[bytes]:
        """The groups of each document: `a1,a2|b1;a3|b2,b3`."""
        (own, other), n = self.groups, self.n_groups
        a, b = self.sides
        before_b = np.concatenate([[0], np.cumsum(np.bincount(other, minlength=n))])
        upto_a = np.cumsum(np.bincount(own, minlength=n)) if n else np.zeros(0, np.int64)
        place = np.concatenate([np.arange(len(own)) + before_b[own], np.arange(len(other)) + upto_a[other]])
        total = len(place)
        ids, ends, docs = (np.zeros(total, np.int64) for _ in range(3))
        ids[place] = np.concatenate([a.ids, b.ids])
        docs[place] = np.concatenate([a.doc, b.doc])
        closes = [np.append(group[1:] != group[:-1], True) if len(group) else np.zeros(0, bool) for group in (own, other)]
        ends[place] = np.concatenate([np.where(closes[0], ord("|"), ord(",")), np.where(closes[1], ord(";"), ord(","))])
        width = len(str(max(a.vocabulary, b.vocabulary)))
        digits = ids[:, None] // 10 ** np.arange(width - 1, -1, -1) % 10 + 48
        shown = np.append(ids[:, None] >= 10 ** np.arange(width - 1, -1, -1), np.ones((total, 1), bool), axis=1)
        shown[:, width - 1] = True  # the id 0 too
        chars = np.append(digits, ends[:, None], axis=1).astype(np.uint8)[shown].tobytes()
        size = np.bincount(docs, shown.sum(axis=1), self.rows).astype(np.int64)
        cuts = np.concatenate([[0], np.cumsum(size)]).tolist()
        return [chars[x : y - 1] if y > x else b"" for x, y in zip(cuts, cuts[1:])]

    def links(self) -> Iterator[tuple[np.ndarray, ...]]:
        """Document, id pair (first id * vocabulary + second id) and links of that pair.

        In order of document and pair; each pair of a document comes once.
        """
        (own, other), (a, b), n = self.groups, self.sides, self.n_groups
        if not n:
            return
        named, row = np.unique(a.doc * a.vocabulary + a.ids, return_inverse=True)
        mine = Csr.counted(row, own, len(named), n)
        theirs = Csr.counted(other, b.ids, n, b.vocabulary)
        for low, high in mine.row_ranges(theirs, ENTRIES):
            rows, columns, values = mine.times(theirs, low, high)
            spot = named[rows]
            yield spot // a.vocabulary, spot % a.vocabulary * b.vocabulary + columns, values


def _slices(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """First row and texts of consecutive slices of bounded size."""
    _, bounds = utf8(texts)
    at, rows = 0, len(texts)
    while at < rows:
        end = int(np.searchsorted(bounds, bounds[at] + SLICE_BYTES, side="right")) - 1
        end = min(max(end, at + 1), rows)
        yield at, texts.slice(at, end - at)
        at = end


def _documents(documents: DataFrame) -> DataFrame:
    return documents.select(quoted("doc_id").cast("long").alias("doc_id"), quoted("text").alias("text"))


def groups(documents: DataFrame, first: str, second: str) -> DataFrame:
    """doc_id and groups (text `a1,a2|b1;a3|b2,b3`, decimal ids in order) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = ByteEncoder(first), PieceEncoder(second)
        for batch in batches:
            for at, texts in _slices(batch.column(1)):
                found = pa.array(Aligned(texts, *encoders).texts(), pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), found], ["doc_id", "groups"])

    return map_arrow(_documents(documents), run, "doc_id long, groups string")


# --- The corpus -------------------------------------------------------------------------

_PARTS = (
    "chunk long, row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
    "groups_sha256 string, at binary, times binary, pairs array<bigint>, docs array<bigint>"
)
_DOC = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")


class Chunks:
    """Rows of documents, flushed as chunks with their distinct pairs."""

    def __init__(self, partition: int):
        self.chunk = self.row = partition << 32
        self.clear()

    def clear(self) -> None:
        self.rows: list[list] = []
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.size = 0

    def document(self, values: tuple) -> None:
        """Begin the next document."""
        self.row += 1
        self.doc_id = values[0]
        self.rows.append([self.row, *values, 0])

    def add(self, pairs: np.ndarray, times: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Pairs of the document begun last; full chunks are given out."""
        while len(pairs):
            if not self.rows:  # it goes on in a new chunk
                self.rows.append([self.row, self.doc_id, 0, 0, 0, 0, None, 0])
            take = min(len(pairs), LINKS - self.size)
            self.pairs.append(pairs[:take])
            self.times.append(times[:take])
            self.rows[-1][-1] += take
            self.size += take
            pairs, times = pairs[take:], times[take:]
            if self.size == LINKS:
                yield self.flush()

    def flush(self) -> pa.RecordBatch:
        """All rows of a chunk; the first carries its distinct pairs and their documents."""
        pairs = np.concatenate([np.zeros(0, np.int64), *self.pairs])
        times = np.concatenate([np.zeros(0, np.int64), *self.times])
        distinct, at, docs = np.unique(pairs, return_inverse=True, return_counts=True)
        *columns, count = zip(*self.rows)
        cuts = np.concatenate([[0], np.cumsum(count)]).tolist()
        spans = list(zip(cuts, cuts[1:]))
        raw = [x.astype("<i4" if i == 0 else "<i8") for i, x in enumerate((at, times))]
        rest = [None] * (len(self.rows) - 1)
        schema = pa.schema(
            [(n, pa.int64()) for n in ("chunk", "row", "doc_id", "n_a", "n_b", "n_groups", "n_links")]
            + [("groups_sha256", pa.string()), ("at", pa.binary()), ("times", pa.binary())]
            + [(n, pa.list_(pa.int64())) for n in ("pairs", "docs")]
        )
        values = [
            [self.chunk] * len(self.rows), *columns,
            *[[x[a:b].tobytes() for a, b in spans] for x in raw],
            [distinct, *rest], [docs.astype(np.int64), *rest],
        ]
        out = pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, schema)], schema=schema)
        self.chunk += 1
        self.clear()
        return out


def _chunks(documents: DataFrame, first: str, second: str) -> DataFrame:
    """Rows of documents in chunks (see _PARTS); one written table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = ByteEncoder(first), PieceEncoder(second)
        chunks = Chunks(TaskContext.get().partitionId())
        for batch in batches:
            for at, texts in _slices(batch.column(1)):
                found = Aligned(texts, *encoders)
                digests = [hashlib.sha256(t).hexdigest() if t else "" for t in found.texts()]
                ids = batch.column(0).slice(at, len(texts)).to_pylist()
                values = list(zip(ids, *(c.tolist() for c in found.counts()), digests))
                done = 0
                for doc, pairs, times in found.links():
                    heads = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
                    for low, high in zip(heads.tolist(), [*heads[1:].tolist(), len(doc)]):
                        while done <= doc[low]:  # documents without pairs too
                            chunks.document(values[done])
                            done += 1
                        yield from chunks.add(pairs[low:high], times[low:high])
                for rest in values[done:]:
                    chunks.document(rest)
                if len(chunks.rows) >= LINKS // 64:
                    yield chunks.flush()
        if chunks.rows:
            yield chunks.flush()

    return materialize(map_arrow(_documents(documents), run, _PARTS), "aligned")


def _corpus_counts(chunks: DataFrame, vocabulary: int) -> DataFrame:
    """pair, n (documents that hold it linked), best (no pair of its first id has more)."""
    per_chunk = chunks.where("pairs is not null").select(F.inline(F.arrays_zip("pairs", "docs")))
    counts = per_chunk.groupBy(F.col("pairs").alias("pair")).agg(F.sum("docs").alias("n"))
    counts = materialize(counts.withColumn("a", F.expr(f"pair div {vocabulary}")), "pair-counts")
    # An id has at most as many pairs as the other vocabulary has ids.
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return counts.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _vocabulary(second: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=second).vocab_size()


def pair_counts(documents: DataFrame, first: str, second: str) -> DataFrame:
    """a_id, b_id, n_docs, best: every id pair of the corpus that is linked."""
    size = _vocabulary(second)
    counts = _corpus_counts(_chunks(documents, first, second), size)
    return counts.select(
        F.expr(f"pair div {size}").alias("a_id"), F.pmod("pair", F.lit(size)).alias("b_id"),
        F.col("n").alias("n_docs"), "best",
    )


def align(documents: DataFrame, first: str, second: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row."""
    chunks = _chunks(documents, first, second)
    counts = _corpus_counts(chunks, _vocabulary(second))
    wanted = chunks.where("pairs is not null").select("chunk", F.posexplode("pairs").alias("at", "pair"))
    known = wanted.join(counts, "pair").select(F.col("chunk").alias("of"), "at", "n", "best")

    def total(parts: pa.Table, known: pa.Table) -> pa.Table:
        size = known.num_rows
        n, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
        spot = known.column("at").to_numpy()
        n[spot], best[spot] = known.column("n").to_numpy(), known.column("best").to_numpy()
        n_best, count_sum = [], []
        for at, times in zip(parts.column("at").to_pylist(), parts.column("times").to_pylist()):
            at, times = np.frombuffer(at, "<i4"), np.frombuffer(times, "<i8")
            n_best.append(int((times * best[at]).sum()))
            count_sum.append(int((times * n[at]).sum()))
        sums = [pa.array(x, pa.int64()) for x in (n_best, count_sum)]
        names = ["row", *_DOC]
        return pa.table([*(parts.column(c) for c in names), *sums], names=[*names, "n_best", "count_sum"])

    left = chunks.select("chunk", "row", *_DOC, "at", "times").groupBy("chunk")
    schema = (
        "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
        "groups_sha256 string, n_best long, count_sum long"
    )
    summed = left.cogroup(known.groupBy("of")).applyInArrow(total, schema)
    # A document with very many pairs has several rows.
    whole = summed.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        *[F.sum(c).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")],
        F.max("groups_sha256").alias("groups_sha256"),
    )
    return whole.drop("row")
