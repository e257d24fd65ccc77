"""Removal of repeated passages, with a count-min prefilter.

A window is WINDOW consecutive words of one document. A word is removed if it lies in a
window whose word sequence also starts in a document with a smaller doc_id, judged on the
input as it is.

First pass: every task counts its windows in a count-min sketch of DEPTH rows of counters
that stop at two, and writes the counters that it hit, segment by segment, as byte-coded
gaps. The sketches are added up by segment; what is left is one bit a counter: two or
more. A row has two counters for every window, up to 2**BITS; so the bits, which are
broadcast, never exceed 64 MB. Counts are only ever overestimated, so no repeated window
is lost.

Second pass: only windows that all rows of the sketch call repeated are grouped, exactly,
by their 64-bit hash. Each task first settles what it can: of its documents with one window
only the smallest goes on, so a window in a third of all documents is a row a task. A
corpus that fills the sketch lets more windows through, which costs shuffle, not results.

Rows without id remove nothing and lose nothing. Null and empty texts have no words. Rows
that repeat with their id are treated alike and do not remove each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starledger.llm.base import map_arrow, quoted
from starledger.llm.words import WordHasher, mix

WINDOW = 13
DEPTH = 2
#: Most counters of a row, and the counters of a segment, as exponents.
BITS = 28
SEGMENT_BITS = 20
#: Bytes of text that stand for one word when the sketch is sized.
WORD_BYTES = 6
#: Windows that a task sketches at once, and candidates that it settles at once.
HELD, SETTLED = 1 << 21, 1 << 20


def counters(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    """The counter of each window in a row of the sketch."""
    salt = np.uint64(0x9E3779B97F4A7C15 * (row + 1) & (1 << 64) - 1)
    return (mix(hashes ^ salt) >> np.uint64(64 - bits)).astype(np.uint32)


def gaps(numbers: np.ndarray) -> bytes:
    """Ascending numbers as bytes: each gap as so many 255 and a smaller rest."""
    gap = np.diff(numbers, prepend=0)
    ends = np.cumsum(gap // 255 + 1)
    out = np.full(int(ends[-1]), 255, np.uint8)
    out[ends - 1] = gap % 255
    return out.tobytes()


def from_gaps(raw: bytes) -> np.ndarray:
    steps = np.frombuffer(raw, np.uint8)
    return np.cumsum(steps, dtype=np.int64)[steps != 255]


def _sketch(batches: Iterator[pa.RecordBatch], window: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Rows (segment, counts): counters that the task's windows hit, each twice at most."""
    hasher = WordHasher()
    held: list[np.ndarray] = []
    size = 0
    for batch in batches:
        for words in hasher.slices(batch.column(1)):
            _, hashes = hasher.windows(words.hash, words.doc, window)
            held.append(hashes)
            size += len(hashes)
            if size >= HELD:
                yield from _sketched(np.concatenate(held), bits)
                held, size = [], 0
    if size:
        yield from _sketched(np.concatenate(held), bits)


def _sketched(hashes: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    for row in range(DEPTH):
        numbers = np.sort(counters(hashes, row, bits))
        third = np.zeros(len(numbers), bool)
        third[2:] = numbers[2:] == numbers[:-2]
        numbers = numbers[~third]
        starts = np.arange(0, (1 << bits) + 1, 1 << SEGMENT_BITS)
        cuts = np.searchsorted(numbers, starts)
        segments = np.flatnonzero(np.diff(cuts))
        blobs = [
            gaps(numbers[cuts[s] : cuts[s + 1]].astype(np.int64) - starts[s]) for s in segments
        ]
        named = segments + (row << (bits - SEGMENT_BITS))
        arrays = [pa.array(named.astype(np.int32)), pa.array(blobs, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, ["segment", "counts"])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by segment; each segment's counts become one bit a counter."""
    current, total = None, np.zeros(1 << SEGMENT_BITS, np.uint8)

    def done() -> pa.RecordBatch:
        bits = np.packbits(total >= 2, bitorder="little").tobytes()
        arrays = [pa.array([current], pa.int32()), pa.array([bits], pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, ["segment", "bits"])

    for batch in batches:
        for segment, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if segment != current:
                if current is not None:
                    yield done()
                current, total = segment, np.zeros(1 << SEGMENT_BITS, np.uint8)
            numbers = from_gaps(counts)
            again = np.append(False, numbers[1:] == numbers[:-1])
            total[numbers[~again]] += 1
            total[numbers[again]] += 1
            np.minimum(total, 2, out=total)
    if current is not None:
        yield done()


def repeated_counters(rows: DataFrame, window: int = WINDOW) -> np.ndarray:
    """One bit for every counter of the merged sketch, a row each, that is two or more."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(BITS, max(SEGMENT_BITS, (2 * size // WORD_BYTES).bit_length()))
    parts = map_arrow(
        rows, lambda batches: _sketch(batches, window, bits), "segment int, counts binary"
    )
    sorted_parts = parts.repartition("segment").sortWithinPartitions("segment")
    out = np.zeros((DEPTH << bits) // 8, np.uint8)
    step = (1 << SEGMENT_BITS) // 8
    for row in map_arrow(sorted_parts, _merged, "segment int, bits binary").collect():
        out[row.segment * step : (row.segment + 1) * step] = np.frombuffer(row.bits, np.uint8)
    return out.reshape(DEPTH, -1)


class Prefilter:
    def __init__(self, rows: np.ndarray):
        self.rows, self.bits = rows, (8 * rows.shape[1]).bit_length() - 1

    def passes(self, hashes: np.ndarray) -> np.ndarray:
        """Which windows every row of the sketch calls repeated."""
        left = np.arange(len(hashes))
        for row, bits in enumerate(self.rows):
            at = counters(hashes[left], row, self.bits)
            hit = (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1
            left = left[hit.astype(bool)]
        return left


def repeated_windows(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc, hash of the windows that also start in a document with a smaller id."""
    model = rows.sparkSession.sparkContext.broadcast(repeated_counters(rows, window))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, prefilter = WordHasher(), Prefilter(model.value)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            valid = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            for words in hasher.slices(batch.column(1)):
                at, hashes = hasher.windows(words.hash, words.doc, window)
                kept = prefilter.passes(hashes)
                row = words.first + words.doc[at[kept]]
                known = valid[row]
                held.append((hashes[kept][known], ids[row[known]]))
                size += len(held[-1][0])
                if size >= SETTLED:
                    yield _settled(held)
                    held, size = [], 0
        if size:
            yield _settled(held)

    found = map_arrow(rows, run, "hash long, doc long, settled long")
    # What a task has settled forms groups of its own, which are spread by document.
    first = F.min("doc").over(W.partitionBy("hash", "settled"))
    found = found.withColumn("first", first)
    return found.where("settled is not null or doc > first").select("doc", "hash")


def _settled(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Each window once a document; `settled` (the id) where the task has a smaller one."""
    hashes, docs = (np.concatenate(x) for x in zip(*held))
    order = np.lexsort((docs, hashes))
    hashes, docs = hashes[order], docs[order]
    start = np.ones(len(hashes), bool)
    start[1:] = hashes[1:] != hashes[:-1]
    new = start.copy()
    new[1:] |= docs[1:] != docs[:-1]
    settled = pa.array(docs[new], mask=start[new])
    arrays = [pa.array(hashes[new].view(np.int64)), pa.array(docs[new]), settled]
    return pa.RecordBatch.from_arrays(arrays, ["hash", "doc", "settled"])


def remove_repeats(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, text: the kept words joined by one space, of every row."""
    rows = documents.select(quoted("doc_id").cast("long").alias("doc_id"), quoted("text").alias("text"))
    marked = repeated_windows(rows, window).groupBy("doc").agg(F.collect_list("hash").alias("marks"))
    joined = rows.join(marked.hint("shuffle_hash"), F.col("doc_id") == F.col("doc"), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            for words in hasher.slices(batch.column(1)):
                part = batch.slice(words.first, words.rows)
                yield _kept(hasher, words, part.column(0), part.column(2), window)

    schema = "doc_id long, n_words long, n_removed long, text string"
    return map_arrow(joined.select("doc_id", "text", "marks"), run, schema)


def _kept(hasher: WordHasher, words, ids: pa.Array, marks: pa.Array, window: int) -> pa.RecordBatch:
    n = len(words.hash)
    at, hashes = hasher.windows(words.hash, words.doc, window)
    lists = marks.is_valid().to_numpy(zero_copy_only=False)
    covered = np.zeros(n + 1, np.int64)
    if lists.any() and len(at):
        low = np.searchsorted(words.doc[at], np.arange(words.rows))
        high = np.append(low[1:], len(at))
        for row in np.flatnonzero(lists):
            own = slice(int(low[row]), int(high[row]))
            wanted = np.array(marks[row].values, np.int64).view(np.uint64)
            hit = at[own][np.isin(hashes[own], wanted)]
            np.add.at(covered, hit, 1)
            np.add.at(covered, hit + window, -1)
    removed = np.cumsum(covered)[:n] > 0
    kept = np.flatnonzero(~removed)
    start, length = words.start[kept], words.ends()[kept] - words.start[kept]
    done = np.cumsum(length + 1)
    # Each word with the byte behind it, which becomes the blank between words.
    source = np.repeat(start - done + length + 1, length + 1) + np.arange(int(done[-1]) if n and len(kept) else 0)
    data = words.data[np.minimum(source, max(len(words.data) - 1, 0))]
    if len(kept):
        data[done - 1] = 32
    n_kept = np.bincount(words.doc[kept], minlength=words.rows)
    size = np.bincount(words.doc[kept], length + 1, words.rows).astype(np.int64)
    raw, end = data.tobytes(), np.cumsum(size)
    texts = [raw[b - s : b - 1] if s else b"" for b, s in zip(end.tolist(), size.tolist())]
    total = words.counts()
    arrays = [ids, pa.array(total), pa.array(total - n_kept), pa.array(texts, pa.binary()).cast(pa.string())]
    return pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "n_removed", "text"])
