"""Packing of documents into sequences along a space-filling curve.

Each document becomes a hashed vector of its words, projected to DIMENSIONS numbers by
random signs taken from the word hashes. The cell of that point gets its index on a
Hilbert curve; documents are range-sorted by it, so neighbours on the curve, which are
near in the projected space, share sequences. Ties and hot cells are split by a hash of
the id and the text.

Within a partition the ids run on from document to document and are cut every LENGTH
ids. What is left at the end of a partition is cut into lengths that are powers of two,
which need no padding, so no id is padding anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starledger.llm.base import map_arrow, quoted
from starledger.llm.encode import Encoder
from starledger.llm.words import WordHasher

LENGTH = 2048
DIMENSIONS = 3
#: Bits of one coordinate; with the dimensions at most 63 together.
BITS = 12
#: Coordinates beyond this share of their range are cut off.
REACH = 0.5
#: Ids handed on at once.
BATCH_IDS = 1 << 20


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of each row of cells (n x dimensions), by bit exchanges."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    bit = 1 << (bits - 1)
    while bit > 1:
        below = bit - 1
        for i in range(n):
            hit = (x[i] & bit) != 0
            swapped = np.where(hit, 0, (x[0] ^ x[i]) & below)
            x[0] ^= np.where(hit, below, swapped)
            if i:
                x[i] ^= swapped
        bit >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    bit = 1 << (bits - 1)
    while bit > 1:
        turn ^= np.where((x[n - 1] & bit) != 0, bit - 1, 0)
        bit >>= 1
    x ^= turn
    index = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            index = index << 1 | (x[i] >> b) & 1
    return index


def curve_key(text: Column) -> Column:
    """Hilbert index of a text; texts without words lie at the middle of the range."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        hasher = WordHasher(fold=True)
        for column in batches:
            out = np.zeros(len(column), np.int64)
            for words in hasher.slices(column):
                total = np.maximum(words.counts(), 1)
                cells = np.zeros((words.rows, DIMENSIONS), np.int64)
                for d in range(DIMENSIONS):
                    sign = (words.hash >> np.uint64(11 + 16 * d) & np.uint64(1)).astype(float) * 2 - 1
                    mean = np.bincount(words.doc, sign, words.rows) / total
                    share = np.clip(mean / REACH, -1, 1) / 2 + 0.5
                    cells[:, d] = np.minimum(share * (1 << BITS), (1 << BITS) - 1)
                out[words.first : words.first + words.rows] = hilbert_index(cells, BITS)
            yield pa.array(out)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "long")(text)


PIECE = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
)


def pack(documents: DataFrame, tokenizer: str, end: int = 1) -> DataFrame:
    """Pieces of all documents with their place in a sequence.

    doc_id, start (ids of the document before the piece), length, doc_tokens, sequence_id,
    offset in the sequence, ids (little-endian unsigned 32-bit). Every document ends with
    the id `end`; null and empty texts are that id alone. Each row of the input is packed,
    also one that repeats; other columns are ignored. No rows give no pieces.
    """
    rows = documents.select(quoted("doc_id").cast("long").alias("doc_id"), quoted("text").alias("text"))
    keyed = rows.withColumn("key", curve_key(F.col("text")))
    order = ["key", F.xxhash64("doc_id", "text")]
    spread = keyed.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer, end, joined_spaces=True, fold=False)
        packer = Packer(TaskContext.get().partitionId())
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for doc_id, tokens in zip(ids, encoder.encode(batch.column(1))):
                packer.add(doc_id, tokens)
                if packer.held > BATCH_IDS:
                    yield packer.full()
        yield packer.rest()

    return map_arrow(spread.select("doc_id", "text"), run, PIECE)


class Packer:
    """Cuts a stream of documents into sequences; ids are bytes, four each."""

    def __init__(self, part: int):
        self.sequence, self.filled = part << 32, 0
        self.pieces: list[tuple] = []
        self.ids: list[bytes] = []
        self.held = 0

    def add(self, doc_id: int | None, tokens: bytes) -> None:
        total, at = len(tokens) // 4, 0
        self.held += total
        while at < total:
            length = min(LENGTH - self.filled, total - at)
            self._piece(doc_id, at, length, total, tokens[4 * at : 4 * (at + length)])
            at += length

    def _piece(self, doc_id, start, length, total, ids) -> None:
        self.pieces.append((doc_id, start, length, total, self.sequence, self.filled))
        self.ids.append(ids)
        self.filled += length
        if self.filled == LENGTH:
            self.sequence, self.filled = self.sequence + 1, 0

    def _take(self, n: int) -> pa.RecordBatch:
        rows, ids = self.pieces[:n], self.ids[:n]
        self.pieces, self.ids = self.pieces[n:], self.ids[n:]
        columns = list(zip(*rows)) if rows else [()] * 6
        arrays = [pa.array(column, pa.int64()) for column in columns]
        names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(ids, pa.binary())], names)

    def full(self) -> pa.RecordBatch:
        """The pieces of all full sequences."""
        open_pieces = 0
        while open_pieces < len(self.pieces) and self.pieces[-1 - open_pieces][4] == self.sequence:
            open_pieces += 1
        self.held = self.filled
        return self._take(len(self.pieces) - open_pieces)

    def rest(self) -> pa.RecordBatch:
        """The remaining pieces; the open sequence is cut at powers of two."""
        left, self.held = self.filled, 0
        done = [i for i, piece in enumerate(self.pieces) if piece[4] == self.sequence]
        if left and done:
            tail = list(zip(self.pieces[done[0] :], self.ids[done[0] :]))
            self.pieces, self.ids = self.pieces[: done[0]], self.ids[: done[0]]
            self.filled, room = 0, 1 << (left.bit_length() - 1)
            for (doc_id, start, length, total, _, _), ids in tail:
                at = 0
                while at < length:
                    take = min(room - self.filled, length - at)
                    self._piece(doc_id, start + at, take, total, ids[4 * at : 4 * (at + take)])
                    at, left = at + take, left - take
                    if self.filled == room and left:
                        self.sequence, self.filled = self.sequence + 1, 0
                        room = 1 << (left.bit_length() - 1)
        return self._take(len(self.pieces))
