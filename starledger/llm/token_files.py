"""Token ids in binary files with Elias-Fano document boundaries.

A file holds one segment: consecutive documents in ascending doc_id order. Its layout,
little-endian throughout:

- 256 bytes of JSON padded with blanks: part and number (the segment's place in the whole),
  n_docs, n_null, n_tokens, width (bytes of an id), first_id, and for each of the two
  sequences its low bits, low bytes and high bytes
- the ends of the documents (running token counts) as an Elias-Fano sequence
- the doc ids less first_id as an Elias-Fano sequence; null ids come first and are counted
- all ids, one document after another, `width` bytes each

An Elias-Fano sequence of n values up to u stores floor(log2(u / n)) low bits of each
value as they are and the rest in unary: value i sets bit (value >> low) + i of the high
part. That is at most 2 + log2(u / n) bits a value, and `select` finds any value without
decoding those before it. Spark's text writer adds one line feed after the segment.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starledger.llm.base import map_arrow, quoted
from starledger.llm.encode import Encoder

HEADER = 256
#: Bytes of ids after which a segment is closed; a longer document fills one of its own.
SEGMENT_BYTES = 16 << 20
#: Most segments whose starts are broadcast: some 20 MB.
BROADCAST_SEGMENTS = 1_000_000
#: Every so many set bits the byte position is noted when a file is opened.
SAMPLE = 512
ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)


class EliasFano:
    """A non-decreasing sequence in near-minimal space."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        counts = ONES[np.frombuffer(high, np.uint8)]
        ends = np.cumsum(counts, dtype=np.int64)
        at = np.searchsorted(ends, np.arange(0, n, SAMPLE), side="right")
        #: Byte that holds every SAMPLE-th set bit, and the set bits before that byte.
        self.samples = at
        self.before = ends[at] - counts[at] if n else at

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n, top = len(values), int(values[-1]) if len(values) else 0
        low_bits = max(0, (top // n).bit_length() - 1) if n else 0
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = ((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
        bits = np.zeros((top >> low_bits) + n, np.uint8)
        bits[(values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)] = 1
        packed = [np.packbits(x.ravel(), bitorder="little").tobytes() for x in (low, bits)]
        return cls(n, low_bits, *packed)

    def select(self, i: int) -> int:
        """Value i, from the nearest sample before it."""
        sample = i // SAMPLE
        byte, left = int(self.samples[sample]), i - int(self.before[sample])
        while left >= ONES[self.high[byte]]:
            left -= int(ONES[self.high[byte]])
            byte += 1
        bits = [b for b in range(8) if self.high[byte] >> b & 1]
        upper = 8 * byte + bits[left] - i
        at = i * self.low_bits
        chunk = int.from_bytes(self.low[at // 8 : (at + self.low_bits + 7) // 8], "little")
        return upper << self.low_bits | (chunk >> at % 8) & ((1 << self.low_bits) - 1)

    def values(self) -> np.ndarray:
        """All values."""
        high = np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little")
        upper = (np.flatnonzero(high)[: self.n] - np.arange(self.n)).astype(np.uint64)
        low = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little")
        low = low[: self.n * self.low_bits].reshape(self.n, self.low_bits).astype(np.uint64)
        weights = np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64)
        return (upper << np.uint64(self.low_bits)) | (low * weights).sum(axis=1, dtype=np.uint64)


class TokenFile:
    """One segment as it lies in a file."""

    def __init__(self, content: bytes):
        self.header = head = json.loads(content[:HEADER])
        self.n_docs, self.width = head["n_docs"], head["width"]
        at, sequences = HEADER, []
        for n, low_bits, low, high in (
            (head["n_docs"], *head["ends"]),
            (head["n_docs"] - head["n_null"], *head["ids"]),
        ):
            sequences.append(
                EliasFano(n, low_bits, content[at : at + low], content[at + low : at + low + high])
            )
            at += low + high
        self.ends, self.numbers = sequences
        self.tokens = memoryview(content)[at : at + head["n_tokens"] * self.width]

    def offset(self, i: int) -> int:
        """Ids in this segment before document i; i may be n_docs."""
        return self.ends.select(i - 1) if i else 0

    def doc_ids(self) -> list[int | None]:
        known = self.numbers.values().astype(np.int64) + self.header["first_id"]
        return [None] * self.header["n_null"] + known.tolist()

    def ids(self, i: int) -> np.ndarray:
        low, high = self.offset(i), self.offset(i + 1)
        return np.frombuffer(self.tokens[low * self.width : high * self.width], f"<u{self.width}")

    @staticmethod
    def pack(
        doc_ids: list[int | None], tokens: list[bytes], width: int, part: int, number: int
    ) -> bytes:
        ends = np.cumsum([len(ids) // width for ids in tokens])
        known = [i for i in doc_ids if i is not None]
        first = known[0] if known else 0
        # Differences of 64-bit ids may need all 64 bits.
        gaps = np.array(known, np.int64).view(np.uint64) - np.array([first], np.int64).view(np.uint64)
        sequences = EliasFano.encode(ends), EliasFano.encode(gaps)
        header = {
            "part": part, "number": number, "n_docs": len(doc_ids),
            "n_null": len(doc_ids) - len(known), "n_tokens": int(ends[-1]), "width": width,
            "first_id": first,
        }
        for name, one in zip(("ends", "ids"), sequences):
            header[name] = [one.low_bits, len(one.low), len(one.high)]
        head = json.dumps(header).encode().ljust(HEADER)
        return b"".join([head, *(x for s in sequences for x in (s.low, s.high)), *tokens])


def write_tokens(
    documents: DataFrame, path: str, tokenizer: str, end: int = 1, width: int = 2
) -> None:
    """Encode `doc_id`, `text` with the tokenizer file, one segment a file below `path`.

    Null texts are empty and give the end id alone. Rows go to range partitions by doc_id
    (nulls first); rows with one doc_id may be split and are ordered by a hash of the text,
    so rows that repeat change nothing. Without rows there are no segments.
    """
    rows = documents.select(quoted("doc_id").cast("long").alias("doc_id"), quoted("text").alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    spread = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer, end, joined_spaces=False, fold=True, dtype=f"<u{width}")
        part, number = TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        tokens: list[bytes] = []
        held = 0

        def segment() -> pa.RecordBatch:
            packed = TokenFile.pack(doc_ids, tokens, width, part, number)
            return pa.RecordBatch.from_arrays([pa.array([packed], pa.binary())], ["segment"])

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for doc_id, piece in zip(ids, encoder.encode(batch.column(1))):
                doc_ids.append(doc_id)
                tokens.append(piece)
                held += len(piece)
                if held >= SEGMENT_BYTES:
                    yield segment()
                    doc_ids, tokens, held, number = [], [], 0, number + 1
        if doc_ids:
            yield segment()

    segments = map_arrow(spread, run, "segment binary")
    # The text writer stores the bytes as they are, on any file system that Spark knows.
    raw = segments.select(F.col("segment").cast("string").alias("value"))
    raw.write.option("maxRecordsPerFile", 1).text(path)


HEADER_TYPE = "part int, number int, n_tokens long"


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the files below `path`: doc_id, start, n_tokens, ids.

    `start` counts the ids of all documents before; `ids` are little-endian unsigned
    32-bit integers. Starts of segments come from the headers alone.
    """
    files = (
        spark.read.format("binaryFile").load(path).where("length > 1").select("content")
    )
    header = F.from_json(F.substring("content", 1, HEADER).cast("string"), HEADER_TYPE)
    before = W.orderBy("part", "number").rowsBetween(W.unboundedPreceding, -1)
    segments = (
        files.select(header.alias("h"))
        .select("h.part", "h.number", "h.n_tokens")
        .select("part", "number", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("base"))
    )
    rows = map_arrow(
        files, _documents, "part int, number int, doc_id long, first long, n_tokens long, ids binary"
    )
    # One small row a segment; beyond the bound Spark joins by shuffling.
    if segments.count() <= BROADCAST_SEGMENTS:
        segments = F.broadcast(segments)
    return rows.join(segments, ["part", "number"]).select(
        "doc_id", (F.col("base") + F.col("first")).alias("start"), "n_tokens", "ids"
    )


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["part", "number", "doc_id", "first", "n_tokens", "ids"]
    for batch in batches:
        for content in batch.column(0):
            file = TokenFile(content.as_py())
            doc_ids = file.doc_ids()
            bounds = np.concatenate([[0], file.ends.values().astype(np.int64)])
            ids = np.frombuffer(file.tokens, f"<u{file.width}")
            step = max(1, len(doc_ids) * (2 << 20) // (len(ids) + 1))
            for at in range(0, len(doc_ids), step):
                some = bounds[at : at + step + 1]
                n = len(some) - 1
                wide = ids[some[0] : some[-1]].astype("<u4")
                ends = ((some - some[0]) * 4).astype(np.int32)
                columns = [
                    pa.array([file.header["part"]] * n, pa.int32()),
                    pa.array([file.header["number"]] * n, pa.int32()),
                    pa.array(doc_ids[at : at + n], pa.int64()),
                    pa.array(some[:-1]),
                    pa.array(np.diff(some)),
                    pa.BinaryArray.from_buffers(
                        pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(wide)]
                    ),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)
