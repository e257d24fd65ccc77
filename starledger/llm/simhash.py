"""Near duplicates by SimHash fingerprints, found by deletion-variant signatures.

A document's shingles are its SIZE-word sequences (A-Z folded, words joined by a space,
repeats included), or its whole word sequence if it has fewer words. A fingerprint bit is 1
if it is set in over half of the XXH64 hashes (seed 42) of the shingles. Documents link when
their fingerprints differ in at most DISTANCE bits.

The 64 bits are cut into DISTANCE // 2 + 1 segments. If every segment of two linked
fingerprints differed in two bits or more, they would differ in more than DISTANCE; so one
segment differs in at most one bit. Each fingerprint is posted under every segment with one
bit left out, for each bit: 64 signatures. Segments that are equal, or differ in the bit
left out, share one, so an equality join finds every link.

Only distinct fingerprints take part. Of a signature's fingerprints, all are compared with
the smallest and the largest first, which settles signatures of up to three. Where a
signature still holds several components, their fingerprints are compared block by block,
and one link is kept for each pair of components. So no list of all pairs of a group is
ever written, and groups of any size are split.

Tables that grow with the documents are joined by shuffles (hint `merge`): a file of
fingerprints is small, but Spark sizes its 64 signatures a row as if they were one, and would
broadcast them all.

Null and empty texts, and those without words, have the fingerprint zero and link like any
other. Rows with one doc_id count as one document; rows without doc_id link with nothing
(component null). Other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starledger.llm.base import map_arrow, quoted, utf8
from starledger.llm.components import components
from starledger.llm.words import SLICE_BYTES, SPACES
from starledger.sources.shared import materialize

BITS = 64
SIZE = 4
DISTANCE = 4
SEED = 42
#: Shingles hashed at once.
PART = 1 << 16
#: Fingerprints of a signature that one group of the block-wise comparison takes of either side.
BLOCK = 2048

# --- Fingerprints -----------------------------------------------------------------------

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: A byte's bits as the lowest bits of eight byte lanes.
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view("<u8")[:, 0]


class Shingled:
    """Some documents as one byte string of folded words, and where their shingles lie in it."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, size: int):
        self.rows = len(bounds) - 1
        inside = ~_IS_SPACE[data]
        before = np.zeros(len(data), bool)
        before[1:] = inside[:-1]
        heads = bounds[:-1][bounds[:-1] < len(data)]
        before[heads] = False
        starts = np.flatnonzero(inside & ~before)
        # A word keeps the one separator behind it.
        kept = inside | before
        place = np.cumsum(kept) - kept
        self.text = _LOWER[data[kept]].tobytes()
        self.text = self.text.translate(bytes(32 if _IS_SPACE[b] else b for b in range(256)))
        doc = np.searchsorted(bounds, starts, side="right") - 1
        after = np.ones(len(data), bool)
        after[:-1] = ~inside[1:]
        tails = bounds[1:][bounds[1:] > 0] - 1
        after[tails] = True
        ends = place[np.flatnonzero(inside & after)] + 1
        starts = place[starts]
        n_words = np.bincount(doc, minlength=self.rows)
        first = np.cumsum(n_words) - n_words
        self.count = np.where(n_words >= size, n_words - size + 1, np.minimum(n_words, 1))
        own = np.repeat(np.arange(self.rows), self.count)
        step = np.arange(len(own)) - np.repeat(np.cumsum(self.count) - self.count, self.count)
        low = first[own] + step
        self.start = starts[low]
        self.end = ends[low + np.minimum(n_words[own], size) - 1]

    def hashes(self, low: int, high: int) -> np.ndarray:
        """XXH64 of the shingles from `low` to `high`."""
        from xxhash import xxh64_intdigest

        text, places = self.text, zip(self.start[low:high].tolist(), self.end[low:high].tolist())
        return np.fromiter((xxh64_intdigest(text[a:b], SEED) for a, b in places), "<u8", high - low)

    def prints(self) -> np.ndarray:
        """A fingerprint for each document."""
        counts = np.zeros((self.rows, BITS), np.int64)
        ends = np.cumsum(self.count)
        for low in range(0, int(ends[-1]) if self.rows else 0, PART):
            high = min(low + PART, int(ends[-1]))
            doc = np.searchsorted(ends, np.arange(low, high), side="right")
            _add_bits(counts, self.hashes(low, high), doc)
        ones = 2 * counts > self.count[:, None]
        return np.packbits(ones, axis=1, bitorder="little").view("<u8")[:, 0]


def _add_bits(counts: np.ndarray, hashes: np.ndarray, doc: np.ndarray) -> None:
    """Add to each document's counts how many of its hashes have each bit; `doc` ascends."""
    lanes = _LANES[hashes.view(np.uint8)].reshape(-1, 8)
    heads = np.ones(len(doc), bool)
    heads[1:] = doc[1:] != doc[:-1]
    heads[:: 255] = True  # the sum of a lane stays below 256
    at = np.flatnonzero(heads)
    sums = np.add.reduceat(lanes, at, axis=0).view(np.uint8)
    np.add.at(counts, doc[at], sums)


def fingerprints_of(texts: pa.Array, size: int = SIZE) -> np.ndarray:
    """The fingerprint of each text; null is the empty text."""
    data, bounds = utf8(texts)
    out, at, rows = np.zeros(len(bounds) - 1, "<u8"), 0, len(bounds) - 1
    while at < rows:
        end = int(np.searchsorted(bounds, bounds[at] + SLICE_BYTES, side="right")) - 1
        end = min(max(end, at + 1), rows)
        low, high = int(bounds[at]), int(bounds[end])
        out[at:end] = Shingled(data[low:high], bounds[at : end + 1] - low, size).prints()
        at = end
    return out


def fingerprints(documents: DataFrame, size: int = SIZE) -> DataFrame:
    """doc_id and fingerprint (64 bits as a signed long) of every row."""
    rows = documents.select(quoted("doc_id").cast("long").alias("doc_id"), quoted("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = fingerprints_of(batch.column(1), size).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["doc_id", "print"])

    return map_arrow(rows, run, "doc_id long, print long")


# --- Signatures -------------------------------------------------------------------------


def segments(distance: int = DISTANCE) -> list[tuple[int, int]]:
    """First and last bit (exclusive) of each segment."""
    n = distance // 2 + 1
    cuts = [round(BITS * i / n) for i in range(n + 1)]
    return list(zip(cuts, cuts[1:]))


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def signatures(bits: Column, distance: int = DISTANCE) -> Column:
    """The 64 signatures of a fingerprint: a segment less one of its bits, and which bit.

    A signature's number of a bit takes the place of what lies outside the segment; where
    the segment leaves no room for it, both are hashed.
    """
    out = []
    for low, high in segments(distance):
        for bit in range(low, high):
            mask = ((1 << high) - (1 << low)) & ~(1 << bit)
            rest = F.shiftrightunsigned(bits.bitwiseAND(F.lit(_signed(mask))), low)
            if high - low <= 48:
                out.append(rest.bitwiseOR(F.lit(_signed(bit << 48))))
            else:
                out.append(F.xxhash64(rest, F.lit(bit)))
    return F.array(*out)


def _near(a: str, b: str, distance: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= distance


# --- Links and components ---------------------------------------------------------------


def _shared(distinct: DataFrame, distance: int) -> DataFrame:
    """sig, print, n, low, high: what signatures that several fingerprints have still say.

    That is fingerprints near the smallest or the largest, and all of signatures of more
    than three; two or three that are not near have nothing more to be compared with.
    """
    posted = distinct.select(F.explode(signatures(F.col("print"), distance)).alias("sig"), "print")
    ends = posted.groupBy(F.col("sig").alias("of")).agg(
        F.min("print").alias("low"), F.max("print").alias("high"), F.count("*").alias("n")
    )
    settled = (F.col("n") <= 3) & ~_linked("low", distance) & ~_linked("high", distance)
    met = (F.col("sig") == F.col("of")) & ~settled
    shared = posted.join(ends.where("low <> high").hint("merge"), met).drop("of")
    return materialize(shared, "shared-signatures")


def _linked(end: str, distance: int) -> Column:
    return (F.col("print") != F.col(end)) & _near("print", end, distance)


def _stars(shared: DataFrame, distance: int) -> DataFrame:
    """Links of each signature's fingerprints with its smallest and its largest."""
    low = shared.where(_linked("low", distance)).select(F.col("low").alias("a"), F.col("print").alias("b"))
    high = shared.where(_linked("high", distance)).select(F.col("print").alias("a"), F.col("high").alias("b"))
    return low.unionByName(high).distinct()


def _across(shared: DataFrame, labels: DataFrame, distance: int) -> DataFrame:
    """Pairs a, b of components that a link joins, found in signatures that hold several."""
    rows = shared.where("n > 3").select("sig", "print", "n")
    rows = rows.join(labels.select(F.col("id").alias("print"), "component").hint("merge"), "print", "left")
    rows = materialize(rows.withColumn("component", F.coalesce("component", "print")), "open-signatures")
    open_ = rows.groupBy("sig").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    rows = rows.join(open_.where("low <> high").select("sig").hint("merge"), "sig", "left_semi")
    n_blocks = F.ceil(F.col("n") / BLOCK)
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("print"), n_blocks))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), n_blocks - 1)))
    keys = ["sig", "first", "second"]
    keyed = rows.select(
        "sig", F.least("mine", "other").alias("first"), F.greatest("mine", "other").alias("second"),
        "print", "component",
    )
    # Groups arrive whole and sorted, many to a batch.
    keyed = keyed.repartition(*keys).sortWithinPartitions(*keys)
    spots = keyed.select(F.xxhash64(*keys).alias("spot"), "print", "component")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = [np.zeros(0, np.int64)] * 3
        for batch in batches:
            own = [np.concatenate([r, batch.column(i).to_numpy()]) for i, r in enumerate(rest)]
            # The last group may go on in the next batch.
            cut = int(np.flatnonzero(np.append(True, own[0][1:] != own[0][:-1]))[-1]) if len(own[0]) else 0
            yield _pairs(*[x[:cut] for x in own], distance)
            rest = [x[cut:] for x in own]
        yield _pairs(*rest, distance)

    return materialize(spots.mapInArrow(run, "a long, b long").distinct(), "component-links")


def _pairs(spot: np.ndarray, bits: np.ndarray, component: np.ndarray, distance: int) -> pa.RecordBatch:
    """Pairs of components of which two fingerprints of one group are near."""
    found = [np.zeros((0, 2), np.int64)]
    at = np.arange(len(spot))
    for step in range(1, len(spot)):
        at = at[at + step < len(spot)]
        at = at[spot[at] == spot[at + step]]
        if not len(at):
            break
        apart = at[component[at] != component[at + step]]
        near = apart[np.bitwise_count(bits[apart] ^ bits[apart + step]) <= distance]
        if len(near):
            pair = np.sort(np.stack([component[near], component[near + step]], axis=1), axis=1)
            found.append(np.unique(pair, axis=0))
    pairs = np.unique(np.concatenate(found), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def near_duplicates(documents: DataFrame, size: int = SIZE, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row.

    component_id is the smallest doc_id that links lead to, the document itself included.
    """
    prints = materialize(fingerprints(documents, size), "fingerprints")
    known = prints.where("doc_id is not null")
    distinct = materialize(known.groupBy("print").agg(F.min("doc_id").alias("rep")), "distinct-prints")
    shared = _shared(distinct, distance)
    labels = components(_stars(shared, distance).unionByName(_same_id(known)))
    across = _across(shared, labels, distance)
    joined = labels.limit(0) if across.isEmpty() else components(across)
    whole = joined.select(F.col("id").alias("component"), F.col("component").alias("whole"))
    merged = labels.join(whole.hint("merge"), "component", "left")
    first = merged.select(F.col("id").alias("print"), F.coalesce("whole", "component").alias("component"))
    # Components that had no link yet but got one now stand for themselves.
    own = joined.join(labels.select("id").hint("merge"), "id", "left_anti")
    first = first.unionByName(own.select(F.col("id").alias("print"), "component"))
    placed = distinct.join(first.hint("merge"), "print", "left").withColumn("component", F.coalesce("component", "print"))
    placed = materialize(placed, "placed-prints")
    least = placed.groupBy("component").agg(F.min("rep").alias("component_id"))
    placed = placed.join(least.hint("merge"), "component").select("print", "component_id")
    out = prints.join(placed.hint("merge"), "print", "left")
    return out.select(
        "doc_id",
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def _same_id(known: DataFrame) -> DataFrame:
    """Links between the fingerprints of rows with one doc_id."""
    first = known.groupBy("doc_id").agg(F.min("print").alias("a"), F.max("print").alias("b"))
    several = first.where("a <> b").select("doc_id", "a").join(known.hint("merge"), "doc_id")
    return several.select("a", F.col("print").alias("b")).where("a <> b").distinct()
