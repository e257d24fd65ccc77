"""Join of documents whose word n-gram sets are similar, by PartEnum signatures.

A document's set holds its distinct SHINGLE-word sequences (A-Z folded), or its whole word
sequence if it has fewer words. Two documents link when 100 * intersection >= PERCENT *
union, counted exactly.

Sizes are cut into bands. A class holds the sets of one band and those larger ones that
may still be similar to one of them, so any similar pair shares a class, and within it
differs in at most k elements, k a fixed share of the band's end. The element domain is
hashed into n1 partitions of n2 parts. As k differences cannot spoil all n1 partitions by
more than k2 each, some partition has n2 - k2 unspoilt parts: every set has one signature
for each partition and each subset of n2 - k2 of its parts, and similar sets share one.
Signatures of empty parts would be shared by many; with SPARE partitions more than needed
they are left out, except where a set has more empty choices than spares. Nothing is lost.

Sets that are equal are one. Of each signature's sets, all are compared with its smallest
and its largest document first; connected sets then form groups, and what still shares a
signature across groups is compared block by block. Candidates pass a parity sketch, whose
bit differences never exceed the true ones, before their sets are read and intersected.

Null ids link with nothing (component null). Documents without words, and null texts, have
an empty set and link with nothing. Rows with one doc_id count as one document.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starledger.llm.base import binary_array, map_arrow, quoted
from starledger.llm.components import components
from starledger.llm.words import WordHasher, Words, mix
from starledger.sources.shared import discard, materialize

SHINGLE = 4
PERCENT = 85
#: First-level partitions beyond those that the differences may spoil.
SPARE = 1
#: Sets of a task that are remembered at once, so that equal ones are posted once.
SEEN = 1_000_000
#: Sets of one block when a signature's sets are compared with each other.
BLOCK = 256


class Shingles:
    """The distinct shingles of a slice of documents, by document, then by hash."""

    def __init__(self, hasher: WordHasher, words: Words, size: int):
        counts = words.counts()
        at, hashes = hasher.windows(words.hash, words.doc, size, salt=size)
        docs = [words.doc[at]]
        found = [hashes]
        # Fewer words than a shingle has: the whole sequence, told apart by its length.
        for n in range(1, size):
            short = np.flatnonzero(counts == n)
            if len(short):
                at, hashes = hasher.windows(words.hash, words.doc, n, salt=n)
                own = np.isin(words.doc[at], short)
                docs.append(words.doc[at][own])
                found.append(hashes[own])
        doc, hashes = np.concatenate(docs), np.concatenate(found)
        order = np.argsort(hashes)
        narrow = doc[order].astype(np.uint16 if words.rows < 1 << 16 else np.int64)
        order = order[np.argsort(narrow, kind="stable")]
        doc, hashes = doc[order], hashes[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
        self.doc, self.hash = doc[new], hashes[new]
        self.size = np.bincount(self.doc, minlength=words.rows)
        self.first = np.cumsum(self.size) - self.size

    def sums(self, salt: int) -> np.ndarray:
        """An order-free fingerprint of every set; 0 for the empty one."""
        out = np.zeros(len(self.size), np.uint64)
        some = self.size > 0
        if some.any():
            mixed = mix(self.hash ^ np.uint64(salt))
            out[some] = np.add.reduceat(mixed, self.first[some])
        return out


def sketch_bits(size: np.ndarray) -> np.ndarray:
    """Bits of a parity sketch as an exponent: at least 64 and twice the set's size."""
    return np.maximum(6, np.ceil(np.log2(np.maximum(2 * size, 1))).astype(np.int64))


def sketches(sets: Shingles) -> list[bytes]:
    """For each set, the parity of how many elements hash to each bit."""
    exponent = sketch_bits(sets.size)
    bits = 1 << exponent
    first = np.cumsum(bits) - bits
    spot = mix(sets.hash ^ np.uint64(0x5851F42D4C957F2D)) >> (64 - exponent[sets.doc]).astype(np.uint64)
    odd = np.bincount(first[sets.doc] + spot.astype(np.int64), minlength=int(bits.sum())) & 1
    raw = np.packbits(odd.astype(np.uint8)).tobytes()
    return [raw[a // 8 : b // 8] for a, b in zip(first.tolist(), (first + bits).tolist())]


def folded(sketch: np.ndarray, size: int) -> np.ndarray:
    """A sketch (bytes) at a smaller number of bytes: neighbouring bits are added up."""
    bits = np.unpackbits(sketch)
    while len(bits) > 8 * size:
        bits = bits[::2] ^ bits[1::2]
    return np.packbits(bits)


def most_differences(a, b, percent: int = PERCENT):
    """The most elements that only one of two similar sets of these sizes may hold."""
    return (a + b) * (100 - percent) // (100 + percent)


# --- Bands and signatures ---------------------------------------------------------------


class Classes:
    """Bands of sizes and the partitions of their classes, for sizes up to a limit."""

    def __init__(self, percent: int = PERCENT):
        self.percent = percent
        self.starts, self.ends = [1], []
        self.grow(1 << 12)

    def grow(self, size: int) -> None:
        while self.starts[-1] <= size:
            start = self.starts[-1]
            following = max(start + 1, start * 10_000 // self.percent**2)
            self.ends.append(following - 1)
            self.starts.append(following)

    def of(self, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of `sizes` and the classes each takes part in."""
        if len(sizes):
            self.grow(int(sizes.max()))
        ends = np.array(self.ends, np.int64)
        band = np.searchsorted(ends, sizes)
        rows, classes = [], []
        back = 0
        while True:
            known = (band >= back) & (sizes > 0)
            limit = ends[np.maximum(band - back, 0)] * 100 // self.percent
            fits = np.flatnonzero(known & (sizes <= limit))
            if not len(fits):
                return np.concatenate(rows or [band[:0]]), np.concatenate(classes or [band[:0]])
            rows.append(fits)
            classes.append(band[fits] - back)
            back += 1

    def parameters(self, classes: np.ndarray) -> tuple[np.ndarray, ...]:
        """k, partitions, parts of each, spare partitions; every subset has two parts."""
        ends = np.array(self.ends, np.int64)[classes]
        # a + b <= end + 100 * end / percent for the sizes of a similar pair.
        k = (ends * (100 - self.percent)) // self.percent
        few = k <= 2
        parts = np.where(k == 2, 4, 3)
        spare = np.where(few, 0, SPARE)
        return k, np.where(few, 1, k // 2 + 1) + spare, parts, spare


def signatures(sets: Shingles, classes: Classes) -> tuple[np.ndarray, np.ndarray]:
    """Rows and signatures; sets whose class allows no difference have none."""
    rows, class_ = classes.of(sets.size)
    k, partitions, parts, spare = classes.parameters(class_)
    out_rows, out = [], []
    for n_parts in (3, 4):
        use = np.flatnonzero((k > 0) & (parts == n_parts))
        if not len(use):
            continue
        row, own, n, free = rows[use], class_[use], partitions[use], spare[use]
        # The elements of every entry, one entry (set and class) after another.
        length = sets.size[row]
        entry = np.repeat(np.arange(len(row)), length)
        end = np.cumsum(length)
        hashes = sets.hash[np.repeat(sets.first[row] - end + length, length) + np.arange(end[-1])]
        slots = n * n_parts
        offset = np.cumsum(slots) - slots
        spread = (mix(hashes ^ np.uint64(0x2545F4914F6CDD1D)) >> np.uint64(32)).astype(np.int64)
        slot = offset[entry] + (spread * slots[entry] >> 32)
        value = mix(hashes ^ np.uint64(0x9FB21C651E98DF25))
        total = int(slots.sum())
        low = np.bincount(slot, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), total)
        high = np.bincount(slot, (value >> np.uint64(32)).astype(np.float64), total)
        sums = (high.astype(np.uint64) << np.uint64(32)) + low.astype(np.uint64)
        sums = sums.reshape(-1, n_parts)
        empty = (np.bincount(slot, minlength=total) == 0).reshape(-1, n_parts)
        owner = np.repeat(np.arange(len(row)), n)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        salt = mix((own[owner] << 32 | number).astype(np.uint64))
        n_empty = empty.sum(axis=1) >= 2  # partitions in which some choice is empty
        allowed = np.bincount(owner, n_empty, len(row)) > free
        for choice, (i, j) in enumerate(combinations(range(n_parts), 2)):
            kept = allowed[owner] | ~(empty[:, i] & empty[:, j])
            mixed = mix(sums[kept, i]) + np.uint64(3) * mix(sums[kept, j] + np.uint64(1))
            out.append(mix(mixed ^ mix(salt[kept] + np.uint64(choice))))
            out_rows.append(row[owner[kept]])
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(out_rows), np.concatenate(out)


# --- The join ---------------------------------------------------------------------------


def _map_sets(rows: DataFrame, build, schema: str, size: int) -> DataFrame:
    """`build(ids, sets)` gives the arrays of `schema` for each slice of documents."""
    names = [field.split()[0] for field in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(fold=True)
        for batch in batches:
            for words in hasher.slices(batch.column(1)):
                ids = batch.column(0).slice(words.first, words.rows)
                arrays = build(ids, Shingles(hasher, words, size))
                yield pa.RecordBatch.from_arrays(arrays, names)

    return map_arrow(rows, run, schema)


def shingle_sets(rows: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, two fingerprints and the sketch of every document's set."""

    def build(ids, sets):
        keys = [pa.array(sets.sums(salt).view(np.int64)) for salt in (1, 2)]
        return [ids, pa.array(sets.size.astype(np.int64)), *keys, binary_array(sketches(sets))]

    schema = "doc_id long, n_shingles long, key long, key2 long, sketch binary"
    return _map_sets(rows, build, schema, size)


def _signature_rows(rows: DataFrame, size: int, percent: int) -> DataFrame:
    """Signatures of the sets of each task; of equal sets in a task one is enough."""

    def build(ids, sets, state=[]):  # noqa: B006 - one object for the whole task
        if not state:
            state += [Classes(percent), set()]
        classes, seen = state
        row, found = signatures(sets, classes)
        keys = zip(*(sets.sums(salt).tolist() for salt in (1, 2)), sets.size.tolist())
        known = ids.is_valid().to_pylist()
        fresh = np.zeros(len(ids), bool)
        for i, (key, there) in enumerate(zip(keys, known)):
            if there and key not in seen:
                fresh[i] = True
                seen.add(key)
        if len(seen) > SEEN:
            seen.clear()
        row, found = row[fresh[row]], found[fresh[row]]
        return [pa.array(found.view(np.int64)), ids.take(pa.array(row))]

    return _map_sets(rows, build, "sig long, doc long", size)


def _parity_passes(percent: int):
    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for a, b, size_a, size_b in batches:
            limit = most_differences(size_a.to_numpy(), size_b.to_numpy(), percent)
            out = np.zeros(len(a), bool)
            for i, (x, y) in enumerate(zip(a.to_pylist(), b.to_pylist())):
                out[i] = parity_differences(x, y) <= limit[i]
            yield pa.array(out)

    run.__annotations__ = {
        "batches": Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]],
        "return": Iterator[pa.Array],
    }
    return F.arrow_udf(run, "boolean")


def parity_differences(x: bytes, y: bytes) -> int:
    """Differing bits of two sketches, at the smaller one's length."""
    if len(x) != len(y):
        small = min(len(x), len(y))
        x, y = (folded(np.frombuffer(s, np.uint8), small).tobytes() for s in (x, y))
    return (int.from_bytes(x, "little") ^ int.from_bytes(y, "little")).bit_count()


class Join:
    """The steps of one join; every step that is read twice is a written table."""

    def __init__(self, rows: DataFrame, size: int, percent: int):
        self.rows, self.size, self.percent = rows, size, percent
        self.sets = materialize(shingle_sets(rows, size), "shingle-sets")
        known = self.sets.where("doc_id is not null and n_shingles > 0")
        same = known.groupBy("n_shingles", "key", "key2").agg(F.min("doc_id").alias("rep"))
        members = known.select("doc_id", "n_shingles", "key", "key2").join(
            same, ["n_shingles", "key", "key2"]
        )
        #: The set that stands for each document's; an id with several texts has several.
        self.reps = materialize(members.select("doc_id", "rep").distinct(), "equal-sets")
        #: Size and sketch of the sets that stand for others, a row for each.
        stands = known.join(same, ["n_shingles", "key", "key2"]).where("doc_id = rep")
        stands = stands.select("rep", "n_shingles", "sketch").dropDuplicates(["rep", "sketch"])
        self.sketches = materialize(stands, "set-sketches")

    def similar(self, pairs: DataFrame) -> DataFrame:
        """Of pairs a, b of representatives, those that link."""
        a, b = (
            self.sketches.select(
                F.col("rep").alias(x), F.col("n_shingles").alias(f"n_{x}"),
                F.col("sketch").alias(f"sketch_{x}"),
            ) for x in "ab"
        )
        sized = pairs.join(a, "a").join(b, "b")
        fits = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * self.percent
        near = sized.where(fits).where(
            _parity_passes(self.percent)("sketch_a", "sketch_b", "n_a", "n_b")
        )
        near = materialize(near.select("a", "b").distinct(), "near-pairs")
        wanted = near.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
        sets = materialize(self._elements(wanted), "near-sets")
        a, b = (sets.select(F.col("doc_id").alias(x), F.col("elements").alias(f"set_{x}")) for x in "ab")
        common = F.size(F.array_intersect("set_a", "set_b"))
        union = F.size("set_a") + F.size("set_b") - common
        linked = near.join(a, "a").join(b, "b").where(common * 100 >= union * self.percent)
        linked = materialize(linked.select("a", "b"), "linked-pairs")
        discard(near, sets)
        return linked

    def _elements(self, wanted: DataFrame) -> DataFrame:
        """The sets of the wanted documents, read from their texts again."""

        def build(ids, sets):
            ends = np.append(sets.first, len(sets.hash)).astype(np.int32)
            elements = pa.ListArray.from_arrays(pa.array(ends), pa.array(sets.hash.view(np.int64)))
            return [ids, elements]

        texts = self.rows.join(wanted.hint("shuffle_hash"), "doc_id", "left_semi")
        return _map_sets(texts, build, "doc_id long, elements array<bigint>", self.size)

    def shared(self) -> DataFrame:
        """sig, doc, low, high: documents of every signature that several documents have."""
        found = _signature_rows(self.rows, self.size, self.percent).where("doc is not null")
        group = W.partitionBy("sig")
        found = found.withColumns(
            {"low": F.min("doc").over(group), "high": F.max("doc").over(group)}
        )
        return materialize(found.where("low <> high"), "shared-signatures")

    def as_reps(self, pairs: DataFrame) -> DataFrame:
        """Pairs of documents as different pairs of representatives, a < b."""
        for x in "ab":
            names = self.reps.select(F.col("doc_id").alias(x), F.col("rep").alias(f"rep_{x}"))
            pairs = pairs.join(names, x)
        pairs = pairs.where("rep_a <> rep_b")
        least, most = F.least("rep_a", "rep_b"), F.greatest("rep_a", "rep_b")
        return pairs.select(least.alias("a"), most.alias("b")).distinct()

    def across(self, shared: DataFrame, labels: DataFrame) -> DataFrame:
        """Pairs that share a signature but no component, past the sketches.

        Groups of two sets are done. Of three, the first and last document may be copies of
        one set, and the other two are not compared yet.
        """
        reps = shared.select("sig", "doc").join(self.reps, F.col("doc") == F.col("doc_id"))
        reps = reps.select("sig", "rep").distinct()
        known = labels.select(F.col("id").alias("rep"), "component")
        reps = reps.join(known, "rep", "left")
        # Written step by step, so that the shuffles of each step go before the next.
        reps = materialize(reps.withColumn("component", F.coalesce("component", "rep")), "signature-sets")
        discard(shared)
        groups = reps.groupBy("sig").agg(
            F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high"),
            F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("who"),
        )
        # Groups of the same sets are compared once.
        groups = groups.where("n > 2 and low <> high").groupBy("n", "who").agg(F.min("sig").alias("sig"))
        open_ = materialize(reps.join(groups.select("sig", "n"), "sig"), "open-signatures")
        discard(reps)
        rows = open_.join(self.sketches, "rep")
        last = F.floor((F.col("n") - 1) / BLOCK).cast("int")
        rows = rows.withColumn("mine", F.pmod(F.xxhash64("rep"), last + 1).cast("int"))
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), last)))
        keyed = rows.select(
            "sig", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"),
            "mine", "rep", "component", "n_shingles", "sketch",
        )
        percent = self.percent

        def compare(group: pa.Table) -> pa.Table:
            return _compare(group, percent)

        return keyed.groupBy("sig", "low", "high").applyInArrow(compare, "a long, b long")

    def run(self) -> DataFrame:
        """doc_id, n_shingles, component_id of every row."""
        shared = self.shared()
        low = shared.select(F.col("low").alias("a"), F.col("doc").alias("b"))
        high = shared.select(F.col("doc").alias("a"), F.col("high").alias("b"))
        stars = low.unionByName(high).where("a <> b").distinct()
        ties = self._same_id()
        links = materialize(self.similar(self.as_reps(stars)).unionByName(ties), "similar")
        labels = components(links)
        more = materialize(self.across(shared, labels).distinct(), "across")
        if not more.isEmpty():
            labels = components(links.unionByName(self.similar(more)))
        by_doc = self.reps.join(labels, F.col("rep") == F.col("id"), "left").groupBy("doc_id")
        by_doc = by_doc.agg(F.min(F.coalesce("component", "rep")).alias("component_id"))
        out = self.sets.select("doc_id", "n_shingles").join(by_doc, "doc_id", "left")
        return out.withColumn("component_id", F.coalesce("component_id", "doc_id"))

    def _same_id(self) -> DataFrame:
        """Links between the sets of rows with one doc_id."""
        first = self.reps.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b"))
        one = first.where("a <> b").select("doc_id", "a").join(self.reps, "doc_id")
        return one.select("a", F.col("rep").alias("b")).where("a <> b")


def _compare(group: pa.Table, percent: int) -> pa.Table:
    """Pairs of two blocks with different components and near sketches."""
    mine, rep, component, size = (
        group.column(name).to_numpy() for name in ("mine", "rep", "component", "n_shingles")
    )
    sketch = group.column("sketch").to_pylist()
    by_length = sorted({len(s) for s in sketch})
    left = np.flatnonzero(mine == mine.min())
    right = np.flatnonzero(mine == mine.max())
    found = []
    at = {
        length: {
            i: folded(np.frombuffer(sketch[i], np.uint8), length)
            for i in range(len(sketch)) if length <= len(sketch[i]) <= 2 * length
        } for length in by_length
    }
    for i in left:
        other = right[(component[right] != component[i]) & (rep[right] > rep[i] if len(left) == len(rep) else True)]
        low, high = np.minimum(size[other], size[i]), np.maximum(size[other], size[i])
        other = other[low * 100 >= high * percent]
        for length in by_length:
            some = [j for j in other.tolist() if min(len(sketch[i]), len(sketch[j])) == length]
            if not some or i not in at[length]:
                continue
            rows = np.stack([at[length][j] for j in some])
            apart = np.bitwise_count(rows ^ at[length][i]).sum(axis=1)
            near = apart <= most_differences(size[some], size[i], percent)
            found += [(int(rep[i]), int(rep[j])) for j, ok in zip(some, near) if ok]
    pairs = sorted({(min(p), max(p)) for p in found})
    columns = [pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)]
    return pa.table(columns, names=["a", "b"])


def jaccard_join(
    documents: DataFrame, size: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) of every row."""
    rows = documents.select(quoted("doc_id").cast("long").alias("doc_id"), quoted("text").alias("text"))
    return Join(rows, size, percent).run()
