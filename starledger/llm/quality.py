"""Importance resampling: documents like a target set, sampled in proportion to their weight.

Words and word pairs (A-Z folded) are hashed into BUCKETS. Two generative models are
fitted as bucket frequencies: the raw model over all documents, the target model over the
labelled target documents, smoothed towards the raw model. The log weight of a document is
the mean log ratio target / raw over its n-grams, times LENGTH: the log importance weight
of a text of that many n-grams, so long and short texts compare. Gumbel noise, drawn from
a hash of the row, is added, and the rows with the k greatest sums are the sample: sampling
without replacement with chances in proportion to the weights.

The raw counts, the weights and the sample cover every document. Only the target set may
be bounded: TARGET_ROWS labelled documents, those with the smallest hashes.

Texts without words, and null texts, have no weight and are never sampled; rows that
repeat have equal sums and are kept or left together. Without target rows all weights are
equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.llm.base import map_arrow, quoted
from starledger.llm.words import Words, WordHasher
from starledger.sources.shared import materialize

BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
LENGTH = 100.0
#: Weight of the raw model in the smoothed target model, as a number of n-grams a bucket.
SMOOTHING = 2.0
#: Most labelled documents that the target model is fitted on.
TARGET_ROWS = 20_000
#: Share of the documents with words that is sampled.
KEEP = 0.85
SEED = 20_26
#: Bins of one pass towards the k-th greatest value.
BINS = 4096


def _buckets(hasher: WordHasher, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every word and word pair."""
    at, pairs = hasher.windows(words.hash, words.doc, 2, salt=2)
    hashes = np.concatenate([words.hash, pairs])
    rows = np.concatenate([words.doc, words.doc[at]])
    return rows, (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def target_ids(labels: DataFrame, target) -> list[int]:
    """Ids of the target documents, at most TARGET_ROWS."""
    ids = labels.where(target).where("doc_id is not null").select("doc_id").distinct()
    chosen = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TARGET_ROWS)
    return sorted(row.doc_id for row in chosen.collect())


def log_ratios(documents: DataFrame, targets: list[int]) -> np.ndarray:
    """Log ratio target / raw of every bucket; `documents` has doc_id and text."""
    chosen = documents.sparkSession.sparkContext.broadcast(np.array(targets, np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, wanted = WordHasher(fold=True), chosen.value
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            ids = batch.column(0)
            is_target = np.isin(ids.fill_null(0).to_numpy(zero_copy_only=False), wanted)
            is_target &= ids.is_valid().to_numpy(zero_copy_only=False)
            for words in hasher.slices(batch.column(1)):
                rows, buckets = _buckets(hasher, words)
                raw += np.bincount(buckets, minlength=BUCKETS)
                own = is_target[words.first + rows]
                target += np.bincount(buckets[own], minlength=BUCKETS)
        seen = np.flatnonzero(raw)
        arrays = [pa.array(x) for x in (seen, raw[seen], target[seen])]
        yield pa.RecordBatch.from_arrays(arrays, ["bucket", "raw", "target"])

    counts = map_arrow(documents, run, "bucket long, raw long, target long")
    totals = counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for row in totals.collect():  # at most BUCKETS rows
        raw[row.bucket], target[row.bucket] = row.raw, row.target
    share = (raw + 1) / (raw.sum() + BUCKETS)
    smooth = SMOOTHING * BUCKETS
    return np.log((target + smooth * share) / (target.sum() + smooth)) - np.log(share)


def weigh(documents: DataFrame, ratios: np.ndarray) -> DataFrame:
    """doc_id, log_weight, key (with Gumbel noise) of every document that has words."""
    model = documents.sparkSession.sparkContext.broadcast(ratios)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, table = WordHasher(fold=True), model.value
        for batch in batches:
            total, n = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            for words in hasher.slices(batch.column(1)):
                rows, buckets = _buckets(hasher, words)
                own = slice(words.first, words.first + words.rows)
                total[own] = np.bincount(rows, table[buckets], words.rows)
                n[own] = np.bincount(rows, minlength=words.rows)
            weight = LENGTH * total / np.maximum(n, 1)
            arrays = [batch.column(0), pa.array(weight), batch.column(2)]
            out = pa.RecordBatch.from_arrays(arrays, ["doc_id", "log_weight", "noise"])
            yield out.filter(pa.array(n > 0))

    rows = documents.select(
        "doc_id", "text", F.xxhash64(F.lit(SEED), "doc_id", "text").alias("noise")
    )
    weighed = map_arrow(rows, run, "doc_id long, log_weight double, noise long")
    uniform = (F.shiftrightunsigned("noise", 11) + 0.5) / float(1 << 53)
    return weighed.withColumn("key", F.col("log_weight") - F.log(-F.log(uniform))).drop("noise")


def kth_greatest(df: DataFrame, column: str, k: int) -> float:
    """The k-th greatest value of a column without nulls, exactly, by narrowing histograms."""
    low, high, left = None, None, k
    while True:
        inside = df if low is None else df.where(F.col(column).between(low, high))
        if low is None:
            low, high = inside.agg(F.min(column), F.max(column)).first()
        if low == high:
            return low
        bin_ = F.floor((F.col(column) - low) / (high - low) * BINS)
        bins = inside.groupBy(F.least(bin_, F.lit(BINS - 1)).alias("bin")).agg(
            F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")
        )
        for row in sorted(bins.collect(), key=lambda r: -r.bin):
            if left <= row.n:
                low, high = row.low, row.high
                break
            left -= row.n
        if left == 1:
            return high


def resample(documents: DataFrame, labels: DataFrame, target, keep: float = KEEP) -> DataFrame:
    """The sampled documents: doc_id, log_weight, key.

    `target` is a condition on `labels`; both inputs are joined by doc_id.
    """
    rows = documents.select(quoted("doc_id").cast("long").alias("doc_id"), quoted("text").alias("text"))
    weighed = weigh(rows, log_ratios(rows, target_ids(labels, target)))
    weighed = materialize(weighed, "document-weights")
    k = round(keep * weighed.count())
    if not k:
        return weighed.limit(0)
    return weighed.where(F.col("key") >= kth_greatest(weighed, "key", k))
