"""Nearest neighbours by a permutation index.

PIVOTS vectors of a bounded sample order every vector: its permutation lists the pivots
from the nearest on, and its first PREFIX pivots are what the index keeps. Vectors lie in
blocks; in each, the inverted file of a pivot holds the pivot's place in every vector's
list (PREFIX where it is not in it). A query reads the files of its own PREFIX pivots and
adds up the differences of places, the footrule distance. The FIRST + n / SHARE vectors of
a block that come first are reranked by the inner product in double precision, and the
best of all blocks are the result.

Blocks of vectors meet blocks of queries as keyed groups of bounded size, so neither side
passes the driver or one task. Copies of a vector in a block take one place in the ranking,
so a vector that fills a third of the table crowds nothing out.

Vectors that are null, zero, of another length than most, or that hold null or non-finite
components take no part, and rows without id neither. An id that repeats counts once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starledger.llm.base import quoted
from starledger.sources.shared import materialize

PIVOTS = 256
PREFIX = 128
#: Rows from which the pivots are taken, as copies are dropped.
PIVOT_SAMPLE = 1024
FIRST, SHARE = 128, 8
VECTOR_BLOCK, QUERY_BLOCK = 4096, 256

FOUND = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id and vector of the rows that take part."""
    rows = vectors.select(quoted(vec_id).cast("long").alias("vec_id"), quoted(embedding).alias("vector"))
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = rows.where("vec_id is not null and vector is not null")
    rows = rows.where(~F.exists("vector", odd) & F.exists("vector", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vector").alias("size")).count()
    usual = sizes.orderBy(F.desc("count"), "size").first()
    rows = rows.where(F.size("vector") == usual["size"]) if usual else rows
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def pivots_of(rows: DataFrame) -> np.ndarray:
    """Up to PIVOTS vectors, as unit vectors, of a sample by the smallest hashes of ids.

    Each next pivot is the one least like all before, so a dense group gives few.
    """
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOT_SAMPLE).collect()
    vectors = np.array([row.vector for row in sample], np.float64)
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    chosen, likeness = [0], vectors @ vectors[0]
    while len(chosen) < min(PIVOTS, len(vectors)):
        following = int(np.argmin(likeness))
        if likeness[following] > 1 - 1e-9:
            break  # only copies are left
        chosen.append(following)
        likeness = np.maximum(likeness, vectors @ vectors[following])
    return vectors[chosen]


def places(vectors: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest pivots of each vector in order, and each pivot's place, pivot by vector."""
    prefix = min(PREFIX, len(pivots))
    order = np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")[:, :prefix]
    place = np.full((len(vectors), len(pivots)), prefix, np.int16)
    np.put_along_axis(place, order, np.arange(prefix, dtype=np.int16)[None, :], axis=1)
    return order, np.ascontiguousarray(place.T)


class Block:
    """The inverted files of one block; copies of a vector share one entry."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, pivots: np.ndarray, k: int):
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order]
        groups: dict[bytes, list[int]] = {}
        for row in range(len(ids)):
            copies = groups.setdefault(vectors[row].tobytes(), [])
            # One more than the result needs, as a query may be one of the copies.
            if len(copies) <= k:
                copies.append(row)
        self.copies = [ids[rows] for rows in groups.values()]
        self.vectors = vectors[[rows[0] for rows in groups.values()]]
        self.pivots, self.k = pivots, k
        self.files = places(self.vectors, pivots)[1]

    def search(self, query_id: int, query: np.ndarray, near: np.ndarray) -> list[tuple]:
        """The block's best (vec_id, score) for a query whose nearest pivots are `near`."""
        rank = np.arange(len(near), dtype=np.int16)[:, None]
        footrule = np.abs(self.files[near] - rank).sum(axis=0, dtype=np.int16)
        n = len(footrule)
        ranked = footrule.astype(np.int64) * n + np.arange(n)  # ties: the smaller id first
        wanted = FIRST + n // SHARE
        first = np.argpartition(ranked, wanted)[:wanted] if wanted < n else np.arange(n)
        scores = self.vectors[first] @ query
        best = np.argsort(-scores, kind="stable")
        # All entries that tie with the last one needed.
        if len(best) > self.k + 1:
            best = best[scores[best] >= scores[best[self.k]]]
        found = [
            (-score, vec_id)
            for score, entry in zip(scores[best].tolist(), first[best].tolist())
            for vec_id in self.copies[entry].tolist()
            if vec_id != query_id
        ]
        return [(vec_id, -score) for score, vec_id in sorted(found)[: self.k]]


def nearest(vectors: DataFrame, is_query, k: int = 20) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest found of each query.

    `is_query` is a condition on vec_id. Nearness is the inner product; ties go to the
    smaller vec_id, and a query is not its own neighbour. Without usable rows: no rows.
    """
    rows = materialize(usable(vectors), "usable-vectors")
    spark = rows.sparkSession
    total, queries = rows.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    if not queries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    n_blocks, n_query_blocks = -(-total // VECTOR_BLOCK), -(-queries // QUERY_BLOCK)
    model = spark.sparkContext.broadcast(pivots_of(rows))

    block = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    indexed = rows.select(
        block(n_blocks).alias("block"), every(n_query_blocks).alias("query_block"),
        F.lit(False).alias("asks"), "vec_id", "vector",
    )
    asking = rows.where(is_query).select(
        every(n_blocks).alias("block"), block(n_query_blocks).alias("query_block"),
        F.lit(True).alias("asks"), "vec_id", "vector",
    )

    def search(group: pa.Table) -> pa.Table:
        pivots = model.value
        asks = group.column("asks").to_numpy()
        ids = group.column("vec_id").to_numpy()
        flat = pa.chunked_array(group.column("vector")).combine_chunks().flatten()
        data = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(ids), -1)
        out = []
        if asks.any() and not asks.all():
            index = Block(ids[~asks], data[~asks], pivots, k)
            wanted, queries = ids[asks], data[asks]
            near, _ = places(queries, pivots)
            for query_id, query, own in zip(wanted.tolist(), queries, near):
                out += [(query_id, *hit) for hit in index.search(query_id, query, own)]
        columns = list(zip(*out)) or [()] * 3
        types = [pa.int64(), pa.int64(), pa.float64()]
        arrays = [pa.array(c, t) for c, t in zip(columns, types)]
        return pa.table(arrays, names=["query_id", "vec_id", "score"])

    groups = indexed.unionByName(asking).groupBy("block", "query_block")
    found = groups.applyInArrow(search, FOUND)
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
