"""Small helpers the operators share: Arrow columns, task-side mapping, safe columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one Arrow batch; long texts make wider batches costly in a Python worker.
BATCH_ROWS = 2048


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_arrow(
    df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """`mapInArrow`, with batches cut to BATCH_ROWS rows for a bounded working set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return fn(
            batch.slice(at, BATCH_ROWS)
            for batch in batches
            for at in range(0, batch.num_rows, BATCH_ROWS)
        )

    return df.mapInArrow(run, schema)


def texts_of(column: pa.Array) -> pa.Array:
    """Strings with null as the empty string."""
    if pa.types.is_large_string(column.type):
        column = column.cast(pa.string())
    return column.fill_null("") if column.null_count else column


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after another, and the bounds of each text in them."""
    column = texts_of(column)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, ends, data = column.buffers()
    bounds = np.frombuffer(ends, np.int32)[column.offset : column.offset + len(column) + 1]
    first = int(bounds[0])
    if data is None or bounds[-1] == first:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    raw = np.frombuffer(data, np.uint8)[first : int(bounds[-1])]
    return raw, bounds.astype(np.int64) - first


def binary_array(pieces: list[bytes]) -> pa.Array:
    return pa.array(pieces, pa.binary())


def quoted(name: str) -> Column:
    """A column by its exact name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")
