"""Which landed batches are new, per source.

The landing log has one row per landed batch: `source`, `batch_id`, `landed_at`, `rows`.
A source whose newest batch is already committed is current, which is not an error.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Outcomes of a source.
FRESH = "fresh_snapshot"
CURRENT = "already_current"

FRESHNESS_HOURS = 2


def source_status(landed: DataFrame, committed: DataFrame) -> DataFrame:
    """Newest batch per source with its outcome, row count and message.

    `committed` lists the batches already taken, as (source, batch_id). One partial
    aggregate finds the newest batches; a semi-join on that one row per source decides.
    """
    newest = landed.groupBy("source").agg(
        F.max_by(F.struct("batch_id", "rows"), F.struct("landed_at", "batch_id")).alias("_b"),
        F.max("landed_at").alias("landed_at"),
    )
    newest = newest.select("source", "_b.batch_id", "landed_at", F.col("_b.rows").alias("_rows"))
    keys = ["source", "batch_id"]
    taken = committed.select(*keys).join(newest.select(*keys), keys, "left_semi").distinct()
    marked = newest.join(taken.withColumn("_taken", F.lit(True)), keys, "left")
    is_fresh = F.col("_taken").isNull()
    return marked.select(
        "source",
        "batch_id",
        "landed_at",
        F.when(is_fresh, FRESH).otherwise(CURRENT).alias("status"),
        F.when(is_fresh, F.col("_rows")).otherwise(F.lit(0)).cast("bigint").alias("row_count"),
        F.when(is_fresh, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("no batch newer than "), F.col("batch_id").cast("string")))
        .alias("message"),
    )


def freshness(
    landed: DataFrame, as_of: datetime | str, hours: float = FRESHNESS_HOURS
) -> DataFrame:
    """Per source: newest landing and whether it is younger than `hours` at `as_of`."""
    age_limit = F.lit(str(as_of)).cast("timestamp") - F.make_dt_interval(
        secs=F.lit(hours * 3600).cast("decimal(18,6)")
    )
    return landed.groupBy("source").agg(F.max("landed_at").alias("landed_at")).withColumn(
        "skip", F.col("landed_at").cast("timestamp") > age_limit
    )
