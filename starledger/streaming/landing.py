"""Take newly landed page files exactly once.

The file stream's checkpoint remembers which files were taken, so a second run without
new files does nothing: the source is already current.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starledger.sources.landing import CURRENT, FRESH


def take_landed_pages(
    spark: SparkSession,
    landing: str,
    checkpoint: str,
    on_pages: Callable[[DataFrame], None],
    one_per_file: bool = True,
) -> str:
    """Hand all files landed since the last run to `on_pages` and return the outcome.

    `on_pages` gets a frame with column `page`. A run that fails is repeated with the
    same files, so `on_pages` should overwrite what it wrote for them before.
    """
    taken: list[int] = []

    def take(batch: DataFrame, batch_id: int) -> None:
        on_pages(batch.withColumnRenamed("value", "page"))
        taken.append(batch_id)

    stream = spark.readStream.text(landing, wholetext=one_per_file)
    query = (
        stream.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return FRESH if taken else CURRENT
