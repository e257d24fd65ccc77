"""Intermediate tables in the folder all executors share.

A written table cuts lineage and survives the loss of executors; unlike a checkpoint it
also keeps column pruning and filter pushdown for the jobs that read it back. The tables
of an application lie in one folder, which goes when the application ends.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; only a local session may do without the setting."""
    configured = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    own = Path(tempfile.gettempdir(), "starledger-shared").as_uri()
    spark.sparkContext.setCheckpointDir(own)
    return own


@cache
def _application_dir(application: str, shared: str) -> str:
    """One folder an application, removed by the file system when the driver ends."""
    spark = SparkSession.active()
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared}/starledger-{application}")
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return path.toString()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder."""
    folder = _application_dir(spark.sparkContext.applicationId, shared_dir(spark))
    return f"{folder}/{label}-{uuid.uuid4().hex}"


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside go at its end, not when the driver collects garbage."""
    before = spark.conf.get(_REMOVE_SHUFFLES, None)
    if before is None:  # a Spark without the setting
        yield
        return
    spark.conf.set(_REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_REMOVE_SHUFFLES, before)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once and read it back."""
    path = scratch_path(df.sparkSession, label)
    with _shuffles_removed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    vars(written)[_PLACE] = path
    return written


#: Where `materialize` notes the folder of a table.
_PLACE = "_starledger_path"


def discard(*tables: DataFrame) -> None:
    """Delete tables that `materialize` wrote, once everything that reads them is written too."""
    for table in tables:
        path = vars(table).get(_PLACE)
        if path:
            path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            fs = path.getFileSystem(table.sparkSession._jsparkSession.sessionState().newHadoopConf())
            fs.delete(path, True)
