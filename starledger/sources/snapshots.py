"""Date-partitioned Parquet history of full snapshots, behind a commit log.

    base/snapshot_date=YYYY-MM-DD/v-<id>/part-*.parquet    one folder for each write
    base/_log/<number>.json                                one entry for each commit

A write ends with its log entry, a file that is created only if its number is free. Readers
go by the log: the last whole entry of a date names its folder. So nothing is ever moved or
replaced, and a driver lost at any point leaves every committed snapshot as it was, also
where the storage has no atomic rename: files without an entry are passed over, and so is an
entry that was not written to its end. `remove_uncommitted` clears them away.

Folders with files and no entry, as other tools leave them, count if a finished job's marker
lies beside the files. Explicit paths are read, so a stray folder cannot break partition
discovery, and one date never touches another date's files.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import asdict, dataclass
from datetime import date
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATE_COLUMN = "snapshot_date"
SCHEMA_VERSION = "schema_version"
_PARTITION = re.compile(rf"{DATE_COLUMN}=(\d{{4}}-\d{{2}}-\d{{2}})")

#: Left by Spark when all files of a write are in place.
FINISHED = "_SUCCESS"
LOG = "_log"

# File compression.
CODEC = "zstd"
CODEC_LEVEL = 3


def snapshot_path(base: str, snapshot_date: date) -> str:
    """Folder of one snapshot."""
    return f"{base.rstrip('/')}/{DATE_COLUMN}={snapshot_date.isoformat()}"


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), hadoop_path


def _has_data(fs, folder) -> bool:
    """Whether a write has ended there: data files and the marker of a finished job."""
    names = [status.getPath().getName() for status in fs.listStatus(folder) if status.isFile()]
    return FINISHED in names and any(not name.startswith(("_", ".")) for name in names)


def _require_base(spark: SparkSession, base: str):
    fs, path = _file_system(spark, base)
    if not fs.exists(path):
        raise FileNotFoundError(f"snapshot base does not exist: {base}")
    if not fs.getFileStatus(path).isDirectory():
        raise NotADirectoryError(f"snapshot base is not a folder: {base}")
    return fs, path


@dataclass(frozen=True)
class Entry:
    """One commit: where the rows of a date lie, and the version of their contract."""

    number: int
    snapshot_date: str
    folder: str
    version: str | None


def _read_text(spark: SparkSession, fs, path) -> str:
    stream = fs.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _log_numbers(spark: SparkSession, fs, base: str) -> dict[int, object]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{LOG}")
    if not fs.exists(folder):
        return {}
    paths = [status.getPath() for status in fs.listStatus(folder)]
    return {int(p.getName()[:-5]): p for p in paths if re.fullmatch(r"\d+\.json", p.getName())}


def commits(spark: SparkSession, base: str) -> list[Entry]:
    """All whole entries of the log, in order."""
    fs, _ = _require_base(spark, base)
    found = []
    for number, path in sorted(_log_numbers(spark, fs, base).items()):
        try:
            found.append(Entry(**json.loads(_read_text(spark, fs, path))))
        except ValueError:  # its writer was lost
            continue
    return found


def _current(spark: SparkSession, base: str) -> dict[date, Entry]:
    """The entry that counts for each date; number 0 where there is none in the log."""
    fs, path = _require_base(spark, base)
    found = {}
    for status in fs.listStatus(path):
        match = _PARTITION.fullmatch(status.getPath().getName())
        if not (match and status.isDirectory()):
            continue
        try:
            day = date.fromisoformat(match.group(1))
        except ValueError:
            continue
        if _has_data(fs, status.getPath()):
            found[day] = Entry(0, match.group(1), match.group(0), None)
    for entry in commits(spark, base):
        found[date.fromisoformat(entry.snapshot_date)] = entry
    return found


def _commit(spark: SparkSession, base: str, entry: Entry, replace: bool) -> Entry:
    """Add an entry under the next free number; a date that has one is refused unless `replace`."""
    fs, _ = _require_base(spark, base)
    while True:
        if not replace and date.fromisoformat(entry.snapshot_date) in _current(spark, base):
            raise FileExistsError(f"{base} has {entry.snapshot_date}")
        number = max(_log_numbers(spark, fs, base), default=0) + 1
        own = Entry(number, entry.snapshot_date, entry.folder, entry.version)
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{LOG}/{number:010d}.json")
        if _create(spark, fs, path, json.dumps(asdict(own))):
            return own


def _create(spark: SparkSession, fs, path, text: str) -> bool:
    """Write a file unless one is there already."""
    try:
        stream = fs.create(path, False)
    except Py4JJavaError as error:
        if fs.exists(path):  # another writer was first
            return False
        raise error
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return True


def remove_uncommitted(spark: SparkSession, base: str) -> list[str]:
    """Delete folders of writes that the log does not name (any more); returns their paths.

    Replaced snapshots go too. Not to be run while a write is under way.
    """
    fs, path = _require_base(spark, base)
    kept = {entry.folder for entry in _current(spark, base).values()}
    gone = []
    for day in fs.listStatus(path):
        if not (_PARTITION.fullmatch(day.getPath().getName()) and day.isDirectory()):
            continue
        for status in fs.listStatus(day.getPath()):
            folder = f"{day.getPath().getName()}/{status.getPath().getName()}"
            if status.isDirectory() and status.getPath().getName().startswith("v-") and folder not in kept:
                fs.delete(status.getPath(), True)
                gone.append(folder)
    return gone


def list_snapshot_dates(spark: SparkSession, base: str) -> list[date]:
    """Dates with data, ascending; other folders and impossible dates are passed over."""
    return sorted(_current(spark, base))


def stored_path(spark: SparkSession, snapshot_date: date, base: str) -> str:
    """The folder that holds the rows of a date."""
    found = _current(spark, base).get(snapshot_date)
    if found is None:
        raise FileNotFoundError(f"no snapshot for {snapshot_date} under {base}")
    return f"{base.rstrip('/')}/{found.folder}"


def previous_snapshot_date(spark: SparkSession, base: str, current: date) -> date | None:
    """Newest snapshot strictly before `current`, or None."""
    return max((d for d in list_snapshot_dates(spark, base) if d < current), default=None)


def with_schema_version(df: DataFrame, version: str) -> DataFrame:
    """Carry the contract version in the column metadata, which Parquet files keep."""
    return df.select(
        *[
            F.col(f"`{f.name}`").alias(f.name, metadata={**f.metadata, SCHEMA_VERSION: version})
            for f in df.schema
        ]
    )


def stored_schema_version(df: DataFrame) -> str | None:
    """Contract version found in the column metadata."""
    return next((f.metadata[SCHEMA_VERSION] for f in df.schema if SCHEMA_VERSION in f.metadata), None)


def _check_versions(stored: Iterable[str | None], version: str | None) -> None:
    """Refuse several majors, and any other major than that of `version`."""
    stored = set(stored)
    if len({_major(v) for v in stored}) > 1:
        raise ValueError(f"snapshots of several major schema versions: {sorted(map(str, stored))}")
    if version is not None and {_major(v) for v in stored} - {_major(version)}:
        raise ValueError(f"schema version {', '.join(sorted(map(str, stored)))} cannot be read as {version}")


def _major(version: str | None) -> str | None:
    return version.split(".")[0] if version else None


def _write(
    df: DataFrame, snapshot_date: date, base: str, measures: Sequence[Column] = ()
) -> tuple[str, dict]:
    """Write to a folder of its own, which no reader knows yet.

    Returns its name under `base` and the measures, which are taken as the rows pass by.
    """
    spark = df.sparkSession
    fs, _ = _require_base(spark, base)
    folder = f"{DATE_COLUMN}={snapshot_date.isoformat()}/v-{uuid.uuid4().hex}"
    seen = Observation()
    try:
        (
            df.observe(seen, F.count(F.lit(1)).alias("rows written"), *measures)
            .write.option("compression", CODEC)
            .option("parquet.compression.codec.zstd.level", CODEC_LEVEL)
            .parquet(f"{base.rstrip('/')}/{folder}")
        )
    except Exception:
        _discard(spark, fs, base, folder)
        raise
    return folder, seen.get


def _discard(spark: SparkSession, fs, base: str, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/{folder}")
    fs.delete(path, True)
    if fs.exists(path.getParent()) and not fs.listStatus(path.getParent()):
        fs.delete(path.getParent(), False)


def save_snapshot(
    df: DataFrame,
    snapshot_date: date,
    base: str,
    overwrite: bool = False,
    version: str | None = None,
    measures: Sequence[Column] = (),
    accept: Callable[[dict], None] | None = None,
) -> str:
    """Write one snapshot, commit it, and return its folder.

    The base folder must exist, the date must be new unless `overwrite`, and the frame
    must have rows. Until the commit readers see what was there before, also if the write
    fails or the driver is lost. A `snapshot_date` column of the frame stays inside the files.

    `measures` are aggregates that are taken while the rows are written. `accept` is called
    with their values before the commit; if it raises, the snapshot is not committed.
    """
    spark = df.sparkSession
    fs, _ = _require_base(spark, base)
    if not overwrite and snapshot_date in _current(spark, base):
        raise FileExistsError(f"snapshot exists: {snapshot_path(base, snapshot_date)}")
    stamped = df if version is None else with_schema_version(df, version)
    folder, seen = _write(stamped, snapshot_date, base, measures)
    entry = Entry(0, snapshot_date.isoformat(), folder, stored_schema_version(stamped))
    try:
        if accept:
            accept(seen)
        if not seen["rows written"]:
            raise ValueError("refusing to write an empty snapshot")
        _commit(spark, base, entry, overwrite)
    except Exception:
        _discard(spark, fs, base, folder)
        raise
    return f"{base.rstrip('/')}/{folder}"


def load_snapshot(
    spark: SparkSession, snapshot_date: date, base: str, version: str | None = None
) -> DataFrame:
    """The rows of one date, without a partition column; missing or empty is an error."""
    df = spark.read.parquet(stored_path(spark, snapshot_date, base))
    _check_versions([stored_schema_version(df)], version)
    if df.isEmpty():
        raise ValueError(f"snapshot for {snapshot_date} is empty")
    return df


def load_history(
    spark: SparkSession, base: str, schema: T.StructType | None = None, version: str | None = None
) -> DataFrame:
    """All snapshots with `snapshot_date` as a column; a filter on it prunes folders.

    Versions of one major number are read together: a column that some dates lack is null
    there. Dates of different majors are refused, and with `version` those of another
    major than it. The versions come from the log, with a `schema` too; the schemas come
    from one file footer a date.
    """
    found = sorted(_current(spark, base).items())
    if not found:
        raise FileNotFoundError(f"no snapshots under {base}")
    paths = [f"{base.rstrip('/')}/{entry.folder}" for _, entry in found]
    reader = spark.read.option("basePath", base)
    # Folders without an entry tell their version in the files.
    versions = [
        entry.version if entry.number else stored_schema_version(spark.read.parquet(path))
        for (_, entry), path in zip(found, paths)
    ]
    _check_versions(versions, version)
    if schema:
        return reader.schema(schema).parquet(*paths)
    dated = [(day, spark.read.parquet(path)) for (day, _), path in zip(found, paths)]
    merged = reduce(_with_appended, (df.schema for _, df in dated))
    inside = any(field.name == DATE_COLUMN for field in merged)
    fields = [f for f in merged if f.name != DATE_COLUMN] if inside else list(merged)
    kept = T.StructType([*fields, T.StructField(DATE_COLUMN, T.DateType())])
    return reader.schema(kept).parquet(*paths)


def _with_appended(schema: T.StructType, later: T.StructType) -> T.StructType:
    """The fields of both; a field of both must keep its type, and the later one counts."""
    known = {field.name: field for field in schema}
    for field in later:
        before = known.get(field.name)
        if before is not None and before.dataType != field.dataType:
            raise ValueError(f"column {field.name} changed from {before.dataType} to {field.dataType}")
        known[field.name] = T.StructField(field.name, field.dataType, True, field.metadata)
    return T.StructType(list(known.values()))


def history_dates(history: DataFrame) -> DataFrame:
    """Each snapshot date with its predecessor: one row per date, so one small window."""
    days = history.select(DATE_COLUMN).distinct()
    return days.withColumn(
        "previous_date", F.lag(DATE_COLUMN).over(Window.orderBy(DATE_COLUMN))
    )


def append_changes(changes: DataFrame, snapshot_date: date, base: str) -> str:
    """Add one snapshot's change rows to a changelog; an existing date is refused."""
    spark = changes.sparkSession
    fs, _ = _require_base(spark, base)
    if snapshot_date in _current(spark, base):
        raise FileExistsError(f"changelog entry exists: {snapshot_path(base, snapshot_date)}")
    folder, _ = _write(changes, snapshot_date, base)
    try:
        _commit(spark, base, Entry(0, snapshot_date.isoformat(), folder, None), False)
    except FileExistsError:
        _discard(spark, fs, base, folder)
        raise
    return f"{base.rstrip('/')}/{folder}"
