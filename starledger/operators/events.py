"""Row events between snapshots, and their replay to any date.

An event says that a row was added, changed or removed, and carries the whole row: the new
one, or for a removal the last one. Rows go by their key and, where a key repeats, by their
number among its copies, so tables with repeated or null keys replay as well. Events of one
snapshot lie under its date in an append-only store; of each row the last event up to a date
is what it was then, an aggregate without any order of files or rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starledger.functions.text import column
from starledger.operators.ranking import Queue, digest_bucket, with_position
from starledger.sources.snapshots import DATE_COLUMN, append_changes, load_history

ADDED, CHANGED, REMOVED = "added", "changed", "removed"
#: What an event carries beside its row.
EVENT, COPY = "_event", "_copy"


def _numbered(df: DataFrame, key: Sequence[str], side: str) -> DataFrame:
    """Each row as a struct, with its key and its number among equal keys.

    Rows that are equal stand for each other, so it doesn't matter in which order they are
    numbered; the others go by a digest.
    """
    row = F.struct(*map(column, df.columns))
    rows = df.select(F.struct(*map(column, key)).alias("_key"), row.alias(side))
    digest = F.xxhash64(side)
    return with_position(Queue(rows, digest_bucket(digest), (digest,)), ["_key"], COPY)


def row_events(previous: DataFrame | None, current: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Events that turn `previous` into `current`: the row, `_copy` and `_event`.

    Without a previous snapshot all rows are added. Columns that only `current` has count
    as appended: they were null before. One that it lacks stays null from now on.
    """
    key = (key,) if isinstance(key, str) else tuple(key)
    reserved = {EVENT, COPY, DATE_COLUMN} & {*current.columns, *(previous.columns if previous else ())}
    if reserved:
        raise ValueError(f"rows with events cannot have columns {sorted(reserved)}")
    if previous is None:
        return _events(_numbered(current, key, "new"), "new", F.lit(ADDED))
    names = [*previous.columns, *(c for c in current.columns if c not in previous.columns)]
    sides = [
        _numbered(_with_columns(df, names, other), key, side)
        for df, other, side in ((previous, current, "old"), (current, previous, "new"))
    ]
    both = sides[0].join(sides[1], ["_key", COPY], "full_outer")
    kind = (
        F.when(F.col("old").isNull(), ADDED)
        .when(F.col("new").isNull(), REMOVED)
        .when(~F.col("old").eqNullSafe(F.col("new")), CHANGED)
    )
    told = both.withColumn("_kind", kind).where("_kind is not null")
    row = told.withColumn("row", F.coalesce("new", "old"))
    return _events(row, "row", F.col("_kind"))


def _with_columns(df: DataFrame, names: Sequence[str], other: DataFrame) -> DataFrame:
    missing = {c: F.lit(None).cast(other.schema[c].dataType).alias(c) for c in names if c not in df.columns}
    return df.select(*[missing.get(c, column(c)) for c in names])


def _events(rows: DataFrame, row: str, kind: Column) -> DataFrame:
    return rows.select(f"{row}.*", COPY, kind.alias(EVENT))


def append_events(events: DataFrame, snapshot_date: date, base: str) -> str:
    """Commit the events of one snapshot; a date that is there already is refused."""
    return append_changes(events, snapshot_date, base)


def replay(spark: SparkSession, base: str, key: str | Sequence[str], as_of: date | None = None) -> DataFrame:
    """The rows as they were at a date (the last one if None), from events alone."""
    key = (key,) if isinstance(key, str) else tuple(key)
    events = load_history(spark, base)
    if as_of is not None:
        events = events.where(F.col(DATE_COLUMN) <= F.lit(as_of))
    rows = [c for c in events.columns if c not in (EVENT, COPY, DATE_COLUMN)]
    last = F.max_by(F.struct(EVENT, F.struct(*map(column, rows)).alias("row")), DATE_COLUMN)
    folded = events.groupBy(F.struct(*map(column, key)).alias("_key"), COPY).agg(last.alias("_last"))
    return folded.where(F.col(f"_last.{EVENT}") != REMOVED).select("_last.row.*")
