"""Semantic diff of two full snapshots: added rows, removed rows, changed values.

Keys that occur once on either side, nearly all as a rule, meet in one full outer join that
tags each key as added, removed or matched; changed values become rows by inlining an
array. Rows with a null key equal nothing: they are always added or removed, and a salt
spreads them over the tasks of the join.

A key that repeats pairs every previous row with every current row. Those pairs are
counted, not built. One pass over the keys writes the repeated ones with their numbers of
rows, which alone tell added and removed rows; another writes how often each value of each
column occurs on either side, which gives all totals. Only the list of changes lets the
distinct values of a key and column meet: a join, which can be split however many there are.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starledger.functions.text import column, comparable_text
from starledger.sources.shared import materialize
from starledger.sources.snapshots import DATE_COLUMN, history_dates

CHANGE_COLUMNS = ("column_name", "old_value", "new_value")


@dataclass(frozen=True)
class SnapshotDiff:
    """Lazy result of `diff_snapshots`.

    `added` has the current columns, `removed` the previous ones. `weighted_changes` has
    the key, `column_name`, `old_value`, `new_value` (text, '' as null) and `n_pairs`, the
    number of row pairs with that change: 1 wherever the key is unique on both sides.
    `totals` is one row: n_added, n_removed, n_modified_rows, n_modified_changes.
    """

    key: tuple[str, ...]
    added: DataFrame
    removed: DataFrame
    weighted_changes: DataFrame
    totals: DataFrame
    keys_unique: bool

    @cached_property
    def changes(self) -> DataFrame:
        """Changed values ordered by key and column; for a repeated key, each change once."""
        order = [*map(column, self.key), F.col("column_name")]
        return self.weighted_changes.select(*order, "old_value", "new_value").orderBy(*order)

    @cached_property
    def counts(self) -> DataFrame:
        """n_added, n_removed, n_modified_rows, n_modified_changes, is_empty: one row."""
        return self.totals.withColumn(
            "is_empty", F.expr("n_added = 0 and n_removed = 0 and n_modified_changes = 0")
        )


TOTALS = ("n_added", "n_removed", "n_modified_rows", "n_modified_changes")


def _sums(rows: DataFrame, *values: Column) -> DataFrame:
    """One row of totals."""
    zero = F.lit(0).cast("bigint")
    return rows.agg(
        *[F.coalesce(F.sum(v.cast("bigint")), zero).alias(n) for n, v in zip(TOTALS, values)]
    )


def _all_known(key: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [column(k).isNotNull() for k in key])


def _diff_of_unique(
    previous: DataFrame, current: DataFrame, key: Sequence[str], columns: Sequence[str]
) -> SnapshotDiff:
    """The diff where each key meets at most one row, from one join of both sides."""
    names = [f"_key_{i}" for i in range(len(key))]

    def side(df: DataFrame, label: str) -> DataFrame:
        salt = F.when(~_all_known(key), F.xxhash64(*map(column, [*key, *columns])))
        return df.select(
            *[column(k).alias(n) for k, n in zip(key, names)],
            F.coalesce(salt, F.lit(0)).alias("_salt"),
            F.lit(True).alias(f"_in_{label}"),
            *[column(c).alias(f"{label} {c}") for c in df.columns],
        )

    def back(rows: DataFrame, df: DataFrame, label: str) -> DataFrame:
        return rows.select(*[column(f"{label} {c}").alias(c) for c in df.columns])

    joined = side(previous, "old").join(side(current, "new"), [*names, "_salt"], "full_outer")
    old, new = ([comparable_text(f"{label} {c}") for c in columns] for label in ("old", "new"))
    differs = [~a.eqNullSafe(b) for a, b in zip(old, new)]
    is_added, is_removed = F.col("_in_old").isNull(), F.col("_in_new").isNull()
    changed = [
        F.when(
            d, F.struct(F.lit(c).alias("column_name"), a.alias("old_value"), b.alias("new_value"))
        )
        for c, a, b, d in zip(columns, old, new, differs)
    ]
    n_changed = F.when(~is_added & ~is_removed, reduce(lambda x, y: x + y, [d.cast("int") for d in differs]))
    pairs = joined.where(~is_added & ~is_removed)
    return SnapshotDiff(
        key=tuple(key),
        added=back(joined.where(is_added), current, "new"),
        removed=back(joined.where(is_removed), previous, "old"),
        weighted_changes=pairs.select(
            *[F.col(n).alias(k) for k, n in zip(key, names)],
            F.inline(F.array_compact(F.array(*changed))),
            F.lit(1).cast("bigint").alias("n_pairs"),
        ),
        totals=_sums(joined, is_added, is_removed, n_changed > 0, n_changed),
        keys_unique=True,
    )


def _value_counts(
    previous: DataFrame, current: DataFrame, key: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Rows of either side per key, column and value: `n_old` and `n_new`."""

    def melted(df: DataFrame, n_old: int, n_new: int) -> DataFrame:
        cells = [
            F.struct(F.lit(name).alias("column_name"), comparable_text(name).alias("value"))
            for name in columns
        ]
        return df.where(_all_known(key)).select(
            *map(column, key),
            F.inline(F.array(*cells)),
            F.lit(n_old).cast("bigint").alias("n_old"),
            F.lit(n_new).cast("bigint").alias("n_new"),
        )

    both = melted(previous, 1, 0).unionAll(melted(current, 0, 1))
    return both.groupBy(*map(column, key), "column_name", "value").agg(
        F.sum("n_old").alias("n_old"), F.sum("n_new").alias("n_new")
    )


def _changes_of_repeated(counts: DataFrame, key: Sequence[str]) -> DataFrame:
    """Changed values as distinct (old, new) with the number of row pairs."""
    cell = [*key, "column_name"]
    old = counts.where("n_old > 0").select(
        *map(column, cell), F.col("value").alias("old_value"), "n_old"
    )
    new = counts.where("n_new > 0").select(
        *map(column, cell), F.col("value").alias("new_value"), "n_new"
    )
    return (
        old.join(new, cell, "inner")
        .where("not (old_value <=> new_value)")
        .select(
            *map(column, cell),
            "old_value",
            "new_value",
            (F.col("n_old") * F.col("n_new")).alias("n_pairs"),
        )
    )


def _totals_of_repeated(counts: DataFrame, key: Sequence[str]) -> DataFrame:
    """Totals from counted values.

    Changed pairs of a column are all pairs less those with equal values, and the values of
    any column add up to the rows of the key.
    """
    names = list(map(column, key))
    per_column = counts.groupBy(*names, "column_name").agg(
        F.sum("n_old").alias("n_old"),
        F.sum("n_new").alias("n_new"),
        (F.sum("n_old") * F.sum("n_new") - F.sum(F.col("n_old") * F.col("n_new"))).alias("n_pairs"),
    )
    per_key = per_column.groupBy(*names).agg(
        F.max("n_old").alias("n_old"), F.max("n_new").alias("n_new"), F.sum("n_pairs").alias("n_pairs")
    )
    zero = F.lit(0)
    added, removed = (
        F.when(F.col(f"n_{other}") == 0, F.col(f"n_{own}")).otherwise(zero)
        for own, other in (("new", "old"), ("old", "new"))
    )
    return _sums(per_key, added, removed, F.col("n_pairs") > 0, F.col("n_pairs"))


def _repeated(previous: DataFrame, current: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that several rows of one side have, with the rows of either side; written once."""
    sides = [
        df.where(_all_known(key)).select(
            *map(column, key), F.lit(old).alias("_n_old"), F.lit(1 - old).alias("_n_new")
        )
        for df, old in ((previous, 1), (current, 0))
    ]
    sums = [F.sum(n).cast("bigint").alias(n) for n in ("_n_old", "_n_new")]
    counted = sides[0].unionAll(sides[1]).groupBy(*map(column, key)).agg(*sums)
    return materialize(counted.where("_n_old > 1 or _n_new > 1"), "repeated-keys")


def _diff_of_repeated(
    previous: DataFrame, current: DataFrame, repeated: DataFrame, key: Sequence[str], columns: Sequence[str]
) -> SnapshotDiff:
    """The diff of rows with known keys that repeat, from counted values."""

    def rows(df: DataFrame, of: str) -> DataFrame:
        keys = repeated.where(of).select(*map(column, key))
        return df.join(keys, list(key), "left_semi").select(*map(column, df.columns))

    every = "true"
    counts = _value_counts(rows(previous, every), rows(current, every), key, columns)
    counts = materialize(counts, "value-counts")
    return SnapshotDiff(
        key=tuple(key),
        added=rows(current, "_n_old = 0"),
        removed=rows(previous, "_n_new = 0"),
        weighted_changes=_changes_of_repeated(counts, key),
        totals=_totals_of_repeated(counts, key),
        keys_unique=False,
    )


def missing_columns(df: DataFrame, names: Sequence[str]) -> list[str]:
    """The names that a frame lacks, in order."""
    return sorted(set(names) - set(df.columns))


def _require(df: DataFrame, names: Sequence[str], side: str) -> None:
    missing = missing_columns(df, names)
    if missing:
        raise ValueError(f"{side} snapshot lacks columns: {missing}")


def diff_snapshots(
    previous: DataFrame,
    current: DataFrame,
    key: str | Sequence[str],
    columns: Sequence[str],
    keys_unique: bool = False,
) -> SnapshotDiff:
    """Compare two snapshots on `key` over `columns`.

    Set `keys_unique` when a uniqueness check has passed: repeated keys are then not
    looked for. Else they are looked for at once, and what they need is written.
    """
    key = (key,) if isinstance(key, str) else tuple(key)
    if not columns or set(key) & set(columns):
        raise ValueError("compare at least one column, and none of the key columns")
    for side, df in (("previous", previous), ("current", current)):
        _require(df, [*key, *columns], side)
    if keys_unique:
        return _diff_of_unique(previous, current, key, columns)
    repeated = _repeated(previous, current, key)
    if repeated.isEmpty():
        return _diff_of_unique(previous, current, key, columns)
    keys = repeated.select(*map(column, key))
    single = [df.join(keys, list(key), "left_anti").select(*map(column, df.columns)) for df in (previous, current)]
    once = _diff_of_unique(*single, key, columns)
    often = _diff_of_repeated(previous, current, repeated, key, columns)
    both = once.totals.unionAll(often.totals)
    return SnapshotDiff(
        key=key,
        added=once.added.unionByName(often.added),
        removed=once.removed.unionByName(often.removed),
        weighted_changes=once.weighted_changes.unionByName(often.weighted_changes),
        totals=_sums(both, *map(F.col, TOTALS)),
        keys_unique=False,
    )


def diff_history(
    history: DataFrame, key: str | Sequence[str], columns: Sequence[str], keys_unique: bool = False
) -> SnapshotDiff:
    """Compare every snapshot of a history with its predecessor in one job.

    Each previous row moves to the date of the following snapshot, then both sides meet
    on (snapshot_date, key). The date table has one row per calendar day at most, which
    bounds the broadcast. The first snapshot has no predecessor and yields no rows.
    """
    key = (key,) if isinstance(key, str) else tuple(key)
    days = history_dates(history).where("previous_date is not null")
    following = F.broadcast(
        days.select(F.col(DATE_COLUMN).alias("_next"), F.col("previous_date").alias(DATE_COLUMN))
    )
    later = F.broadcast(days.select(DATE_COLUMN))
    columns_out = list(map(column, history.columns))
    previous = (
        history.join(following, DATE_COLUMN)
        .withColumn(DATE_COLUMN, F.col("_next"))
        .select(*columns_out)
    )
    current = history.join(later, DATE_COLUMN).select(*columns_out)
    return diff_snapshots(previous, current, (DATE_COLUMN, *key), columns, keys_unique)
