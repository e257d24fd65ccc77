"""Snapshot diff: cases, repeated and null keys, history, properties, plan shape."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from starledger.operators.diff import diff_history, diff_snapshots
from starledger.plans.contracts import DIFF_COLUMNS
from starledger.sources.pages import REGISTRY_SCHEMA

KEY = "International Designator"
ROW = {
    KEY: "1998-067A",
    "National Designator": "N-77",
    "Name of Space Object": "Lantern 4",
    "State of Registry": "Norway",
    "Date of Launch": dt.date(1998, 11, 20),
    "Status": "in orbit",
    "Date of Decay": None,
    "UN Registered": False,
    "Registration Documents": "A/AC.105/INF.400",
    "Function": "weather",
    "Remarks": None,
    "External website": None,
}


def frame(spark, *rows):
    return spark.createDataFrame([tuple({**ROW, **r}.values()) for r in rows], REGISTRY_SCHEMA)


def registry_diff(previous, current, unique=False):
    return diff_snapshots(previous, current, KEY, DIFF_COLUMNS, keys_unique=unique)


def changes(diff):
    return [tuple(r) for r in diff.changes.collect()]


def counts(diff):
    return tuple(diff.counts.first())


@pytest.mark.parametrize("unique", [True, False])
def test_same_snapshots_have_no_diff(spark, unique):
    df = frame(spark, {}, {KEY: "2024-002A"})
    assert counts(registry_diff(df, df, unique)) == (0, 0, 0, 0, True)


def test_added_and_removed_keep_all_columns(spark):
    old = frame(spark, {}, {KEY: "2023-001A"})
    new = frame(spark, {}, {KEY: "2024-009A", "Remarks": "note"})
    diff = registry_diff(old, new)
    assert diff.added.columns == diff.removed.columns == REGISTRY_SCHEMA.names
    assert [r[KEY] for r in diff.added.collect()] == ["2024-009A"]
    assert [r["Remarks"] for r in diff.added.collect()] == ["note"]
    assert [r[KEY] for r in diff.removed.collect()] == ["2023-001A"]
    assert counts(diff) == (1, 1, 0, 0, False)


CHANGED = {
    "National Designator": ("X", "N-77", "X"),
    "Name of Space Object": ("Other", "Lantern 4", "Other"),
    "State of Registry": ("Chile", "Norway", "Chile"),
    "Date of Launch": (dt.date(1999, 2, 1), "1998-11-20", "1999-02-01"),
    "Status": ("decayed", "in orbit", "decayed"),
    "Date of Decay": (dt.date(2025, 1, 1), None, "2025-01-01"),
    "UN Registered": (True, "false", "true"),
    "Registration Documents": (None, "A/AC.105/INF.400", None),
    "Function": ("", "weather", None),
}


@pytest.mark.parametrize("name", DIFF_COLUMNS)
def test_each_compared_column(spark, name):
    value, old, new = CHANGED[name]
    diff = registry_diff(frame(spark, {}), frame(spark, {name: value}))
    assert changes(diff) == [(ROW[KEY], name, old, new)]
    assert diff.changes.columns == [KEY, "column_name", "old_value", "new_value"]
    assert {t for _, t in diff.changes.dtypes} == {"string"}


@pytest.mark.parametrize("name", ["Remarks", "External website"])
def test_ignored_columns(spark, name):
    assert counts(registry_diff(frame(spark, {}), frame(spark, {name: "new"})))[-1]


def test_blank_equals_null(spark):
    old, new = frame(spark, {"Status": ""}), frame(spark, {"Status": None})
    assert changes(registry_diff(old, new)) == []
    assert changes(registry_diff(new, old)) == []


def test_changes_are_ordered_and_rows_counted_once(spark):
    old = frame(spark, {KEY: "b"}, {KEY: "a"})
    new = frame(spark, {KEY: "b", "Status": "x"}, {KEY: "a", "Status": "x", "Function": "y"})
    diff = registry_diff(old, new)
    assert [c[:2] for c in changes(diff)] == [("a", "Function"), ("a", "Status"), ("b", "Status")]
    assert counts(diff) == (0, 0, 2, 3, False)


def test_missing_columns_name_the_side(spark):
    whole, part = frame(spark, {}), frame(spark, {}).drop("Status", KEY)
    with pytest.raises(ValueError, match="previous.*International Designator.*Status"):
        registry_diff(part, whole)
    with pytest.raises(ValueError, match="current"):
        registry_diff(whole, part)


def test_key_cannot_be_compared(spark):
    df = frame(spark, {})
    with pytest.raises(ValueError):
        diff_snapshots(df, df, KEY, [KEY])


def test_empty_sides(spark):
    empty, one = frame(spark, {}).limit(0), frame(spark, {})
    assert counts(registry_diff(empty, one)) == (1, 0, 0, 0, False)
    assert counts(registry_diff(one, empty)) == (0, 1, 0, 0, False)
    assert counts(registry_diff(empty, empty)) == (0, 0, 0, 0, True)


def test_null_keys_never_match(spark):
    df = frame(spark, {KEY: None}, {KEY: None}, {})
    diff = registry_diff(df, df)
    assert counts(diff) == (2, 2, 0, 0, False)
    assert diff.added.count() == diff.removed.count() == 2


def test_repeated_keys_pair_every_row(spark):
    old = spark.createDataFrame([("k", "a", 1)] * 3 + [("k", "b", 1)], "k string, v string, w int")
    new = spark.createDataFrame([("k", "a", 1)] * 2 + [("k", "c", 2)], "k string, v string, w int")
    diff = diff_snapshots(old, new, "k", ["v", "w"])
    pairs = [(o, n) for o in old.collect() for n in new.collect()]
    expected = Counter(("k", "v", o.v, n.v) for o, n in pairs if o.v != n.v)
    expected += Counter(("k", "w", str(o.w), str(n.w)) for o, n in pairs if o.w != n.w)
    assert Counter(changes(diff)) == Counter(set(expected))
    weighted = {tuple(r)[:4]: r.n_pairs for r in diff.weighted_changes.collect()}
    assert weighted == dict(expected)
    assert counts(diff) == (0, 0, 1, sum(expected.values()), False)


def test_copies_of_a_hot_key_are_counted_not_paired(spark):
    n = 60_000
    rows = spark.range(n).select(F.lit("hot").alias("k"), F.lit("a").alias("v"))
    later = rows.withColumn("v", F.lit("b"))
    diff = diff_snapshots(rows, later, "k", ["v"])
    assert [tuple(r) for r in diff.weighted_changes.collect()] == [("hot", "v", "a", "b", n * n)]
    assert counts(diff) == (0, 0, 1, n * n, False)


def test_counts_of_a_hot_key_build_no_pairs(spark):
    n = 20_000
    rows = spark.range(n).select(F.lit("hot").alias("k"), F.col("id").cast("string").alias("v"))
    diff = diff_snapshots(rows, rows, "k", ["v"])
    assert counts(diff) == (0, 0, 1, n * n - n, False)


def test_count_balance_and_replay(spark):
    old = spark.range(0, 500).select("id", (F.col("id") % 7).cast("string").alias("v"))
    new = spark.range(100, 700).select("id", (F.col("id") % 5).cast("string").alias("v"))
    diff = diff_snapshots(old, new, "id", ["v"], keys_unique=True)
    added, removed, *_ = counts(diff)
    assert added - removed == new.count() - old.count()
    state = {r.id: r.v for r in old.collect()}
    for r in diff.removed.collect():
        del state[r.id]
    state |= {r.id: r.v for r in diff.added.collect()}
    state |= {r.id: r.new_value for r in diff.changes.collect()}
    assert state == {r.id: r.v for r in new.collect()}


def test_history_compares_with_the_predecessor(spark):
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 8), dt.date(2024, 1, 22)]
    rows = [
        (days[0], "a", "1"),
        (days[0], "b", "1"),
        (days[1], "a", "2"),
        (days[1], "c", "1"),
        (days[2], "a", "2"),
        (days[2], "b", "3"),
        (days[2], "c", "1"),
    ]
    history = spark.createDataFrame(rows, "snapshot_date date, k string, v string")
    diff = diff_history(history, "k", ["v"])
    assert changes(diff) == [(days[1], "a", "v", "1", "2")]
    assert {(r.snapshot_date, r.k) for r in diff.added.collect()} == {(days[1], "c"), (days[2], "b")}
    assert {(r.snapshot_date, r.k) for r in diff.removed.collect()} == {(days[1], "b")}


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_unique_keys_meet_in_one_join(spark):
    df = spark.range(10).selectExpr("id", "id as a", "id as b", "id as c")
    diff = diff_snapshots(df, df.where("id > 1"), "id", ["a", "b", "c"], keys_unique=True)
    assert counts(diff) == (0, 2, 0, 0, False)
    for part in (diff.weighted_changes, diff.added, diff.counts):
        assert plan(part).count("Join ") == 1 and plan(part).count("Range (") == 2


def test_single_and_repeated_keys_together(spark):
    old = spark.createDataFrame([(1, "a"), (2, "a"), (2, "b"), (3, "c"), (None, "n"), (5, "x"), (5, "x")], "k int, v string")
    new = spark.createDataFrame([(1, "z"), (2, "a"), (4, "d"), (4, "d"), (None, "n"), (3, "c")], "k int, v string")
    diff = diff_snapshots(old, new, "k", ["v"])
    assert sorted(changes(diff)) == [(1, "v", "a", "z"), (2, "v", "b", "a")]
    assert sorted(diff.added.collect(), key=str) == sorted(new.where("k = 4 or k is null").collect(), key=str)
    assert sorted(diff.removed.collect(), key=str) == sorted(old.where("k = 5 or k is null").collect(), key=str)
    assert counts(diff) == (3, 3, 2, 2, False)
