"""Plausibility checks and drift."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from starledger.operators.expectations import (
    check_drift,
    check_expectations,
    row_warnings,
    top_values,
)

COLUMNS = (
    "International Designator",
    "Name of Space Object",
    "State of Registry",
    "Date of Launch",
    "Remarks",
)
SCHEMA = ", ".join(f"`{c}` string" for c in COLUMNS)
GOOD = ("2020-001A", "Sat", "USA", "2020-01-01", None)


def report(spark, *changes, previous_count=None, copies=3, **kw):
    rows = [dict(zip(COLUMNS, GOOD)) for _ in range(copies)]
    rows += [dict(zip(COLUMNS, GOOD)) | c for c in changes]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA)
    found = check_expectations(df, previous_count, as_of_year=2026, **kw).collect()
    assert len(found) == 6
    return {r.name: (r.passed, r["count"]) for r in found}


def test_clean_snapshot_passes(spark):
    found = report(spark)
    assert all(passed for passed, _ in found.values())
    assert set(found) == {
        "launch_year",
        "format_year_coherence",
        "xxxx_placeholders",
        "whitespace_residual",
        "sor_outliers",
        "cardinality",
    }


@pytest.mark.parametrize(
    ("launch", "bad"),
    [("1956-12-31", 1), ("1957-01-01", 0), ("2028-01-01", 0), ("2029", 1), ("", 0), ("x", 0), (None, 0)],
)
def test_launch_year(spark, launch, bad):
    assert report(spark, {"Date of Launch": launch})["launch_year"] == (bad == 0, bad)


def test_launch_year_of_a_date_column(spark):
    df = spark.createDataFrame([GOOD] * 3, SCHEMA)
    dated = df.withColumn("Date of Launch", F.lit(dt.date(1950, 1, 1)))
    rows = {r.name: r for r in check_expectations(dated, as_of_year=2026).collect()}
    assert rows["launch_year"]["count"] == 3


@pytest.mark.parametrize(
    ("designator", "bad"),
    [
        ("1962-BETA OMEGA 1", 0),
        ("1963-ALPHA 1", 1),
        ("1974-ALPHA BETA", 1),
        ("1961-001A", 1),
        ("1963-001A", 0),
        ("1974-XXXX", 0),
        ("1974-AB", 0),
        ("", 0),
        (None, 0),
    ],
)
def test_designator_form(spark, designator, bad):
    found = report(spark, {"International Designator": designator})
    assert found["format_year_coherence"] == (bad == 0, bad)


def test_placeholders_are_only_counted(spark):
    found = report(spark, {"International Designator": "1974-XXXX"}, {"International Designator": "XXXX"})
    assert found["xxxx_placeholders"] == (True, 2)


@pytest.mark.parametrize("text", [" a", "a  ", "a\t", " a"])
def test_outer_whitespace(spark, text):
    assert report(spark, {"Remarks": text})["whitespace_residual"] == (False, 1)
    assert report(spark, {"Remarks": text, "Name of Space Object": text})["whitespace_residual"][1] == 2


def test_rare_categories(spark):
    found = report(spark, {"State of Registry": "X"}, {"State of Registry": ""}, {"State of Registry": None})
    assert found["sor_outliers"] == (False, 1)
    assert report(spark, *[{"State of Registry": "X"}] * 3)["sor_outliers"] == (True, 0)


def test_rare_categories_are_listed_in_order(spark):
    df = spark.createDataFrame(
        [(GOOD[0], GOOD[1], f"S{i:02d}", GOOD[3], None) for i in range(15)], SCHEMA
    )
    detail = {r.name: r.detail for r in check_expectations(df, as_of_year=2026).collect()}["sor_outliers"]
    assert detail.startswith("15 values") and detail.endswith(", ".join(f"S{i:02d}" for i in range(10)))


@pytest.mark.parametrize(
    ("previous", "expected"),
    [(None, (True, 0)), (100, (True, 0)), (96, (True, 0)), (95, (False, 1)), (0, (False, 1)), (106, (False, 1))],
)
def test_cardinality(spark, previous, expected):
    assert report(spark, previous_count=previous, copies=100)["cardinality"] == expected


def test_bad_arguments(spark):
    df = spark.createDataFrame([GOOD], SCHEMA)
    with pytest.raises(ValueError):
        check_expectations(df, previous_count=-1)
    with pytest.raises(ValueError, match="State of Registry"):
        check_expectations(df.drop("State of Registry"))
    with pytest.raises(PySparkException, match="rows"):
        check_expectations(df.limit(0)).collect()


def drift(spark, previous, current, added, **kw):
    schema = "`State of Registry` string, `UN Registered` boolean"
    frames = [spark.createDataFrame(rows, schema) for rows in (previous, current, added)]
    return {r.name: (r.passed, r["count"]) for r in check_drift(*frames, **kw).collect()}


def test_drift(spark):
    old = [("A", True)] * 50 + [("B", False)] * 50
    new = [("A", True)] * 53 + [("C", None)] * 47
    found = drift(spark, old, new, new[:9], total_rows=(1, 100))
    assert found == {
        "new_rows": (False, 9),
        "flagged_share": (False, 1),
        "top_values": (False, 2),
        "total_rows": (True, 100),
    }
    same = drift(spark, old, old, old[:10])
    assert same["new_rows"] == (True, 10) and same["flagged_share"] == (True, 0)
    assert same["top_values"] == (True, 0) and same["total_rows"] == (False, 100)
    two_points = [("A", True)] * 52 + [("B", False)] * 48
    assert drift(spark, old, two_points, old)["flagged_share"] == (True, 0)


def test_top_values_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), ("",), (None,)], "s string")
    assert [tuple(r) for r in top_values(df, "s", 2).collect()] == [("c", 2), ("a", 1)]


def test_row_warnings(spark):
    day = dt.date
    rows = [
        ("In Orbit", day(2020, 1, 1), day(2021, 1, 1)),
        ("decayed", day(2020, 1, 1), day(2019, 1, 1)),
        ("in orbit", day(2020, 1, 1), day(2019, 1, 1)),
        ("in orbit", day(2020, 1, 1), None),
        (None, day(2020, 1, 1), day(2020, 1, 1)),
    ]
    df = spark.createDataFrame(rows, "Status string, `Date of Launch` date, `Date of Decay` date")
    found = [r.warning for r in row_warnings(df).collect()]
    assert sorted(found) == ["decay before launch"] * 2 + ["in orbit with a decay date"] * 2
