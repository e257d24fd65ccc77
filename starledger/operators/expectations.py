"""Plausibility checks of a registry snapshot, and drift between snapshots.

A report is a frame of (name, passed, count, detail); no check stops a run. The row
checks and the row count come from one aggregate, rare values from one grouping.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starledger.functions.text import column, has_edge_space, leading_year, year_of

# Limits and patterns of the checks.
FIRST_LAUNCH_YEAR = 1957
YEARS_AHEAD = 2
MODERN_DESIGNATOR_YEAR = 1963
GREEK_DESIGNATOR = r"^\d{4}-[A-Z]{4,}"
MODERN_DESIGNATOR = r"^\d{4}-\d{3}[A-Z0-9]+"
PLACEHOLDER = "XXXX"
MIN_FREQUENCY = 3
COUNT_TOLERANCE = 0.05
LISTED_VALUES = 10

# Limits of the drift checks.
NEW_ROWS = (10, 500)
TOTAL_ROWS = (20_000, 60_000)
SHARE_DRIFT_POINTS = 2.0
TOP_VALUES = 10


# Columns that the checks read.
@dataclass(frozen=True)
class RegistryColumns:
    """Columns the checks look at."""

    designator: str = "International Designator"
    launch: str = "Date of Launch"
    category: str = "State of Registry"
    text: tuple[str, ...] = (
        "International Designator",
        "National Designator",
        "Name of Space Object",
        "State of Registry",
        "Status",
        "Function",
        "Remarks",
        "Registration Documents",
        "External website",
    )


def implausible_year(year: Column, as_of_year: int) -> Column:
    """Year before the first launch or too far ahead; unknown years are fine."""
    plausible = year.between(FIRST_LAUNCH_YEAR, as_of_year + YEARS_AHEAD)
    return F.coalesce(~plausible, F.lit(False))


def incoherent_designator(c: Column | str) -> Column:
    """Greek-letter form from 1963 on, or the modern form before; placeholders are skipped."""
    text = column(c)
    year = leading_year(text)
    greek = text.rlike(GREEK_DESIGNATOR) & (year >= MODERN_DESIGNATOR_YEAR)
    modern = text.rlike(MODERN_DESIGNATOR) & (year < MODERN_DESIGNATOR_YEAR)
    return F.coalesce(~text.contains(PLACEHOLDER) & (greek | modern), F.lit(False))


def _known(category: str) -> Column:
    value = column(category)
    return value.isNotNull() & (value.cast("string") != "")


def rare_values(
    df: DataFrame, category: str, below: int = MIN_FREQUENCY, count: str = "n"
) -> DataFrame:
    """Values of a column with fewer than `below` rows; null and '' are no values."""
    counted = df.where(_known(category)).groupBy(column(category)).agg(F.count(F.lit(1)).alias(count))
    return counted.where(F.col(count) < below)


def _row(name: str, passed: Column, count: Column, good: Column, bad: Column) -> Column:
    return F.struct(
        F.lit(name).alias("name"),
        passed.alias("passed"),
        count.cast("bigint").alias("count"),
        F.when(passed, good).otherwise(bad).alias("detail"),
    )


def _count_row(name: str, count: str, good: str, bad: str) -> Column:
    n = F.col(count)
    return _row(name, n == 0, n, F.lit(good), F.format_string(bad, n))


def _cardinality_row(previous_count: int | None) -> Column:
    if previous_count is None:
        skipped = F.lit("skipped: no previous snapshot")
        return _row("cardinality", F.lit(True), F.lit(0), skipped, skipped)
    rows = F.col("_rows")
    drift = F.abs(rows - previous_count) / F.lit(max(previous_count, 1))
    passed = drift <= COUNT_TOLERANCE
    text = F.format_string(f"%d rows after {previous_count}, drift %.2f%%", rows, drift * 100)
    return _row("cardinality", passed, F.when(passed, 0).otherwise(1), text, text)


#: Names of the row measures.
MEASURES = ("_rows", "_years", "_forms", "_placeholders", "_edges")


def row_measures(
    df: DataFrame, as_of_year: int | None = None, columns: RegistryColumns = RegistryColumns()
) -> list[Column]:
    """What the row checks count, as aggregates of `df` for `agg` or `observe`."""
    required = {columns.designator, columns.launch, columns.category}
    missing = sorted(required - set(df.columns))
    if missing:
        raise ValueError(f"expectations need columns: {missing}")
    as_of_year = as_of_year or datetime.now(UTC).year
    launch_year = year_of(columns.launch, dict(df.dtypes)[columns.launch])
    designator = column(columns.designator)
    edges = [F.count_if(has_edge_space(c)) for c in columns.text if c in df.columns]
    return [
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(implausible_year(launch_year, as_of_year)).alias("_years"),
        F.count_if(incoherent_designator(designator)).alias("_forms"),
        F.count_if(designator.contains(PLACEHOLDER)).alias("_placeholders"),
        reduce(lambda a, b: a + b, edges, F.lit(0)).alias("_edges"),
    ]


def check_expectations(
    df: DataFrame,
    previous_count: int | None = None,
    as_of_year: int | None = None,
    columns: RegistryColumns = RegistryColumns(),
    listed_values: int = LISTED_VALUES,
    measured: Mapping[str, int] | None = None,
) -> DataFrame:
    """Six checks as six rows. An empty frame fails when the report is evaluated.

    `as_of_year` fixes the latest plausible launch year; the current UTC year if not set.
    The text of the last check names up to `listed_values` rare values, its count all;
    `rare_values` gives them as rows, `edge_space_counts` the whitespace of each column.
    `measured` has the values of `row_measures` where they are known already.
    """
    if previous_count is not None and previous_count < 0:
        raise ValueError(f"previous_count must not be negative: {previous_count}")
    as_of_year = as_of_year or datetime.now(UTC).year
    measures = row_measures(df, as_of_year, columns)
    if measured is None:
        measured = df.agg(*measures)
    else:
        known = [F.lit(measured[c]).cast("bigint").alias(c) for c in MEASURES]
        measured = df.sparkSession.range(1).select(*known)
    # A filter, so that the test runs whichever columns are read.
    guarded = measured.where(
        F.when(F.col("_rows") > 0, F.lit(True)).otherwise(
            F.raise_error(F.lit("expectations need a frame with rows")).try_cast("boolean")
        )
    )
    placeholders = F.col("_placeholders")
    note = F.format_string("%d placeholder designators", placeholders)
    row_checks = guarded.select(
        F.inline(
            F.array(
                _count_row(
                    "launch_year",
                    "_years",
                    "all launch years are plausible",
                    f"%d rows outside {FIRST_LAUNCH_YEAR}..{as_of_year + YEARS_AHEAD}",
                ),
                _count_row(
                    "format_year_coherence",
                    "_forms",
                    "designator forms fit their years",
                    "%d designators whose form does not fit the year",
                ),
                _row("xxxx_placeholders", F.lit(True), placeholders, note, note),
                _count_row(
                    "whitespace_residual",
                    "_edges",
                    "no outer whitespace",
                    "%d cells with outer whitespace",
                ),
                _cardinality_row(previous_count),
            )
        )
    )
    return row_checks.unionByName(_rare_value_check(df, columns.category, listed_values))


def _rare_value_check(df: DataFrame, category: str, listed_values: int) -> DataFrame:
    rare = rare_values(df, category, count="_n").select(column(category).alias("_v"), F.lit(1).alias("_c"))
    # The count is an aggregate; only the few listed values are gathered, in order.
    listed = rare.orderBy("_v").limit(listed_values).select("_v", F.lit(0).alias("_c"))
    counted = rare.agg(F.count(F.lit(1)).alias("_c")).select(F.lit(None).cast("string").alias("_v"), "_c")
    both = counted.unionByName(listed.withColumn("_v", F.col("_v").cast("string"))).agg(
        F.sum("_c").alias("_c"), F.array_join(F.sort_array(F.collect_list("_v")), ", ").alias("_v")
    )
    n = F.col("_c")
    bad = F.format_string(f"%d values with fewer than {MIN_FREQUENCY} rows: %s", n, F.col("_v"))
    return both.select(
        F.inline(F.array(_row("sor_outliers", n == 0, n, F.lit("no rare values"), bad)))
    )


def edge_space_counts(df: DataFrame, columns: RegistryColumns = RegistryColumns()) -> DataFrame:
    """Cells with outer whitespace in each text column, as (column_name, n): one pass."""
    names = [c for c in columns.text if c in df.columns]
    counted = df.agg(*[F.count_if(has_edge_space(c)).alias(f"n{i}") for i, c in enumerate(names)])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n")) for i, c in enumerate(names)]
    return counted.select(F.inline(F.array(*rows)))


def top_values(df: DataFrame, category: str, limit: int = TOP_VALUES) -> DataFrame:
    """The most frequent values with counts; ties go to the smaller value."""
    counted = df.where(_known(category)).groupBy(column(category).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), F.asc("value")).limit(limit)


def check_drift(
    previous: DataFrame,
    current: DataFrame,
    added: DataFrame,
    flag: str = "UN Registered",
    category: str = "State of Registry",
    new_rows: Sequence[int] = NEW_ROWS,
    total_rows: Sequence[int] = TOTAL_ROWS,
) -> DataFrame:
    """Four checks of a snapshot against the one before, as (name, passed, count, detail).

    Number of added rows, share of flagged rows in percentage points, stability of the
    most frequent categories, and total rows. All inputs reduce to single rows first.
    """

    def flagged_share(df: DataFrame, name: str) -> DataFrame:
        share = F.avg(F.coalesce(column(flag), F.lit(False)).cast("double")) * 100
        return df.agg(F.count(F.lit(1)).alias(f"{name}_rows"), share.alias(f"{name}_share"))

    before = top_values(previous, category).select("value", F.lit(1).alias("before"))
    after = top_values(current, category).select("value", F.lit(1).alias("after"))
    moved = before.join(after, "value", "full_outer").where("before is null or after is null")
    measures = [
        flagged_share(previous, "previous"),
        flagged_share(current, "current"),
        added.agg(F.count(F.lit(1)).alias("added")),
        moved.agg(F.count(F.lit(1)).alias("moved")),
    ]
    # One tagged row per measure, folded into one row: no join of any kind.
    names = [c for m in measures for c in m.columns]
    folded = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), measures).agg(
        *[F.max(n).alias(n) for n in names]
    )
    drift = F.coalesce(F.abs(F.col("current_share") - F.col("previous_share")), F.lit(0.0))
    share_ok = F.round(drift, 9) <= SHARE_DRIFT_POINTS
    added_ok = F.col("added").between(*new_rows)
    total_ok = F.col("current_rows").between(*total_rows)
    added_text = F.format_string("%d new rows", F.col("added"))
    share_text = F.format_string("flagged share moved %.4f points", drift)
    moved_text = F.format_string("%d values entered or left the top", F.col("moved"))
    total_text = F.format_string("%d rows", F.col("current_rows"))
    return folded.select(
        F.inline(
            F.array(
                _row("new_rows", added_ok, F.col("added"), added_text, added_text),
                _row(
                    "flagged_share",
                    share_ok,
                    F.when(share_ok, 0).otherwise(1),
                    share_text,
                    share_text,
                ),
                _row("top_values", F.col("moved") == 0, F.col("moved"), moved_text, moved_text),
                _row("total_rows", total_ok, F.col("current_rows"), total_text, total_text),
            )
        )
    )


def row_warnings(
    df: DataFrame,
    status: str = "Status",
    launch: str = "Date of Launch",
    decay: str = "Date of Decay",
    in_orbit: Sequence[str] = ("in orbit", "active"),
) -> DataFrame:
    """Rows that break a business rule, one row per broken rule, column `warning` added.

    An object in orbit has no decay date, and nothing decays before its launch.
    """
    orbiting = F.lower(column(status)).isin(*in_orbit)
    broken = F.array(
        F.when(orbiting & column(decay).isNotNull(), F.lit("in orbit with a decay date")),
        F.when(column(decay) < column(launch), F.lit("decay before launch")),
    )
    return df.select("*", F.explode(F.array_compact(broken)).alias("warning"))
