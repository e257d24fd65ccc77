"""The weekly run: load, validate, check, save, compare with the previous snapshot."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation

from starledger.operators.contracts import check_counts, rule_counts
from starledger.operators.diff import SnapshotDiff, diff_snapshots
from starledger.operators.events import append_events, row_events
from starledger.operators.expectations import (
    check_drift,
    check_expectations,
    rare_values,
    row_measures,
    row_warnings,
)
from starledger.plans.contracts import DIFF_COLUMNS, REGISTRY
from starledger.sources.pages import check_completeness, checked_counts, load_registry
from starledger.sources.snapshots import (
    append_changes,
    load_snapshot,
    previous_snapshot_date,
    save_snapshot,
)

CATEGORY = "State of Registry"


@dataclass(frozen=True)
class WeeklyResult:
    """What a run produced; `diff`, `drift` and `changelog` are None on the first run."""

    snapshot_date: date
    path: str
    rows: int
    expectations: DataFrame
    rare_values: DataFrame
    warnings: DataFrame
    diff: SnapshotDiff | None
    drift: DataFrame | None
    changelog: str | None
    events: str | None = None


def registry_diff(previous: DataFrame, current: DataFrame) -> SnapshotDiff:
    """Diff of two registry snapshots; one pass over the keys tells whether any repeats."""
    return diff_snapshots(previous, current, REGISTRY.key, DIFF_COLUMNS)


def weekly_ingest(
    pages: DataFrame,
    snapshot_date: date,
    base: str,
    overwrite: bool = False,
    as_of_year: int | None = None,
    changelog_base: str | None = None,
    events_base: str | None = None,
) -> WeeklyResult:
    """Take one landed load of registry pages into the snapshot store.

    The load is read once: while it is written, its records, the contract's rules and the row
    checks are counted, and the snapshot is committed only if it is complete and the contract
    holds. An incomplete load, told first, or a broken contract stops the run; expectations, drift checks and row warnings do not. With `changelog_base`
    the changed values are added to a changelog there, with `events_base` the added, changed
    and removed rows to an event log, from which any snapshot can be rebuilt; a date that is
    already in either is refused.
    """
    spark = pages.sparkSession
    landed = Observation()
    load = load_registry(pages, landed)
    day_before = previous_snapshot_date(spark, base, snapshot_date)
    try:
        previous = load_snapshot(spark, day_before, base, REGISTRY.version) if day_before else None
    except FileNotFoundError:
        previous = None
    seen: dict[str, int] = {}

    def accept(counts: dict) -> None:
        checked_counts(spark, landed.get)
        check_counts(load, REGISTRY, counts)
        seen.update(counts)

    measures = [*rule_counts(load, REGISTRY), *row_measures(load, as_of_year)]
    try:
        path = save_snapshot(
            load, snapshot_date, base, overwrite, REGISTRY.version, measures, accept
        )
    except Exception:
        check_completeness(pages)  # says so where a load that fails is incomplete as well
        raise
    current = load_snapshot(spark, snapshot_date, base, REGISTRY.version)
    previous_rows = previous.count() if previous is not None else None
    report = check_expectations(current, previous_rows, as_of_year, measured=seen)
    diff = registry_diff(previous, current) if previous is not None else None
    logged = told = None
    if diff is not None and changelog_base:
        logged = append_changes(diff.weighted_changes, snapshot_date, changelog_base)
    if events_base:
        told = append_events(row_events(previous, current, REGISTRY.key), snapshot_date, events_base)
    return WeeklyResult(
        snapshot_date,
        path,
        seen["rows"],
        report,
        rare_values(current, CATEGORY),
        row_warnings(current),
        diff,
        check_drift(previous, current, diff.added) if diff is not None else None,
        logged,
        told,
    )
