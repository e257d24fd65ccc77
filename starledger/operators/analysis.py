"""Reports over the canonical table: orbit gap, constellations, states, registration."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starledger.functions.text import blank_to_null, column, strip

# Fixed value: the remark that names the state a registration is made for.
_ON_BEHALF = r"\(for ([^)]*)\)"


def _lookup(table: Mapping[str, str], c: Column) -> Column:
    """Value for `c` from a table written in code; null when it has none."""
    if not table:
        return F.lit(None).cast("string")
    entries = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), c)


def registered_for(state: Column | str) -> Column:
    """The X of "(for X)", null when there is none."""
    return blank_to_null(strip(F.regexp_extract(column(state), _ON_BEHALF, 1)))


def canonical_state(state: Column | str, equivalents: Mapping[str, str]) -> Column:
    """State without its "(for X)", replaced by its equivalent if the table has one."""
    bare = blank_to_null(strip(F.regexp_replace(column(state), r"\s*" + _ON_BEHALF, "")))
    return F.coalesce(_lookup(equivalents, bare), bare)


def constellation(name: Column | str, families: Mapping[str, str]) -> Column:
    """Constellation of an object: its leading letters, lowered, looked up in `families`."""
    family = F.lower(F.regexp_extract(column(name), r"^\s*([A-Za-z]+)", 1))
    return _lookup(families, family)


def with_constellations(df: DataFrame, name: str, families: Mapping[str, str]) -> DataFrame:
    """Add `constellation_id` and `is_megaconstellation`."""
    tagged = df.withColumn("constellation_id", constellation(name, families))
    return tagged.withColumn("is_megaconstellation", F.col("constellation_id").isNotNull())


def without_constellations(df: DataFrame, name: str, families: Mapping[str, str]) -> DataFrame:
    """Rows that belong to no constellation."""
    return df.where(constellation(name, families).isNull())


def orbit_gap(canonical: DataFrame, equivalents: Mapping[str, str] | None = None) -> DataFrame:
    """Tracked objects and registered objects per state and launch year, and their gap."""
    table = equivalents or {}
    state = F.coalesce(
        canonical_state("state_unoosa", table), canonical_state("country_celestrak", table)
    )
    year = F.year(F.coalesce("launch_date_unoosa", "launch_date_celestrak"))
    return (
        canonical.groupBy(state.alias("state"), year.alias("launch_year"))
        .agg(
            F.count_if(F.col("source_presence") != "unoosa_only").alias("tracked"),
            F.count_if("un_registered").alias("registered"),
        )
        .withColumn("gap", F.col("tracked") - F.col("registered"))
    )


def compliance_lag(registered_on: Column | str, launched_on: Column | str) -> Column:
    """Days from launch to registration, null when either is unknown."""
    return F.date_diff(column(registered_on), column(launched_on))


def registration_by_decade(df: DataFrame, launch: str, flag: str) -> DataFrame:
    """Objects, registered objects and their share per launch decade."""
    decade = (F.floor(F.year(column(launch)) / 10) * 10).cast("int")
    registered = F.count_if(column(flag))
    return (
        df.where(column(launch).isNotNull())
        .groupBy(decade.alias("decade"))
        .agg(F.count(F.lit(1)).alias("objects"), registered.alias("registered"))
        .withColumn("share", F.col("registered") / F.col("objects"))
    )
