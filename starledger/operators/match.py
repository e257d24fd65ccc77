"""Hierarchical matching of two catalogs: designator, then name and date, then name alone.

Each pass takes the rows earlier passes left over. Keys that no side repeats meet in one
join; other rows are paired one to one by position within equal keys, so thousands of
fragments with one name and launch date pair in linear work. Only ids and keys travel
through the passes.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starledger.functions.names import with_normal_name
from starledger.functions.similarity import token_key
from starledger.functions.text import column
from starledger.operators.candidates import best_pairs
from starledger.operators.ranking import Queue, digest_bucket, pair_by_position, repeated_groups
from starledger.sources.shared import materialize

# Threshold of the name pass and the offsets of the date pass.
FUZZY_THRESHOLD = 0.90
DAY_OFFSETS = (0, -1, 1)

# Pass names and confidence tiers.
COSPAR, NAME_DATE, FUZZY = "cospar", "name_date", "fuzzy"
UNMATCHED_LEFT, UNMATCHED_RIGHT = "unmatched_unoosa", "unmatched_celestrak"
MEDIUM_SCORE = 0.95


@dataclass(frozen=True)
class Side:
    """A catalog and the columns to match on; `tie` makes the pairing order definite."""

    df: DataFrame
    designator: str
    name: str
    launch: str
    tie: tuple[str, ...] = ()


def match_confidence(source: Column, score: Column) -> Column:
    """high, medium or low from how a row was matched."""
    sure_fuzzy = (source == FUZZY) & (score >= MEDIUM_SCORE)
    return (
        F.when(source == COSPAR, "high")
        .when((source == NAME_DATE) | sure_fuzzy, "medium")
        .otherwise("low")
    )


def source_presence(in_left: Column, in_right: Column) -> Column:
    """Which side a row comes from."""
    return (
        F.when(in_left & in_right, "both").when(in_left, "unoosa_only").otherwise("celestrak_only")
    )


KEYS = ("id", "designator", "name", "day", "bucket", "tie")


def _prepare(side: Side, label: str) -> tuple[DataFrame, DataFrame]:
    """The rows with an id, and the few values per row that the passes work on.

    Both come from one written table, which also makes the ids final.
    """
    named = with_normal_name(side.df, side.name, "_name")
    ties = [column(side.designator), *map(column, side.tie)]
    row = F.struct(*map(column, side.df.columns))
    written = materialize(
        named.select(
            F.monotonically_increasing_id().alias("id"),
            row.alias("row"),
            column(side.designator).alias("designator"),
            F.nullif("_name", F.lit("")).alias("name"),
            column(side.launch).alias("day"),
            digest_bucket(*ties).alias("bucket"),
            F.struct(*ties, F.xxhash64(row).alias("_row_hash")).alias("tie"),
        ),
        label,
    )
    return written.select("id", "row"), written.select(*KEYS)


def _queue(df: DataFrame, side: str, keys: dict[str, Column], by_day: bool = False) -> Queue:
    """Rows of one side as struct `side`, queued by the given keys."""
    own = df.select(*[c.alias(k) for k, c in keys.items()], F.struct("*").alias(side))
    bucket = F.col(f"{side}.bucket")
    if by_day:
        bucket = F.concat_ws("|", F.col(f"{side}.day").cast("string"), bucket)
    return Queue(own, bucket, (F.col(f"{side}.tie"),), F.col(f"{side}.id"))


def _left_over(paired: DataFrame, side: str, other: str) -> DataFrame:
    """Rows of one side that a pass did not pair."""
    rest = paired.where(F.col(side).isNotNull() & F.col(other).isNull())
    return rest.select(*[F.col(f"{side}.{c}") for c in KEYS])


def _matched(paired: DataFrame, source: str, score: Column) -> DataFrame:
    return paired.where("l is not null and r is not null").select(
        F.col("l.id").alias("l_id"),
        F.col("r.id").alias("r_id"),
        F.lit(source).alias("match_source"),
        score.cast("double").alias("match_score"),
    )


def _pair_names(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """Pair the rows of similar names, best pairs first.

    Names are compared once per distinct token set. Within a pair of names rows queue by
    launch day first, so objects of one launch tend to meet.
    """
    keyed = [df.withColumn("_key", token_key("name")) for df in (left, right)]
    names = [
        materialize(df.where("_key <> ''").select(F.col("_key").alias("name")).distinct(), "names")
        for df in keyed
    ]
    best = materialize(best_pairs(*names, threshold), "best-names").hint("merge")
    pair = F.col("pair")
    l_rows = keyed[0].join(
        best.select(F.col("l").alias("_key"), F.col("l").alias("pair"), "score"), "_key"
    )
    r_rows = keyed[1].join(best.select(F.col("r").alias("_key"), F.col("l").alias("pair")), "_key")
    return pair_by_position(
        _queue(l_rows.drop("_key"), "l", {"_k": pair}, by_day=True),
        _queue(r_rows.drop("_key"), "r", {"_k": pair}, by_day=True),
        ["_k"],
    )


def _pair_dated_names(left: DataFrame, right: DataFrame) -> tuple[list[DataFrame], tuple[DataFrame, ...]]:
    """Pairs of equal names and near dates, and the rows left of either side.

    A name that either side has once at most, as most do, has one pair at most, whichever
    the offset: one join on the name. Other names pair by position, an offset after another.
    """
    sides = left, right
    known = [df.where("name is not null") for df in sides]
    repeated = materialize(repeated_groups(known, ["name"]), "repeated-names")
    lone = [
        df.join(repeated, "name", "left_anti").select("name", F.struct(*KEYS).alias(side))
        for df, side in zip(known, "lr")
    ]
    apart = F.datediff("r.day", "l.day")
    met = F.coalesce(apart.isin(*DAY_OFFSETS), F.lit(False)).alias("met")
    joined = materialize(lone[0].join(lone[1], "name", "full_outer").select("l", "r", met), "match-lone-names")
    found = [_matched(joined.where("met"), NAME_DATE, F.lit(None))]
    unpaired = [
        joined.where(f"{side} is not null and not met").select(*[F.col(f"{side}.{c}") for c in KEYS]) for side in "lr"
    ]
    if not repeated.isEmpty():
        rest = [df.join(repeated, "name", "left_semi").select(*KEYS) for df in known]
        for offset in DAY_OFFSETS:
            paired = materialize(
                pair_by_position(
                    _queue(rest[0], "l", {"_k": F.col("name"), "_d": F.date_add("day", offset)}),
                    _queue(rest[1], "r", {"_k": F.col("name"), "_d": F.col("day")}),
                    ["_k", "_d"],
                    groups_repeat=True,
                ),
                "match-name-date",
            )
            found.append(_matched(paired, NAME_DATE, F.lit(None)))
            rest = [_left_over(paired, "l", "r"), _left_over(paired, "r", "l")]
        unpaired = [a.unionByName(b) for a, b in zip(unpaired, rest)]
    nameless = [df.where("name is null").select(*KEYS) for df in sides]
    return found, tuple(a.unionByName(b) for a, b in zip(unpaired, nameless))


def _links(
    left: DataFrame, right: DataFrame, fuzzy_threshold: float | None, designators_unique: bool
) -> DataFrame:
    """Matched row ids (l_id, r_id, match_source, match_score) of all passes, written once."""
    no_score = F.lit(None)
    by_id = {"_k": F.col("designator")}
    paired = materialize(
        pair_by_position(
            _queue(left, "l", by_id), _queue(right, "r", by_id), ["_k"], designators_unique
        ),
        "match-designator",
    )
    found = [_matched(paired, COSPAR, no_score)]
    rest = (_left_over(paired, "l", "r"), _left_over(paired, "r", "l"))
    matched, rest = _pair_dated_names(*rest)
    found += matched
    if fuzzy_threshold is not None:
        paired = _pair_names(*rest, fuzzy_threshold)
        found.append(_matched(paired, FUZZY, F.col("l.score")))
    return materialize(reduce(DataFrame.unionAll, found), "match-links")


def match_catalogs(
    left: Side,
    right: Side,
    fuzzy_threshold: float | None = FUZZY_THRESHOLD,
    designators_unique: bool = False,
) -> DataFrame:
    """Match two catalogs and keep every row of both exactly once.

    Result: structs `l` and `r` (null where a side is absent), `match_source`,
    `match_score` (name pass only), `match_confidence`, `source_presence`. The passes work
    on row ids and keys; whole rows are written once and joined once at the end. Each pass
    is written to the shared folder, which cuts lineage. No name pass runs when
    `fuzzy_threshold` is None.
    """
    l_rows, l_keys = _prepare(left, "match-left")
    r_rows, r_keys = _prepare(right, "match-right")
    links = _links(l_keys, r_keys, fuzzy_threshold, designators_unique).hint("merge")

    l_rows = l_rows.select(F.col("id").alias("l_id"), F.col("row").alias("l"))
    r_rows = r_rows.select(F.col("id").alias("r_id"), F.col("row").alias("r"))
    # All ids of a side, however small the file they are read from: nothing to broadcast.
    both = l_rows.join(links, "l_id").join(r_rows.hint("merge"), "r_id")
    l_only = l_rows.join(links.select("l_id"), "l_id", "left_anti")
    r_only = r_rows.join(links.select("r_id"), "r_id", "left_anti")
    parts = [
        both.select("l", "r", "match_source", "match_score"),
        l_only.select("l", F.lit(UNMATCHED_LEFT).alias("match_source")),
        r_only.select("r", F.lit(UNMATCHED_RIGHT).alias("match_source")),
    ]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return every.select(
        "l",
        "r",
        "match_source",
        "match_score",
        match_confidence(F.col("match_source"), F.col("match_score")).alias("match_confidence"),
        source_presence(F.col("l").isNotNull(), F.col("r").isNotNull()).alias("source_presence"),
    )


def match_report(matched: DataFrame) -> DataFrame:
    """Rows per pass and their share of all rows."""
    counted = matched.groupBy("match_source").agg(F.count(F.lit(1)).alias("n"))
    # Five rows at most: the total is a window over the counts.
    share = F.col("n") / F.sum("n").over(Window.partitionBy())
    return counted.withColumn("share", share)
