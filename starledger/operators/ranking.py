"""Pairing rows one to one within groups of any size.

Two sides that share a key are paired by position: the first row of a group with the
first row of the other side's group, and so on. This takes as many rows as the group has,
where a join on the key alone would build every pair.

Groups of one row on either side, nearly all as a rule, are joined as they are. For the
others positions are found without gathering a group in one task: the group is split into
buckets by a digest of its rows, and rows that are equal in what orders them into SALTS
cells. Each cell is numbered by itself and shifted by the sizes of the cells before it in its
bucket and of the buckets before. So neither a large group nor very many copies of one row
meet in one task. Only equal rows may change places; the order of the others is the same for
groups of any size.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starledger.sources.shared import materialize

# Fixed value: leading hex digits of the digest, so at most 256 buckets in a group.
BUCKET_DIGITS = 2
#: Cells of rows that are equal in what orders them.
SALTS = 64


def digest_bucket(*parts: Column) -> Column:
    """Bucket of a row from the MD5 digest of its identifying values."""
    text = F.concat_ws("|", *[p.cast("string") for p in parts])
    return F.substring(F.md5(text.cast("binary")), 1, BUCKET_DIGITS)


@dataclass(frozen=True)
class Queue:
    """One side of a pairing: rows with the group columns, and the order in a group.

    `order` should say all that tells rows apart. Rows that are equal in it are spread by a
    hash of `row_id`, where there is one.
    """

    df: DataFrame
    bucket: Column
    order: tuple[Column, ...]
    row_id: Column | None = None


def _sums_before(counts: DataFrame, within: Sequence[str], order: str, out: str) -> DataFrame:
    """The sum of `_n` over the rows before, in each group."""
    window = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(out, F.coalesce(F.sum("_n").over(window), F.lit(0)))


def with_position(queue: Queue, group: Sequence[str], out: str) -> DataFrame:
    """Add the 1-based position of each row in its group.

    Rows stand in the order of their buckets, and in a bucket in the queue's order.
    """
    salt = F.lit(0) if queue.row_id is None else F.pmod(F.xxhash64(queue.row_id), F.lit(SALTS))
    bucketed = queue.df.withColumns({"_bucket": queue.bucket, "_cell": F.struct(*queue.order, salt.cast("int").alias("_salt"))})
    bucket, cell = [*group, "_bucket"], [*group, "_bucket", "_cell"]
    cells = bucketed.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n"))
    buckets = bucketed.groupBy(*bucket).agg(F.count(F.lit(1)).alias("_n"))
    inside = _sums_before(cells, bucket, "_cell", "_inside").drop("_n")
    before = _sums_before(buckets, group, "_bucket", "_before").where("_before > 0").drop("_n")
    numbered = bucketed.withColumn(
        "_at", F.row_number().over(Window.partitionBy(*cell).orderBy(F.lit(0) if queue.row_id is None else queue.row_id))
    )
    return (
        numbered.join(inside.where("_inside > 0"), cell, "left")
        .join(before, bucket, "left")
        .withColumn(out, F.col("_at") + F.coalesce("_inside", F.lit(0)) + F.coalesce("_before", F.lit(0)))
        .drop("_at", "_inside", "_before", "_bucket", "_cell")
    )


def repeated_groups(sides: Sequence[DataFrame], group: Sequence[str]) -> DataFrame:
    """Groups with several rows on one side; partial counts keep hot groups small."""
    counts = [
        df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*group)
        for df in sides
    ]
    return counts[0].union(counts[1]).distinct()


def pair_by_position(
    left: Queue, right: Queue, group: Sequence[str], groups_unique: bool = False, groups_repeat: bool = False
) -> DataFrame:
    """Full outer join of both sides on `group` and the position in the group.

    Every input row appears exactly once. Rows with a null in `group` pair with nothing
    and skip the join. Beside `group`, the sides must not share column names.
    `groups_unique` says that no group repeats on either side, `groups_repeat` that most do,
    so repeats need not be looked for. Else they are looked for at once, and what is found
    is written: as a rule one plain join is left.
    """
    known = F.expr(" and ".join(f"`{g}` is not null" for g in group))
    sides = [q.df.where(known) for q in (left, right)]
    keys = list(group)
    if groups_unique:
        joined = sides[0].join(sides[1], keys, "full_outer")
    elif groups_repeat:
        queued = [
            with_position(replace(q, df=df), group, "_pos") for df, q in zip(sides, (left, right))
        ]
        joined = queued[0].join(queued[1], [*keys, "_pos"], "full_outer").drop("_pos")
    else:
        repeated = materialize(repeated_groups(sides, group), "repeated-groups")
        if repeated.isEmpty():
            joined = sides[0].join(sides[1], keys, "full_outer")
        else:
            # Both sides meet on the same keys next, so these joins need no shuffle of their own.
            repeated = repeated.hint("merge")
            single = [df.join(repeated, keys, "left_anti") for df in sides]
            many = [
                with_position(replace(q, df=df.join(repeated, keys, "left_semi")), group, "_pos")
                for df, q in zip(sides, (left, right))
            ]
            joined = single[0].join(single[1], keys, "full_outer").unionByName(
                many[0].join(many[1], [*keys, "_pos"], "full_outer").drop("_pos")
            )
    for queue in (left, right):
        joined = joined.unionByName(queue.df.where(~known), allowMissingColumns=True)
    return joined
