"""Column contracts: ordered fields with types, nullability and value rules.

A contract is data. It compiles to one predicate per rule, all evaluated in a single
pass over the frame. Null passes every value rule; nullability is a rule of its own.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starledger.functions.text import column

VIOLATION_SCHEMA = "column_name string, check string, value string"


@dataclass(frozen=True)
class Rule:
    """One value rule: matches, ge, gt, le, lt or isin."""

    check: str
    bound: object

    def holds(self, c: Column) -> Column:
        if self.check == "matches":
            return c.rlike(self.bound)
        if self.check == "isin":
            return c.isin(*self.bound)
        limit = F.lit(self.bound)
        compare = {"ge": c >= limit, "gt": c > limit, "le": c <= limit, "lt": c < limit}
        return compare[self.check]

    @property
    def label(self) -> str:
        bound = self.bound
        if isinstance(bound, dt.date):
            bound = bound.isoformat()
        elif isinstance(bound, tuple):
            bound = ",".join(map(str, bound))
        return f"{self.check}({bound})"


@dataclass(frozen=True)
class Field:
    """A contract column."""

    name: str
    dtype: T.DataType
    nullable: bool = True
    rules: tuple[Rule, ...] = ()

    def failures(self) -> list[tuple[str, Column]]:
        """Label and failure predicate of each row rule; predicates are never null."""
        c = column(self.name)
        found = [] if self.nullable else [("not_null", c.isNull())]
        for rule in self.rules:
            found.append((rule.label, F.coalesce(~rule.holds(c), F.lit(False))))
        return found


@dataclass(frozen=True)
class Contract:
    """Named, versioned set of fields; `ordered` makes column order part of it."""

    name: str
    version: str
    fields: tuple[Field, ...]
    ordered: bool = True
    key: tuple[str, ...] = field(default=())

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.dtype, f.nullable) for f in self.fields])

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    def __getitem__(self, name: str) -> Field:
        return next(f for f in self.fields if f.name == name)


class ContractError(ValueError):
    """A frame breaks its contract. `failures` has (column_name, check, count)."""

    def __init__(self, contract: Contract, failures: list[tuple[str, str, int]]):
        self.failures = failures
        listed = "; ".join(f"{c}: {check} ({n})" for c, check, n in failures)
        super().__init__(f"{contract.name} {contract.version}: {listed}")


def schema_failures(schema: T.StructType, contract: Contract) -> list[tuple[str, str, int]]:
    """Missing, unexpected, mistyped and misplaced columns; needs no data."""
    names, wanted = schema.names, contract.columns
    found = [(n, "missing", 1) for n in wanted if n not in names]
    found += [(n, "unexpected", 1) for n in names if n not in wanted]
    for f in contract.fields:
        if f.name in names and schema[f.name].dataType != f.dtype:
            actual = schema[f.name].dataType.simpleString()
            found.append((f.name, f"dtype({f.dtype.simpleString()}), is {actual}", 1))
    if contract.ordered:
        present = [n for n in names if n in wanted]
        expected = [n for n in wanted if n in names]
        found += [(n, "order", 1) for n, e in zip(present, expected) if n != e]
    return found


def _checkable(df: DataFrame, contract: Contract) -> list[Field]:
    return [
        f for f in contract.fields if f.name in df.columns and df.schema[f.name].dataType == f.dtype
    ]


def violations(df: DataFrame, contract: Contract, keep: Sequence[str] = ()) -> DataFrame:
    """Every broken rule of every row as (keep..., column_name, check, value)."""
    broken = [
        F.when(
            fails,
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(label).alias("check"),
                column(f.name).cast("string").alias("value"),
            ),
        )
        for f in _checkable(df, contract)
        for label, fails in f.failures()
    ]
    if not broken:
        kept = df.select(*map(column, keep)).where(F.lit(False))
        return kept.select("*", F.inline(F.lit(None).cast(f"array<struct<{_struct_fields()}>>")))
    return df.select(*map(column, keep), F.inline(F.array_compact(F.array(*broken))))


def _struct_fields() -> str:
    return ",".join(":".join(part.split()) for part in VIOLATION_SCHEMA.split(","))


def _rules(df: DataFrame, contract: Contract) -> list[tuple[str, str, Column]]:
    return [(f.name, label, fails) for f in _checkable(df, contract) for label, fails in f.failures()]


def rule_counts(df: DataFrame, contract: Contract) -> list[Column]:
    """Aggregates of `df`: `rows`, and rows broken per rule as n0, n1, ...

    They fit `agg` as well as `observe`, which takes them while something else runs.
    """
    rules = enumerate(_rules(df, contract))
    return [F.count(F.lit(1)).alias("rows"), *[F.count_if(fails).alias(f"n{i}") for i, (_, _, fails) in rules]]


def violation_summary(df: DataFrame, contract: Contract) -> DataFrame:
    """Rows broken per rule, zero included, and `rows` in all: one aggregate, one pass."""
    counts = df.agg(*rule_counts(df, contract))
    per_rule = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(label).alias("check"),
            F.col(f"n{i}").alias("violations"),
        )
        for i, (name, label, _) in enumerate(_rules(df, contract))
    ]
    empty = F.struct(
        F.lit("*").alias("column_name"),
        F.lit("non_empty").alias("check"),
        F.when(F.col("rows") == 0, 1).otherwise(0).cast("bigint").alias("violations"),
    )
    return counts.select(F.inline(F.array(empty, *per_rule)), "rows")


def check_counts(df: DataFrame, contract: Contract, counts: Mapping[str, int]) -> None:
    """Raise one error that lists every rule that `rule_counts` found broken."""
    failures = schema_failures(df.schema, contract)
    if not counts["rows"]:
        failures.append(("*", "non_empty", 1))
    for i, (name, label, _) in enumerate(_rules(df, contract)):
        if counts[f"n{i}"]:
            failures.append((name, label, counts[f"n{i}"]))
    if failures:
        raise ContractError(contract, failures)


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count; null keys do not count."""
    known = F.expr(" and ".join(f"`{k}` is not null" for k in key))
    counted = df.where(known).groupBy(*map(column, key)).agg(F.count(F.lit(1)).alias("n"))
    return counted.where("n > 1")


def validate(df: DataFrame, contract: Contract, unique_key: bool = False) -> DataFrame:
    """Return `df` unchanged, or raise one error that lists every broken rule.

    One aggregate job covers all value rules and the non-empty test. `unique_key` adds
    the key's uniqueness, which needs a shuffle of the key alone.
    """
    failures = schema_failures(df.schema, contract)
    for row in violation_summary(df, contract).where("violations > 0").collect():
        failures.append((row["column_name"], row["check"], row["violations"]))
    if unique_key and all(k in df.columns for k in contract.key):
        repeated = duplicate_keys(df, contract.key).count()
        if repeated:
            failures.append((",".join(contract.key), "unique", repeated))
    if failures:
        raise ContractError(contract, failures)
    return df


# --- contract evolution -------------------------------------------------------------

ADDITIVE, BREAKING = "additive", "breaking"


def _rule_tier(old: Rule | None, new: Rule | None) -> str:
    if new is None:
        return ADDITIVE
    if old is None:
        return BREAKING
    if old.check == "isin":
        return ADDITIVE if set(old.bound) <= set(new.bound) else BREAKING
    if old.check in ("ge", "gt"):
        return ADDITIVE if new.bound <= old.bound else BREAKING
    if old.check in ("le", "lt"):
        return ADDITIVE if new.bound >= old.bound else BREAKING
    return BREAKING


def contract_changes(old: Contract, new: Contract) -> list[tuple[str, str, str]]:
    """Differences as (column_name, change, tier).

    Additive: a nullable column appended at the end, a wider value set or range, a
    dropped rule. All else is breaking, relaxing a column to nullable included, because
    readers of the old contract may rely on it.
    """
    found: list[tuple[str, str, str]] = []
    kept = [n for n in new.columns if n in old.columns]
    tail = new.columns[len(kept) :] if new.columns[: len(kept)] == kept else []
    for name in old.columns:
        if name not in new.columns:
            found.append((name, "removed", BREAKING))
    for f in new.fields:
        if f.name not in old.columns:
            appended = f.name in tail and f.nullable
            found.append((f.name, "added", ADDITIVE if appended else BREAKING))
    if kept != [n for n in old.columns if n in kept]:
        found.append(("*", "reordered", BREAKING))
    for name in kept:
        a, b = old[name], new[name]
        if a.dtype != b.dtype:
            found.append((name, "dtype", BREAKING))
        if a.nullable != b.nullable:
            found.append((name, "nullability", BREAKING))
        before, after = ({r.check: r for r in f.rules} for f in (a, b))
        for check in dict.fromkeys([*before, *after]):
            if before.get(check) != after.get(check):
                tier = _rule_tier(before.get(check), after.get(check))
                found.append((name, f"rule {check}", tier))
    if old.key != new.key:
        found.append((",".join(new.key), "key", BREAKING))
    return found


def frozen_failures(manifest: Sequence[tuple[str, str, bool]], contract: Contract) -> list[str]:
    """Check a contract against a frozen (name, type, nullable) manifest.

    Every frozen column must still be there with its type, nullability and relative
    order; columns added since are allowed.
    """
    problems = []
    for name, dtype, nullable in manifest:
        if name not in contract.columns:
            problems.append(f"{name}: removed")
            continue
        f = contract[name]
        if f.dtype.simpleString() != dtype:
            problems.append(f"{name}: {dtype} became {f.dtype.simpleString()}")
        if f.nullable != nullable:
            problems.append(f"{name}: nullability changed")
    frozen = [name for name, _, _ in manifest]
    if [n for n in contract.columns if n in frozen] != [n for n in frozen if n in contract.columns]:
        problems.append("order changed")
    return problems


def schema_report(df: DataFrame, contract: Contract) -> DataFrame:
    """Contract and frame side by side, one row per column of either.

    Position, type and observed nulls; the null counts are one pass over the frame.
    """
    names = list(dict.fromkeys([*contract.columns, *df.columns]))
    present = [n for n in names if n in df.columns]
    nulls = df.agg(*[F.count_if(column(n).isNull()).alias(f"n{i}") for i, n in enumerate(present)])

    def entry(name: str) -> Column:
        frozen = contract[name] if name in contract.columns else None
        actual = df.schema[name].dataType if name in df.columns else None
        observed = F.col(f"n{present.index(name)}") if actual is not None else F.lit(None)
        same_type = frozen is not None and actual is not None and frozen.dtype == actual
        same_place = same_type and contract.columns.index(name) == df.columns.index(name)
        nulls_ok = F.lit(True) if frozen is None or frozen.nullable else observed == 0
        return F.struct(
            F.lit(name).alias("column_name"),
            F.lit(frozen is not None).alias("in_contract"),
            F.lit(actual is not None).alias("in_frame"),
            F.lit(same_type).alias("type_ok"),
            F.lit(same_place).alias("place_ok"),
            observed.cast("bigint").alias("nulls"),
            F.coalesce(nulls_ok, F.lit(False)).alias("nulls_ok"),
        )

    return nulls.select(F.inline(F.array(*map(entry, names))))
