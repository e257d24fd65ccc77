"""Contract rows with one changed field, structure rules, evolution."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import types as T

from starledger.operators.contracts import (
    ADDITIVE,
    BREAKING,
    Contract,
    ContractError,
    Field,
    Rule,
    contract_changes,
    duplicate_keys,
    frozen_failures,
    schema_report,
    validate,
    violation_summary,
    violations,
)
from starledger.plans.contracts import CANONICAL, GP, REGISTRY, SATCAT

DAY = dt.date(2024, 1, 1)
VALID = {
    "registry": (
        REGISTRY,
        dict(zip(REGISTRY.columns, ("1998-067A", "N-77", "Lantern 4", "Norway", DAY, "in orbit", None, False,
                                    "A/AC.105/INF.400", "weather", None, None))),
    ),
    "gp": (
        GP,
        dict(zip(GP.columns, ("LANTERN 4", "1998-067A", "2031-01-02T03:04:05", 15.5, 0.25,
                              51.5, 10.0, 20.0, 30.0, 0, "C", 4711, 12, 34, 0.125, 0.0, 0.0))),
    ),
    "satcat": (
        SATCAT,
        dict(zip(SATCAT.columns, ("LANTERN 4 DEB", "1998-067B", 4712, "DEB", "-", "NOR", dt.date(1998, 11, 20),
                                  "SVA", None, 92.5, 51.5, 420, 410, None, None, "EA", "ORB"))),
    ),
    "canonical": (
        CANONICAL,
        dict(zip(CANONICAL.columns, ("1998-067A", 4711, "Lantern 4", "LANTERN 4", "Norway", "NOR", DAY, DAY,
                                     "in orbit", None, False, "A/AC.105/INF.400", "weather", 15.5, 0.25, "LEO",
                                     None, "cospar", None, "high", "both", None, None,
                                     dt.date(2031, 1, 2)))),
    ),
}


def open_schema(contract):
    return T.StructType([T.StructField(f.name, f.dtype) for f in contract.fields])


def frame(spark, kind, **changed):
    contract, row = VALID[kind]
    return contract, spark.createDataFrame([tuple((row | changed).values())], open_schema(contract))


@pytest.mark.parametrize("kind", VALID)
def test_valid_row_comes_back_unchanged(spark, kind):
    contract, df = frame(spark, kind)
    assert validate(df, contract, unique_key=True) is df


@pytest.mark.parametrize("kind", VALID)
def test_required_columns(spark, kind):
    contract, row = VALID[kind]
    _, df = frame(spark, kind, **{f.name: None for f in contract.fields})
    failed = {r.column_name for r in violations(df, contract).collect()}
    assert failed == {f.name for f in contract.fields if not f.nullable}


BAD = [
    ("registry", "International Designator", ["", "NULL", "2024", "2024-", "24-001A", "2024-001a", "2024-001A\n"]),
    ("registry", "Date of Launch", [dt.date(1957, 10, 3)]),
    ("registry", "Date of Decay", [dt.date(1900, 1, 1)]),
    ("gp", "OBJECT_ID", ["x"]),
    ("gp", "MEAN_MOTION", [-0.1, 20.1]),
    ("gp", "ECCENTRICITY", [-0.1, 1.0]),
    ("gp", "INCLINATION", [-0.1, 180.1]),
    ("gp", "RA_OF_ASC_NODE", [-0.1, 360.1]),
    ("gp", "ARG_OF_PERICENTER", [-0.1, 360.1]),
    ("gp", "MEAN_ANOMALY", [-0.1, 360.1]),
    ("gp", "EPHEMERIS_TYPE", [-1]),
    ("gp", "ELEMENT_SET_NO", [-1]),
    ("gp", "REV_AT_EPOCH", [-1]),
    ("gp", "NORAD_CAT_ID", [0, -1]),
    ("gp", "CLASSIFICATION_TYPE", ["X", "u"]),
    ("satcat", "OBJECT_ID", ["x"]),
    ("satcat", "NORAD_CAT_ID", [0]),
    ("satcat", "OBJECT_TYPE", ["SAT"]),
    ("satcat", "OPS_STATUS_CODE", ["Z"]),
    ("satcat", "LAUNCH_DATE", [dt.date(1957, 10, 3)]),
    ("satcat", "DECAY_DATE", [dt.date(1957, 10, 3)]),
    ("satcat", "PERIOD", [-1.0]),
    ("satcat", "INCLINATION", [180.5]),
    ("satcat", "APOGEE", [-1]),
    ("satcat", "PERIGEE", [-1]),
    ("satcat", "RCS", [-0.5]),
    ("satcat", "DATA_STATUS_CODE", ["N"]),
    ("satcat", "ORBIT_TYPE", ["X"]),
    ("canonical", "cospar_id", ["x"]),
    ("canonical", "launch_date_unoosa", [dt.date(1957, 10, 3)]),
    ("canonical", "launch_date_celestrak", [dt.date(1957, 10, 3)]),
    ("canonical", "date_of_decay", [dt.date(1957, 10, 3)]),
    ("canonical", "snapshot_date", [dt.date(1957, 10, 3)]),
    ("canonical", "mean_motion", [-0.1, 20.01]),
    ("canonical", "eccentricity", [-0.1, 1.0]),
    ("canonical", "orbit_regime_canonical", ["leo"]),
    ("canonical", "orbit_regime_confidence", [1.01]),
    ("canonical", "match_source", ["name"]),
    ("canonical", "match_score", [-0.01, 1.01]),
    ("canonical", "match_confidence", ["none"]),
    ("canonical", "source_presence", ["neither"]),
    ("canonical", "function_canonical_confidence", [2.0]),
]
GOOD = [
    ("registry", "International Designator", ["22022-002AM", "1974-XXXX", "1962-BETA OMEGA 1", "2024-001*"]),
    ("registry", "Date of Launch", [dt.date(1957, 10, 4), None]),
    ("gp", "MEAN_MOTION", [0.0, 20.0]),
    ("gp", "ECCENTRICITY", [0.0, 0.999]),
    ("gp", "INCLINATION", [0.0, 180.0]),
    ("gp", "MEAN_ANOMALY", [0.0, 360.0]),
    ("satcat", "OPS_STATUS_CODE", ["+", "-", "P", "B", "S", "X", "D", "p", None]),
    ("satcat", "RCS", [None, 0.0]),
    ("canonical", "match_score", [0.0, 1.0, None]),
    ("canonical", "norad_cat_id", [None]),
]


def rows_with(spark, kind, cases):
    contract, row = VALID[kind]
    rows = [tuple((row | {name: v}).values()) for name, values in cases for v in values]
    labels = [(name, str(v)) for name, values in cases for v in values]
    return contract, spark.createDataFrame(rows, open_schema(contract)), labels


@pytest.mark.parametrize("kind", VALID)
def test_bad_values(spark, kind):
    cases = [(name, values) for k, name, values in BAD if k == kind]
    contract, df, labels = rows_with(spark, kind, cases)
    found = [(r.column_name, r.value) for r in violations(df, contract).collect()]
    assert sorted(found) == sorted(labels)
    with pytest.raises(ContractError) as raised:
        validate(df, contract)
    assert sum(n for _, _, n in raised.value.failures) == len(labels)


@pytest.mark.parametrize("kind", VALID)
def test_good_values(spark, kind):
    cases = [(name, values) for k, name, values in GOOD if k == kind]
    contract, df, _ = rows_with(spark, kind, cases)
    validate(df, contract)


def test_nan_is_above_every_number(spark):
    contract, df = frame(spark, "gp", MEAN_MOTION=float("nan"))
    assert [r.check for r in violations(df, contract).collect()] == ["le(20.0)"]


def test_structure(spark):
    contract, df = frame(spark, "gp")
    cases = {
        "missing": df.drop("BSTAR"),
        "unexpected": df.withColumn("more", df.BSTAR),
        "dtype": df.withColumn("NORAD_CAT_ID", df.NORAD_CAT_ID.cast("int")),
        "order": df.select(*reversed(df.columns)),
        "non_empty": df.limit(0),
    }
    for check, broken in cases.items():
        with pytest.raises(ContractError, match=check):
            validate(broken, contract)


def test_registry_order_is_free(spark):
    contract, df = frame(spark, "registry")
    validate(df.select(*reversed(df.columns)), contract)


def test_all_failures_in_one_error(spark):
    contract, df = frame(spark, "satcat", OBJECT_TYPE="?", RCS=-1.0, OWNER=None)
    with pytest.raises(ContractError) as raised:
        validate(df.drop("PERIGEE"), contract)
    assert {c for c, _, _ in raised.value.failures} == {"OBJECT_TYPE", "RCS", "OWNER", "PERIGEE"}


def test_summary_lists_every_rule(spark):
    contract, df = frame(spark, "gp", MEAN_MOTION=21.0)
    rows = violation_summary(df, contract).collect()
    assert len(rows) == 1 + sum(len(f.failures()) for f in contract.fields)
    assert [(r.column_name, r.violations) for r in rows if r.violations] == [("MEAN_MOTION", 1)]


def test_unique_key(spark):
    contract, df = frame(spark, "registry")
    twice = df.unionAll(df)
    assert [r.n for r in duplicate_keys(twice, contract.key).collect()] == [2]
    validate(twice, contract)
    with pytest.raises(ContractError, match="unique"):
        validate(twice, contract, unique_key=True)


def test_validation_reads_the_frame_once(spark):
    contract, df = frame(spark, "canonical")
    text = violation_summary(df, contract)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Scan ") == 1 and "Join" not in text


def small(**changed):
    base = Contract(
        "t",
        "1.0.0",
        (
            Field("id", T.LongType(), False),
            Field("kind", T.StringType(), True, (Rule("isin", ("a", "b")),)),
            Field("size", T.DoubleType(), True, (Rule("ge", 0.0), Rule("le", 10.0))),
        ),
        key=("id",),
    )
    return replace(base, **changed)


def with_field(name, **changed):
    return small(fields=tuple(replace(f, **changed) if f.name == name else f for f in small().fields))


EXTRA = Field("extra", T.StringType())


@pytest.mark.parametrize(
    ("new", "expected"),
    [
        (small(), []),
        (small(fields=(*small().fields, EXTRA)), [("extra", "added", ADDITIVE)]),
        (
            small(fields=(*small().fields, replace(EXTRA, nullable=False))),
            [("extra", "added", BREAKING)],
        ),
        (small(fields=(EXTRA, *small().fields)), [("extra", "added", BREAKING)]),
        (small(fields=small().fields[:2]), [("size", "removed", BREAKING)]),
        (small(fields=small().fields[::-1]), [("*", "reordered", BREAKING)]),
        (with_field("id", dtype=T.IntegerType()), [("id", "dtype", BREAKING)]),
        (with_field("kind", nullable=False), [("kind", "nullability", BREAKING)]),
        (with_field("id", nullable=True), [("id", "nullability", BREAKING)]),
        (with_field("kind", rules=(Rule("isin", ("a", "b", "c")),)), [("kind", "rule isin", ADDITIVE)]),
        (with_field("kind", rules=(Rule("isin", ("a",)),)), [("kind", "rule isin", BREAKING)]),
        (with_field("kind", rules=()), [("kind", "rule isin", ADDITIVE)]),
        (
            with_field("size", rules=(Rule("ge", -1.0), Rule("le", 9.0))),
            [("size", "rule ge", ADDITIVE), ("size", "rule le", BREAKING)],
        ),
        (with_field("id", rules=(Rule("matches", "x"),)), [("id", "rule matches", BREAKING)]),
        (small(key=()), [("", "key", BREAKING)]),
    ],
)
def test_evolution_tiers(new, expected):
    assert contract_changes(small(), new) == expected


# The canonical columns as first published.
FROZEN = [
    ("cospar_id", "string", False),
    ("norad_cat_id", "bigint", True),
    ("name_unoosa", "string", True),
    ("object_name_celestrak", "string", True),
    ("state_unoosa", "string", True),
    ("country_celestrak", "string", True),
    ("launch_date_unoosa", "date", True),
    ("launch_date_celestrak", "date", True),
    ("status", "string", True),
    ("date_of_decay", "date", True),
    ("un_registered", "boolean", True),
    ("registration_documents", "string", True),
    ("function", "string", True),
    ("mean_motion", "double", True),
    ("eccentricity", "double", True),
    ("orbit_regime_canonical", "string", True),
    ("orbit_regime_confidence", "double", True),
    ("match_source", "string", False),
    ("match_score", "double", True),
    ("match_confidence", "string", False),
    ("source_presence", "string", False),
    ("function_canonical", "string", True),
    ("function_canonical_confidence", "double", True),
    ("snapshot_date", "date", False),
]


def test_canonical_contract_is_as_frozen():
    assert frozen_failures(FROZEN, CANONICAL) == []
    assert len(CANONICAL.fields) == 24 and CANONICAL.version == "1.0.0"


def test_frozen_failures():
    grown = replace(CANONICAL, fields=(*CANONICAL.fields, EXTRA))
    assert frozen_failures(FROZEN, grown) == []
    assert frozen_failures(FROZEN, replace(CANONICAL, fields=CANONICAL.fields[1:])) == [
        "cospar_id: removed"
    ]
    assert frozen_failures(FROZEN, replace(CANONICAL, fields=CANONICAL.fields[::-1])) == ["order changed"]


def test_schema_report(spark):
    contract, df = frame(spark, "gp", OBJECT_NAME=None)
    rows = {r.column_name: r for r in schema_report(df.withColumn("more", df.BSTAR), contract).collect()}
    assert (rows["OBJECT_NAME"].nulls, rows["OBJECT_NAME"].nulls_ok) == (1, False)
    assert (rows["more"].in_contract, rows["more"].in_frame) == (False, True)
    assert rows["EPOCH"].type_ok and rows["EPOCH"].place_ok and rows["EPOCH"].nulls_ok
