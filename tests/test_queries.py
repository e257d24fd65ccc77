"""Every query against its SQL equivalent on the smallest shared tables."""

import glob
import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_points

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="shared tables not present")

QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{path}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def test_every_query_of_the_reference_has_sql():
    own = {name for name in QUERIES if name != "pipeline" and not name.startswith("op")}
    own |= {"orbit_regimes", "orbit_gap", "outside_constellations"} & set(QUERIES)
    assert own <= set(ORACLES)
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, tables, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    relation = tables.sql(ORACLES[name])
    assert sorted(relation.columns) == columns
    at = [relation.columns.index(c) for c in columns]
    expected = Counter(tuple(plain(r[i]) for i in at) for r in relation.fetchall())
    assert Counter(tuple(plain(r[c]) for c in columns) for r in df.collect()) == expected


def test_fuzzy_match_keeps_every_row(spark):
    exact = QUERIES["hierarchical_match"](spark, DATA)
    fuzzy = QUERIES["fuzzy_match"](spark, DATA)
    for column in ("designator", "norad_cat_id"):
        known = [
            Counter(r[0] for r in df.select(column).collect() if r[0] is not None)
            for df in (exact, fuzzy)
        ]
        assert known[0] == known[1]
    scores = [r.match_score for r in fuzzy.where("match_source = 'fuzzy'").collect()]
    assert scores and min(scores) > 0.9 and max(scores) <= 1.0


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
