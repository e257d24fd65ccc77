"""Pairing by position, name candidates, hierarchical matching, canonical table, reports."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starledger.functions import similarity
from starledger.functions.similarity import _score
from starledger.operators import candidates, ranking
from starledger.operators import analysis
from starledger.operators.candidates import _alike, accepted_pairs, best_pairs, mutual_best, similar_names
from starledger.operators.contracts import duplicate_keys, validate
from starledger.operators.match import (
    Side,
    match_catalogs,
    match_confidence,
    match_report,
    source_presence,
)
from starledger.operators.ranking import Queue, digest_bucket, pair_by_position, with_position
from starledger.plans.canonical import (
    build_canonical,
    catalog_report,
    join_catalogs,
    publish_canonical,
)
from starledger.plans.contracts import CANONICAL, GP, REGISTRY, SATCAT
from starledger.sources.shared import materialize
from starledger.sources.snapshots import load_snapshot

D = dt.date


def test_positions_run_through_a_group(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") < 4000, "hot").otherwise(F.col("id").cast("string")).alias("g"), "id"
    )
    queue = Queue(df, digest_bucket(F.col("id")), (F.col("id"),))
    numbered = with_position(queue, ["g"], "pos")
    hot = sorted(r.pos for r in numbered.where("g = 'hot'").collect())
    assert hot == list(range(1, 4001))
    assert {r.pos for r in numbered.where("g <> 'hot'").collect()} == {1}


def test_copies_are_numbered(spark):
    df = spark.range(1000).select(F.lit("hot").alias("g"), F.lit("copy").alias("v"), "id")
    queue = Queue(df, digest_bucket(F.col("v")), (F.col("v"),))
    numbered = with_position(queue, ["g"], "pos")
    assert sorted(r.pos for r in numbered.collect()) == list(range(1, 1001))


def test_equal_rows_are_spread_over_cells(spark):
    """A third of all rows are one row; its copies are numbered in many cells, in no gaps."""
    rows = spark.range(6000).select(
        F.lit("g").alias("g"), F.when(F.col("id") < 4000, "copy").otherwise(F.col("id").cast("string")).alias("v"), "id"
    )
    rows = rows.withColumn("w", F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.col("v")))
    queue = Queue(rows, digest_bucket(F.col("v")), (F.col("v"), F.col("w")), F.col("id"))
    numbered = with_position(queue, ["g"], "pos")
    found = sorted((r.pos, r.v, r.w) for r in numbered.collect())
    assert [f[0] for f in found] == list(range(1, 6001))
    # Only equal rows may change places.
    plain = Queue(rows, digest_bucket(F.col("v")), (F.col("v"), F.col("w")))
    assert found == sorted((r.pos, r.v, r.w) for r in with_position(plain, ["g"], "pos").collect())
    plan = numbered._jdf.queryExecution().toString()
    assert "_cell" in plan
    cells = queue.df.groupBy(F.pmod(F.xxhash64("id"), F.lit(ranking.SALTS))).count().collect()
    assert max(r["count"] for r in cells) < 2 * 6000 / ranking.SALTS + 60


@pytest.mark.parametrize("unique", [True, False])
def test_pairing_keeps_every_row_once(spark, unique):
    step = 1 if unique else 7
    left = spark.range(200).select((F.col("id") / step).cast("int").alias("g"), F.col("id").alias("l"))
    right = spark.range(100, 300).select((F.col("id") / step).cast("int").alias("g"), F.col("id").alias("r"))
    nulls = [df.limit(3).withColumn("g", F.lit(None).cast("int")) for df in (left, right)]
    sides = [
        Queue(df.unionByName(n), digest_bucket(F.col(c)), (F.col(c),))
        for df, n, c in ((left, nulls[0], "l"), (right, nulls[1], "r"))
    ]
    rows = pair_by_position(*sides, ["g"], unique).collect()
    for side, other in (("l", "r"), ("r", "l")):
        source = left if side == "l" else right
        lone = source.limit(3).collect()
        assert Counter(r[side] for r in rows if r[side] is not None) == Counter(
            [r[side] for r in source.collect()] + [r[side] for r in lone]
        )
        assert all(r[other] is None for r in rows if r.g is None and r[side] is not None)
    sizes = [Counter(r.g for r in df.collect()) for df in (left, right)]
    paired = Counter(r.g for r in rows if r.l is not None and r.r is not None)
    assert paired == sizes[0] & sizes[1]


def name_pool(seed, size):
    pick = random.Random(seed)
    words = ["ab", "abc", "abcd", "bcd", "x", "yz", "gagarin", "gagarina", "verylongtoken"]
    names = set()
    while len(names) < size:
        kind = pick.random()
        if kind < 0.3:
            name = f"starlink-{pick.randint(1000, 1200)}"
        elif kind < 0.6:
            name = f"cosmos {pick.randint(1, 150)}" + pick.choice(["", " deb"])
        elif kind < 0.8:
            name = " ".join(pick.choice(words) for _ in range(pick.randint(1, 4)))
        else:
            name = f"international space observatory mission {pick.randint(1, 100)}"
            name += pick.choice(["", " b", " deb", "b"])
        names.add(" ".join(sorted(set(name.split()))))
    return sorted(names)


@pytest.mark.parametrize("threshold", [0.9, 0.75])
def test_similar_names_find_every_pair(spark, threshold):
    left, right = name_pool(1, 150), name_pool(2, 150)
    frames = [spark.createDataFrame([(n,) for n in names], "name string") for names in (left, right)]
    found = {(r.l, r.r): r.score for r in similar_names(*frames, threshold).collect()}
    assert found == {
        (a, b): _score(a, b) for a in left for b in right if _score(a, b) > threshold
    }


def test_long_and_edited_names_are_found(spark):
    rng = random.Random(5)
    letters = "abcdefgh12"

    def edited(name):
        out = list(name)
        for _ in range(rng.randint(0, 5)):
            at = rng.randrange(len(out))
            out[at : at + rng.randint(0, 1)] = rng.choice(["", rng.choice(letters), " "])
        return "".join(out)

    def words(n):
        return " ".join("".join(rng.choices(letters, k=rng.randint(1, 9))) for _ in range(n))

    base = [words(rng.randint(1, 9)) for _ in range(80)]
    pools = [{" ".join(sorted(set(n.split()))) for n in names} - {""} for names in (base, map(edited, base * 2))]
    assert max(map(len, pools[0])) > 50
    frames = [spark.createDataFrame([(n,) for n in sorted(names)], "name string") for names in pools]
    found = {(r.l, r.r) for r in similar_names(*frames, 0.9).collect()}
    assert found == {(a, b) for a in pools[0] for b in pools[1] if _score(a, b) > 0.9}


def test_short_names_meet_on_what_one_letter_leaves(spark):
    rng = random.Random(9)
    letters = "ab1 "

    def names(n):
        found = set()
        while len(found) < n:
            tokens = "".join(rng.choices(letters, k=rng.randint(3, 14))).split()
            found.add(" ".join(sorted(set(tokens))))
        return sorted(found - {""})

    pools = names(150), names(150)
    frames = [spark.createDataFrame([(n,) for n in pool], "name string") for pool in pools]
    lengths = [sorted({len(n) for n in pool}) for pool in pools]
    threshold = 0.8
    met = {(r.l, r.r) for r in candidates._nearly_equal(*frames, lengths, threshold).collect()}
    wanted = set()
    for a in pools[0]:
        for b in pools[1]:
            drops = candidates._drops(len(a), len(b), threshold)
            shared = set(a.split()) & set(b.split())
            rest = [" ".join(sorted(set(x.split()) - shared)) for x in (a, b)]
            common = similarity._common_length(*rest)
            if drops and max(drops) <= 1 and sum(map(len, rest)) - 2 * common <= sum(drops):
                wanted.add((a, b))
    assert wanted <= met and len(wanted) > 50


def test_a_family_of_numbers_gives_few_candidates(spark):
    frames = [spark.range(a, a + 400).select(F.concat((F.col("id") + 100_000).cast("string"), F.lit(" cosmos")).alias("name")) for a in (0, 200)]
    lengths = [[13], [13]]
    pairs = candidates._nearly_equal(*frames, lengths, 0.9)
    similar = {(r.l, r.r) for r in similar_names(*frames, 0.9).collect()}
    met = {(r.l, r.r) for r in pairs.collect()}
    assert met == similar and candidates._most_destroyed(13, [13], 0.9) is None


def test_two_dropped_letters_of_short_names(spark):
    """Letters, spaces and whole one-letter tokens, in any order, and between tokens both sides have."""
    rng = random.Random(17)
    pools = [set(), set()]
    for _ in range(120):
        tokens = ["".join(rng.choices("abc1", k=rng.randint(1, 5))) for _ in range(rng.randint(2, 4))]
        name = " ".join(sorted(set(tokens)))
        short = list(name)
        for _ in range(2):
            del short[rng.randrange(len(short))]
        for pool, text in zip(pools, (name, "".join(short)) if rng.random() < 0.5 else ("".join(short), name)):
            pool.add(" ".join(sorted(set(text.split()))))
    pools = [sorted(pool - {""}) for pool in pools]
    frames = [spark.createDataFrame([(n,) for n in pool], "name string") for pool in pools]
    lengths = [sorted({len(n) for n in pool}) for pool in pools]
    threshold = 0.85
    met = {(r.l, r.r) for r in candidates._nearly_equal(*frames, lengths, threshold).collect()}
    wanted = set()
    for a in pools[0]:
        for b in pools[1]:
            drops = candidates._drops(len(a), len(b), threshold)
            shared = set(a.split()) & set(b.split())
            rest = [" ".join(sorted(set(x.split()) - shared)) for x in (a, b)]
            left = [len(x) - similarity._common_length(*rest) for x in rest]
            if drops and all(rest) and sorted(drops) == [0, 2] and left == list(drops):
                wanted.add((a, b))
    assert wanted <= met and len(wanted) > 30


def test_names_of_few_drops_meet_on_no_letter_pairs(spark):
    """Numbers of one family: two letters less on one side took a search by letter pairs."""
    frames = [
        spark.range(a, b).select(F.concat(F.col("id").cast("string"), F.lit(" cosmos")).alias("name"))
        for a, b in ((1000, 1200), (100_000, 100_200))
    ]
    lengths = [[11], [13]]
    assert candidates._most_destroyed(11, [13], 0.9) is None
    assert _alike(*frames, lengths, 0.9).count() == 0
    assert {tuple(r)[:2] for r in similar_names(*frames, 0.9).collect()} == {
        (f"{a} cosmos", f"{b} cosmos")
        for a in range(1000, 1200) for b in range(100_000, 100_200)
        if _score(f"{a} cosmos", f"{b} cosmos") > 0.9
    }


def test_a_pair_of_names_is_scored_once(spark, tmp_path):
    """However often it met: the filter on the score stays above the distinct pairs."""
    names = [materialize(spark.createDataFrame([(n,) for n in name_pool(s, 40)], "name string"), "n") for s in (1, 2)]
    plan = similar_names(*names, 0.75)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert plan.index("ArrowEvalPython") < plan.index("Aggregate")


@pytest.mark.parametrize("threshold", [0.9, 0.75])
def test_best_pairs_are_those_of_all_pairs(spark, threshold):
    left, right = name_pool(3, 120), name_pool(4, 120)
    names = [materialize(spark.createDataFrame([(n,) for n in pool], "name string"), "n") for pool in (left, right)]
    best = {tuple(r) for r in best_pairs(*names, threshold).collect()}
    assert best == {tuple(r) for r in accepted_pairs(similar_names(*names, threshold)).collect()}
    scores = [s for *_, s in best]
    assert min(scores) <= (1 + threshold) / 2 < max(scores)
    assert best_pairs(names[0].limit(0), names[1], threshold).collect() == []


def test_names_of_near_pairs_meet_no_distant_ones(spark, monkeypatch):
    """Of a family in which each name has a near partner, no pair of two numbers is built."""
    frames = [
        materialize(spark.range(300).select(F.concat((F.col("id") + 100_000).cast("string"), F.lit(word)).alias("name")), "n")
        for word in (" cosmos", " cosmoss")
    ]
    built, scored = [], candidates.token_set_score
    find = candidates.similar_names

    def counted(*args):
        pairs = materialize(find(*args), "pairs")
        built.append(pairs.count())
        return pairs

    monkeypatch.setattr(candidates, "similar_names", counted)
    assert best_pairs(*frames, 0.85).count() == 300 and built == [300, 0]
    assert find(*frames, 0.85).count() > 3000 and scored is candidates.token_set_score


def test_lone_names_pair_within_a_day(spark):
    day = D(2024, 5, 5)
    moved = [day, D(2024, 5, 4), D(2024, 5, 6), D(2024, 5, 7), None]
    left = [(None, f"n{i}", day) for i in range(5)] + [(None, "twice", day)] * 2 + [(None, None, day)]
    right = [(None, f"n{i}", d) for i, d in enumerate(moved)] + [(None, "twice", D(2024, 5, 6))] * 3 + [(None, None, day)]
    schema = "id string, name string, day date"
    sides = [Side(spark.createDataFrame(rows, schema), "id", "name", "day") for rows in (left, right)]
    rows = match_catalogs(*sides, None).collect()
    paired = Counter(r.l.name for r in rows if r.match_source == "name_date")
    assert paired == {"n0": 1, "n1": 1, "n2": 1, "twice": 2}
    assert len(rows) == len(left) + len(right) - 5


def test_precedence_of_three_sources(spark):
    registry = spark.createDataFrame(
        [("2024-001A", "a", D(2024, 1, 1), D(2025, 1, 1)), ("2024-002A", "b", D(2024, 1, 1), None), ("2024-003A", "c", D(2024, 1, 1), None)],
        "`International Designator` string, `Name of Space Object` string, `Date of Launch` date, `Date of Decay` date",
    )
    for name in ("State of Registry", "Status", "Registration Documents", "Function"):
        registry = registry.withColumn(name, F.lit(None).cast("string"))
    registry = registry.withColumn("UN Registered", F.lit(True))
    rows = [(i, f"2024-00{i}A", "x") for i in (1, 2, 3, 4)]
    gp = spark.createDataFrame(rows, "NORAD_CAT_ID long, OBJECT_ID string, OBJECT_NAME string")
    gp = gp.withColumns({"MEAN_MOTION": F.lit(15.0), "ECCENTRICITY": F.lit(0.0)})
    satcat = gp.select("NORAD_CAT_ID", "OBJECT_ID", "OBJECT_NAME", F.lit("o").alias("OWNER"), F.lit(D(2024, 1, 1)).alias("LAUNCH_DATE"), F.lit(D(2027, 1, 1)).alias("DECAY_DATE"))
    tracking = spark.createDataFrame(
        [(1, D(2026, 1, 1)), (2, D(2026, 2, 1)), (2, D(2026, 1, 1)), (4, D(2026, 4, 1)), (None, D(2020, 1, 1)), (9, None)],
        "NORAD_CAT_ID long, DECAY_DATE date",
    )
    built = build_canonical(registry, gp, satcat, D(2026, 4, 24), None, tracking=tracking).rows.collect()
    dates = {r.cospar_id: r.date_of_decay for r in built}
    assert dates == {
        "2024-001A": D(2025, 1, 1), "2024-002A": D(2026, 1, 1), "2024-003A": D(2027, 1, 1), "2024-004A": D(2026, 4, 1)
    }


def test_unlike_long_names_give_few_candidates(spark):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 8))) for _ in range(2000)]
    counted = []
    for n in (500, 1000):
        pools = [{" ".join(sorted(rng.sample(vocabulary, 5))) for _ in range(n)} for _ in "lr"]
        frames = [spark.createDataFrame([(x,) for x in sorted(p)], "name string") for p in pools]
        lengths = [sorted({len(x) for x in p}) for p in pools]
        counted.append(_alike(*frames, lengths, 0.9).count())
    assert counted[0] <= 500 and counted[1] <= 1000


def test_mutual_best(spark):
    pairs = [("a", "x", 0.95), ("a", "y", 0.99), ("b", "y", 0.97), ("b", "x", 0.91), ("c", "x", 0.95)]
    df = spark.createDataFrame(pairs, "l string, r string, score double")
    assert {tuple(r) for r in mutual_best(df).collect()} == {("a", "y", 0.99)}
    ties = spark.createDataFrame([("b", "x", 1.0), ("a", "x", 1.0), ("a", "z", 1.0)], df.schema)
    first = ties.orderBy(F.md5(F.concat_ws("|", "l", "r").cast("binary"))).first()
    assert tuple(first) in {tuple(r) for r in mutual_best(ties).collect()}


def test_pairs_are_accepted_until_none_is_free(spark):
    rng = random.Random(2)
    rows = {(f"l{rng.randint(0, 25)}", f"r{rng.randint(0, 25)}"): rng.randint(90, 99) / 100 for _ in range(120)}
    df = spark.createDataFrame([(*k, v) for k, v in rows.items()], "l string, r string, score double")
    expected, used = set(), set()
    for a, b, score in df.orderBy(F.desc("score"), F.md5(F.concat_ws("|", "l", "r").cast("binary"))).collect():
        if a not in used and b not in used:
            expected.add((a, b, score))
            used |= {a, b}
    assert {tuple(r) for r in accepted_pairs(df).collect()} == expected
    assert accepted_pairs(df.limit(0)).collect() == []


LEFT_SCHEMA = "lid string, lname string, lday date"
RIGHT_SCHEMA = "rid string, rname string, rday date, n long"


def run_match(spark, left, right, threshold=0.9, **kw):
    right = [(*row, i) for i, row in enumerate(right)]
    matched = match_catalogs(
        Side(spark.createDataFrame(left, LEFT_SCHEMA), "lid", "lname", "lday"),
        Side(spark.createDataFrame(right, RIGHT_SCHEMA), "rid", "rname", "rday", ("n",)),
        threshold,
        **kw,
    )
    rows = matched.collect()
    assert Counter(tuple(r.l) for r in rows if r.l) == Counter(left)
    assert Counter(tuple(r.r) for r in rows if r.r) == Counter(right)
    return rows


def outcome(rows):
    return {(r.l.lid if r.l else None, r.r.rid if r.r else None): (r.match_source, r.match_confidence, r.source_presence) for r in rows}


@pytest.mark.parametrize("unique", [True, False])
def test_passes_in_order(spark, unique):
    day = D(2024, 1, 10)
    left = [
        ("2024-001A", "One", day),
        ("2024-002A", "Two (Alias)", day),
        ("2024-003A", "Three", day),
        ("2024-004A", "Four", day),
        ("2024-005A", "Five Five Sat", day),
        ("2024-006A", "(x)", day),
        ("2024-007A", None, None),
    ]
    right = [
        ("2024-001A", "Zzz", D(1990, 1, 1)),
        ("2024-102A", "TWO", D(2024, 1, 11)),
        ("2024-103A", "THREE", D(2024, 1, 9)),
        ("2024-104A", "FOUR", D(2024, 1, 12)),
        ("2024-105A", "SAT FIVE", None),
        ("2024-106A", "(y)", day),
        (None, None, None),
    ]
    found = outcome(run_match(spark, left, right, designators_unique=unique))
    assert found == {
        ("2024-001A", "2024-001A"): ("cospar", "high", "both"),
        ("2024-002A", "2024-102A"): ("name_date", "medium", "both"),
        ("2024-003A", "2024-103A"): ("name_date", "medium", "both"),
        ("2024-004A", "2024-104A"): ("fuzzy", "medium", "both"),
        ("2024-005A", "2024-105A"): ("fuzzy", "medium", "both"),
        ("2024-006A", None): ("unmatched_unoosa", "low", "unoosa_only"),
        ("2024-007A", None): ("unmatched_unoosa", "low", "unoosa_only"),
        (None, "2024-106A"): ("unmatched_celestrak", "low", "celestrak_only"),
        (None, None): ("unmatched_celestrak", "low", "celestrak_only"),
    }


def test_score_only_on_the_name_pass(spark):
    left = [("a", "cosmos 12345", D(2024, 1, 1)), ("b", "same", D(2024, 1, 1))]
    right = [("c", "cosmos 12346", D(2024, 1, 1)), ("d", "same", D(2024, 1, 1))]
    rows = {r.l.lid: r for r in run_match(spark, left, right)}
    assert rows["a"].match_score == pytest.approx(1 - 2 / 24)
    assert rows["a"].match_confidence == "low" and rows["b"].match_score is None
    off = {r.match_source for r in run_match(spark, left, right, threshold=None)}
    assert off == {"name_date", "unmatched_unoosa", "unmatched_celestrak"}


def test_fragments_with_one_name_and_day_pair_linearly(spark):
    n = 3000
    left = [(f"L{i}", "Fengyun Deb", D(1999, 5, 10)) for i in range(n)]
    right = [(f"R{i}", "FENGYUN DEB", D(1999, 5, 10 + i % 3)) for i in range(n + 100)]
    sources = Counter(r.match_source for r in run_match(spark, left, right))
    # Same day and next day pair by date, the rest of the group by name.
    assert sources["unmatched_celestrak"] == 100 and sources["name_date"] + sources["fuzzy"] == n


def test_repeated_designators_stay_one_to_one(spark):
    left = [("x", f"n{i}", D(2024, 1, 1)) for i in range(3)]
    right = [("x", f"m{i}", D(2024, 1, 1)) for i in range(5)]
    sources = Counter(r.match_source for r in run_match(spark, left, right, threshold=None))
    assert sources == {"cospar": 3, "unmatched_celestrak": 2}


def test_nothing_left_for_the_name_pass(spark):
    rows = [("x", "long enough to be called a long name", D(2024, 1, 1))]
    assert [r.match_source for r in run_match(spark, rows, rows)] == ["cospar"]
    assert [r.match_source for r in run_match(spark, rows, [])] == ["unmatched_unoosa"]


def test_confidence_and_presence(spark):
    rows = [("cospar", None), ("name_date", None), ("fuzzy", 0.95), ("fuzzy", 0.949), ("unmatched_unoosa", None)]
    df = spark.createDataFrame(rows, "s string, x double")
    found = [r[0] for r in df.select(match_confidence(F.col("s"), F.col("x"))).collect()]
    assert found == ["high", "medium", "medium", "low", "low"]
    sides = spark.createDataFrame([(True, True), (True, False), (False, True)], "a boolean, b boolean")
    assert [r[0] for r in sides.select(source_presence(F.col("a"), F.col("b"))).collect()] == [
        "both",
        "unoosa_only",
        "celestrak_only",
    ]


def open_schema(contract):
    return T.StructType([T.StructField(f.name, f.dtype) for f in contract.fields])


def gp_row(norad, cospar, name, motion=15.0, ecc=0.001):
    return (name, cospar, "2026-04-24T00:00:00", motion, ecc, 1.0, 1.0, 1.0, 1.0, 0, "U", norad, 1, 1, 0.0, 0.0, 0.0)


def sat_row(norad, cospar, name, launch, decay=None, owner="US"):
    return (name, cospar, norad, "PAY", "+", owner, launch, "AFETR", decay, 90.0, 50.0, 500, 400, 1.0, None, "EA", "ORB")


def reg_row(cospar, name, launch, decay=None, state="USA", registered=True):
    return (cospar, None, name, state, launch, "active", decay, registered, "ST/1", "comms", None, None)


@pytest.fixture(scope="module")
def catalogs(spark):
    day = D(2020, 5, 1)
    gp = [
        gp_row(1, "2020-001A", "ONE"),
        gp_row(2, "2020-002X", "TWO", 1.0, 0.01),
        gp_row(4, "2020-004A", "FOUR"),
        gp_row(6, None, "SIX"),
    ]
    sat = [
        sat_row(1, "2020-001A", "ONE OLD", day, D(2021, 1, 1)),
        sat_row(2, "2020-002A", "TWO", day),
        sat_row(3, "2020-003A", "THREE", day, D(2022, 2, 2)),
    ]
    reg = [reg_row("2020-001A", "One", day, D(2021, 3, 3)), reg_row("2020-009A", "Three", day), reg_row("2020-010A", "Lost", day)]
    return [
        spark.createDataFrame(rows, open_schema(c)) for rows, c in ((reg, REGISTRY), (gp, GP), (sat, SATCAT))
    ]


@pytest.mark.parametrize("unique", [True, False])
def test_catalog_join(catalogs, unique):
    _, gp, sat = catalogs
    rows = {r.NORAD_CAT_ID: r for r in join_catalogs(gp, sat, unique).collect()}
    assert set(rows) == {1, 2, 3, 4, 6}
    assert (rows[1].OBJECT_NAME, rows[1].OWNER) == ("ONE", "US")
    assert (rows[2].OBJECT_ID, rows[2].id_differs) == ("2020-002A", True)
    assert (rows[3].OBJECT_NAME, rows[3].MEAN_MOTION) == ("THREE", None)
    assert (rows[4].OBJECT_ID, rows[4].LAUNCH_DATE) == ("2020-004A", None)
    report = catalog_report(join_catalogs(gp, sat)).first()
    assert tuple(report) == (2, 2, 1, 1, 1)


def test_canonical_table(spark, catalogs, tmp_path):
    build = build_canonical(*catalogs, D(2026, 4, 24))
    publish_canonical(build, D(2026, 4, 24), str(tmp_path))
    stored = load_snapshot(spark, D(2026, 4, 24), str(tmp_path), version="1.3.0")
    validate(stored, CANONICAL, unique_key=True)
    assert stored.columns == CANONICAL.columns
    assert duplicate_keys(build.rows, ["cospar_id"]).isEmpty()
    rows = {r.cospar_id: r for r in build.rows.collect()}
    assert set(rows) == {"2020-001A", "2020-009A", "2020-010A", "2020-002A", "2020-004A"}
    one = rows["2020-001A"]
    assert (one.match_source, one.match_confidence, one.source_presence) == ("cospar", "high", "both")
    assert one.date_of_decay == D(2021, 3, 3) and one.orbit_regime_canonical == "LEO"
    assert (one.name_unoosa, one.object_name_celestrak) == ("One", "ONE")
    three = rows["2020-009A"]
    assert three.match_source == "name_date" and three.norad_cat_id == 3
    assert three.date_of_decay == D(2022, 2, 2) and three.orbit_regime_canonical is None
    assert rows["2020-010A"].match_source == "unmatched_unoosa"
    two = rows["2020-002A"]
    assert two.source_presence == "celestrak_only" and two.orbit_regime_canonical == "GEO"
    for r in rows.values():
        assert r.function_canonical is None and r.orbit_regime_confidence is None
        assert r.snapshot_date == D(2026, 4, 24)
    assert build.report.first().rows_excluded == 1
    shares = {r.match_source: (r.n, r.share) for r in match_report(build.rows).collect()}
    assert shares["cospar"] == (1, 0.2) and sum(n for n, _ in shares.values()) == 5


def test_orbit_gap(spark, catalogs):
    build = build_canonical(*catalogs, D(2026, 4, 24), fuzzy_threshold=None)
    rows = {tuple(r) for r in analysis.orbit_gap(build.rows, {"US": "USA"}).collect()}
    assert rows == {("USA", 2020, 3, 3, 0), (None, None, 1, 0, 1)}


def test_constellations_and_states(spark):
    df = spark.createDataFrame([("STARLINK-1", "USSR (for Poland)"), ("Cosmos 1", "Russia"), (None, None)], "n string, s string")
    families = {"starlink": "Starlink"}
    tagged = analysis.with_constellations(df, "n", families).collect()
    assert [(r.constellation_id, r.is_megaconstellation) for r in tagged] == [
        ("Starlink", True),
        (None, False),
        (None, False),
    ]
    assert analysis.without_constellations(df, "n", families).count() == 2
    states = df.select(
        analysis.canonical_state("s", {"USSR": "Russia"}), analysis.registered_for("s")
    ).collect()
    assert [tuple(r) for r in states] == [("Russia", "Poland"), ("Russia", None), (None, None)]


def test_registration_reports(spark):
    rows = [(D(1979, 1, 1), True), (D(1980, 1, 1), False), (D(1989, 1, 1), True), (None, True)]
    df = spark.createDataFrame(rows, "d date, f boolean")
    found = {tuple(r) for r in analysis.registration_by_decade(df, "d", "f").collect()}
    assert found == {(1970, 1, 1, 1.0), (1980, 2, 1, 0.5)}
    lag = df.select(analysis.compliance_lag(F.lit(D(1980, 1, 11)), "d")).collect()
    assert [r[0] for r in lag] == [
        (D(1980, 1, 11) - d).days if d else None for d, _ in rows
    ]


def test_keys_that_do_not_repeat_meet_in_one_plain_join(spark):
    """No positions are looked for where no group repeats, and known groups are found once."""
    left, right = (spark.range(n).select(F.col("id").alias("k"), F.struct("id").alias(side)) for n, side in ((40, "l"), (60, "r")))
    queues = [Queue(df, F.lit(""), (F.col(f"{side}.id"),)) for df, side in ((left, "l"), (right, "r"))]
    paired = pair_by_position(*queues, ["k"])
    plan = paired._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("Join") == 1
    assert paired.count() == 60 and paired.where("l is not null and r is not null").count() == 40


def test_growing_tables_of_names_are_not_broadcast(spark):
    """As files they are small, as rows in the driver they are not."""
    names = [spark.createDataFrame([(f"cosmos {i:05d}{x}",) for i in range(60)], "name string") for x in ("", "0")]
    pairs = materialize(similar_names(*[materialize(n, "n") for n in names], 0.85), "p")
    assert pairs.count() > 0
    best = mutual_best(pairs)
    assert "Broadcast" not in best._jdf.queryExecution().executedPlan().toString()
    parts = [candidates._mostly_shared(*names, candidates._part_counts(*names, F.split("name", " ")), 0.85), candidates._nearly_equal(*names, ([12], [13]), 0.85)]
    parts.append(_alike(*names, ([12], [13]), 0.85))
    for df in parts:
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
