"""Cleaning, names, orbit regime and similarity."""

import datetime as dt
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from starledger.functions import similarity
from starledger.functions.names import fold_accents, normalize_name, with_normal_name
from starledger.functions.orbit import REGIMES, orbit_regime
from starledger.functions.similarity import token_key, token_set_score
from starledger.functions.text import (
    comparable_text,
    first_known,
    has_edge_space,
    join_documents,
    leading_year,
    parse_flag,
    partial_date,
    strip,
    year_of,
)


def apply(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(fn("v").alias("out")).collect()]


def test_partial_date_shapes(spark):
    values = ["2024-01-15", "2024-03", "1974", "", "bad", "  2024-02-29 ", "2023-02-29", "2024-13", None]
    assert apply(spark, values, partial_date) == [
        dt.date(2024, 1, 15),
        dt.date(2024, 3, 1),
        dt.date(1974, 1, 1),
        None,
        None,
        dt.date(2024, 2, 29),
        None,
        None,
        None,
    ]


def test_partial_date_needs_the_whole_text(spark):
    values = ["2024-01-15T10:00", "2024-1-5", "20240115", "12024", "2024-01-15\n"]
    assert apply(spark, values, partial_date) == [None, None, None, None, dt.date(2024, 1, 15)]


def test_flags(spark):
    values = ["T", "F", " t ", "f", "", "unknown", None]
    assert apply(spark, values, parse_flag) == [True, False, True, False, None, None, None]


def test_strip_takes_unicode_whitespace(spark):
    values = [" a ", "\ta b\n", " a ", "a", "", "  ", None]
    assert apply(spark, values, strip) == ["a", "a b", "a", "a", "", "", None]
    assert apply(spark, values, has_edge_space) == [True, True, True, False, False, True, None]


def test_comparable_text(spark):
    assert apply(spark, ["", "x", None], comparable_text) == [None, "x", None]
    assert apply(spark, [True, False], comparable_text, "boolean") == ["true", "false"]
    assert apply(spark, [dt.date(2024, 1, 2)], comparable_text, "date") == ["2024-01-02"]


def test_documents(spark):
    values = [["a", "b"], [], None]
    assert apply(spark, values, join_documents, "array<string>") == ["a, b", "", ""]


def test_years(spark):
    assert apply(spark, ["1999-05", "x1999", "199", None], leading_year) == [1999, None, None, None]
    assert apply(spark, [dt.date(2001, 2, 3)], lambda c: year_of(c, "date"), "date") == [2001]


def test_first_known(spark):
    df = spark.createDataFrame([(None, "b", "c")], "a string, b string, c string")
    assert df.select(first_known(["a", "b", "c"])).first()[0] == "b"


# Normal forms of names.
NORMAL_NAMES = [
    ("starlink-30123", "starlink-30123"),
    ("STARLINK-30123", "starlink-30123"),
    ("StarLink 2", "starlink 2"),
    ("   iss   ", "iss"),
    ("cosmos    1234", "cosmos 1234"),
    ("ops\t5712", "ops 5712"),
    ("ISS (ZARYA)", "iss"),
    ("OSCAR 7 (AO-7)", "oscar 7"),
    ("COSMOS 1989 (ETALON 1)", "cosmos 1989"),
    ("USA 65 (DSP 15)", "usa 65"),
    ("NAVSTAR 52 (USA 168)", "navstar 52"),
    ("ZIYUAN 1-02C (ZY 1-02C)", "ziyuan 1-02c"),
    ("OPS 5712 (P/L 160)", "ops 5712"),
    ("COSMOS 1234 [DEB]", "cosmos 1234"),
    ("BREEZE-M [TANK]", "breeze-m"),
    ("COSMOS 1234 [DEB] (ALIAS)", "cosmos 1234"),
    ("EXPLORER I", "explorer 1"),
    ("EXPLORER VII", "explorer 7"),
    ("APOLLO XI", "apollo 11"),
    ("MARINER V", "mariner 5"),
    ("Alouetté", "alouette"),
    ("Müller-Sat", "muller-sat"),
    ("ONEWEB-0567", "oneweb-0567"),
    ("BEIDOU-2 IGSO-4", "beidou-2 igso-4"),
    ("FLOCK 4K-20", "flock 4k-20"),
    ("sat.", "sat"),
    ("sat...", "sat"),
    ("sat.one", "sat.one"),
    ("", ""),
    ("    ", ""),
    ("(REMOVED)", ""),
    ("2021-091B", "2021-091b"),
    ("SAT", "sat"),
    # A hyphen bounds a numeral; a closing run is dropped once.
    ("X-37B", "10-37b"),
    ("sat. ,", "sat."),
    ("XVIII xx Xi", "18 20 11"),
    ("mix vim civil", "mix vim civil"),
]


def test_normal_names(spark):
    names = [n for n, _ in NORMAL_NAMES]
    assert apply(spark, names, normalize_name) == [n for _, n in NORMAL_NAMES]


def test_normal_names_are_stable_and_clean(spark):
    stable = [n for _, n in NORMAL_NAMES if n != "sat."]
    assert apply(spark, stable, normalize_name) == stable
    for name in stable:
        assert name == name.strip() and "  " not in name and name == name.lower()


def test_null_name_stays_null(spark):
    assert apply(spark, [None], normalize_name) == [None]


def test_with_normal_name_keeps_rows(spark):
    df = spark.createDataFrame([(1, "Ünï"), (2, "ASCII"), (3, None)], "id int, n string")
    rows = with_normal_name(df, "n", "m").collect()
    assert {(r.id, r.m) for r in rows} == {(1, "uni"), (2, "ascii"), (3, None)}


def test_fold_matches_the_character_tables(spark):
    pick = random.Random(5)
    pool = [chr(c) for c in range(0x20, 0x2FFF) if unicodedata.category(chr(c)) not in ("Cn", "Cs")]
    pool += list("한국ﬁ½™㍿𝐀😀")
    texts = ["".join(pick.choice(pool) for _ in range(8)) for _ in range(500)] + ["ΟΔΥΣΣΕΥΣ"]

    def fold(text):
        split = unicodedata.normalize("NFKD", text)
        return "".join(ch for ch in split if not unicodedata.combining(ch))

    assert apply(spark, texts, fold_accents) == [fold(t) for t in texts]


@pytest.mark.parametrize(
    ("motion", "ecc", "regime"),
    [
        (15.5, 0.0, "LEO"),
        (11.2501, 0.9, "LEO"),
        (11.25, 0.0, "MEO"),
        (2.0, 0.2499, "MEO"),
        (2.0, 0.25, "HEO"),
        (1.5001, 0.0, "MEO"),
        (1.5, 0.0, "unknown"),
        (1.03, 0.0499, "GEO"),
        (1.0301, 0.0, "unknown"),
        (0.97, 0.0, "GEO"),
        (0.9699, 0.0, "unknown"),
        (1.0, 0.05, "unknown"),
        (1.0, 0.25, "HEO"),
        (None, 0.1, None),
        (15.0, None, None),
    ],
)
def test_orbit_regime(spark, motion, ecc, regime):
    df = spark.createDataFrame([(motion, ecc)], "m double, e double")
    assert df.select(orbit_regime("m", "e")).first()[0] == regime


def test_orbit_regime_is_total(spark):
    df = spark.range(2000).select((F.rand(1) * 20).alias("m"), F.rand(2).alias("e"))
    found = {r[0] for r in df.select(orbit_regime("m", "e")).distinct().collect()}
    assert found <= set(REGIMES)


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def plain_score(a, b):
    """The definition, on whole strings."""
    left, right = set(a.split()), set(b.split())
    shared = left & right
    if shared and (left <= right or right <= left):
        return 1.0
    s = " ".join(sorted(shared))
    x = " ".join([s, *sorted(left - right)]).strip()
    y = " ".join([s, *sorted(right - left)]).strip()
    pairs = [(x, y)] + ([(s, x), (s, y)] if shared else [])
    return max(2 * lcs(p, q) / (len(p) + len(q)) for p, q in pairs)


def test_token_set_score_follows_its_definition(spark):
    pick = random.Random(11)
    words = ["cosmos", "cosmo", "deb", "12", "123", "sat", "a", "yaogan"]
    pairs = [
        tuple(" ".join(pick.sample(words, pick.randint(1, 4))) for _ in range(2)) for _ in range(300)
    ]
    df = spark.createDataFrame(pairs, "a string, b string")
    for row in df.withColumn("s", token_set_score("a", "b")).collect():
        assert row.s == pytest.approx(plain_score(row.a, row.b), abs=1e-12), row


def test_token_key(spark):
    assert apply(spark, ["b a b", "x", ""], token_key) == ["a b", "x", ""]


def test_batches_of_names_score_as_single_pairs():
    rng = random.Random(4)
    letters = "abcé日1 "
    text = lambda: "".join(rng.choices(letters, k=rng.choice([0, 1, 5, 30, 63, 64, 65, 130, 300])))
    tokens = ["a", "ab", "abc", "b7", "cosmos", "1234", "日本", "x"]
    pairs = [(text(), text()) for _ in range(600)]
    pairs += [tuple(" ".join(rng.sample(tokens, rng.randint(0, 5))) for _ in "lr") for _ in range(600)]
    left, right = map(list, zip(*pairs))
    sides = similarity.Texts.of(left), similarity.Texts.of(right)
    assert similarity.common_lengths(*sides).tolist() == [similarity._common_length(a, b) for a, b in pairs]
    assert similarity.token_set_scores(left, right).tolist() == [similarity._score(a, b) for a, b in pairs]
    assert similarity.token_set_scores([], []).tolist() == []


def test_scores_of_missing_names(spark):
    rows = [("a b", "a c"), (None, "a"), ("a", None), (None, None), ("", "a"), ("a", "a b")]
    df = spark.createDataFrame(rows, "l string, r string")
    scores = [r.s for r in df.select(similarity.token_set_score("l", "r").alias("s")).collect()]
    assert scores[1:4] == [None] * 3 and scores[4:] == [0.0, 1.0]
    assert scores[0] == similarity._score("a b", "a c")
