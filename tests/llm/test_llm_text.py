"""Operators on single texts: main text, language, personal data, quality."""

import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from starledger.llm import html_text, language, pii, quality

DOCS = "doc_id long, text string"


# --- main text of pages -----------------------------------------------------------------


def test_minimum_cut_is_the_cheapest_labelling():
    rng = random.Random(5)
    scale = html_text.SCALE
    for _ in range(300):
        n = rng.randint(1, 8)
        gains = [rng.uniform(-3, 3) for _ in range(n)]
        pairs = itertools.combinations(range(n), 2)
        edges = [(a, b, rng.uniform(0, 2)) for a, b in pairs if rng.random() < 0.5]

        def cost(labels):
            terminal = sum(
                round(scale * max(g, 0)) if not on else round(scale * max(-g, 0))
                for g, on in zip(gains, labels)
            )
            return terminal + sum(round(scale * c) for a, b, c in edges if labels[a] != labels[b])

        best = min(cost(labels) for labels in itertools.product([False, True], repeat=n))
        assert cost(html_text.minimum_cut(gains, edges)) == best


def test_smoothing_keeps_a_short_block_between_long_ones():
    gains = [2.0, -0.5, 2.0]
    assert html_text.minimum_cut(gains, []) == [True, False, True]
    assert html_text.minimum_cut(gains, [(0, 1, 0.4), (1, 2, 0.4)]) == [True, True, True]


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("<html><body></body></html>", ""),
        ("<nav><ul><li><a href=/>Home</a></li></ul></nav>", ""),
        (
            "<title>T</title><header>Top of page</header><article><h1>A &amp; B</h1>"
            "<p>One  <b>two</b>\n three&nbsp;four, a sentence.<p>Next paragraph here.</p>"
            "<div class='ad'>Buy this now.</div><script>var x = '<p>no</p>';</script></article>"
            "<section id=comments><p>Nice text, thanks a lot.</p></section><footer>c</footer>",
            "A & B\nOne two three four, a sentence.\nNext paragraph here.",
        ),
        ("<article><p>Cut off in the mid", "Cut off in the mid"),
        ("<article><p>Said twice.</p><p>Said twice.</p></article>", "Said twice.\nSaid twice."),
        ("<main><p>Some words<br>on two lines.</p></main>", "Some words on two lines."),
    ],
)
def test_extract(page, text):
    assert html_text.extract(page) == text


@pytest.mark.parametrize(
    "head",
    [
        "<head><title>T</title><body>",
        "<html><head><meta charset=utf-8><link rel=x href=y><script>var a = '<p>';</script>",
        "<HEAD><style>p {}</style><BODY class=x>",
        "<head><noscript><link href=y><body>",
        "<head><noscript><link href=y>",
        "<head><template><div>not shown</div></template><noscript><p>Not shown.</p></noscript>",
        "<head><title>T</title></head><body>",
        "<head><template><body>",
    ],
)
def test_a_head_ends_where_the_body_begins(head):
    page = head + "<article><h1>A</h1><p>Some text is here, a sentence.</p></article>"
    assert html_text.extract(page) == "A\nSome text is here, a sentence."


def test_text_ends_a_head():
    text = "Plain text of a page without any body tag, which is a long enough sentence."
    assert html_text.extract(f"<head><meta charset=utf-8>\n{text}") == text


def test_very_long_page_takes_linear_time():
    page = "<article>" + "<p>A sentence of some words.</p><div class=ad>Buy</div>" * 20_000
    assert html_text.extract(page).count("\n") == 19_999


def test_main_text_column_keeps_rows(spark):
    rows = [(1, "<article><p>Some text is here.</p>"), (1, None), (2, "")]
    pages = spark.createDataFrame(rows, "page_id long, html string")
    found = pages.select("page_id", html_text.main_text(F.col("html")).alias("t")).collect()
    assert sorted(map(tuple, found)) == [(1, ""), (1, "Some text is here."), (2, "")]
    assert pages.limit(0).select(html_text.main_text(F.col("html"))).collect() == []


# --- language ---------------------------------------------------------------------------


def _learned(spark):
    rows = [
        ("the cat and the dog sat on the mat with another cat", "en"),
        ("der hund und die katze sitzen auf der matte", "de"),
        (None, "en"),
        ("no label here", None),
    ]
    return language.learn(spark.createDataFrame(rows, "text string, lang string"))


def test_profiles_match_a_plain_count(spark):
    profiles = _learned(spark)
    assert profiles.languages == ["de", "en"]
    text = " der hund und die katze sitzen auf der matte "
    counts = {}
    for n in (1, 2, 3):
        for i in range(len(text) - n + 1):
            gram = text[i : i + n]
            if gram != " " and not (n == 3 and gram[1] == " "):
                code = sum((0 if c == " " else ord(c)) << 21 * (n - 1 - k) for k, c in enumerate(gram))
                counts[code] = counts.get(code, 0) + 1
    ranked = sorted(counts, key=lambda c: (-counts[c], c))[: language.PROFILE]
    own = profiles.codes[profiles.ranks[0] < language.PROFILE]
    by_rank = sorted(own.tolist(), key=lambda c: profiles.ranks[0][profiles.codes.tolist().index(c)])
    assert by_rank == ranked


def test_predictions_and_edge_cases(spark):
    rows = [
        (1, "the dog and the cat", "x"),
        (2, "DIE KATZE UND DER HUND", "x"),
        (3, None, "x"),
        (4, "", "x"),
        (5, "123 !!! 456", "x"),
        (1, "the dog and the cat", "x"),
        (6, "the cat and the dog " * 20_000, "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    found = language.predict(docs, _learned(spark))
    assert found.columns == ["doc_id", "text", "score", "lang_pred", "fit"]
    got = sorted((r.doc_id, r.lang_pred) for r in found.collect())
    assert got == [(1, "en"), (1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und"), (6, "en")]
    assert all(0 <= r.score <= 1 for r in found.collect())


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    docs = spark.createDataFrame([(1, "words")], DOCS)
    assert language.predict(docs, language.learn(empty)).first().lang_pred == "und"


def test_held_out_accuracy(spark):
    from starledger.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    found = QUERIES["op3_language"](spark, sf).where("held_out")
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").collect()
    assert len(rows) > 20
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)


# --- personal data ----------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _plain_spans(text):
    """The base kinds by searching the whole text with each pattern."""
    found = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            ok = {
                "email": True,
                "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in doubled) % 10 == 0,
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if ok:
                found.append((m.start(), rank, m.end(), kind))
    return [(kind, a, b) for a, _, b, kind in sorted(found)]


def test_base_spans_equal_a_search():
    rng, finder = random.Random(3), pii.SpanFinder()
    for letters in ("ab@.+-1 2345(:/)%", "4111 -1234567890", "é@a.b 1+ [at]token="):
        for _ in range(8000):
            text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 45)))
            found = [s for s in finder.spans(text) if s[0] in pii.BASE_KINDS]
            assert found == _plain_spans(text), text


@pytest.mark.parametrize(
    ("text", "kind", "part"),
    [
        ('set token = "04dbebab91ab85687d33" now', "account", "04dbebab91ab85687d33"),
        ("IBAN: DE89 3704 0044 0532 0130 00.", "account", "DE89 3704 0044 0532 0130 00."),
        ("write to jane (at) example dot com", None, None),
        ("write to jane [at] example [dot] com", "masked", "jane [at] example [dot] com"),
        ("ftp://user:pa55@host.example/x", "login", "user:pa55"),
        ("the tokens of a text", None, None),
    ],
)
def test_added_kinds(text, kind, part):
    spans = [s for s in pii.SpanFinder().spans(text) if s[0] not in pii.BASE_KINDS]
    assert [(k, text[a:b]) for k, a, b in spans] == ([(kind, part)] if kind else [])


def test_long_texts_take_linear_time():
    finder = pii.SpanFinder()
    for piece in ("1", "1.", "a@", "+1 ", "1 ", "token=", "a:b://"):
        finder.spans(piece * 200_000)


@pytest.mark.parametrize(
    ("text", "clean"),
    [
        ("token: " + "aB3" * 150 + " end", "token: <ACCOUNT> end"),
        ("secret=" + "x" * 300 + "7" + "y" * 300 + ", end", "secret=<ACCOUNT>, end"),
        ("a token=" + "token=" * 100 + "x1 end", "a token=<ACCOUNT> end"),
        ("ftp://" + "u" * 400 + ":" + "p" * 400 + "@host/x", "ftp://<LOGIN>@host/x"),
        ("to " + "j" * 300 + " [at] example [dot] com", "to <MASKED>"),
    ],
)
def test_long_values_go_whole(text, clean):
    assert pii._cut(text, pii.SpanFinder()) == clean


def test_long_runs_of_cues_take_linear_time():
    finder = pii.SpanFinder()
    for piece in ("token=", "token=-", "token:x[at]", "://a:b", "a://b:c@", "x[at]"):
        finder.spans(piece * 200_000)
    for text in ("x" * 200_000 + "[at]", "://" + "a" * 10**6 + ":" + "b" * 10**6, "token=" + "x" * 10**6):
        finder.spans(text * 3)


def test_find_and_redact(spark):
    rows = [(1, "me@x.org or 10.0.0.1", 7), (2, None, 7), (3, "", 7), (1, "me@x.org or 10.0.0.1", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    found = pii.find_spans(docs)
    assert found.columns == ["doc_id", "text", "spans"]
    kinds = sorted((r.doc_id, [s.kind for s in r.spans]) for r in found.collect())
    assert kinds == [(1, ["email", "ip"]), (1, ["email", "ip"]), (2, []), (3, [])]
    assert sorted((r.doc_id, r.text or "") for r in pii.redact(docs).collect()) == [
        (1, "<EMAIL> or <IP>"), (1, "<EMAIL> or <IP>"), (2, ""), (3, ""),
    ]


def test_pii_query_against_the_patterns(spark):
    from starledger.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    rows = QUERIES["op10_pii"](spark, sf).collect()
    assert len(rows) == len(texts)
    for row in rows:
        plain = _plain_spans(texts[row.doc_id])
        written = ",".join(f"{k}:{a}:{b}" for k, a, b in plain)
        assert row.base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert row.n_email == sum(k == "email" for k, _, _ in plain)


# --- quality ----------------------------------------------------------------------------


def test_kth_greatest_is_exact(spark):
    rng = random.Random(1)
    values = [rng.choice([rng.gauss(0, 1), 0.5, 1e9]) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for k in (1, 2, 100, 499, 500):
        assert quality.kth_greatest(df, "v", k) == sorted(values, reverse=True)[k - 1]


def test_resampling_prefers_the_target(spark):
    good, bad = "clear words in plain sentences", "zzz !!! qqq ### vvv"
    rows = [(i, f"{good if i % 2 else bad} {i}") for i in range(200)] + [(900, None), (901, " ")]
    docs = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame([(i, 1) for i in range(1, 100, 2)] + [(None, 1)], "doc_id long, q int")
    kept = quality.resample(docs, labels, F.col("q") == 1, keep=0.5).collect()
    assert len(kept) == 100
    assert sum(r.doc_id % 2 for r in kept) >= 95
    again = quality.resample(docs, labels, F.col("q") == 1, keep=0.5).collect()
    assert sorted(r.doc_id for r in kept) == sorted(r.doc_id for r in again)
    assert quality.resample(docs.limit(0), labels, F.col("q") == 1).count() == 0
    assert quality.resample(docs, labels.limit(0), F.col("q") == 1, keep=1.0).count() == 200


def test_quality_on_labelled_documents(spark):
    from starledger.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    kept = QUERIES["op9_quality"](spark, sf).select("doc_id").withColumn("kept", F.lit(1))
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    share = labels.join(kept, "doc_id", "left").groupBy("quality").agg(
        (F.count("kept") / F.count("*")).alias("share")
    )
    shares = {r.quality: r.share for r in share.collect()}
    assert shares[1] > 0.95 and shares[0] < 0.3
