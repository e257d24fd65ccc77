"""Inputs that once broke an operator, ids of other types, and stock phrases of a benchmark."""

import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from starledger.llm import (
    alignment,
    decontaminate,
    hard_negatives,
    html_text,
    jaccard,
    language,
    neighbours,
    packing,
    pii,
    quality,
    repeats,
    simhash,
    token_files,
)
from starledger.sources.shared import scratch_path

public_tokenizers = pytest.importorskip("public_tokenizers")

ARTICLE = "The council met on Monday evening and agreed on the new plan for the harbour, which had been under review for years."


def texts_of_pages(spark, pages):
    df = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string")
    found = df.withColumn("text", html_text.main_text(F.col("html"))).orderBy("page_id").collect()
    return [r.text for r in found]


def test_raw_text_ends_at_its_own_end_tag_only(spark):
    body = f"<article><p>{ARTICLE}</p><p>{ARTICLE}</p></article>"
    whole = f"{ARTICLE}\n{ARTICLE}"
    loop = "<script>for(var i=0;i<n;i++){f(i)}</script>"
    pages = [
        loop + body,
        f"<html><head>{loop}</head><body>{loop}{body}{loop}</body></html>",
        f"<script>if(a<b)document.write('<!-- x')</script>{body}<script>x<y</script>",
        f"<style>a<b{{}} <!-- </style>{body}",
        f"<SCRIPT>'<p title=\"'</Script >{body}",
        f"<script>'</scripts> <p>no</p>'</script>{body}",
        f"<article><p>{ARTICLE}</p><script>a<b",
        f"<textarea><p>x</p></textarea>{body}",
    ]
    found = texts_of_pages(spark, pages)
    assert found[:6] == [whole] * 6 and found[6] == ARTICLE and found[7] == whole


def test_quotes_open_values_only_behind_an_equals_sign(spark):
    pages = [
        f"<article><p title=it's>{ARTICLE}</p></article>",
        f"<article><p title = \"a>b\" x='>' y=>{ARTICLE}</p></article>",
        f"<article><p data-x 'odd \">{ARTICLE}</p></article>",
        f"<article><p class=\"open>{ARTICLE}</p></article>",
    ]
    assert texts_of_pages(spark, pages) == [ARTICLE] * 4


def test_repeated_and_empty_pages(spark):
    page = f"<article><p>{ARTICLE}</p></article>"
    assert texts_of_pages(spark, [page, None, "", page, "<script>", "plain"])[:5] == [ARTICLE, "", "", ARTICLE, ""]


def test_very_long_digit_parts(spark):
    texts = ["0" * 5000 + ".1.2.3", "1" * 5000 + ".1.2.3", "1.2.3." + "0" * 9000 + "7", "1.2.3.000256", "0.0.0.0"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: [s.kind for s in r.spans if s.kind == "ip"] for r in pii.find_spans(rows).collect()}
    assert found == {0: ["ip"], 1: [], 2: ["ip"], 3: [], 4: ["ip"]}
    assert pii.redact(rows).count() == 5


def test_letters_of_all_planes():
    grams = language.Grams()
    for text in ("\U00031350", "\U000323af", "\U00030000", "\U0001d5d4", "é"):
        assert len(grams.codes(grams.points(text)))
    assert not len(grams.codes(grams.points("1 \U0001f600 ٣")))


def test_a_repeated_vector_id_counts_once(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(60)]
    own = dict(rows)
    extra = [(7, [9.0] * 8), (7, [-9.0] * 8), (20, rng.normal(size=8).tolist())]
    df = spark.createDataFrame(rows + extra, "vec_id int, embedding array<double>")
    found = neighbours.nearest(df, F.col("vec_id") % 20 == 0, k=60).collect()
    for i, v in extra:
        own[i] = min(own[i], v)
    for query in (0, 20, 40):
        scores = {r.vec_id: r.score for r in found if r.query_id == query}
        assert len(scores) == 59 == sum(r.query_id == query for r in found)
        assert all(abs(s - np.dot(own[query], own[i])) < 1e-9 for i, s in scores.items())


def test_narrow_ids(spark):
    texts = ["one two three four five six", "one two three four five six", "", None, ARTICLE]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts, 1)], "doc_id int, text string, lang string")
    items = spark.createDataFrame([(1, ARTICLE)], "item_id int, text string")
    labels = spark.createDataFrame([(1, 1, 0), (5, 1, 0)], "doc_id int, quality int, toxic int")
    path = scratch_path(spark, "narrow-ids")
    token_files.write_tokens(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    byte_bpe, pieces = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    every = [
        jaccard.jaccard_join(docs),
        simhash.near_duplicates(docs),
        repeats.remove_repeats(docs),
        language.predict(docs, language.learn(docs)),
        quality.resample(docs, labels, F.col("quality") == 1),
        token_files.read_tokens(spark, path),
        pii.find_spans(docs),
        packing.pack(docs, byte_bpe),
        alignment.align(docs, byte_bpe, pieces),
        decontaminate.find_leaks(docs, items),
    ]
    for df in every[:-4] + every[-3:]:
        assert {r.doc_id for r in df.select("doc_id").collect()} <= {1, 2, 3, 4, 5}
    assert [(r.doc_id, r.item_id) for r in every[-1].collect()] == [(5, 1)]
    vectors = spark.createDataFrame([(i, [1.0, float(i)], i % 2) for i in range(6)], "vec_id int, embedding array<double>, label int")
    assert hard_negatives.mine(vectors, F.col("vec_id") == 0, low=0, high=100).count() > 0


# --- benchmark items that share phrases -------------------------------------------------


def plain_alignment(a, b):
    """Best score by the whole table; ties as the operator breaks them are not needed."""
    table = np.zeros((len(a) + 1, len(b) + 1), int)
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            table[i, j] = max(0, table[i - 1, j - 1] + (2 if x == y else -1), table[i - 1, j] - 1, table[i, j - 1] - 1)
    return int(table.max())


def test_leaks_of_a_small_corpus_with_stock_phrases(spark):
    """Every document and item against the rule, with a phrase and a passage that items share."""
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(4000)}"
    stock = "which of the following statements about the text is true".split()
    passage = [word() for _ in range(30)]
    items = [[*(stock if i % 2 else []), *(passage if i % 5 == 0 else []), *[word() for _ in range(rng.choice([6, 15, 25]))]] for i in range(60)]
    docs = [[word() for _ in range(60)] for _ in range(10)]
    docs += [d[:20] + stock + d[20:] for d in docs[:5]]
    for i in range(0, 60, 3):
        copied = list(items[i])
        for _ in range(rng.choice([0, 1, 2])):
            copied[rng.randrange(len(copied))] = word()
        docs.append(docs[i % 10][:15] + copied + docs[i % 10][15:])
    docs.append(docs[0][:9] + passage + docs[0][9:])
    frames = [
        spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(rows)], f"{name} long, text string")
        for name, rows in (("doc_id", docs), ("item_id", items))
    ]
    found = {(r.doc_id, r.item_id): r for r in decontaminate.find_leaks(*frames).collect()}
    scores = {(d, i): plain_alignment(items[i], docs[d]) for d in range(len(docs)) for i in range(len(items))}
    for (d, i), r in found.items():
        share = 2 * len(items[i]) * decontaminate.SHARE
        assert round(r.score * 2 * len(items[i]), 6) == scores[d, i]
        assert scores[d, i] >= share and r.n_equal >= 8 or r.n_equal >= 13 and r.n_equal >= 0.8 * r.n_aligned
    # Eight equal words or more at half the score, or far more than thirteen equal ones.
    sure = {k for k, s in scores.items() if s >= max(16, len(items[k[1]])) or s >= 34}
    assert sure <= set(found) and len(sure) > 30
    assert not {k for k in found if scores[k] < min(len(items[k[1]]), 23)}


def test_a_phrase_of_very_many_items_seeds_none_that_has_rarer_ones():
    common, rare = 10_000, 1
    spread = [rare] * 9 + [common] * 7
    assert decontaminate.rare_places(spread) == list(range(9))
    # Where nothing is rarer, every run of words keeps a seed.
    for n in (1, 5, 10, 11, 40):
        places = decontaminate.rare_places([common] * n)
        width = min(decontaminate.RUN - decontaminate.SEED + 1, n)
        assert all(any(a <= p < a + width for p in places) for a in range(n - width + 1))


def test_a_shared_phrase_is_no_leak(spark):
    stock = "which of the following statements about the text is true"
    items = [(i, f"{stock} {' '.join(f'v{i}x{k}' for k in range(12))}") for i in range(300)]
    docs = [(i, f"a{i} b{i} {stock} c{i}") for i in range(20)] + [(99, "before " + items[7][1] + " after")]
    frames = [spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")]
    assert [(r.doc_id, r.item_id) for r in decontaminate.find_leaks(*frames).collect()] == [(99, 7)]
    spread = [300] * 7 + [1] * 15
    assert len(decontaminate.rare_places(spread)) == 15


def test_alignment_of_long_items_takes_little_memory():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 1 << 40, 20_000).astype(np.uint64)
    b = np.concatenate([rng.integers(0, 1 << 40, 50).astype(np.uint64), a[5_000:6_000], a[6_010:7_000]])
    tracemalloc.start()
    found = decontaminate.align(a, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == (2 * 1990 - 10, 1990, 2000, 50, len(b) - 1) and peak < 20e6
