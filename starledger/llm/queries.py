"""One query per operator, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
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
from starledger.llm.base import table
from starledger.sources.shared import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
#: SQL by query name; the other queries are tested against brute force.
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op10_pii(spark, sf):
    """Spans of personal data of every document."""
    documents = table(spark, sf, "documents").select("doc_id", "text")
    found = pii.find_spans(documents).drop("text")
    base = F.filter("spans", lambda s: s.kind.isin(*pii.BASE_KINDS))
    written = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ","
    )
    counted = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind))
    counts = [counted(kind).cast("long").alias(f"n_{kind}") for kind in pii.BASE_KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(written(base), 256).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
    )


@query
def op3_language(spark, sf):
    """Predicted language of every document; one fold in four is held out of the learning."""
    documents = table(spark, sf, "documents")
    fold = language.held_out(F.col("doc_id"))
    profiles = language.learn(documents.where(~fold))
    predicted = language.predict(documents.select("doc_id", "text"), profiles)
    return predicted.select("doc_id", fold.alias("held_out"), "lang_pred", "score", "fit")


@query
def op5_token_files(spark, sf):
    """Ids of every document, written to token files and read back."""
    import public_tokenizers

    path = scratch_path(spark, "token-files")
    documents = table(spark, sf, "documents")
    token_files.write_tokens(documents, path, public_tokenizers.path("word_bpe_49k.json"))
    read = token_files.read_tokens(spark, path)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op8_packing(spark, sf):
    """Pieces of all documents packed into sequences."""
    import public_tokenizers

    pieces = packing.pack(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query
def op1_html(spark, sf):
    """Main text of every page."""
    pages = table(spark, sf, "pages").select("page_id", "url", "html")
    texts = pages.withColumn("text", html_text.main_text(F.col("html"))).drop("html")
    return texts.withColumn("n_chars", F.length("text").cast("long"))


@query
def op6_decontamination(spark, sf):
    """Pairs of a document and a benchmark item that it holds, exactly or edited."""
    return decontaminate.find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op9_quality(spark, sf):
    """Documents sampled by their likeness to those labelled good and not toxic."""
    target = (F.col("quality") == 1) & (F.col("toxic") == 0)
    return quality.resample(table(spark, sf, "documents"), table(spark, sf, "labels"), target)


@query
def op4_neighbours(spark, sf):
    """The 20 nearest vectors of every twentieth vector."""
    return neighbours.nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op2_jaccard(spark, sf):
    """Size of every document's shingle set and the component of its links."""
    return jaccard.jaccard_join(table(spark, sf, "documents"))


@query
def op7_repeats(spark, sf):
    """Words of every document and those removed as repeats of an earlier document."""
    kept = repeats.remove_repeats(table(spark, sf, "documents"))
    return kept.withColumn("kept_sha256", F.sha2("text", 256)).drop("text")


@query
def op13_simhash(spark, sf):
    """Fingerprint of every document and the component of its links."""
    return simhash.near_duplicates(table(spark, sf, "documents"))


@query
def op11_alignment(spark, sf):
    """Groups and links between the ids of two tokenizers, of every document."""
    import public_tokenizers as tokenizers

    files = map(tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align(table(spark, sf, "documents"), *files)


@query
def op12_hard_negatives(spark, sf):
    """Hard negatives of every fiftieth vector and each of its positives."""
    vectors = table(spark, sf, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", label), F.col("vec_id") % 50 == 0, every_row=True)
