"""From raw documents to packed sequences: five stages, each one operator of `starledger.llm`.

Each stage takes what the one before has kept, written as Parquet and read again. All
stages but the last return the columns of `documents`; rows are dropped, or their text and
n_chars changed, nothing else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starledger.llm import decontaminate, jaccard, language, packing, pii
from starledger.llm.base import table
from starledger.sources.shared import materialize

#: A text is rejected where less than this of a language's profile fits it.
LEAST_FIT = 0.2
#: Near copies share this percentage of their sequences of so many words.
NEAR_WORDS, NEAR_PERCENT = 5, 80
TOKENIZER = "byte_bpe_50k.json"
#: Cells of ids in a broadcast, at most.
CELLS = 1 << 20


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages of the labelled rows; `lang` stays as it was.

    Null texts and texts without letters go, and those that fit no language.
    """
    predicted = language.predict(docs.withColumns(_shadows(docs)), language.learn(docs))
    kept = predicted.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("fit") >= LEAST_FIT))
    return kept.select(*[F.col(_own(c)).alias(c) if c in SHADOWED else F.col(c) for c in docs.columns])


#: Columns that a prediction would replace are kept under another name meanwhile.
SHADOWED = ("lang_pred", "score", "fit")


def _own(name: str) -> str:
    return f"own {name}"


def _shadows(docs: DataFrame) -> dict:
    return {_own(c): F.col(c) for c in SHADOWED if c in docs.columns}


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of every group of near copies; rows without id all stay."""
    groups = jaccard.jaccard_join(docs, size=NEAR_WORDS, percent=NEAR_PERCENT)
    gone = groups.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    leaks = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    leaks = materialize(leaks.select("doc_id").distinct(), "leaks")
    return _without_ids(docs, leaks)


def _without_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose doc_id is not in `ids`, few of all as a rule.

    Ids are dealt to CELLS cells by a hash. Texts of cells without such an id, most of them,
    stay where they are, however many ids there are; only the others are shuffled to be
    compared. Rows without id all stay.
    """
    cell = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(CELLS)).cast("int")
    taken = F.broadcast(ids.select(cell.alias("_cell")).distinct())
    met = cell == F.col("_cell")
    apart = docs.join(taken, met, "left_anti")
    near = docs.join(taken, met, "left_semi").join(ids, "doc_id", "left_anti")
    return apart.select(docs.columns).unionByName(near.select(docs.columns))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; n_chars follows the text."""
    clean = pii.redact(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences, with a checksum of their ids."""
    import public_tokenizers

    pieces = packing.pack(docs, public_tokenizers.path(TOKENIZER))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("language", identify_language),
    ("near copies", one_of_each),
    ("benchmark", without_benchmark),
    ("personal data", without_personal_data),
    ("packing", packed),
]

#: Several stages cannot be written in SQL; the tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
