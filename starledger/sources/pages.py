"""Registry records from landed JSON pages.

A page is one JSON document with a `results` array of records and an expected total.
Each record holds its fields under `values`, keyed by dotted names. Pages are parsed to
VARIANT so that a value's own JSON type decides: a number where text is expected counts
as missing, it is not turned into text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starledger.functions.text import (
    column,
    date_by_shape,
    flag_by_letter,
    join_documents,
    null_to_blank,
    strip,
)

# JSON keys under `values` and the columns they fill.
FIELD_COLUMNS = {
    "object.internationalDesignator_s1": "International Designator",
    "object.nationalDesignator_s1": "National Designator",
    "object.nameOfSpaceObjectO_s1": "Name of Space Object",
    "object.launch.stateOfRegistry_s1": "State of Registry",
    "object.launch.dateOfLaunch_s1": "Date of Launch",
    "en#object.status.objectStatus_s1": "Status",
    "object.status.dateOfDecay_s1": "Date of Decay",
    "object.unRegistration.unRegistered_s1": "UN Registered",
    "object.functionOfSpaceObject_s1": "Function",
    "object.remark_s1": "Remarks",
    "object.status.webSite_s1": "External website",
}
DOCUMENTS_KEY = "object.unRegistration.registrationDocuments.document..document.symbol_s"
DOCUMENTS_COLUMN = "Registration Documents"

# Registry columns in output order.
REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("International Designator", T.StringType()),
        T.StructField("National Designator", T.StringType()),
        T.StructField("Name of Space Object", T.StringType()),
        T.StructField("State of Registry", T.StringType()),
        T.StructField("Date of Launch", T.DateType()),
        T.StructField("Status", T.StringType()),
        T.StructField("Date of Decay", T.DateType()),
        T.StructField("UN Registered", T.BooleanType()),
        T.StructField("Registration Documents", T.StringType()),
        T.StructField("Function", T.StringType()),
        T.StructField("Remarks", T.StringType()),
        T.StructField("External website", T.StringType()),
    ]
)

_END = "end of page"

# Where a page states the expected total, in order of preference.
TOTAL_PATHS = ("$.found", "$.total", "$.response.found")


def read_pages(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """Landed pages as one row each in column `page`.

    With `one_per_file=False` every line is a page: the layout for large landings, as
    Spark can then split the files.
    """
    return spark.read.text(path, wholetext=one_per_file).withColumnRenamed("value", "page")


def _parsed(pages: DataFrame) -> DataFrame:
    # Spark stops at the end of the first JSON value and ignores what follows. Inside a
    # list with an end mark, anything after the page's own value breaks the list.
    wrapped = F.try_parse_json(F.concat(F.lit("["), "page", F.lit(f',"{_END}"]')))
    parts = pages.select("page", F.try_variant_get(wrapped, "$", "array<variant>").alias("_parts"))
    whole = (F.size("_parts") == 2) & (F.try_variant_get(F.get("_parts", F.lit(1)), "$", "string") == _END)
    bodies = parts.select("page", F.when(whole, F.get("_parts", F.lit(0))).alias("_body"))
    return bodies.withColumn("_results", F.try_variant_get("_body", "$.results", "array<variant>"))


def _is_object(value: Column) -> Column:
    # A schema would be put together from all that the value holds.
    return value.try_cast("map<string,variant>").isNotNull()


def _fault() -> Column:
    results = F.col("_results")
    given = F.try_variant_get("_body", "$.results", "variant").isNotNull()
    return (
        F.when(F.col("_body").isNull(), "not JSON")
        .when(~_is_object(F.col("_body")), "not an object")
        .when(given & results.isNull(), "results is not a list")
        .when(F.exists(results, lambda r: ~_is_object(r)), "a record is not an object")
    )


def bad_pages(pages: DataFrame) -> DataFrame:
    """Pages that cannot be used, with the reason: the quarantine."""
    return _parsed(pages).select("page", _fault().alias("fault")).where("fault is not null")


def _text_field(values: Column, key: str) -> Column:
    value = F.try_element_at(values, F.lit(key))
    text = F.when(F.schema_of_variant(value) == "STRING", value.try_cast("string"))
    return null_to_blank(text)


def _documents_field(values: Column) -> Column:
    docs = F.try_element_at(values, F.lit(DOCUMENTS_KEY)).try_cast("array<variant>")
    texts = F.transform(
        docs,
        lambda d: F.when(
            F.coalesce(F.schema_of_variant(d), F.lit("VOID")) == "STRING", d.try_cast("string")
        ).otherwise(F.raise_error(F.lit("a registration document is not text"))),
    )
    return join_documents(texts)


def page_records(pages: DataFrame, seen: Observation | None = None) -> DataFrame:
    """One row of raw text per record, columns in registry order, missing values ''.

    A page with a fault fails the job; look at `bad_pages` for the list. With `seen`, what
    `checked_counts` needs is counted as the pages pass by.
    """
    fault = _fault()
    parsed = _parsed(pages)
    if seen is not None:
        parsed = parsed.observe(seen, *_page_counts())
    checked = parsed.select(
        F.when(
            fault.isNotNull(),
            F.raise_error(F.concat(F.lit("unusable page: "), fault)).try_cast("array<variant>"),
        )
        .otherwise(F.col("_results"))
        .alias("_results")
    )
    # The outer form keeps Spark from repeating the whole parse in an inferred filter.
    record = checked.select(F.explode_outer("_results").alias("_record")).where(
        F.col("_record").isNotNull()
    )
    # The values of a record are read once; each field is then looked up by its key.
    values = record.select(
        F.try_variant_get("_record", "$.values", "map<string,variant>").alias("_values")
    )
    fields = {name: _text_field(F.col("_values"), key) for key, name in FIELD_COLUMNS.items()}
    fields[DOCUMENTS_COLUMN] = _documents_field(F.col("_values"))
    return values.select(*[fields[name].alias(name) for name in REGISTRY_SCHEMA.names])


def type_records(records: DataFrame) -> DataFrame:
    """Raw text records as the typed registry frame."""

    def typed(field: T.StructField) -> Column:
        if isinstance(field.dataType, T.DateType):
            return date_by_shape(column(field.name))
        if isinstance(field.dataType, T.BooleanType):
            return flag_by_letter(column(field.name))
        return column(field.name)

    # Two projections, so that each text is stripped once and then parsed.
    stripped = records.select(*[strip(name).alias(name) for name in REGISTRY_SCHEMA.names])
    return stripped.select(*[typed(f).alias(f.name) for f in REGISTRY_SCHEMA])


def load_registry(pages: DataFrame, seen: Observation | None = None) -> DataFrame:
    """Landed pages as the typed registry frame; no records give an empty frame."""
    return type_records(page_records(pages, seen))


@dataclass(frozen=True)
class Completeness:
    """Outcome of comparing the rows of a paged load with the announced total."""

    expected: int | None
    records: int
    largest_page: int
    problem: str | None


def completeness(pages: DataFrame, page_size: int | None = None) -> DataFrame:
    """Announced total, records found, largest page and the problem, if any, as one row.

    `page_size` is the slack allowed above the total; the largest page when not given.
    """
    return _with_problem(_parsed(pages).agg(*_page_counts()), page_size)


def _page_counts() -> list[Column]:
    """Announced total, records found and the largest page, as aggregates of parsed pages."""
    total = F.coalesce(*[F.try_variant_get("_body", p, "bigint") for p in TOTAL_PATHS])
    size = F.coalesce(F.size("_results"), F.lit(0))
    return [
        F.max(total).alias("expected"),
        F.coalesce(F.sum(F.greatest(size, F.lit(0))), F.lit(0)).cast("bigint").alias("records"),
        F.coalesce(F.max(size), F.lit(0)).cast("bigint").alias("largest_page"),
    ]


def _with_problem(counted: DataFrame, page_size: int | None) -> DataFrame:
    slack = F.col("largest_page") if page_size is None else F.lit(page_size)
    problem = (
        F.when(F.col("expected").isNull(), "no total announced")
        .when(F.col("expected") < 0, "negative total")
        .when((F.col("expected") > 0) & (F.col("records") == 0), "no records")
        .when(F.col("records") > F.col("expected") + slack, "more records than announced")
    )
    return counted.withColumn("problem", problem)


def check_completeness(pages: DataFrame, page_size: int | None = None) -> Completeness:
    """Run `completeness` and raise when the load cannot be trusted."""
    return _checked(completeness(pages, page_size))


def checked_counts(spark: SparkSession, counts: dict, page_size: int | None = None) -> Completeness:
    """`check_completeness` with what `page_records` counted."""
    counted = spark.createDataFrame([counts], "expected long, records long, largest_page long")
    return _checked(_with_problem(counted, page_size))


def _checked(found: DataFrame) -> Completeness:
    row = found.first()
    result = Completeness(row["expected"], row["records"], row["largest_page"], row["problem"])
    if result.problem:
        raise ValueError(f"incomplete load: {result.problem} ({result})")
    return result
