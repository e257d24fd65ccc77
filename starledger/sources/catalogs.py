"""Catalog CSV files with declared column types.

`read_catalog` trusts a landed file and fails on what it cannot read. `inspect_catalog`
sets such lines aside, each with its file, and goes on with the others.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starledger.functions.text import column


#: Where the reader puts a line that has too few or too many cells.
_LINE = "_line"


def _header(spark: SparkSession, path: str) -> list[str]:
    header = spark.read.option("header", True).csv(path).schema
    if not header:
        raise ValueError(f"no CSV header under {path}")
    return header.names


def _text(spark: SparkSession, path: str, names: list[str], **options) -> DataFrame:
    text = T.StructType([T.StructField(name, T.StringType()) for name in names])
    return spark.read.options(header=True, enforceSchema=False, **options).schema(text).csv(path)


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """All cells as text, columns as the header names them.

    A CSV reader with a schema fills columns by position. Here the header of the first
    file names the columns, and a file whose header differs fails the job.
    """
    return _text(spark, path, _header(spark, path))


def _typed(name: str, dtype: T.DataType) -> Column:
    return column(name).try_cast(dtype)


def _bad(name: str, dtype: T.DataType) -> Column:
    return column(name).isNotNull() & _typed(name, dtype).isNull()


def _declared(df: DataFrame, schema: T.StructType) -> list[T.StructField]:
    return [f for f in schema if f.name in df.columns and not isinstance(f.dataType, T.StringType)]


def type_cells(text: DataFrame, schema: T.StructType) -> DataFrame:
    """Give the declared columns their types; an unreadable cell fails the job.

    Columns that are missing or not declared are left to the contract check.
    """

    def checked(field: T.StructField) -> Column:
        message = F.concat(
            F.lit(f"{field.name}: not a {field.dataType.simpleString()}: "), column(field.name)
        )
        fail = F.raise_error(message).try_cast(field.dataType)
        return F.when(_bad(field.name, field.dataType), fail).otherwise(
            _typed(field.name, field.dataType)
        )

    return text.withColumns({f.name: checked(f) for f in _declared(text, schema)})


def unreadable_cells(text: DataFrame, schema: T.StructType) -> DataFrame:
    """Cells that do not read as their declared type, as (column_name, dtype, value)."""
    cells = [
        F.when(
            _bad(f.name, f.dataType),
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("dtype"),
                column(f.name).alias("value"),
            ),
        )
        for f in _declared(text, schema)
    ]
    return text.select(F.inline(F.array_compact(F.array(*cells))))


def read_catalog(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A landed catalog as a typed frame, columns in file order; no content is an error."""
    return type_cells(read_csv_text(spark, path), schema)


@dataclass(frozen=True)
class Inspection:
    """Typed rows of whole lines, and what was set aside: file, problem, column_name, value."""

    rows: DataFrame
    quarantine: DataFrame


def inspect_catalog(spark: SparkSession, path: str, schema: T.StructType) -> Inspection:
    """Landed files as typed rows, without the lines that cannot be read.

    A line with too few or too many cells is set aside as `ragged`, with its text as the
    value. Of other lines every cell that does not read as its declared type is listed as
    `unreadable`. Files are named by their paths; a header that differs fails the job.
    """
    names = _header(spark, path)
    lines = _text(spark, path, [*names, _LINE], mode="PERMISSIVE", columnNameOfCorruptRecord=_LINE)
    lines = lines.select(*map(column, names), _LINE, F.col("_metadata.file_path").alias("_file"))
    ragged = column(_LINE).isNotNull()
    bad = {f.name: _bad(f.name, f.dataType) for f in _declared(lines, schema)}
    cells = [
        F.when(
            ~ragged & fails,
            F.struct(
                F.lit("unreadable").alias("problem"), F.lit(name).alias("column_name"), column(name).alias("value")
            ),
        )
        for name, fails in bad.items()
    ]
    # The reader counts only the cells that are asked for, so all are.
    text = F.coalesce(column(_LINE), F.concat_ws(",", *map(column, names)))
    whole_line = F.struct(
        F.lit("ragged").alias("problem"), F.lit(None).cast("string").alias("column_name"), text.alias("value")
    )
    found = F.array_compact(F.array(F.when(ragged, whole_line), *cells))
    quarantine = lines.select(F.col("_file").alias("file"), F.inline(found))
    good = lines.where(F.size(found) == 0).select(*map(column, names))
    typed = {f.name: _typed(f.name, f.dataType) for f in _declared(good, schema)}
    return Inspection(good.withColumns(typed), quarantine)
