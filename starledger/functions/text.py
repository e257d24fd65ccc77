"""Cleaning of registry text: whitespace, blanks, partial dates, flags.

Every function maps a column to a column and stays in built-in expressions, so a chain
of them runs inside one generated stage next to the scan.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# (?U) makes \s the Unicode White_Space property; `trim` would only remove U+0020.
_EDGE = r"(?U)^\s+|\s+\z"
_HAS_EDGE = r"(?U)^\s|\s\z"

# Accepted shapes of a registry date.
_FULL_DATE = r"^\d{4}-\d{2}-\d{2}\z"
_YEAR_MONTH = r"^\d{4}-\d{2}\z"
_YEAR = r"^\d{4}\z"


def column(c: Column | str) -> Column:
    """A column by name, taking names with dots or spaces literally."""
    return F.col("`" + c.replace("`", "``") + "`") if isinstance(c, str) else c


def has_edge_space(c: Column | str) -> Column:
    """True when the text starts or ends with Unicode whitespace; null stays null."""
    return column(c).rlike(_HAS_EDGE)


def strip(c: Column | str) -> Column:
    """Remove Unicode whitespace at both ends; clean values skip the replacement."""
    c = column(c)
    return F.when(c.rlike(_HAS_EDGE), F.regexp_replace(c, _EDGE, "")).otherwise(c)


def blank_to_null(c: Column | str) -> Column:
    """Empty text becomes null."""
    return F.nullif(column(c), F.lit(""))


def null_to_blank(c: Column | str) -> Column:
    """Null becomes empty text."""
    return F.coalesce(column(c), F.lit(""))


def comparable_text(c: Column | str) -> Column:
    """Any value as text for comparison, with empty text equal to null."""
    return blank_to_null(column(c).cast("string"))


def join_documents(c: Column | str) -> Column:
    """A list of document symbols as one comma-separated text; no list gives ''."""
    return F.coalesce(F.array_join(column(c), ", "), F.lit(""))


def date_by_shape(text: Column) -> Column:
    """`partial_date` for text that is already stripped.

    The shape decides how the text is completed, so each value is parsed once.
    """
    whole = (
        F.when(text.rlike(_FULL_DATE), text)
        .when(text.rlike(_YEAR_MONTH), F.concat(text, F.lit("-01")))
        .when(text.rlike(_YEAR), F.concat(text, F.lit("-01-01")))
    )
    return F.try_to_date(whole, "yyyy-MM-dd")


def partial_date(c: Column | str) -> Column:
    """Parse YYYY-MM-DD, YYYY-MM (first of month) or YYYY (first of January).

    Outer whitespace is ignored; anything else, including impossible dates, is null.
    """
    return date_by_shape(strip(column(c).cast("string")))


def flag_by_letter(text: Column) -> Column:
    """`parse_flag` for text that is already stripped."""
    flag = F.upper(text)
    return F.when(flag == "T", F.lit(True)).when(flag == "F", F.lit(False))


def parse_flag(c: Column | str) -> Column:
    """T is true and F is false, whatever the case and outer whitespace; else null."""
    return flag_by_letter(strip(column(c).cast("string")))


def leading_year(c: Column | str) -> Column:
    """The first four digits of a text as a year, null when there are none."""
    return F.regexp_extract(column(c), r"^([0-9]{4})", 1).try_cast("int")


def year_of(c: Column | str, dtype: str) -> Column:
    """Year of a date column, or the leading year of a text column."""
    if dtype in ("date", "timestamp", "timestamp_ntz"):
        return F.year(column(c))
    return leading_year(column(c).cast("string"))


def first_known(columns: Iterable[Column | str]) -> Column:
    """First non-null value in order of precedence."""
    return F.coalesce(*[column(c) for c in columns])
