"""Normal form of object names, for comparing names across catalogs.

Fold accents, lower, drop [..] and (..), turn standalone Roman numerals into digits,
collapse whitespace, and drop closing punctuation, all in built-in expressions.

Folding is compatibility decomposition (NFKD) without combining marks. Both act on single
characters, as reordering concerns only the marks that are dropped. So the character
table of the Python runtime, read once on the driver, gives the fold as constants.
"""

from __future__ import annotations

import json
import sys
import unicodedata
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starledger.functions.text import column

# Standalone Roman numerals and what they become.
ROMAN_NUMERALS = {
    "i": "1",
    "ii": "2",
    "iii": "3",
    "iv": "4",
    "v": "5",
    "vi": "6",
    "vii": "7",
    "viii": "8",
    "ix": "9",
    "x": "10",
    "xi": "11",
    "xii": "12",
    "xiii": "13",
    "xiv": "14",
    "xv": "15",
    "xvi": "16",
    "xvii": "17",
    "xviii": "18",
    "xix": "19",
    "xx": "20",
}

# Java's \s leaves out U+001C..U+001F, which count as whitespace in a name.
_SPACE = r"[\s\x1c-\x1f]"
_BRACKETS = rf"(?U){_SPACE}*\[[^\]]*\]{_SPACE}*"
_PARENS = rf"(?U){_SPACE}*\([^)]*\){_SPACE}*"
_SPACES = rf"(?U){_SPACE}+"
_CLOSING = r"[.,;:]+\z"
_WORD = r"[\p{L}\p{N}_]"
_ANY_ROMAN = rf"(?<!{_WORD})[ivx]+(?!{_WORD})"
_NON_ASCII = r"[^\x00-\x7F]"


@cache
def _fold_tables() -> tuple[dict[str, str], dict[str, str]]:
    """Characters whose fold is at most one character, and those that expand."""
    short, long = {}, {}
    for code in range(0x80, sys.maxunicode + 1):
        ch = chr(code)
        kept = [d for d in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(d)]
        folded = "".join(kept)
        if folded != ch and not 0xD800 <= code <= 0xDFFF:
            (short if len(folded) <= 1 else long)[ch] = folded
    return short, long


def _char_class(chars: list[str]) -> str:
    """Regular expression class of the given characters, runs written as ranges."""
    ranges: list[list[int]] = []
    for code in sorted(map(ord, chars)):
        if ranges and code == ranges[-1][1] + 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "[" + "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in ranges) + "]"


def fold_accents(c: Column | str) -> Column:
    """Drop accents and compatibility forms; ASCII text is passed through."""
    text = column(c)
    short, long = _fold_tables()
    kept = [ch for ch, to in short.items() if to]
    dropped = [ch for ch, to in short.items() if not to]
    # translate() removes the characters that have no partner.
    single = F.translate(text, "".join(kept + dropped), "".join(short[ch] for ch in kept))
    table = F.from_json(F.lit(json.dumps(long)), "map<string,string>")
    spelled = F.array_join(
        F.transform(F.split(single, ""), lambda ch: F.coalesce(F.try_element_at(table, ch), ch)), ""
    )
    return (
        F.when(~text.rlike(_NON_ASCII), text)
        .when(text.rlike(_char_class(list(long))), spelled)
        .otherwise(single)
    )


def _normalize_folded(folded: Column) -> Column:
    def without(text: Column, opening: str, pattern: str) -> Column:
        # Most names have neither; a plain search is much cheaper than the pattern.
        return F.when(text.contains(opening), F.regexp_replace(text, pattern, " ")).otherwise(text)

    bare = without(without(folded, "[", _BRACKETS), "(", _PARENS)
    arabic = bare
    for roman, digits in sorted(ROMAN_NUMERALS.items(), key=lambda kv: -len(kv[0])):
        arabic = F.regexp_replace(arabic, rf"(?<!{_WORD}){roman}(?!{_WORD})", digits)
    numbered = F.when(bare.rlike(_ANY_ROMAN), arabic).otherwise(bare)
    spaced = F.trim(F.regexp_replace(numbered, _SPACES, " "))
    return F.trim(F.regexp_replace(spaced, _CLOSING, ""))


def normalize_name(c: Column | str) -> Column:
    """Normal form of a name column; null stays null."""
    return _normalize_folded(F.lower(fold_accents(c)))


def with_normal_name(df: DataFrame, name: str, out: str) -> DataFrame:
    """Add the normal form of `name` as `out`, in two projections.

    The first folds, so that the long chain of replacements has one plain input.
    """
    folded = df.withColumn(out, F.lower(fold_accents(name)))
    return folded.withColumn(out, _normalize_folded(column(out)))
