"""Language identification by rank-order profiles.

A profile lists the most frequent letter n-grams (one to three letters, words padded by
one blank) of a language, most frequent first; ties go to the smaller n-gram code. A text
is compared by the out-of-place distance: over the text's own top n-grams, the sum of rank
differences, with PROFILE for an n-gram that the language's profile lacks. The language
with the least distance wins; ties go to the smaller name.

Learning counts the n-grams of every training text in every task, adds the partial counts
with Spark, and keeps PROFILE n-grams a language. Only those profiles, bounded by the
number of languages, pass the driver.

Null texts and texts without letters are `und` with score 0. Texts are read whole. Rows
that repeat are predicted alike. Without any training row every text is `und`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starledger.llm.base import map_arrow, quoted, texts_of

#: N-grams in a profile, of a language and of a text.
PROFILE = 400
UNKNOWN = "und"
#: Bits of one letter in an n-gram code: any code point fits.
BITS = 21
#: Characters counted at once while learning.
CHUNK = 1 << 20


class Grams:
    """Codes of the letter n-grams of texts; built once per task."""

    def __init__(self):
        letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
        self.letters = letters

    def points(self, text: str) -> np.ndarray:
        """Lower-case code points with 0 for everything that is no letter."""
        raw = text.lower().encode("utf-32-le", "surrogatepass")
        points = np.frombuffer(raw, np.uint32)
        return np.where(self.letters[points], points, 0).astype(np.int64)

    @staticmethod
    def codes(points: np.ndarray) -> np.ndarray:
        """Codes of all n-grams; a run of non-letters counts as one blank."""
        kept = points != 0
        kept[1:] |= points[:-1] != 0
        row = np.zeros(int(kept.sum()) + 2, np.int64)
        row[1:-1] = points[kept]
        one = row[row > 0]
        two = (row[:-1] << BITS | row[1:])[(row[:-1] > 0) | (row[1:] > 0)]
        three = (row[:-2] << 2 * BITS | row[1:-1] << BITS | row[2:])[row[1:-1] > 0]
        return np.concatenate([one, two, three])


def tally(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in ascending order and how often each occurs."""
    codes = np.sort(codes)
    first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])) if len(codes) else codes
    return codes[first], np.diff(np.append(first, len(codes)))


def ranked(codes: np.ndarray) -> np.ndarray:
    """The top PROFILE codes, most frequent first, ties to the smaller code."""
    distinct, counts = tally(codes)
    order = np.argsort(-counts, kind="stable")[:PROFILE]
    return distinct[order]


@dataclass
class Profiles:
    """Ranks by language in one sorted table of n-gram codes."""

    languages: list[str]
    codes: np.ndarray  # sorted
    ranks: np.ndarray  # languages x codes, PROFILE where absent

    def distances(self, grams: np.ndarray) -> np.ndarray:
        """Out-of-place distance of a ranked list to every language, as a share of the most."""
        own = np.arange(len(grams))
        at = np.minimum(np.searchsorted(self.codes, grams), len(self.codes) - 1)
        ranks = np.where(self.codes[at] == grams, self.ranks[:, at], PROFILE)
        gaps = np.where(ranks < PROFILE, np.abs(ranks - own), PROFILE)
        return gaps.sum(axis=1) / (PROFILE * len(grams))


def learn(documents: DataFrame, text: str = "text", lang: str = "lang") -> Profiles:
    """Profiles from all rows whose text and language are not null."""
    labelled = documents.select(quoted(lang).alias("lang"), quoted(text).alias("text"))
    counts = map_arrow(
        labelled.where("lang is not null and text is not null"), _count, "lang string, gram long, n long"
    )
    totals = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # A language's n-grams are cut per hash group first, so no window holds them all.
    top = totals
    for keys in (("lang", F.pmod(F.xxhash64("gram"), F.lit(64))), ("lang",)):
        place = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("n"), "gram"))
        top = top.withColumn("place", place).where(F.col("place") <= PROFILE)
    rows = top.select("lang", "gram", "place").collect()
    languages = sorted({row.lang for row in rows})
    codes = np.unique(np.array([row.gram for row in rows], np.int64))
    ranks = np.full((len(languages), len(codes)), PROFILE, np.int32)
    number = {language: i for i, language in enumerate(languages)}
    for row in rows:
        ranks[number[row.lang], np.searchsorted(codes, row.gram)] = row.place - 1
    return Profiles(languages, codes, ranks)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    grams = Grams()
    held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    waiting: dict[str, list[np.ndarray]] = {}
    size: dict[str, int] = {}

    def add(language: str) -> None:
        codes, counts = tally(np.concatenate(waiting.pop(language)))
        size[language] = 0
        if language in held:
            codes = np.concatenate([held[language][0], codes])
            counts = np.concatenate([held[language][1], counts])
            order = np.argsort(codes, kind="stable")
            codes, counts = codes[order], counts[order]
            first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
            codes, counts = codes[first], np.add.reduceat(counts, first)
        held[language] = codes, counts

    for batch in batches:
        for language, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)).to_pylist()):
            codes = grams.codes(grams.points(text))
            if not len(codes):
                continue
            waiting.setdefault(language, []).append(codes)
            size[language] = size.get(language, 0) + len(codes)
            if size[language] > CHUNK:
                add(language)
            if sum(len(codes) for codes, _ in held.values()) > 4 * CHUNK:
                yield from _counted(held)
                held.clear()
    for language in list(waiting):
        add(language)
    yield from _counted(held)


def _counted(held: dict[str, tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    for language, (codes, counts) in held.items():
        columns = [pa.array([language] * len(codes), pa.string()), pa.array(codes), pa.array(counts)]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "gram", "n"])


PREDICTION = "struct<lang_pred:string,score:double,fit:double>"


def predict(documents: DataFrame, profiles: Profiles, text: str = "text") -> DataFrame:
    """The rows with `lang_pred`, `score` and `fit`; columns of those names are replaced.

    `score` is the lead over the second language, as a share of the second's distance;
    `fit` is 1 less the winner's distance as a share of the greatest possible.
    """
    # Plain arrays: a broadcast does not carry this module's classes to the executors.
    plain = (profiles.languages, profiles.codes, profiles.ranks)
    model = documents.sparkSession.sparkContext.broadcast(plain)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        grams, known = Grams(), Profiles(*model.value)
        for column in batches:
            rows = [_predict(grams, known, text) for text in texts_of(column).to_pylist()]
            names, scores, fits = zip(*rows) if rows else ((), (), ())
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(fits, pa.float64())],
                ["lang_pred", "score", "fit"],
            )

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    found = F.arrow_udf(run, PREDICTION)(quoted(text))
    hidden = _free_name(documents)
    out = documents.withColumn(hidden, found)
    return out.withColumns(
        {name: F.col(f"{hidden}.{name}") for name in ("lang_pred", "score", "fit")}
    ).drop(hidden)


def _predict(grams: Grams, profiles: Profiles, text: str) -> tuple[str, float, float]:
    own = ranked(grams.codes(grams.points(text)))
    if not len(own) or not profiles.languages:
        return UNKNOWN, 0.0, 0.0
    distances = profiles.distances(own)
    best = int(np.argmin(distances))
    others = np.delete(distances, best)
    second = float(others.min()) if len(others) else 1.0
    lead = (second - float(distances[best])) / second if second > 0 else 0.0
    return profiles.languages[best], min(1.0, max(0.0, lead)), 1.0 - float(distances[best])


def _free_name(df: DataFrame) -> str:
    name = "found"
    while name in df.columns:
        name += "_"
    return name


def held_out(doc_id: Column) -> Column:
    """True for the fold that no profile learns from: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
