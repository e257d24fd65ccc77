"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are runs of letters, digits and non-ASCII characters, compared in lower case. The
seeds of a benchmark item are those of its SEED-word sequences that COMMON distinct items at
most have, and in every run of RUN words, however common they all are, the rarest. So every
RUN words of an item hold a seed, and a phrase that very many items share brings only those
items to a document that have nothing rarer near it. What goes unseen is an edited copy in
which no RUN words in a row are whole and whose whole sequences are all common ones. A
document that shares a seed with an item is aligned with it around the seed's diagonal:
local alignment of words with affine-free gaps, MATCH for equal words, MISMATCH and GAP
otherwise. A document is contaminated by an item when

- the alignment's score is at least SHARE of the score of the whole item, and LEAST words or
  the whole item are equal, or
- it aligns RUN equal words or more, with at least PURITY of the aligned words equal. Such
  words always hold SEED of them in a row, so none of these is lost.

The scores of candidates alone are computed first, many at once, and only those that can
reach a limit are aligned word by word. Both keep one row of the alignment's table, so a long
item or text takes memory in proportion to its length.

Items of fewer words than SEED are one seed and must be found whole. Empty items and
documents, and null texts, match nothing. The benchmark is cut into blocks of BLOCK_SEEDS
seeds; every block is a bounded broadcast and passes over all documents once, so a
benchmark of any size works. Copies of a document are each reported. Items of the same words
are searched once and reported under each of their ids; an item that repeats with its id
counts once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starledger.llm.base import map_arrow, quoted, texts_of
from starledger.llm.words import PUNCTUATION, WordHasher
from starledger.sources.shared import materialize

SEED = 4
MATCH, MISMATCH, GAP = 2, -1, -1
SHARE = 0.5
#: Two seeds' words: one stock phrase of a short item is no copy of it.
LEAST = 2 * SEED
RUN, PURITY = 13, 0.8
#: Distinct items that a sequence may have and count as rare.
COMMON = 100
#: Words on either side of a seed's diagonal that an alignment may use.
SLACK = 16
#: Seeds of one broadcast: some 30 MB with the words of their items.
BLOCK_SEEDS = 500_000
#: Hits of seeds that are held at once, and cells of the tables that are filled at once.
HITS = 1 << 18
CELLS = 1 << 16

FOUND = (
    "doc_id long, item_id long, score double, n_equal int, n_aligned int,"
    " first_word int, last_word int"
)


def _hash_words(hasher: WordHasher, texts: pa.Array):
    return hasher.slices(pc.utf8_lower(texts_of(texts)))


def item_seeds(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Words and seeds of all items with words: item_id, words, grams, size (words of a seed)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(separators=PUNCTUATION)
        for batch in batches:
            ids, out = batch.column(0).to_pylist(), []
            for words in _hash_words(hasher, batch.column(1)):
                ends = np.cumsum(words.counts())
                for row, (low, high) in enumerate(zip(ends - words.counts(), ends)):
                    own = words.hash[low:high]
                    if not len(own):
                        continue
                    size = min(SEED, len(own))
                    _, grams = hasher.windows(own, np.zeros(len(own), np.int8), size, salt=size)
                    out.append(
                        (ids[words.first + row], own.view(np.int64), grams.view(np.int64), size)
                    )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x[0] for x in out], pa.int64()),
                    pa.array([x[1] for x in out], pa.list_(pa.int64())),
                    pa.array([x[2] for x in out], pa.list_(pa.int64())),
                    pa.array([x[3] for x in out], pa.int32()),
                ],
                ["item_id", "words", "grams", "size"],
            )

    rows = items.select(quoted(item_id).cast("long").alias("item_id"), quoted(text).alias("text"))
    return map_arrow(rows, run, "item_id long, words array<bigint>, grams array<bigint>, size int")


def find_leaks(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Contaminated pairs: doc_id, item_id, score (share of the item's own), counts, words.

    `first_word` and `last_word` bound the aligned words of the document, counted from 0.
    Both inputs need an id (`doc_id`, `item_id`) and `text`; other columns are ignored.
    """
    spark = documents.sparkSession
    items = item_seeds(benchmark).where("item_id is not null")
    distinct = materialize(
        items.groupBy(F.xxhash64("words").alias("item")).agg(
            *[F.first(c).alias(c) for c in ("words", "grams", "size")],
            F.collect_set("item_id").alias("item_ids"),
        ),
        "benchmark-items",
    )
    seeds = materialize(distinct.join(_spread_of(distinct), "item"), "benchmark-seeds")
    total = seeds.agg(F.sum(F.size("grams") + F.size("item_ids"))).first()[0] or 0
    blocks = -(-total // BLOCK_SEEDS) or 1
    rows = documents.select(quoted("doc_id").cast("long").alias("doc_id"), quoted("text").alias("text"))
    found = None
    for block in range(blocks):
        part = seeds.where(F.pmod("item", F.lit(blocks)) == block)
        one = _search(spark, rows, part)
        found = one if found is None else found.unionByName(one)
    return found


def _spread_of(items: DataFrame) -> DataFrame:
    """item, spread: for each of its sequences in order, how many items have it."""
    each = items.select("item", F.posexplode("grams").alias("at", "gram"))
    counts = each.select("item", "gram").distinct().groupBy("gram").agg(F.count("*").alias("n"))
    listed = F.sort_array(F.collect_list(F.struct("at", "n"))).alias("listed")
    return each.join(counts, "gram").groupBy("item").agg(listed).select("item", F.col("listed.n").alias("spread"))


def rare_places(spread: list[int]) -> list[int]:
    """Places of an item's seeds, from how many items have each of its sequences."""
    n = np.array(spread, np.int64)
    width = min(RUN - SEED + 1, len(n))
    runs = np.lib.stride_tricks.sliding_window_view(n, width)
    rarest = runs.argmin(axis=1) + np.arange(len(runs))
    return np.union1d(rarest, np.flatnonzero(n <= COMMON)).tolist()


def _search(spark, rows: DataFrame, seeds: DataFrame) -> DataFrame:
    known = seeds.collect()  # at most about BLOCK_SEEDS seeds
    words = [np.array(row.words, np.int64).view(np.uint64) for row in known]
    flat = [
        (row.grams[at], i, at, row["size"])
        for i, row in enumerate(known) for at in rare_places(row.spread)
    ]
    flat.sort()
    grams = np.array([x[0] for x in flat], np.int64).view(np.uint64)
    order = np.argsort(grams, kind="stable")
    columns = [np.array([x[k] for x in flat], np.int64)[order] for k in (1, 2, 3)]
    model = spark.sparkContext.broadcast(
        ([row.item_ids for row in known], words, grams[order], *columns)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(*model.value)
        hasher = WordHasher(separators=PUNCTUATION)
        for batch in batches:
            out = []
            for part in _hash_words(hasher, batch.column(1)):
                out += search.leaks(hasher, part)
            doc_ids = batch.column(0).take(pa.array([x[0] for x in out], pa.int64()))
            columns = list(zip(*out)) or [()] * 7
            types = [pa.int64(), pa.float64(), *[pa.int32()] * 4]
            arrays = [pa.array(c, t) for c, t in zip(columns[1:], types)]
            names = [field.split()[0] for field in FOUND.split(", ")]
            yield pa.RecordBatch.from_arrays([doc_ids, *arrays], names)

    return map_arrow(rows, run, FOUND)


class Search:
    """Seed lookup and alignment of the words of some documents with the items of a block."""

    def __init__(self, item_ids, words, grams, item, at, size):
        self.item_ids, self.words = item_ids, words
        self.item, self.at = item, at
        self.lengths = np.array([len(x) for x in words], np.int64)
        self.firsts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.concatenate([*words, np.zeros(1, np.uint64)])
        self.sizes = sorted(set(size.tolist()))
        self.grams, which, self.spread = np.unique(grams, return_inverse=True, return_counts=True)
        #: Seeds go by gram, then item, so those of a range of items are found by this key.
        self.key = which * len(words) + item
        #: A small table over some bits of the grams rules out most of a document at once.
        self.filter = np.zeros(1 << 22, bool)
        self.filter[grams >> np.uint64(42)] = True

    def leaks(self, hasher: WordHasher, part) -> list[tuple]:
        grams, places = [], []
        for size in self.sizes:
            at, found = hasher.windows(part.hash, part.doc, size, salt=size)
            maybe = np.flatnonzero(self.filter[found >> np.uint64(42)])
            gram = np.minimum(np.searchsorted(self.grams, found[maybe]), len(self.grams) - 1)
            hit = self.grams[gram] == found[maybe]
            grams.append(gram[hit])
            places.append(at[maybe[hit]])
        if not sum(map(len, places)):
            return []
        gram, place = np.concatenate(grams), np.concatenate(places)
        order = np.argsort(part.doc[place], kind="stable")
        gram, place = gram[order], place[order]
        bounds = np.concatenate([[0], np.cumsum(part.counts())])
        out = []
        for item, at, hit in self._hits(gram, place, part.doc[place]):
            out += self._aligned(item, hit - at, part.doc[hit], part, bounds)
        return out

    def _hits(self, gram, place, doc):
        """Item, place in it and in the documents, of the hits of some documents and items."""
        n = self.spread[gram]
        new = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
        before = (np.cumsum(n) - n)[new] // HITS
        edges = np.append(new[np.flatnonzero(np.append(True, before[1:] != before[:-1]))], len(doc))
        for a, b in zip(edges, edges[1:]):
            # A single document may have more hits: then its items are taken in turns.
            turns = min(-(-int(n[a:b].sum()) // HITS), len(self.words))
            cuts = np.linspace(0, len(self.words), turns + 1).astype(np.int64)
            own = gram[a:b] * len(self.words)
            for first, end in zip(cuts, cuts[1:]):
                low = np.searchsorted(self.key, own + first)
                m = np.searchsorted(self.key, own + end) - low
                seed = np.repeat(low - np.cumsum(m) + m, m) + np.arange(m.sum())
                if len(seed):
                    yield self.item[seed], self.at[seed], np.repeat(place[a:b], m)

    def _aligned(self, item, start, doc, part, bounds) -> list[tuple]:
        order = np.lexsort((start, item, doc))
        doc, item, start = doc[order], item[order], start[order]
        # One search region per document, item and bundle of near diagonals.
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (start[1:] - start[:-1] > SLACK)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(doc)) - 1
        doc, item = doc[first], item[first]
        low = np.maximum(start[first] - SLACK, bounds[doc])
        high = np.minimum(start[last] + self.lengths[item] + SLACK, bounds[doc + 1])
        scores = best_scores(self.flat, self.firsts[item], self.lengths[item], part.hash, low, high)
        best: dict[tuple[int, int], tuple] = {}
        for k in np.flatnonzero(scores >= least_score(self.lengths[item])):
            d, i, words = int(doc[k]), int(item[k]), self.words[item[k]]
            found = align(words, part.hash[low[k] : high[k]])
            if is_leak(len(words), *found[:3]):
                score = found[0] / (MATCH * len(words))
                offset = int(low[k] - bounds[d])
                row = (score, found[1], found[2], offset + found[3], offset + found[4])
                if best.get((d, i), (-1,))[0] < score:
                    best[d, i] = row
        return [
            (part.first + d, item_id, *row)
            for (d, i), row in best.items() for item_id in self.item_ids[i]
        ]


def least_score(n_words: np.ndarray) -> np.ndarray:
    """No alignment below this score is a leak."""
    run = RUN * (MATCH + (1 / PURITY - 1) * max(MISMATCH, GAP))
    return np.where(n_words < SEED, MATCH * n_words, np.minimum(SHARE * MATCH * n_words, run))


def best_scores(flat, firsts, lengths, hashes, low, high) -> np.ndarray:
    """Scores of the best local alignments of items in `flat` with `hashes[low:high]`."""
    wide, scores, done = high - low, np.zeros(len(low), np.int32), 0
    order = np.lexsort((lengths, -wide))
    while done < len(order):
        m = int(wide[order[done]])
        some = order[done : done + max(1, CELLS // (m + 1))]
        done += len(some)
        at = low[some] + np.arange(m)[:, None]
        inside = at < high[some]
        b = hashes[np.minimum(at, len(hashes) - 1)]
        steps = np.arange(m + 1, dtype=np.int32)[:, None] * np.int32(-GAP)
        table, best = np.zeros((m + 1, len(some)), np.int32), np.zeros(len(some), np.int32)
        for k in range(int(lengths[some].max())):
            word = flat[np.minimum(firsts[some] + k, len(flat) - 1)]
            same = (b == word) & inside & (k < lengths[some])
            row = table[:-1] + np.where(same, np.int32(MATCH), np.int32(MISMATCH))
            np.maximum(row, table[1:] + np.int32(GAP), out=row)
            table[1:] = np.maximum(row, 0, out=row)
            # As in `align`: a gap in b by a running maximum.
            table += steps
            np.maximum.accumulate(table, axis=0, out=table)
            table -= steps
            np.maximum(best, table.max(axis=0), out=best)
        scores[some] = best
    return scores


def is_leak(n_words: int, score: int, equal: int, aligned: int) -> bool:
    if n_words < SEED:
        return equal == n_words == aligned
    share = score >= SHARE * MATCH * n_words and equal >= min(n_words, LEAST)
    return share or (equal >= RUN and equal >= PURITY * aligned)


def align(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int, int, int]:
    """Best local alignment: score, equal words, aligned columns, first and last word of b."""
    columns = np.arange(len(b) + 1)
    steps = columns * -GAP
    # For the best path to each cell of the running row: its value, equal words, columns,
    # and the word of b at which it begins.
    value, equal, aligned, first = np.zeros((4, len(b) + 1), np.int64)
    first += columns
    best = (0, 0, 0, 0, -1)
    for word in a:
        hit = b == word
        diagonal, above = value[:-1] + np.where(hit, MATCH, MISMATCH), value[1:] + GAP
        own = np.append(0, np.maximum(np.maximum(diagonal, above), 0))
        straight = diagonal >= above
        equal[1:] = np.where(straight, equal[:-1] + hit, equal[1:])
        aligned[1:] = np.where(straight, aligned[:-1], aligned[1:]) + 1
        first[1:] = np.where(straight, first[:-1], first[1:])
        # A gap in b costs -GAP a word: a running maximum of row + cost so far.
        reach = np.maximum.accumulate(own + steps)
        origin = np.maximum.accumulate(np.where(own + steps == reach, columns, 0))
        value = reach - steps
        equal, aligned, first = equal[origin], aligned[origin] + columns - origin, first[origin]
        void = value == 0
        equal[void], aligned[void], first[void] = 0, 0, columns[void]
        at = int(np.argmax(value))
        if value[at] > best[0]:
            best = (int(value[at]), int(equal[at]), int(aligned[at]), int(first[at]), at - 1)
    return best
