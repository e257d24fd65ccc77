"""Token-set similarity of two names, in [0, 1].

With S the shared tokens and A', B' the rest of each side, the score is the best
`1 - indel / (len + len)` among (S, S+A'), (S, S+B') and (S+A', S+B'), and 1 when
something is shared and one rest is empty. The first two follow from lengths alone, so
only the rests are aligned, all pairs of a batch at once.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starledger.functions.text import column


def _common_length(a: str, b: str) -> int:
    """Longest common subsequence, one big-integer step per character of `b`."""
    seen: dict[str, int] = {}
    for i, ch in enumerate(a):
        seen[ch] = seen.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    free = full
    for ch in b:
        hit = free & seen.get(ch, 0)
        free = ((free + hit) | (free - hit)) & full
    return (full ^ free).bit_count()


def _score(a: str | None, b: str | None) -> float | None:
    """The score of one pair, by itself: what `token_set_scores` is tested against."""
    if a is None or b is None:
        return None
    left, right = set(a.split()), set(b.split())
    if not left or not right:
        return 0.0
    shared = left & right
    only_a, only_b = " ".join(sorted(left - right)), " ".join(sorted(right - left))
    if shared and not (only_a and only_b):
        return 1.0
    base = sum(map(len, shared)) + max(len(shared) - 1, 0)
    gap = 1 if shared else 0
    total = 2 * (base + gap) + len(only_a) + len(only_b)
    best = 1 - (len(only_a) + len(only_b) - 2 * _common_length(only_a, only_b)) / total
    if shared:
        for rest in (only_a, only_b):
            extra = 1 + len(rest)
            best = max(best, 1 - extra / (2 * base + extra))
    return best


#: Letters of a lane.
LANE = 64


def _spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places from each start on, as many as its size says, one span after another."""
    ends = np.cumsum(size)
    return np.repeat(start - ends + size, size) + np.arange(int(ends[-1]) if len(ends) else 0)


@dataclass
class Texts:
    """Texts as code points, one after another."""

    codes: np.ndarray
    start: np.ndarray
    size: np.ndarray

    @classmethod
    def of(cls, texts: list[str]) -> Texts:
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        if int(codes.max(initial=0)) < 256:
            codes = codes.astype(np.uint8)
        return cls(codes, np.cumsum(size) - size, size)

    def rows(self, at: np.ndarray, width: int) -> np.ndarray:
        """Some texts as rows of a matrix, filled up with zeros."""
        out = np.zeros((len(at), width), self.codes.dtype)
        size = self.size[at]
        out[np.arange(width) < size[:, None]] = self.codes[_spans(self.start[at], size)]
        return out


def common_lengths(left: Texts, right: Texts) -> np.ndarray:
    """Longest common subsequence of each pair of texts.

    The shorter text of a pair is a row of 64-bit lanes, a bit for each letter. All pairs of
    one number of lanes take each letter of their longer texts together: equal letters are
    packed to bits, and an addition with a carry from lane to lane moves the matches on.
    """
    out = np.zeros(len(left.size), np.int64)
    swapped = left.size > right.size
    for chosen, short, long in ((~swapped, left, right), (swapped, right, left)):
        lanes = np.where(chosen, -(-short.size // LANE), 0)
        for n in np.unique(lanes[lanes > 0]).tolist():
            # Longest first, so that the pairs still at work are the first ones.
            at = np.flatnonzero(lanes == n)
            at = at[np.argsort(-long.size[at], kind="stable")]
            out[at] = _common(short.rows(at, n * LANE), short.size[at], long.rows(at, int(long.size[at[0]])), long.size[at])
    return out


def _common(rows: np.ndarray, size: np.ndarray, other: np.ndarray, steps: np.ndarray) -> np.ndarray:
    n = rows.shape[1] // LANE
    working = np.searchsorted(-steps, -np.arange(other.shape[1]), side="left")
    free = np.full((len(rows), n), -1, np.int64).view(np.uint64)
    for step, m in enumerate(working.tolist()):
        equal = np.packbits(rows[:m] == other[:m, step : step + 1], axis=1, bitorder="little").view("<u8")
        carry = np.zeros(m, np.uint64)
        for lane in range(n):
            old = free[:m, lane]
            hit = old & equal[:, lane]
            new = old + hit
            over = new < hit
            new += carry
            carry = (over | (new < carry)).astype(np.uint64)
            free[:m, lane] = new | (old & ~hit)
    taken = np.unpackbits(~free.view(np.uint8), axis=1, bitorder="little").astype(bool)
    return (taken & (np.arange(n * LANE) < size[:, None])).sum(axis=1)


def token_set_scores(left: list[str], right: list[str]) -> np.ndarray:
    """`_score` of each pair of names."""
    n = len(left)
    names = list({*left, *right})
    number = {name: i for i, name in enumerate(names)}
    lists = list(map(str.split, names))
    tokens = list(chain.from_iterable(lists))
    every = sorted(set(tokens))
    # Numbered in order, so that sorted numbers are sorted tokens.
    order = {token: i for i, token in enumerate(every)}
    ids = np.fromiter(map(order.__getitem__, tokens), np.int64, len(tokens))
    owner = np.repeat(np.arange(len(names)), np.fromiter(map(len, lists), np.int64, len(names)))
    spots = np.unique(owner * max(1, len(every)) + ids)
    owner, listed = spots // max(1, len(every)), spots % max(1, len(every))
    count = np.bincount(owner, minlength=len(names))
    first = np.cumsum(count) - count
    # Each token is followed by the space that joins it to the next.
    spelled = Texts.of([token + " " for token in every])

    # The tokens of each side of each pair, as pair * number of tokens + token, ascending.
    spots = []
    for side in (left, right):
        at = np.fromiter(map(number.__getitem__, side), np.int64, n)
        pair = np.repeat(np.arange(n), count[at])
        spots.append(pair * max(1, len(every)) + listed[_spans(first[at], count[at])])
    rests, size = [], []
    for own, other in (spots, spots[::-1]):
        place = np.minimum(np.searchsorted(other, own), max(0, len(other) - 1))
        shared = other[place] == own if len(other) else np.zeros(len(own), bool)
        pair, token = own // max(1, len(every)), own % max(1, len(every))
        length = np.bincount(pair[~shared], spelled.size[token[~shared]], n).astype(np.int64)
        codes = spelled.codes[_spans(spelled.start[token[~shared]], spelled.size[token[~shared]])]
        size.append(np.maximum(length - 1, 0))
        rests.append(Texts(codes, np.cumsum(length) - length, size[-1]))
    pair, token = pair[shared], token[shared]
    gap = np.minimum(np.bincount(pair, minlength=n), 1)
    base = np.maximum(np.bincount(pair, spelled.size[token], n).astype(np.int64) - 1, 0)

    total = 2 * (base + gap) + size[0] + size[1]
    drops = size[0] + size[1] - 2 * common_lengths(*rests)
    with np.errstate(invalid="ignore", divide="ignore"):
        out = 1 - drops / total
        for one in size:
            extra = 1 + one
            out = np.where(gap == 1, np.maximum(out, 1 - extra / (2 * base + extra)), out)
    out[(gap == 1) & ((size[0] == 0) | (size[1] == 0))] = 1.0
    out[(gap == 0) & ((size[0] == 0) | (size[1] == 0))] = 0.0
    return out


def _scores(left: pd.Series, right: pd.Series) -> pd.Series:
    known = left.notna() & right.notna()
    scores = token_set_scores(left[known].tolist(), right[known].tolist())
    return pd.Series(scores, left.index[known], dtype="float64").reindex(left.index)


_token_set_score = F.pandas_udf(_scores, T.DoubleType())
_scored_in_place = F.pandas_udf(_scores, T.DoubleType()).asNondeterministic()


def token_set_score(left: Column | str, right: Column | str, once: bool = False) -> Column:
    """Score two name columns; meant for candidate pairs, not for whole tables.

    With `once` the optimizer leaves the scoring, and filters on it, where they stand.
    """
    score = _scored_in_place if once else _token_set_score
    return score(column(left), column(right))


def token_key(name: Column | str) -> Column:
    """Sorted distinct tokens of a normal name as one text: the unit of comparison."""
    tokens = F.filter(F.split(column(name), " "), lambda t: t != "")
    return F.array_join(F.array_sort(F.array_distinct(tokens)), " ")
