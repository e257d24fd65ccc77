"""Hashes of words and word windows, computed on whole byte arrays.

A word is a longest run of bytes that are no separators. Its hash is a polynomial over
random 64-bit values of its bytes, modulo 2**64, mixed at the end; a window hash is the
same over its word hashes. All words of a slice of documents are hashed by a handful of
array operations, so no Python loop runs per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from starledger.llm.base import utf8

#: Space and the control characters 9 to 13.
SPACES = (9, 10, 11, 12, 13, 32)
#: Every ASCII byte that is neither letter nor digit.
PUNCTUATION = tuple(b for b in range(128) if not chr(b).isalnum())
#: Text bytes hashed at once; larger documents form a slice of their own.
SLICE_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd number and of its inverse modulo 2**64."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(0, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up, self.down = (self._series(x, size) for x in (self.base, self.inverse))
        return self.up, self.down

    @staticmethod
    def _series(base: int, size: int) -> np.ndarray:
        factors = np.full(size, base, np.uint64)
        factors[0] = 1
        return np.cumprod(factors, dtype=np.uint64)


@dataclass
class Words:
    """The words of some consecutive documents of a batch."""

    first: int  # row of the first document
    rows: int
    doc: np.ndarray  # row of each word, counted from `first`
    hash: np.ndarray
    start: np.ndarray  # byte position of each word in `data`
    data: np.ndarray
    bounds: np.ndarray  # byte bounds of the documents in `data`

    is_space: np.ndarray  # by byte

    def counts(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=self.rows)

    def ends(self) -> np.ndarray:
        """Byte position behind each word."""
        inside = ~self.is_space[self.data]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        tails = self.bounds[1:][self.bounds[1:] > 0] - 1
        last[tails] = inside[tails]
        return np.flatnonzero(last) + 1


class WordHasher:
    """Finds and hashes words; `fold` makes A-Z equal to a-z."""

    def __init__(self, fold: bool = False, separators: tuple[int, ...] = SPACES):
        self.values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        if fold:
            self.values[65:91] = self.values[97:123]
        self.is_space = np.zeros(256, bool)
        self.is_space[list(separators)] = True
        self.values[self.is_space] = 0
        self.powers = Powers(0xD6E8FEB86659FD93)
        self.steps = Powers(0xA0761D6478BD642F)

    def slices(self, texts: pa.Array) -> Iterator[Words]:
        data, bounds = utf8(texts)
        at, rows = 0, len(bounds) - 1
        while at < rows:
            end = int(np.searchsorted(bounds, bounds[at] + SLICE_BYTES, side="right")) - 1
            end = min(max(end, at + 1), rows)
            low, high = int(bounds[at]), int(bounds[end])
            yield self._words(at, data[low:high], bounds[at : end + 1] - low)
            at = end

    def _words(self, first: int, data: np.ndarray, bounds: np.ndarray) -> Words:
        n, rows = len(data), len(bounds) - 1
        inside = ~self.is_space[data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        heads = bounds[:-1][bounds[:-1] < n]
        begins[heads] = inside[heads]
        starts = np.flatnonzero(begins)
        if not len(starts):
            none = np.zeros(0, np.int64)
            return Words(
                first, rows, none, none.astype(np.uint64), none, data, bounds, self.is_space
            )
        up, down = self.powers.upto(n)
        sums = np.add.reduceat(self.values[data] * up[:n], starts)
        doc = np.searchsorted(bounds, starts, side="right") - 1
        return Words(
            first, rows, doc, mix(sums * down[starts]), starts, data, bounds, self.is_space
        )

    def windows(
        self, hashes: np.ndarray, doc: np.ndarray, size: int, salt: int = 0
    ) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the first words of all windows within a document, and their hashes."""
        n = len(hashes)
        if n < size:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        up, down = self.steps.upto(n + 1)
        terms = mix(hashes + np.uint64(salt)) if salt else hashes
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(terms * up[:n], out=sums[1:])
        at = np.flatnonzero(doc[size - 1 :] == doc[: n - size + 1])
        return at, mix((sums[at + size] - sums[at]) * down[at])
