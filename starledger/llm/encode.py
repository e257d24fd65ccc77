"""Token ids of whole texts, with a bounded table of pieces that a worker has seen.

A text falls into pieces that the tokenizers of public_tokenizers encode apart with the
same result: white space begins a piece or separates pieces, and a piece also ends between
a Latin letter or digit and an ASCII punctuation mark other than the apostrophe. All
pieces of a slice of texts are found and hashed (64 bits) by array operations; their ids
come from a table by hash. Only pieces that are not in it go to the tokenizer, in blocks
joined by a special token, which no tokenizer merges with its neighbours. The table is
emptied when it is full.

Texts with white space or invisible characters beyond plain ASCII are encoded as a whole.
"""

from __future__ import annotations

import os
import sys
import types

import numpy as np
import pyarrow as pa

from starledger.llm.base import utf8
from starledger.llm.words import SPACES, Powers, mix

#: Pieces in a worker's table (some 40 MB), and the longest one that is kept, in bytes.
TABLE_PIECES = 1_000_000
KEPT_BYTES = 64
#: Text bytes looked at in one go, and new pieces that go to the tokenizer as one text.
SLICE_BYTES = 2 << 20
BLOCK_PIECES = 500
#: A special token of the tokenizers; pieces that might hold it are encoded apart.
MARK = "<|endoftext|>"


def worker_state(name: str, make):
    """A value that lives as long as the Python worker, across its tasks."""
    store = sys.modules.setdefault("_token_pieces", types.ModuleType("_token_pieces"))
    return store.__dict__.setdefault(name, make())


class Table:
    """Ids of pieces by hash: sorted hashes, places in one array of ids, and lengths."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.place = self.length = np.zeros(0, np.int64)
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the given hashes, and which of them are there."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        rows = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return rows, self.hashes[rows] == hashes

    def add(self, hashes: np.ndarray, ids: list[np.ndarray]) -> None:
        length = np.fromiter(map(len, ids), np.int64, len(ids))
        place = self.used + np.cumsum(length) - length
        end = self.used + int(length.sum())
        if end > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.zeros(2 * end, np.uint32)])
        if ids:
            self.ids[self.used : end] = np.concatenate(ids)
        self.used = end
        hashes = np.concatenate([self.hashes, hashes])
        order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[order]
        self.place = np.concatenate([self.place, place])[order]
        self.length = np.concatenate([self.length, length])[order]


class Encoder:
    """`dtype` holds one id; `end` is appended to every document.

    `joined_spaces`: the tokenizer keeps white space, so it stays with the piece that it
    precedes; else it is dropped. `fold`: the tokenizer lower-cases A-Z itself.
    """

    def __init__(self, path: str, end: int, joined_spaces: bool, fold: bool, dtype: str = "<u4"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        plain, marked = worker_state(path, lambda: (Tokenizer.from_file(path), Tokenizer.from_file(path)))
        self.tokenizer, self.marked = plain, marked
        self.tokenizer.encode_special_tokens = True  # their strings in a text are plain text
        self.mark = self.marked.token_to_id(MARK)
        self.dtype, self.end = np.dtype(dtype), np.array([end], dtype).tobytes()
        self.joined = joined_spaces
        self.table = worker_state(f"{path} {joined_spaces} {fold}", Table)
        self.powers = Powers(0xD6E8FEB86659FD93)
        self.values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        if fold:
            self.values[65:91] = self.values[97:123]
        self.space, self.mark_byte, self.alnum = (np.zeros(256, bool) for _ in range(3))
        self.space[list(SPACES)] = True
        if not joined_spaces:
            self.values[self.space] = 0
        for byte in range(33, 127):
            (self.alnum if chr(byte).isalnum() else self.mark_byte)[byte] = True
        self.mark_byte[ord("'")] = False

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text, with the end id, as bytes; null is the empty text."""
        data, bounds = utf8(texts)
        out: list[bytes] = []
        at, rows = 0, len(bounds) - 1
        while at < rows:
            end = int(np.searchsorted(bounds, bounds[at] + SLICE_BYTES, side="right")) - 1
            end = min(max(end, at + 1), rows)
            low, high = int(bounds[at]), int(bounds[end])
            out += self._slice(data[low:high], bounds[at : end + 1] - low)
            at = end
        return out

    def _slice(self, data: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        starts = self._starts(data, bounds)
        doc = np.searchsorted(bounds, starts, side="right") - 1
        odd = self._odd(data, bounds)
        if odd.any():
            kept = ~odd[doc]
            starts_kept, doc_kept = starts[kept], doc[kept]
        else:
            starts_kept, doc_kept = starts, doc
        ids, length = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if len(starts):
            up, down = self.powers.upto(len(data))
            hashes = mix(np.add.reduceat(self.values[data] * up[: len(data)], starts) * down[starts])
            ends = np.append(starts[1:], len(data))
            last = bounds[doc + 1]
            ends = np.minimum(ends, last)
            if odd.any():
                hashes, ends = hashes[kept], ends[kept]
            ids, length = self._look_up(data, starts_kept, ends, hashes)
        raw, step = ids.astype(self.dtype).tobytes(), self.dtype.itemsize
        total = np.bincount(doc_kept, length, len(bounds) - 1).astype(np.int64)
        cuts = (np.concatenate([[0], np.cumsum(total)]) * step).tolist()
        out = [raw[a:b] + self.end for a, b in zip(cuts, cuts[1:])]
        for row in np.flatnonzero(odd).tolist():
            text = data[bounds[row] : bounds[row + 1]].tobytes().decode()
            out[row] = self._ids([text])[0].astype(self.dtype).tobytes() + self.end
        return out

    def _starts(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Byte positions at which pieces start."""
        n = len(data)
        space = self.space[data]
        begins = np.zeros(n, bool)
        if self.joined:
            begins[1:] = space[1:] & ~space[:-1]
        else:
            begins[1:] = space[:-1]
        latin = self.alnum[data]
        # The Latin letters of two bytes: C3 80 to C3 BF without the signs 97 and B7.
        latin[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        begins[1:] |= self.mark_byte[data[1:]] & latin[:-1]
        begins[bounds[:-1][bounds[:-1] < n]] = True
        if not self.joined:
            begins &= ~space
        return np.flatnonzero(begins)

    @staticmethod
    def _odd(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Texts with white space or invisible characters that tokenizers may treat apart."""
        odd = np.zeros(len(bounds) - 1, bool)
        at = np.flatnonzero((data >= 0x1C) & (data <= 0x1F))
        lead = np.flatnonzero(
            (data == 0xC2) | (data == 0xE1) | (data == 0xE2) | (data == 0xE3) | (data == 0xEF)
        )
        if len(lead):
            padded = np.concatenate([data, np.zeros(2, np.uint8)])
            one, two, three = data[lead], padded[lead + 1], padded[lead + 2]
            hit = (one == 0xC2) & ((two == 0x85) | (two == 0xA0))
            hit |= (one == 0xE1) & ((two == 0x9A) | (two == 0xA0))
            hit |= (one == 0xE2) & (two == 0x80) & (
                (three <= 0x8F) | (three == 0xA8) | (three == 0xA9) | (three == 0xAF)
            )
            hit |= (one == 0xE2) & (two == 0x81) & ((three == 0x9F) | (three == 0xA0))
            hit |= (one == 0xE3) & (two == 0x80) & (three == 0x80)
            hit |= (one == 0xEF) & (two == 0xBB)
            at = np.concatenate([at, lead[hit]])
        if len(at):
            odd[np.searchsorted(bounds, at, side="right") - 1] = True
        return odd

    def _look_up(self, data, starts, ends, hashes) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces in order, and how many each piece has."""
        order = np.argsort(hashes)
        ranked = hashes[order]
        first = np.append(True, ranked[1:] != ranked[:-1]) if len(ranked) else np.zeros(0, bool)
        distinct, sample = ranked[first], order[first]
        which = np.empty(len(hashes), np.int64)
        which[order] = np.cumsum(first) - 1
        table = self.table
        if len(table.hashes) > TABLE_PIECES:
            table.clear()
        _, known = table.find(distinct)
        new = np.flatnonzero(~known)
        if len(new):
            at = sample[new]
            table.add(distinct[new], self._new(data, starts[at], ends[at]))
        rows, _ = table.find(distinct)
        place, length = table.place[rows][which], table.length[rows][which]
        done = np.cumsum(length)
        total = int(done[-1]) if len(done) else 0
        ids = table.ids[np.repeat(place - done + length, length) + np.arange(total)]
        if len(new) and (ends[at] - starts[at] > KEPT_BYTES).any():
            self._forget(distinct[new][ends[at] - starts[at] > KEPT_BYTES])
        return ids, length

    def _forget(self, hashes: np.ndarray) -> None:
        keep = ~np.isin(self.table.hashes, hashes)
        for name in ("hashes", "place", "length"):
            setattr(self.table, name, getattr(self.table, name)[keep])
        if self.table.used > 16 * TABLE_PIECES:
            self.table.clear()

    def _new(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        raw = data.tobytes()
        pieces = [raw[a:b].decode() for a, b in zip(starts.tolist(), ends.tolist())]
        out: list[np.ndarray | None] = [None] * len(pieces)
        plain = [i for i, piece in enumerate(pieces) if "<" not in piece]
        for at in range(0, len(plain), BLOCK_PIECES):
            block = plain[at : at + BLOCK_PIECES]
            text = MARK.join([pieces[i] for i in block])
            encoded = self.marked.encode_batch_fast([text], add_special_tokens=False)[0]
            ids = np.array(encoded.ids, np.uint32)
            cuts = np.flatnonzero(ids == self.mark)
            low, high = [0, *(cuts + 1).tolist()], [*cuts.tolist(), len(ids)]
            for i, a, b in zip(block, low, high):
                out[i] = ids[a:b]
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(rest, self._ids([pieces[i] for i in rest])):
            out[i] = ids
        return out

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(one.ids, np.uint32) for one in encoded]
