"""Repeats of word sequences across documents, by recompression."""

from __future__ import annotations

import numpy as np
import pandas as pd

#: Words of a window whose repeat counts.
WINDOW = 50
#: Rounds of naming; a name stands for at most SPAN words.
ROUNDS, SPAN = 8, 40

_GOLD, _MIX1, _MIX2 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
#: Odd bases of the two rolling hashes.
_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer, so that every bit of a name depends on every bit of what it names."""
    x = x + np.uint64(_GOLD)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_MIX1)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_MIX2)
    return x ^ (x >> np.uint64(31))


def word_names(words: list[bytes]) -> np.ndarray:
    """A 64-bit name for each word, equal for equal words in every task."""
    if not words:
        return np.zeros(0, np.uint64)
    boxed = np.empty(len(words), object)
    boxed[:] = words
    return pd.util.hash_array(boxed, categorize=False)


class _Level:
    """Symbols in order: name, words covered, and the words that it depends on (first, last).

    Whatever holds the words a symbol depends on holds the same symbol at the same place.
    """

    def __init__(self, name, start, span, first, last, fixed):
        self.name, self.start, self.span, self.first, self.last, self.fixed = name, start, span, first, last, fixed

    def runs(self) -> _Level:
        """Every maximal run of one symbol becomes a symbol named by it and the length of the run."""
        n = len(self.name)
        new = np.ones(n, bool)
        new[1:] = (self.name[1:] != self.name[:-1]) | self.fixed[1:] | self.fixed[:-1]
        at = np.flatnonzero(new)
        end = np.append(at[1:], n) - 1
        length = end - at + 1
        name = self.name[at]
        long = length > 1
        name[long] = mix(name[long] ^ (length[long].astype(np.uint64) * np.uint64(_MIX2)))
        # a run ends where its neighbours differ, and that depends on what they depend on
        first = np.minimum(self.first[at], self.first[np.maximum(at - 1, 0)])
        last = np.maximum(self.last[end], self.last[np.minimum(end + 1, n - 1)])
        fixed = self.fixed[at]
        first[fixed], last[fixed] = self.first[at][fixed], self.last[at][fixed]
        return _Level(name, self.start[at], np.add.reduceat(self.span, at), first, last, fixed)

    def pairs(self, salt: int) -> _Level:
        """A left symbol and a right symbol next to it become one; a hash of its name tells a symbol's side."""
        n = len(self.name)
        left = (mix(self.name ^ np.uint64(salt * 0x51ED270B + 7)) & np.uint64(1)).astype(bool)
        join = np.zeros(n, bool)
        join[:-1] = left[:-1] & ~left[1:] & ~self.fixed[:-1] & ~self.fixed[1:] & (self.span[:-1] + self.span[1:] <= SPAN)
        taken = np.zeros(n, bool)
        taken[1:] = join[:-1]
        first, last = self.first.copy(), self.last.copy()
        # a symbol that stays alone depends on the neighbour on its open side
        alone_left = np.flatnonzero(left & ~join)
        last[alone_left] = np.maximum(last[alone_left], self.last[np.minimum(alone_left + 1, n - 1)])
        alone_right = np.flatnonzero(~left & ~taken)
        first[alone_right] = np.minimum(first[alone_right], self.first[np.maximum(alone_right - 1, 0)])
        head = np.flatnonzero(join)
        name, span = self.name.copy(), self.span.copy()
        name[head] = mix(name[head] * np.uint64(3) + mix(self.name[head + 1]))
        span[head] += self.span[head + 1]
        last[head] = self.last[head + 1]
        keep = ~taken
        return _Level(name[keep], self.start[keep], span[keep], first[keep], last[keep], self.fixed[keep])


class Block:
    """The words of several documents, one after the other, and the anchors of their windows.

    ``names`` holds the word names of each document. Windows are numbered by their first word; an
    anchor of a window is the highest symbol that depends on words of the window only, so equal
    windows have equal anchors wherever they stand.
    """

    def __init__(self, names: list[np.ndarray], window: int = WINDOW):
        self.window = window
        self.sizes = np.array([len(n) for n in names], np.int64)
        # a border stands before each document and after the last one
        self.offsets = np.cumsum(self.sizes + 1) - self.sizes
        total = int(self.sizes.sum()) + len(names) + 1
        self.words = np.zeros(total, np.uint64)
        self.border = np.zeros(total, bool)
        self.border[self.offsets - 1] = True
        self.border[-1] = True
        for at, own in zip(self.offsets, names):
            self.words[at : at + len(own)] = own
        # windows that lie within a document
        room = np.maximum(self.sizes - window + 1, 0)
        self.doc_of = np.repeat(np.arange(len(names)), room)
        from trialspark.llm.common import ranges

        self.starts = ranges(self.offsets, room)
        self._anchor: np.ndarray | None = None

    def _paint(self, tables: np.ndarray, level: _Level) -> None:
        """Give each symbol to all windows that hold the words it depends on, the highest one wins."""
        w = self.window
        fit = (level.last - level.first < w) & ~level.fixed
        low = np.maximum(level.last[fit] - w + 1, 0)
        high = level.first[fit]
        rank = (level.span[fit].astype(np.uint64) << np.uint64(58)) | (mix(level.name[fit]) >> np.uint64(6))
        step = (np.frexp((high - low + 1).astype(np.float64))[1] - 1).astype(np.int64)
        width = tables.shape[1]
        flat = tables.reshape(-1)
        np.maximum.at(flat, step * width + low, rank)
        np.maximum.at(flat, step * width + high + 1 - (1 << step), rank)

    def anchors(self) -> np.ndarray:
        """The anchor of each window in ``starts``."""
        if self._anchor is not None:
            return self._anchor
        n = len(self.words)
        where = np.arange(n)
        level = base = _Level(self.words, where, np.ones(n, np.int64), where, where, self.border)
        top = int(np.log2(self.window))
        tables = np.zeros((top + 1, n), np.uint64)
        for salt in range(ROUNDS):
            level = level.runs().pairs(salt)
            self._paint(tables, level)
        painted = self._settled(tables)
        if len(self.starts) and (painted[self.starts] == 0).any():  # the words themselves are always at hand
            # in a table of their own: whether other windows of the block need them changes no anchor
            words = np.zeros_like(tables)
            self._paint(words, base)
            painted = np.where(painted == 0, self._settled(words), painted)
        self._anchor = painted[self.starts]
        return self._anchor

    @staticmethod
    def _settled(tables: np.ndarray) -> np.ndarray:
        out = tables.copy()
        for k in range(len(out) - 1, 0, -1):
            half = 1 << (k - 1)
            np.maximum(out[k - 1], out[k], out=out[k - 1])
            np.maximum(out[k - 1][half:], out[k][:-half], out=out[k - 1][half:])
        return out[0]

    def window_hashes(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """128 bits of the word sequence of each chosen window."""
        out = []
        for salt, base in enumerate(_BASES):
            value = mix(self.words ^ np.uint64(salt + 1))
            powers = np.full(len(value), base, np.uint64)
            powers[0] = 1
            powers = np.cumprod(powers)
            inverse = np.full(len(value), pow(base, -1, 1 << 64), np.uint64)
            inverse[0] = 1
            inverse = np.cumprod(inverse)
            sums = np.concatenate([[np.uint64(0)], np.cumsum(value * powers)])
            s = self.starts[chosen]
            out.append(mix((sums[s + self.window] - sums[s]) * inverse[s]).view(np.int64))
        return out[0], out[1]
