"""A run-length grammar by recompression, and longest common extensions on it.

The text, a sequence of symbols, is compressed level by level until every part
between separators is one symbol.  A *block* level replaces each maximal run of
one symbol by a symbol for (symbol, count); a *pair* level splits the alphabet into
left and right symbols and replaces every left symbol followed by a right one.  Both
depend on neighbours alone, so equal substrings get equal symbols but for
a symbol or two at their ends, and a longest common extension needs a step or two
on every level: up while both ends agree, then down to the first difference.

All queries of a call go through a level together, as arrays.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

SEEDS = 4          # splits of the alphabet that are tried for a pair level


@dataclass
class Level:
    """Symbols of one level; ``heads`` are the places of the first children of
    the next level's symbols (None at the top)."""

    symbols: np.ndarray
    blocks: bool = False
    heads: np.ndarray | None = None
    up: np.ndarray = field(init=False, default=None)
    first: np.ndarray = field(init=False, default=None)

    def close(self, first: np.ndarray, blocks: bool) -> None:
        self.first, self.blocks = first, blocks
        self.heads = np.flatnonzero(first)
        self.up = np.cumsum(first) - 1


def _named(keys: np.ndarray, free: int) -> np.ndarray:
    """Equal keys get equal new symbols, from ``free`` on."""
    return free + np.unique(keys, return_inverse=True)[1].reshape(-1)


def _left(symbols: np.ndarray, seed: int) -> np.ndarray:
    """A fixed pseudo-random half of the alphabet."""
    with np.errstate(over="ignore"):
        h = (symbols.astype(np.uint64) + np.uint64(seed + 1)) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(40)) & np.uint64(1) == 1


class Grammar:
    """Built over ``text``: symbols of 0 or more, and negative separators, each
    of which occurs once.  The text begins and ends with a separator."""

    def __init__(self, text: np.ndarray):
        level = Level(np.asarray(text, np.int64))
        self.levels = [level]
        free = int(level.symbols.max(initial=0)) + 1
        while True:
            s = level.symbols
            inner = s >= 0
            beside = inner[:-1] & inner[1:]
            if not beside.any():
                break
            equal = np.r_[False, s[1:] == s[:-1]]
            if equal.any():
                level.close(~equal, True)
                counts = np.diff(np.r_[level.heads, len(s)])
                up = s[level.heads].copy()
                long = counts > 1
                up[long] = _named(up[long] * (int(counts.max()) + 1) + counts[long], free)
            else:
                right = self._pairs(s, beside)
                level.close(~right, False)
                up = s[level.heads].copy()
                places = np.flatnonzero(right)
                at = level.up[places]
                up[at] = _named(up[at] * free + s[places], free)
            free = max(free, int(up.max()) + 1)
            level = Level(up)
            self.levels.append(level)

    @staticmethod
    def _pairs(s: np.ndarray, beside: np.ndarray) -> np.ndarray:
        """Marks the right symbol of every pair, by the best of a few splits."""
        best, most, seed = None, 0, 0
        while seed < SEEDS or not most:
            left = _left(s, seed)
            for side in (left, ~left):
                pair = side[:-1] & ~side[1:] & beside
                n = int(np.count_nonzero(pair))
                if n > most:
                    best, most = pair, n
            seed += 1
        return np.r_[False, best]

    def extend(self, x: np.ndarray, y: np.ndarray, back: bool = False) -> np.ndarray:
        """For places x and y (arrays, x != y): how many symbols from there on are
        equal; with ``back`` how many up to there, both places included."""
        a, b = np.array(x, np.int64), np.array(y, np.int64)
        top = len(self.levels) - 1
        until = np.full(len(a), top)          # the level on which each query turns round
        way = -1 if back else 1
        live = np.arange(len(a))
        for k, level in enumerate(self.levels[:-1]):
            equal = level.symbols[a[live]] == level.symbols[b[live]]
            until[live[~equal]] = k
            live = live[equal]
            if not len(live):
                break
            edge = self._edges(level, back)
            mid = live[~(edge[a[live]] & edge[b[live]])]
            self._step(level, a, b, mid, way)
            still = ~(edge[a[mid]] & edge[b[mid]])     # a shorter block has ended
            until[mid[still]] = k
            live = live[until[live] > k]
            a[live], b[live] = level.up[a[live]], level.up[b[live]]
        for k in range(int(until.max(initial=0)), -1, -1):
            level = self.levels[k]
            below = np.flatnonzero(until > k)
            if len(below):
                for at in (a, b):
                    at[below] = self._ends(level, at[below], back)
            live = np.flatnonzero(until >= k)
            self._step(level, a, b, live[level.symbols[a[live]] == level.symbols[b[live]]], way)
        return (a - x) * way

    @staticmethod
    def _edges(level: Level, back: bool) -> np.ndarray:
        return np.r_[level.first[1:], True] if back else level.first

    @staticmethod
    def _ends(level: Level, parents: np.ndarray, back: bool) -> np.ndarray:
        """The child of each parent that is met first."""
        if not back:
            return level.heads[parents]
        after = np.r_[level.heads[1:], len(level.symbols)]
        return after[parents] - 1

    def _step(self, level: Level, a: np.ndarray, b: np.ndarray, at: np.ndarray, way: int) -> None:
        """Past one equal symbol, on a block level past the shorter rest of both blocks."""
        if not len(at):
            return
        n = 1
        if level.blocks:
            rests = []
            for c in (a[at], b[at]):
                parent = level.up[c]
                rests.append(self._ends(level, parent, True) - c if way > 0 else c - level.heads[parent])
            n = np.minimum(*rests) + 1
        a[at] += way * n
        b[at] += way * n
