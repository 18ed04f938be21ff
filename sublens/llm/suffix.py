"""Suffix arrays by induced sorting, and permuted common prefixes.

The induction of a bucket's suffixes is done a batch at a time: all suffixes of
a bucket that are known in order give their predecessors in order, and those
that fall into the same bucket make its next batch.  Every suffix is handled a
constant number of times.
"""

from __future__ import annotations

import numpy as np

MANY_SYMBOLS = 2_000          # beyond, a batch per symbol costs more than ranks doubled
LOW = np.uint64(1) << np.array([16, 32, 48], dtype=np.uint64)       # first bits of a second, third, fourth symbol


def _groups(items: np.ndarray, symbols: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """items by symbol, each group in the given order."""
    if not len(items):
        return []
    order = np.argsort(symbols, kind="stable")
    items, symbols = items[order], symbols[order]
    cut = np.flatnonzero(symbols[1:] != symbols[:-1]) + 1
    return list(zip(symbols[np.concatenate([[0], cut])].tolist(), np.split(items, cut), strict=True))


def suffix_types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one (the last one is)."""
    n = len(t)
    unlike = t[1:] != t[:-1]
    differ = np.flatnonzero(unlike)
    smaller = np.empty(n, dtype=bool)
    smaller[-1] = True
    if n > 1:
        # equal neighbours have the type of the next differing pair
        at = np.cumsum(unlike) - unlike
        there = differ[np.minimum(at, len(differ) - 1)]
        smaller[:-1] = t[there] < t[there + 1]
    return smaller


def _induce(t: np.ndarray, smaller: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """All suffixes, from leftmost-smaller ones in their order in each bucket."""
    symbols = np.unique(t).tolist()
    placed = dict(_groups(starts, t[starts]))
    larger_of: dict[int, list[np.ndarray]] = {c: [] for c in symbols}
    smaller_of: dict[int, list[np.ndarray]] = {c: [] for c in symbols}

    def pass_on(batch: np.ndarray, into: dict[int, list[np.ndarray]], kind: bool) -> None:
        j = batch[batch > 0] - 1
        j = j[smaller[j] == kind]
        for c, part in _groups(j, t[j]):
            into[c].append(part)

    def run(c: int, into: dict[int, list[np.ndarray]], kind: bool) -> np.ndarray:
        done, bucket = 0, into[c]
        while done < len(bucket):
            batch = np.concatenate(bucket[done:])
            bucket[done:] = [batch]
            done += 1
            pass_on(batch, into, kind)
        return np.concatenate(bucket) if bucket else np.empty(0, dtype=starts.dtype)

    larger = {}
    for c in symbols:
        larger[c] = run(c, larger_of, False)
        if c in placed:
            pass_on(placed[c], larger_of, False)
    out = []
    for c in reversed(symbols):           # from the end: smaller suffixes, then larger
        own = run(c, smaller_of, True)
        pass_on(larger[c][::-1], smaller_of, True)
        out += [own, larger[c][::-1]]
    out.append(np.array([len(t) - 1], dtype=starts.dtype))
    return np.concatenate(out)[::-1]


def _doubled(t: np.ndarray) -> np.ndarray:
    """Suffix array by doubling ranks.  A rank is the place of the first suffix of
    its group; groups of one suffix are final and take part no more."""
    n = len(t)
    order = np.argsort(t, kind="stable")
    slot, key = np.arange(n), t[order]
    at = order
    rank, step = np.empty(n, dtype=np.int64), 1
    while True:
        first = np.concatenate([[True], key[1:] != key[:-1]])
        rank[at] = np.maximum.accumulate(np.where(first, slot, 0))
        slot = slot[~(first & np.append(first[1:], True))]
        if not len(slot):
            return order
        at = order[slot]
        second = np.zeros(len(at), dtype=np.int64)
        inside = at < n - step
        second[inside] = rank[at[inside] + step] + 1
        key = rank[at] * (n + 1) + second
        move = np.argsort(key)            # equal ones stay one group, in any order
        key, at = key[move], at[move]
        order[slot] = at
        step *= 2


def _names(t: np.ndarray, starts: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Numbers of the leftmost-smaller substrings, equal ones alike, for
    ``order`` (the starts sorted by substring)."""
    size = np.ones(len(t) + 1, dtype=np.int64)
    size[starts[:-1]] = np.diff(starts) + 1
    a, b = order[:-1], order[1:]
    same = size[a] == size[b]
    live = np.flatnonzero(same)
    for k in range(64):
        live = live[size[a[live]] > k]
        if not len(live):
            break
        wrong = t[a[live] + k] != t[b[live] + k]
        same[live[wrong]] = False
        live = live[~wrong]
    for i in live[size[a[live]] > 64].tolist():
        n = int(size[a[i]])
        same[i] = np.array_equal(t[a[i]:a[i] + n], t[b[i]:b[i] + n])
    return np.concatenate([[0], np.cumsum(~same)])


def suffix_array(t: np.ndarray, many_symbols: int = MANY_SYMBOLS) -> np.ndarray:
    """Suffix array of t, whose last symbol is the smallest and occurs once."""
    n = len(t)
    if n < 2:
        return np.arange(n)
    if n < 64 or len(np.unique(t)) > many_symbols:
        return _doubled(t)
    smaller = suffix_types(t)
    starts = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    mark = np.zeros(n, dtype=bool)
    mark[starts] = True
    order = _induce(t, smaller, starts)
    order = order[mark[order]]
    names = _names(t, starts, order)
    if names[-1] + 1 < len(starts):       # equal substrings: sort the string of their names
        spot = np.empty(n, dtype=np.int64)
        spot[order] = names
        order = starts[suffix_array(spot[starts], many_symbols)]
    return _induce(t, smaller, order)


def _common(t: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The common prefixes of the suffixes at a and at b, as many symbols at a time as
    64 bits hold.  None runs past the end: the last symbol occurs once."""
    bits = 16 if t.dtype.itemsize <= 2 else 64
    many = 64 // bits
    word = t.astype(np.uint64)
    for i in range(1, min(many, len(t))):
        word[:-i] |= t[i:].astype(np.uint64) << np.uint64(bits * i)
    length = np.zeros(len(a), dtype=np.int64)
    live = np.arange(len(a))
    while len(live):
        differ = word[a] ^ word[b]
        same = differ == 0
        low = differ & (~differ + np.uint64(1))              # the lowest bit that differs
        length[live] += np.where(same, many, np.searchsorted(LOW[:many - 1], low, side="right"))
        live, a, b = live[same], a[same] + many, b[same] + many
    return length


def permuted_common_prefixes(t: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """For each position, the common prefix with the suffix sorted before its
    own.  Where the symbols before both are equal, it is one less than for the
    position before; the others are compared."""
    n = len(t)
    before = np.full(n, -1, dtype=np.int64)
    before[sa[1:]] = sa[:-1]
    i = np.arange(n)
    follows = (i > 0) & (before > 0)
    follows[follows] = t[i[follows] - 1] == t[before[follows] - 1]
    base = np.flatnonzero(~follows & (before >= 0))
    length = np.zeros(n, dtype=np.int64)
    length[base] = _common(t, base, before[base])
    # positions that follow: count down from the last compared one
    last = np.maximum.accumulate(np.where(follows, 0, i))
    return np.where(follows, length[last] - (i - last), length)
