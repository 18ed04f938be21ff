"""Periodic runs of words, by recompression.

A run is a longest stretch of words with smallest period q (words q apart are
equal) that is at least ``least`` words and ``times`` periods long.  Such a stretch holds
``times`` neighbouring multiples of q with equal words; for every period these
places of the harmonic grid are compared first (n/1 + n/2 + ... comparisons), and the
few that agree are candidates.  Longest common extensions on a run-length grammar
(:mod:`sublens.llm.grammar`) of the texts that have candidates give each one's
exact ends.  Periods are taken in octaves; a candidate inside a known run whose
period divides its own is that run again and is not extended a second time.

Texts are handled a few at a time (``BATCH_BYTES``; a longer text alone), whole and
without exchange of rows.

Defined cases: NULL and empty texts have no words, no runs and an empty ``kept``; rows that
repeat are repeated in the result; an empty table gives an empty result.  Only the
id and the text are read, so other columns can have any name; the id column
keeps its name, which must not be one of the results' names.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sublens.llm.common import text_bytes
from sublens.llm.grammar import Grammar

LEAST, TIMES = 6, 4
BATCH_BYTES = 2 << 20         # texts that are compared together
CHUNK = 1 << 17               # candidates that are extended together

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

Words = list[bytes]


def _candidates(words: np.ndarray, p: int, times: int) -> np.ndarray:
    """Multiples x of p with equal words at x, x + p, ..., x + (times - 1) p."""
    grid = words[::p]
    equal = grid[1:] == grid[:-1]
    n = len(equal) - times + 2
    if n <= 0:
        return np.zeros(0, np.int64)
    hit = equal[:n].copy()
    for i in range(1, times - 1):
        hit &= equal[i:n + i]
    return np.flatnonzero(hit) * p


def _part(words: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts that hold any of the places: their symbols, and for every text
    its first place before and after the others are left out."""
    bounds = np.flatnonzero(words < 0)
    text = np.unique(np.searchsorted(bounds, places))          # separator that ends it
    sizes = bounds[text] - bounds[text - 1]
    starts = 1 + np.r_[0, np.cumsum(sizes)]
    take = np.repeat(bounds[text - 1] + 1 - starts[:-1], sizes) + np.arange(1, starts[-1])
    return np.r_[words[0], words[take]], bounds[text - 1] + 1, starts[:-1]


def runs_of(words: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Runs in symbols (0 or more) with a separator (negative, each once) before,
    between and after the texts: rows (start, end, period), by start and period."""
    if times < 2:
        raise ValueError("a run has two periods at least")
    bounds = np.flatnonzero(words < 0)
    longest = int(np.diff(bounds).max(initial=1)) - 1
    grid = []
    for p in range(1, longest // times + 1):
        at = _candidates(words, p, times)
        # all of its places lie in one text
        at = at[np.searchsorted(bounds, at) == np.searchsorted(bounds, at + (times - 1) * p)]
        if len(at):
            grid.append((p, at))
    if not grid:
        return np.zeros((0, 3), np.int64)
    symbols, old, new = _part(words, np.concatenate([at for _, at in grid]))
    shift = old - new
    grammar = Grammar(symbols)
    # per place: end and period of the known run that reaches furthest
    reach, period = np.zeros(len(symbols), np.int64), np.ones(len(symbols), np.int64)
    found: dict[tuple[int, int], int] = {}
    at = 0
    while at < len(grid):
        octave = grid[at][0].bit_length()
        group = []
        while at < len(grid) and grid[at][0].bit_length() == octave:
            group.append(grid[at])
            at += 1
        x = np.concatenate([places for _, places in group])
        x = x - shift[np.searchsorted(old, x, "right") - 1]
        p = np.concatenate([np.full(len(places), q) for q, places in group])
        fresh = ~((reach[x] >= x + times * p) & (p % period[x] == 0))
        x, p = x[fresh], p[fresh]
        known = []
        for i in range(0, len(x), CHUNK):
            a, q = x[i:i + CHUNK], p[i:i + CHUNK]
            start = a - grammar.extend(a - 1, a + q - 1, back=True)
            end = a + q + grammar.extend(a, a + q)
            ok = end - start >= np.maximum(least, times * q)
            for key, value in zip(zip(start[ok].tolist(), end[ok].tolist(), strict=True), q[ok].tolist(), strict=True):
                if found.setdefault(key, value) == value:
                    known.append((*key, value))
                else:
                    found[key] = min(found[key], value)
        for s, e, q in set(known):
            part = reach[s:e]
            further = part < e
            part[further], period[s:e][further] = e, q
    if not found:
        return np.zeros((0, 3), np.int64)
    out = np.array([(s, e, q) for (s, e), q in found.items()], np.int64)
    back = shift[np.searchsorted(new, out[:, 0], "right") - 1]
    out[:, 0] += back
    out[:, 1] += back
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def _numbered(texts: list[Words]) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers with separators, and the place of each text's first word."""
    number: dict[bytes, int] = defaultdict(count().__next__)
    out, starts = [-1], []
    for i, words in enumerate(texts):
        starts.append(len(out))
        out += [number[w] for w in words]
        out.append(-2 - i)
    return np.array(out, np.int64), np.array(starts, np.int64)


def _found(texts: list[Words], least: int, times: int) -> Iterator[tuple[int, list, bytes]]:
    """Per text: number of words, runs, kept words joined by one space."""
    numbers, starts = _numbered(texts)
    runs = runs_of(numbers, least, times)
    at = np.searchsorted(starts, runs[:, 0], "right") - 1
    first = np.searchsorted(at, np.arange(len(texts) + 1))
    for i, words in enumerate(texts):
        own = runs[first[i]:first[i + 1]].copy()
        if not len(own):
            yield len(words), [], b" ".join(words)
            continue
        own[:, :2] -= starts[i]
        depth = np.zeros(len(words) + 1, np.int64)
        np.add.at(depth, own[:, 0] + own[:, 2], 1)
        np.add.at(depth, own[:, 1], -1)
        keep = np.cumsum(depth[:-1]) == 0
        yield (len(words), [{"start": s, "length": e - s, "period": q} for s, e, q in own.tolist()],
               b" ".join([words[j] for j in np.flatnonzero(keep).tolist()]))


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  edit: Callable[[object, Words], Words] | None = None,
                  least: int = LEAST, times: int = TIMES) -> DataFrame:
    """The id, ``n_words``, ``runs`` (word number of the start, length, period; by start and
    period) and ``kept``: the words without those that lie in a run behind its
    first period, joined by one space.  Words are parted by ASCII white space; ``edit``
    (id, words) may give other words in their place."""
    if id_col in ("n_words", "runs", "kept"):
        raise ValueError(f"the id column can't be called {id_col}")
    rows = docs.select(id_col, text_bytes(F.col(text_col)).alias("kept"))
    schema = f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}, n_words bigint, runs {RUNS}, kept binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            ends = np.cumsum(pc.binary_length(whole.column(1)).to_numpy(zero_copy_only=False), dtype=np.int64)
            at = 0
            while at < whole.num_rows:
                full = (ends[at - 1] if at else 0) + BATCH_BYTES
                n = max(1, int(np.searchsorted(ends, full, "right")) - at)
                b = whole.slice(at, n)
                at += n
                texts = [t.as_buffer().to_pybytes().split() for t in b.column(1)]
                if edit:
                    texts = [edit(i, t) for i, t in zip(b.column(0).to_pylist(), texts, strict=True)]
                counts, runs, kept = zip(*_found(texts, least, times), strict=True)
                yield pa.record_batch([b.column(0), pa.array(counts, pa.int64()), pa.array(runs, _RUNS),
                                       pa.array(kept, pa.binary())], [id_col, "n_words", "runs", "kept"])

    out = rows.mapInArrow(run, schema)
    return out.withColumn("kept", F.col("kept").cast("string"))
