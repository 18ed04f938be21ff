"""SimHash near-duplicates, searched with pivot distance tables.

Fingerprint: words of the whole text (A-Z lower-cased, split on ASCII white
space), shingles of ``width`` words with repeats, XXH64 of each (seed 42); a bit
is set if it is set in over half of the hashes.

Search: a pair at ``max_bits`` differing bits or fewer agrees on all but
``max_bits`` of the blocks the bits are cut into, so rows meet under the values
of that many agreeing blocks.  Inside such a meeting place every fingerprint has a table of Hamming
distances to many reference fingerprints.  By the triangle inequality a pair
whose tables differ by more than ``max_bits`` in any coordinate cannot be
linked and is discarded; survivors are verified bit by bit.

Hot meeting places (more than ``hot_rows`` fingerprints) are never gathered:
their fingerprints go to a finer cut.  The last cut leaves 12 free bits, so a
meeting place there holds 4,096 distinct fingerprints at most, whatever the input.
Equal fingerprints are one row throughout.  Inside a place only links that
join new parts are emitted (a spanning star per part), never all pairs.

Defined cases: NULL text counts as empty; a text without words has fingerprint
zero and is linked like any other; fewer words than ``width`` make one shingle.
A NULL id is kept, never a component's name unless all its ids are NULL.
Repeated rows are repeated in the result.  Other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sublens.llm.common import aside, checkpointed, text_bytes
from sublens.llm.components import components

SEED = 42
WIDTH = 3
MAX_BITS = 3
PIVOTS = 32
HOT_ROWS = 2048
# numbers of blocks at each cut; all but max_bits of the blocks agree
CUTS = (5, 11, 16)


def fingerprint(text: bytes, width: int = WIDTH) -> int:
    words = text.lower().split()            # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(sizes + 1) - 1
        starts = (ends - sizes)[: len(words) - width + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1:].tolist(), strict=True)]
    h = np.array(hashes, dtype="<u8")
    votes = np.zeros(64, dtype=np.int64)
    for i in range(0, len(h), 1 << 15):
        part = h[i:i + (1 << 15)].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(h), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 width: int = WIDTH, carry: list[str] | None = None) -> DataFrame:
    """(id, fp, *carry): fp is the fingerprint as a signed 64-bit integer."""
    src = df.select(F.col(id_col).cast("long").alias("id"), *[F.col(c) for c in carry or []],
                    text_bytes(F.col(text_col)).alias("fp"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t.as_py(), width) for t in b.column("fp")),
                              dtype=np.uint64, count=b.num_rows)
            yield b.set_column(b.num_columns - 1, "fp", pa.array(fps.view(np.int64)))

    schema = ", ".join(f"`{c}` {t}" for c, t in src.dtypes[:-1])
    return src.mapInArrow(run, f"{schema}, fp long")


def pivots(count: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints: hashes of 0, 1, 2, …"""
    return np.array([xxhash.xxh64_intdigest(str(i), SEED) for i in range(count)], dtype=np.uint64)


def distance_table(fps: np.ndarray, refs: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fps[:, None] ^ refs[None, :]).astype(np.int8)


def _near(fp: np.ndarray, table: np.ndarray, i: int, rows: np.ndarray, max_bits: int) -> np.ndarray:
    """Those of ``rows`` within max_bits of row i: pivot test, then the bits."""
    apart = np.abs(table[rows] - table[i]).max(axis=1)
    rows = rows[apart <= max_bits]
    return rows[np.bitwise_count(fp[rows] ^ fp[i]) <= max_bits]


def place_links(fp: np.ndarray, refs: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that join the parts of one meeting place: each row found from a
    row already reached is linked to it once."""
    table, left, out = distance_table(fp, refs), np.arange(len(fp)), []
    while len(left):
        todo, left = [int(left[0])], left[1:]
        while todo and len(left):
            i = todo.pop()
            hit = _near(fp, table, i, left, max_bits)
            if len(hit):
                out += [(i, int(j)) for j in hit]
                todo += hit.tolist()
                left = np.setdiff1d(left, hit, assume_unique=True)
    return out


def _pair_links(fp: np.ndarray, first: np.ndarray, refs: np.ndarray, max_bits: int) -> np.ndarray:
    """Places of two rows, all at once: which of the pairs (i, i + 1) are links."""
    a, b = fp[first], fp[first + 1]
    keep = np.abs(distance_table(a, refs) - distance_table(b, refs)).max(axis=1) <= max_bits
    first = first[keep]
    return first[np.bitwise_count(fp[first] ^ fp[first + 1]) <= max_bits]


def _places(blocks: int, max_bits: int) -> list[tuple[int, int]]:
    """(number, mask) of every choice of agreeing blocks."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    masks = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:], strict=False)]
    return [(n, sum(c)) for n, c in enumerate(itertools.combinations(masks, blocks - max_bits))]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _cut_links(fps: DataFrame, blocks: int, hot_rows: int | None, max_bits: int) -> tuple[DataFrame, DataFrame | None]:
    """Links found at one cut, and the fingerprints of its hot places."""
    refs = pivots()
    keys: list[Column] = [F.struct(F.lit(n).alias("c"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("k"))
                          for n, m in _places(blocks, max_bits)]
    rows = fps.select("fp", F.inline(F.array(*keys)))
    counts = checkpointed(rows.groupBy("c", "k").agg(F.count("*").alias("n")).filter("n > 1"))
    met = checkpointed(rows.join(counts, ["c", "k"]))
    hot = None
    if hot_rows is not None:
        if met.filter(F.col("n") > hot_rows).limit(1).count():
            hot = checkpointed(met.filter(F.col("n") > hot_rows).select("fp").distinct())
        met = met.filter(F.col("n") <= hot_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for b in itertools.chain(batches, [None]):
            if b is not None:
                t = pa.Table.from_batches([b])
                t = t if rest is None else pa.concat_tables([rest, t])
            elif rest is None:
                return
            else:
                t = rest
            c, k, fp = (t.column(x).to_numpy() for x in ("c", "k", "fp"))
            new = np.flatnonzero((c[1:] != c[:-1]) | (k[1:] != k[:-1])) + 1
            start = np.concatenate([[0], new])
            if b is not None:              # the last place may go on in the next batch
                rest = t.slice(int(start[-1]))
                stop, start = start[1:], start[:-1]
            else:
                rest, stop = None, np.concatenate([new, [len(c)]])
            fp = fp.view(np.uint64)
            size = stop - start
            two = _pair_links(fp, start[size == 2], refs, max_bits)
            a, z = [fp[two]], [fp[two + 1]]
            for s, e in zip(start[size > 2].tolist(), stop[size > 2].tolist(), strict=True):
                if found := place_links(fp[s:e], refs, max_bits):
                    ij = np.array(found) + s
                    a.append(fp[ij[:, 0]])
                    z.append(fp[ij[:, 1]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x).view(np.int64)) for x in (a, z)], ["a", "b"])

    placed = met.select("c", "k", "fp").repartition("c", "k").sortWithinPartitions("c", "k")
    return placed.mapInArrow(run, "a long, b long"), hot


def links(fps: DataFrame, max_bits: int = MAX_BITS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Links (a, b) between distinct fingerprints that give the same components
    as all pairs at max_bits differing bits or fewer."""
    if not 0 <= max_bits < min(CUTS):
        raise ValueError("max_bits out of range")
    out = None
    for blocks in CUTS:
        found, fps = _cut_links(fps, blocks, None if blocks == CUTS[-1] else hot_rows, max_bits)
        out = found if out is None else out.unionByName(found)
        if fps is None:
            break
    return out


def simhash_rows(df: DataFrame, id_col: str, text_col: str, width: int, max_bits: int,
                 carry: list[str] | None = None) -> DataFrame:
    """(id, fp, root, component_id, *carry) for every row of df."""
    docs = checkpointed(fingerprints(df, id_col, text_col, width, carry))
    distinct = checkpointed(docs.groupBy("fp").agg(F.min("id").alias("low")))
    roots = components(links(distinct.select("fp"), max_bits))
    named = checkpointed(distinct.join(roots, F.col("fp") == F.col("vertex"), "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")))
    lows = checkpointed(named.groupBy("root").agg(F.min("low").alias("component_id")))
    named = checkpointed(named.join(lows, "root").select("fp", "root", "component_id"))
    return docs.join(named, "fp")


def simhash_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       width: int = WIDTH, max_bits: int = MAX_BITS) -> DataFrame:
    """(id_col, fingerprint, component_id) for every row of df; component_id is
    the smallest id reachable over links."""
    return simhash_rows(df, id_col, text_col, width, max_bits).select(
        F.col("id").alias(id_col),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               width: int = WIDTH, max_bits: int = MAX_BITS) -> DataFrame:
    """df with one row of each component, all columns kept: that of the
    smallest id (NULL last); of rows that tie, the one whose text hashes lowest;
    of repeated rows, one.  Columns may have any names."""
    clear, names = aside(df)
    id_col, text_col = names[id_col], names[text_col]
    keyed = clear.withColumn("_th", F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    rows = checkpointed(simhash_rows(keyed, id_col, text_col, width, max_bits, ["_th"]))
    best = checkpointed(rows.groupBy("root").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "_th")).alias("m"))
        .select(F.col("m.id").alias("_id"), F.col("m._th").alias("_h")))
    kept = keyed.join(best, F.col(id_col).cast("long").eqNullSafe(F.col("_id"))
                      & (F.col("_th") == F.col("_h")), "left_semi")
    repeated = rows.groupBy("id", "_th").count().filter("count > 1").limit(1).count()
    if repeated:
        kept = kept.dropDuplicates([id_col, "_th"])
    return kept.select(*[F.col(f"`{new}`").alias(old) for old, new in names.items()])
