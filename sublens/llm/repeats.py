"""Exact repeated passages across documents, found with suffix arrays in shards.

A byte goes if it lies in a string of ``length`` bytes that also starts in a
document with a smaller id.  Documents are never joined into one text:

1. Texts that a smaller id has whole (by 128 bits of hash) repeat whole; the
   steps below go on without them.  Every window of ``length`` bytes has a key, the smallest hash of the
   ``GRAM``-byte strings inside it, so equal windows have equal keys wherever
   they stand.  A segment is a run of windows with the same key.
2. Keys that only one document has cannot belong to a repeat.  They are found
   by shuffling the keys alone, packed in blocks.
3. The segments of the other keys are shuffled by key, each different segment
   once, with the smallest id that has it (its owner).  Keys of one owner are
   settled; over shards of the others a task builds suffix arrays
   by induced sorting, takes permuted common prefixes,
   and in each run of suffixes that share ``length`` bytes finds the smallest
   owner: the windows of a segment that a smaller id also has.
4. Each document gets back the spans of its segments: a segment owned by a
   smaller id is covered whole, its own segments where the arrays say so.

A key with more than ``hot_segments`` different segments is not gathered: its
segments are cut into windows, and the smallest owner of each window is found by a
grouped minimum, combined before the shuffle.

Segments are identified by 128 bits of hash.  Defined cases: NULL text is empty;
documents with equal ids never remove bytes of each other; a NULL id counts
as larger than every other (like 2**63 - 1).  Repeated rows are repeated in the result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sublens.llm.common import checkpointed, discard, stored, text_bytes
from sublens.llm.suffix import permuted_common_prefixes, suffix_array

LENGTH = 50
GRAM = 24                     # bytes of the strings that give windows their keys
SHARD_BYTES = 4 << 20         # text of one suffix array
BLOCK_BYTES = 16 << 20        # keys compared in one task
HOT_SEGMENTS = 20_000
LAST = (1 << 63) - 1

U = np.uint64
# odd multipliers that mix bits (fixed, arbitrary)
MIX = (U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9), U(0xBF58476D1CE4E5B9))


def _eights(b: np.ndarray) -> np.ndarray:
    """The 8 bytes from every position on, as integers."""
    two = b[:-1].astype(U) | (b[1:].astype(U) << U(8))
    four = two[:-2] | (two[2:] << U(16))
    return four[:-4] | (four[4:] << U(32))


def window_keys(data: bytes, length: int = LENGTH) -> np.ndarray:
    """The key of every window of ``length`` bytes."""
    if len(data) < length:
        return np.empty(0, dtype=U)
    e = _eights(np.frombuffer(data, dtype=np.uint8))
    n = len(data) - GRAM + 1
    h = e[:n] * MIX[0]
    for at, m in zip(range(8, GRAM, 8), MIX[1:], strict=False):
        h ^= e[at:at + n] * m
        h ^= h >> U(31)
    h ^= h >> U(29)
    h *= MIX[3]
    h ^= h >> U(32)
    width, step = length - GRAM + 1, 1
    m = h
    while 2 * step <= width:
        m = np.minimum(m[:-step], m[step:])
        step *= 2
    last = width - step
    return np.minimum(m[:len(m) - last], m[last:]) if last else m


def segments(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and one past the last window of each run with one key."""
    if not len(keys):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    cut = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    return np.concatenate([[0], cut]), np.concatenate([cut, [len(keys)]])


def _order(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(LAST))


def _source(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    t = text_bytes(F.col(text_col))
    return df.select(_order(id_col).alias("o"), F.xxhash64(t).alias("h"), t.alias("t"))


def _copies(src: DataFrame) -> DataFrame:
    """(o, h, size) of the texts that a smaller id has whole: they repeat from
    end to end, and what else has their passages meets the smaller id."""
    rows = src.select("o", "h", F.xxhash64("t", F.lit(1)).alias("h2"), F.octet_length("t").alias("size"))
    rows = checkpointed(rows.distinct())
    first = checkpointed(rows.groupBy("h", "h2", "size").agg(F.min("o").alias("first"), F.count("*").alias("n")).filter("n > 1"))
    return rows.join(first, ["h", "h2", "size"]).filter("o > first").select("o", "h", "size")


def _short(keys: np.ndarray, blocks: int) -> np.ndarray:
    """Block and 32 bits of a key as one number.  A block holds a few million keys
    at any size of the input, so chance agreements stay rare; they only make
    a segment take part for nothing."""
    return (((keys >> U(33)) % U(blocks)) << U(32)) | (keys & U(0xFFFFFFFF))


def _blocks(src: DataFrame) -> int:
    size = src.agg(F.sum(F.octet_length("t")).alias("n")).first()["n"] or 0
    return int(-(-size * 8 // (13 * BLOCK_BYTES))) or 1       # a key for each 13 bytes or so


def _shared_keys(src: DataFrame, length: int, blocks: int) -> DataFrame:
    """(o, keys): of each id the (short) keys that another id has too."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in (whole.slice(i, 2048) for i in range(0, whole.num_rows, 2048)):
                ids = b.column(0).to_numpy()
                keys = [np.unique(_short(window_keys(t.as_py(), length), blocks)) for t in b.column(2)]
                doc = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
                key = np.concatenate(keys)
                part = (key >> U(32)).astype(np.int64)
                order = np.argsort(part, kind="stable")       # by block, then by document
                part, doc, key = part[order], doc[order], key[order]
                cut = np.searchsorted(part, np.arange(blocks + 1)).tolist()
                rows = []
                for p, (lo, hi) in enumerate(zip(cut, cut[1:], strict=False)):
                    if hi > lo:
                        docs, counts = np.unique(doc[lo:hi], return_counts=True)
                        rows.append((p, ids[docs].tobytes(), counts.astype(np.uint32).tobytes(),
                                     key[lo:hi].astype(np.uint32).tobytes()))
                if rows:
                    p, *cols = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(p, pa.int32()), *(pa.array(c, pa.binary()) for c in cols)], ["p", "o", "n", "key"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        for b in batches:
            for p, *x in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                held.setdefault(p, []).append(x)
        for p, rows in held.items():
            keys = np.concatenate([np.frombuffer(r[2], dtype=np.uint32) for r in rows])
            o = np.concatenate([np.repeat(np.frombuffer(r[0], dtype=np.int64), np.frombuffer(r[1], dtype=np.uint32))
                                for r in rows])
            order = np.argsort(keys, kind="stable")
            k, oo = keys[order], o[order]
            start = np.concatenate([[0], np.flatnonzero(k[1:] != k[:-1]) + 1])
            low, high = np.minimum.reduceat(oo, start), np.maximum.reduceat(oo, start)
            many = np.repeat(low != high, np.diff(np.append(start, len(k))))
            k, oo = k[many].astype(np.int64) | (p << 32), oo[many]
            to = (oo.astype(U) * MIX[0] >> U(33)) % U(blocks)          # by document from here on
            order = np.lexsort((oo, to))
            k, oo, to = k[order], oo[order], to[order]
            cut = np.flatnonzero(to[1:] != to[:-1]) + 1
            edges = [0, *cut.tolist(), len(k)] if len(k) else []
            for lo, hi in zip(edges, edges[1:], strict=False):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(to[lo])], pa.int32()), pa.array([oo[lo:hi].tobytes()], pa.binary()),
                     pa.array([k[lo:hi].tobytes()], pa.binary())], ["p", "o", "key"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(x, y) for b in batches for x, y in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
        if not rows:
            return
        o = np.concatenate([np.frombuffer(x, dtype=np.int64) for x, _ in rows])
        k = np.concatenate([np.frombuffer(y, dtype=np.int64) for _, y in rows])
        order = np.argsort(o, kind="stable")
        o, k = o[order], k[order]
        first = np.concatenate([[0], np.flatnonzero(o[1:] != o[:-1]) + 1])
        ends = np.append(first, len(o))
        for i in range(0, len(first), 4096):
            lo, hi = ends[i], ends[min(i + 4096, len(first))]
            at = ends[i:min(i + 4096, len(first)) + 1] - lo
            yield pa.RecordBatch.from_arrays(
                [pa.array(o[first[i:i + 4096]]),
                 pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(k[lo:hi]))], ["o", "keys"])

    packed = src.mapInArrow(emit, "p int, o binary, n binary, key binary")
    found = packed.repartitionById(blocks, F.col("p")).mapInArrow(find, "p int, o binary, key binary")
    return found.repartitionById(blocks, F.col("p")).mapInArrow(gather, "o long, keys array<long>")


OCCURRENCES = "o long, h long, key long, content long, start int, size int, segment binary"


def _occurrences(src: DataFrame, shared: DataFrame, length: int, blocks: int) -> DataFrame:
    """A row for each segment with a shared key: where it is, what it is.  The
    bytes come with its first row in a batch only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in (whole.slice(i, 2048) for i in range(0, whole.num_rows, 2048)):
                rows, seen = [], set()
                for o, h, t, wanted in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3), strict=True):
                    data = t.as_py()
                    keys = window_keys(data, length)
                    first, stop = segments(keys)
                    own = keys[first]
                    take = np.isin(_short(own, blocks), np.asarray(wanted.values, dtype=np.int64).view(U))
                    for k, s, e in zip(own[take].view(np.int64).tolist(), first[take].tolist(), stop[take].tolist(), strict=True):
                        seg = data[s:e + length - 1]
                        c = xxhash.xxh3_64_intdigest(seg)
                        c = c - (1 << 64) if c >> 63 else c
                        new = (k, c) not in seen
                        seen.add((k, c))
                        rows.append((o, h, k, c, s, len(seg), seg if new else None))
                if rows:
                    cols = list(zip(*rows, strict=True))
                    types = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.binary()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, x) for c, x in zip(cols, types, strict=True)],
                        [x.split(" ")[0] for x in OCCURRENCES.split(", ")])

    joined = src.join(shared, "o").select("o", "h", "t", "keys")
    return joined.mapInArrow(run, OCCURRENCES)


COVER = "array<struct<start:int,end:int>>"


def runs(mask: np.ndarray, length: int) -> list[dict]:
    """Spans covered by the windows that are marked."""
    at = np.flatnonzero(mask)
    if not len(at):
        return []
    cut = np.flatnonzero(at[1:] - at[:-1] > length) + 1       # windows that touch make one span
    first, last = at[np.concatenate([[0], cut])], at[np.concatenate([cut - 1, [len(at) - 1]])]
    return [{"start": int(a), "end": int(z) + length} for a, z in zip(first, last, strict=True)]


def shard_covers(parts: list[bytes], owners: np.ndarray, length: int = LENGTH) -> list[list[dict]]:
    """For each segment: the spans of it that a smaller owner's segment has."""
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    joined = np.frombuffer(b"\0".join(parts) + b"\0\0", dtype=np.uint8)
    t = joined.astype(np.uint16) + 2
    ends = np.cumsum(sizes + 1) - 1
    t[ends] = 1                           # between segments
    t[-1] = 0
    sa = suffix_array(t)
    common = permuted_common_prefixes(t, sa)
    of = np.repeat(np.arange(len(parts)), sizes + 1)
    of = np.append(of, len(parts) - 1)
    owner = owners[of]
    new = common[sa] < length             # a run of suffixes that share `length` symbols begins
    new[0] = True
    first = np.flatnonzero(new)
    lowest = np.empty(len(t), dtype=np.int64)
    lowest[sa] = np.repeat(np.minimum.reduceat(owner[sa], first), np.diff(np.append(first, len(sa))))
    hit = lowest < owner
    begins, stops = ends - sizes, ends - length + 1
    before = np.concatenate([[0], np.cumsum(hit)])
    out: list[list[dict]] = [[]] * len(parts)
    for i in np.flatnonzero(before[stops] > before[begins]).tolist():     # most segments have no hit
        out[i] = runs(hit[begins[i]:stops[i]], length)
    return out


def key_covers(keys: np.ndarray, parts: list[bytes], owners: np.ndarray, length: int = LENGTH) -> list[list[dict]]:
    """The same for segments sorted by key.  Equal windows have equal keys, so a key whose
    segments all have one owner has nothing to find and stays out of the suffix array."""
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    several = np.minimum.reduceat(owners, first) != np.maximum.reduceat(owners, first)
    take = np.flatnonzero(np.repeat(several, np.diff(np.append(first, len(keys)))))
    out: list[list[dict]] = [[]] * len(parts)
    if len(take):
        found = shard_covers([parts[i] for i in take.tolist()], owners[take], length)
        for i, c in zip(take.tolist(), found, strict=True):
            out[i] = c
    return out


def _covers(segs: DataFrame, length: int) -> DataFrame:
    """segs (key, content, owner, segment) -> (key, content, owner, cover)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None

        def flush():
            k, c, o, parts = zip(*held, strict=True)
            covers = key_covers(np.array(k, dtype=np.int64), parts, np.array(o, dtype=np.int64), length)
            return pa.RecordBatch.from_arrays(
                [pa.array(k, pa.int64()), pa.array(c, pa.int64()), pa.array(o, pa.int64()),
                 pa.array(covers, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
                ["key", "content", "owner", "cover"])

        for b in batches:
            for row in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                if size >= SHARD_BYTES and row[0] != last:    # a shard holds whole keys
                    yield flush()
                    held, size = [], 0
                held.append(row)
                size += len(row[3]) + 1
                last = row[0]
        if held:
            yield flush()

    placed = segs.select("key", "content", "owner", "segment").repartition("key").sortWithinPartitions("key")
    return placed.mapInArrow(run, f"key long, content long, owner long, cover {COVER}")


def _hot_covers(segs: DataFrame, length: int) -> DataFrame:
    """The same for keys with very many segments: window by window, with a
    grouped minimum."""
    cut = segs.select("key", "content", "owner", F.posexplode(F.transform(
        F.sequence(F.lit(1), F.length("segment") - length + 1),
        lambda i: F.substring(F.col("segment"), i, F.lit(length)))).alias("at", "w"))
    low = checkpointed(cut.groupBy("w").agg(F.min("owner").alias("low")))
    hits = cut.join(low, "w").filter("low < owner").groupBy("key", "content", "owner").agg(
        F.array_sort(F.collect_list(F.struct(F.col("at").alias("start"), (F.col("at") + length).alias("end")))).alias("cover"))
    return segs.select("key", "content", "owner").join(hits, ["key", "content", "owner"], "left").withColumn(
        "cover", F.coalesce(F.col("cover"), F.array().cast(COVER)))


def spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
          hot_segments: int = HOT_SEGMENTS) -> DataFrame:
    """(o, h, spans): the covered spans, unmerged, of each document that has any;
    o orders the ids, h is xxhash64 of the text's bytes."""
    if length < GRAM + 8:
        raise ValueError(f"length must be {GRAM + 8} or more")
    everything = _source(df, id_col, text_col)
    copies = stored(_copies(everything), "repeat-copies")
    src = everything.join(copies.select("o", "h"), ["o", "h"], "left_anti")
    blocks = _blocks(src)
    shared = stored(_shared_keys(src, length, blocks), "repeat-keys")
    found = stored(_occurrences(src, shared, length, blocks), "repeat-segments")
    discard(shared)
    segs = stored(found.groupBy("key", "content").agg(
        F.min("o").alias("owner"), F.max("segment").alias("segment")), "repeat-owners")
    # other segments of the same key decide; how many there are decides the way
    counts = segs.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > hot_segments)
    counts = checkpointed(counts)
    if counts.limit(1).count():
        hot = stored(segs.join(counts, "key", "left_semi"), "repeat-hot")
        cover = _covers(segs.join(counts, "key", "left_anti"), length).unionByName(_hot_covers(hot, length))
    else:
        cover = _covers(segs, length)
    cover = stored(cover, "repeat-covers")
    discard(segs)
    at = F.when(F.col("owner") < F.col("o"), F.array(F.struct(
        F.col("start"), (F.col("start") + F.col("size")).alias("end")))).otherwise(
        F.transform("cover", lambda c: F.struct((c["start"] + F.col("start")).alias("start"),
                                                (c["end"] + F.col("start")).alias("end"))))
    hits = found.select("o", "h", "key", "content", "start", "size").join(cover, ["key", "content"]).select(
        "o", "h", at.alias("s")).filter(F.size("s") > 0)
    out = stored(hits.groupBy("o", "h").agg(F.flatten(F.collect_list("s")).alias("spans")), "repeat-spans")
    discard(found, cover)
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("size").cast("int").alias("end")))
    return out.unionByName(copies.filter(F.col("size") >= length).select("o", "h", whole.cast(COVER).alias("spans")))


def merged(found: list[dict]) -> list[tuple[int, int]]:
    """Sorted spans, touching and overlapping ones joined."""
    out: list[tuple[int, int]] = []
    for s, e in sorted((x["start"], x["end"]) for x in found):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   hot_segments: int = HOT_SEGMENTS) -> DataFrame:
    """(id_col, n_bytes, removed, kept) for every row: the removed spans (start,
    end) and the bytes that stay (they need not be valid UTF-8)."""
    found = spans(df, id_col, text_col, length, hot_segments)
    t = text_bytes(F.col(text_col))
    rows = df.select(F.col(id_col).cast("long").alias("id"), _order(id_col).alias("o"),
                     F.xxhash64(t).alias("h"), t.alias("t"))
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in (whole.slice(i, 512) for i in range(0, whole.num_rows, 512)):
                sizes, cuts, kept = [], [], []
                for t, x in zip(b.column(1), b.column(2), strict=True):
                    data, gone = t.as_py(), merged(x.as_py() or [])
                    edges = [0, *itertools.chain.from_iterable(gone), len(data)]
                    kept.append(b"".join(data[s:e] for s, e in zip(edges[::2], edges[1::2], strict=True)))
                    sizes.append(len(data))
                    cuts.append([{"start": s, "end": e} for s, e in gone])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(sizes, pa.int64()), pa.array(cuts, kind), pa.array(kept, pa.binary())],
                    [id_col, "n_bytes", "removed", "kept"])

    joined = rows.join(found, ["o", "h"], "left").select("id", "t", "spans")
    return joined.mapInArrow(run, f"`{id_col}` long, n_bytes long, removed {COVER}, kept binary")
