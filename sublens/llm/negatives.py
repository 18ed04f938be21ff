"""Hard negatives by inner product, with coordinate pruning in length buckets.

Rows are sorted by label and length and cut into buckets of ``BUCKET`` rows of one
label at most, so that a bucket's vectors are of similar length.  A bucket
holds, for every coordinate, its rows in order of that coordinate of the unit vectors.
An anchor goes through buckets from the longest on, with the score that its k-th best row
has so far (or its window's lower end) as threshold: divided by both lengths it is a least
cosine t, and with it every focus coordinate f of the anchor (its ``FOCUS`` largest)
has a range q_f t -+ sqrt((1 - t^2) (1 - q_f^2)) of feasible values, one stretch of
that coordinate's list.  Only rows in the stretches of all focus coordinates
are scored, exactly, with integers.  A bucket with t over 1 is passed over whole.

Buckets are dealt to slots of ``SLOT`` buckets on average; every anchor
visits every slot (for rows of its own label: every slot of that label), and a
task holds one slot's buckets while anchors stream past.  What the tasks return, k rows for
anchor, window and slot, is cut to the first k by a window that is limited
before its exchange.

Defined cases: rows with a NULL id, label or vector or a NULL or non-finite
component take no part; shorter vectors count as filled up with zeros; rows that
repeat count each, as candidates, but an anchor that repeats counts once; a row is never
paired with one of the same id.  Scores beyond +-2^56 are cut to that.  An
empty table gives an empty result.  Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sublens.llm.common import discard, stored

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90            # negatives have this share, in hundredths, of the positive's score
BUCKET, SLOT, FOCUS = 8192, 8, 3
FAR = 1 << 56                 # bound of scores
EXACT = 1 << 53               # integers that a double holds

BUCKETS = "label string, longest double, width int, ids binary, parts binary, orders binary"


def usable(id_col: str, label_col: str, vector_col: str) -> Column:
    """Rows that take part."""
    whole = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                     & (F.abs(x.cast("double")) < float("inf")))
    return F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.coalesce(whole, F.lit(False))


def scaled(vector_col: str, scale: int = SCALE) -> Column:
    return F.transform(vector_col, lambda x: F.floor(scale * x.cast("double")))


def _matrix(vectors: pa.ListArray, width: int = 0) -> np.ndarray:
    """The vectors as rows, filled up with zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(vectors), max(width, int(sizes.max(initial=0)))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = vectors.flatten().to_numpy()
    return out


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    width = max(m.shape[1] for m in parts)
    return np.concatenate([np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in parts])


def _unit(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors (zero stays zero) and lengths."""
    whole = parts.astype(np.float64)
    lengths = np.sqrt((whole ** 2).sum(axis=1))
    return whole / np.maximum(lengths, 1e-300)[:, None], lengths


def buckets(rows: DataFrame, size: int = BUCKET) -> DataFrame:
    """Bucket table of (id, label, vec array<bigint>)."""
    length = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    placed = (rows.select("id", F.col("label").cast("string").alias("label"), "vec", F.sqrt(length).alias("length"))
              .repartitionByRange("label", F.desc("length"), "id")
              .sortWithinPartitions("label", F.desc("length"), "id"))

    def packed(label: str, held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        parts = _joined([m for _, m in held])
        unit, lengths = _unit(parts)
        fits = np.abs(parts).max(initial=0) < 1 << 31
        return pa.RecordBatch.from_pylist([{
            "label": label, "longest": float(lengths.max()), "width": parts.shape[1] * (1 if fits else -1),
            "ids": np.concatenate([i for i, _ in held]).tobytes(),
            "parts": (parts.astype(np.int32) if fits else parts).tobytes(),
            "orders": np.argsort(unit, axis=0, kind="stable").T.astype(np.int32).tobytes()}], schema)

    schema = pa.schema([("label", pa.string()), ("longest", pa.float64()), ("width", pa.int32()), ("ids", pa.binary()),
                        ("parts", pa.binary()), ("orders", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label, held, room = None, [], size
        for b in batches:
            labels, ids, parts = b.column(1).to_pylist(), b.column(0).to_numpy(), _matrix(b.column(2))
            at = 0
            while at < len(ids):
                if held and (labels[at] != label or not room):
                    yield packed(label, held)
                    held = []
                if not held:
                    label, room = labels[at], size
                n = 1
                while n < room and at + n < len(ids) and labels[at + n] == label:
                    n += 1
                held.append((ids[at:at + n], parts[at:at + n]))
                room -= n
                at += n
        if held:
            yield packed(label, held)

    return placed.mapInArrow(run, BUCKETS)


class Bucket:
    """One bucket as arrays; ``candidates`` are the rows that may reach a score."""

    def __init__(self, row: dict):
        self.label, self.longest = row["label"], row["longest"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        n, width = len(self.ids), abs(row["width"])
        parts = np.frombuffer(row["parts"], np.int32 if row["width"] >= 0 else np.int64).reshape(n, width)
        self.most = float(np.abs(parts).max(initial=0))
        self.parts = parts.astype(np.int64 if row["width"] < 0 else np.float64)
        self.orders = np.frombuffer(row["orders"], np.int32).reshape(width, n)
        # in float32: ranges are widened by more than its error
        self.sorted = np.take_along_axis(_unit(parts)[0].astype(np.float32).T, self.orders, axis=1)

    def candidates(self, anchor: np.ndarray, least: float, focus: int = FOCUS) -> np.ndarray | None:
        """Rows whose inner product with the anchor can be ``least`` or more; None: all."""
        size = float(np.sqrt((anchor.astype(np.float64) ** 2).sum()))
        if least <= 0:
            return None
        t = least / max(size * self.longest, 1e-300) * (1 - 1e-9)
        if t > 1:
            return np.zeros(0, np.int64)
        q = anchor / size
        marks = np.zeros(len(self.ids), np.uint8)
        chosen = np.argsort(-np.abs(q), kind="stable")[:focus]
        chosen = chosen[chosen < len(self.orders)]
        for f in chosen.tolist():
            wide = np.sqrt(max(0.0, (1 - t * t) * (1 - q[f] * q[f])))
            low, high = q[f] * t - wide - 1e-5, q[f] * t + wide + 1e-5
            # past a cosine of t, the value may lie on the far side of the anchor's own
            if q[f] >= 0 and q[f] >= t:
                high = 1.1
            if q[f] <= 0 and -q[f] >= t:
                low = -1.1
            values = self.sorted[f]
            marks[self.orders[f, np.searchsorted(values, low):np.searchsorted(values, high, "right")]] += 1
        return np.flatnonzero(marks == len(chosen))

    def scores(self, anchor: np.ndarray, rows: np.ndarray | None) -> np.ndarray:
        """Exact inner products of the rows with the anchor, cut to +-FAR."""
        width = self.parts.shape[1]
        a = np.zeros(width, np.int64)
        a[:min(width, len(anchor))] = anchor[:width]
        parts = self.parts if rows is None or 2 * len(rows) > len(self.ids) else self.parts[rows]
        most = self.most * float(np.abs(a).max(initial=0)) * max(1, width)
        if most < EXACT:
            out = (parts @ a.astype(parts.dtype)).astype(np.int64)
        elif most < 2.0 ** 62:
            out = np.clip(parts.astype(np.int64) @ a, -FAR, FAR)
        else:
            whole = parts.astype(np.int64).astype(object) @ a.astype(object)
            out = np.array([min(FAR, max(-FAR, int(x))) for x in whole], np.int64)
        return out[rows] if rows is not None and parts is self.parts else out


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The first k by score, then by smaller id."""
    if len(scores) > 4 * k:
        keep = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        scores, ids = scores[keep], ids[keep]
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def visit(held: list[Bucket], anchor_id: int, label: str, anchor: np.ndarray, windows: list[tuple[int, int]],
          same: bool, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Scores and ids of the first k rows in every window of scores (both ends included)."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in windows]
    open_ = [j for j, (low, high) in enumerate(windows) if low <= high]
    for bucket in held:
        if not open_:
            break
        if (bucket.label == label) != same:
            continue
        least = min(int(found[j][0][-1]) if len(found[j][0]) == k else windows[j][0] for j in open_)
        rows = bucket.candidates(anchor, least)
        if rows is not None and not len(rows):
            continue
        scores = bucket.scores(anchor, rows)
        ids = bucket.ids if rows is None else bucket.ids[rows]
        other = (ids != anchor_id) & (scores >= least)
        scores, ids = scores[other], ids[other]
        for j in open_:
            inside = (scores >= windows[j][0]) & (scores <= windows[j][1])
            s, i = best(scores[inside], ids[inside], k)
            found[j] = best(np.r_[found[j][0], s], np.r_[found[j][1], i], k)
    return found


def first_rows(anchors: DataFrame, held: DataFrame, same: bool, k: int, slot: int = SLOT) -> DataFrame:
    """For anchors (key, id, label, vec, low, high: the windows' ends) and a stored
    bucket table: (key, window, id, score, rank) of the first k rows in each
    window, of the anchor's label (``same``) or of any other."""
    if same:
        sizes = held.groupBy("label").agg(F.ceil(F.count("*") / slot).alias("slots"))
        dealt, visits = held.join(sizes, "label"), anchors.join(sizes, "label")
        space = F.col("label")
    else:
        slots = F.lit(max(1, -(-held.count() // slot))).cast("bigint")
        dealt, visits = held.withColumn("slots", slots), anchors.withColumn("slots", slots)
        space = F.lit("")
    dealt = dealt.withColumns({"space": space, "slot": F.pmod(F.xxhash64("ids", "orders"), "slots"), "tag": F.lit(0)})
    visits = visits.withColumns({"space": space, "tag": F.lit(1),
                                 "slot": F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slots") - 1))})
    both = (dealt.drop("slots").unionByName(visits.drop("slots"), allowMissingColumns=True)
            .repartition("space", "slot").sortWithinPartitions("space", "slot", "tag", F.desc("longest")))
    names = both.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, here = None, []
        for b in batches:
            out = []
            for values in zip(*b.columns, strict=True):
                row = dict(zip(names, values, strict=True))
                at = (row["space"].as_py(), row["slot"].as_py())
                if at != place:
                    place, here = at, []
                if row["tag"].as_py() == 0:
                    here.append(Bucket({n: row[n].as_py() for n in ("label", "longest", "width", "ids", "parts", "orders")}))
                    continue
                windows = list(zip(row["low"].as_py(), row["high"].as_py(), strict=True))
                found = visit(here, row["id"].as_py(), row["label"].as_py(), row["vec"].values.to_numpy(),
                              windows, same, k)
                key = row["key"].as_py()
                out += [(key, j, i, s) for j, (scores, ids) in enumerate(found)
                        for s, i in zip(scores.tolist(), ids.tolist(), strict=True)]
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(
                    zip(*out, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)],
                    ["key", "window", "id", "score"])

    found = both.mapInArrow(run, "key bigint, window int, id bigint, score bigint")
    order = Window.partitionBy("key", "window").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, anchor: Column, id_col: str = "vec_id", label_col: str = "label",
                   vector_col: str = "embedding", positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH, scale: int = SCALE) -> DataFrame:
    """For every row where ``anchor`` holds and each of its first ``positives`` rows of the same
    label: the first ``negatives`` rows of other labels with ``low`` to ``high``
    hundredths of the positive's score.  Columns anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score."""
    chosen = rows.filter(usable(id_col, label_col, vector_col)).select(
        F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("string").alias("label"),
        scaled(vector_col, scale).alias("vec"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    held = stored(buckets(chosen), "negatives-buckets")
    keyed = stored(chosen.filter("anchor").select("id", "label", "vec").distinct()
                   .withColumn("key", F.monotonically_increasing_id()), "negatives-anchors")
    every = keyed.withColumns({"low": F.array(F.lit(-FAR)), "high": F.array(F.lit(FAR))})
    near = stored(first_rows(every, held, True, positives).select("key", "rank", "id", "score"), "negatives-positives")
    ends = near.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "score"))).alias("near"))
    windows = keyed.join(ends, "key").withColumns({      # shares of the score, rounded into the window
        "low": F.expr(f"transform(near.score, s -> if(s < 0, s * {low} div 100, (s * {low} + 99) div 100))"),
        "high": F.expr(f"transform(near.score, s -> if(s < 0, (s * {high} - 99) div 100, s * {high} div 100))")})
    far = first_rows(windows.drop("near"), held, False, negatives)
    out = stored(far.join(keyed.select("key", F.col("id").alias("anchor_id")), "key")
                 .join(near.select("key", (F.col("rank") - 1).alias("window"), F.col("id").alias("positive_id"),
                                   F.col("score").alias("positive_score")), ["key", "window"])
                 .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                         F.col("score").alias("negative_score")), "negatives")
    discard(held, keyed, near)
    return out
