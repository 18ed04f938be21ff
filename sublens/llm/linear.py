"""What the two text classifiers share: labelled rows, folds, calibration."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sublens.llm.common import text_bytes


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; 0 for a NULL id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(0)) % folds


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, limit: int,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(t, y): up to ``limit`` labelled rows outside the held-out fold, chosen
    by a hash of the id so that every part of the table takes part.  NULL ids
    and NULL labels are left out; a label given twice must agree, else the row
    is left out."""
    given = labels.filter(F.col(label).isNotNull() & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).cast("long").alias("_id")).agg(F.min(label).alias("y"), F.max(label).alias("_y"))
    given = given.filter((F.col("y") == F.col("_y")) & (fold("_id", folds) != held)).select("_id", "y")
    # the hash bound is set from the count, so only about ``limit`` ids go on
    n = given.count()
    mix = F.pmod(F.xxhash64(F.col("_id"), F.lit(17)), F.lit(1 << 30))
    if n > limit:
        given = given.filter(mix < int((1 << 30) * (limit / n)))
    src = docs.select(F.col(id_col).cast("long").alias("_id"), text_bytes(F.col(text_col)).alias("t"))
    # about ``limit`` rows of two numbers: small enough to broadcast by design;
    # a document repeated under one id counts once
    rows = src.join(F.broadcast(given), "_id").select("_id", F.col("y").cast("int").alias("y"), "t")
    return rows.groupBy("_id", "y").agg(F.min("t").alias("t")).select("t", "y")


Extract = Callable[[str], set[str]]


def count_features(rows: DataFrame, extract: Extract, least: int) -> DataFrame:
    """(f, pos, neg): in how many rows (t, y) of each class a feature is
    present, for features in ``least`` rows or more; counted where the texts
    are, added up after."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in (whole.slice(i, 256) for i in range(0, whole.num_rows, 256)):
                counts: dict[str, list[int]] = {}
                for t, y in zip(b.column(0), b.column(1).to_pylist(), strict=True):
                    for f in extract(t.as_py().decode()):
                        counts.setdefault(f, [0, 0])[y == 1] += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(counts), pa.string()), pa.array([c[1] for c in counts.values()], pa.int64()),
                     pa.array([c[0] for c in counts.values()], pa.int64())], ["f", "pos", "neg"])

    found = rows.select("t", "y").mapInArrow(run, "f string, pos long, neg long")
    return found.groupBy("f").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).filter(
        F.col("pos") + F.col("neg") >= least)


def class_sizes(rows: DataFrame) -> tuple[int, int]:
    """Rows with label 0 and with label 1."""
    got = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}      # two rows
    return got.get(0, 0), got.get(1, 0)


def constant(negative: int, positive: int) -> float:
    """Log-odds of label 1 when nothing can be learnt (0 without rows)."""
    p = positive / (positive + negative) if positive + negative else 0.5
    p = min(max(p, 1e-6), 1 - 1e-6)
    return float(np.log(p / (1 - p)))


def platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """a, b of 1 / (1 + exp(-(a * margin + b))), by Newton steps on smoothed targets."""
    pos, neg = float((y == 1).sum()), float((y != 1).sum())
    if not pos or not neg:
        return 1.0, 0.0
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0 / max(float(np.std(margin)), 1e-9), 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g, w = p - target, p * (1 - p) + 1e-12
        ga, gb = float(g @ margin), float(g.sum())
        haa, hab, hbb = float(w @ margin**2) + 1e-6, float(w @ margin), float(w.sum()) + 1e-6
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        a, b = a - da, b - db
        if abs(da) + abs(db) < 1e-9:
            break
    return (a, b) if a > 0 else (1.0 / max(float(np.std(margin)), 1e-9), 0.0)


def sigmoid(x: float) -> float:
    return 1 / (1 + np.exp(-min(max(x, -30.0), 30.0)))
