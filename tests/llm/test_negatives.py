"""Hard negatives against brute force, and what the pruning may leave out."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sublens.llm import negatives
from sublens.llm.negatives import FAR, Bucket

SCHEMA = "vec_id long, label int, embedding array<float>"


def floor_vec(v):
    return [math.floor(256 * float(np.float32(x))) for x in v]


def plain(rows, every=100, npos=5, nneg=10):
    use = [(i, label, floor_vec(v)) for i, label, v in rows
           if i is not None and label is not None and v is not None
           and all(x is not None and math.isfinite(x) for x in v)]

    def dot(a, b):
        return max(-FAR, min(FAR, sum(x * y for x, y in zip(a, b, strict=False))))

    out = []
    for i, label, v in {(i, label, tuple(v)) for i, label, v in use if i % every == 0}:
        scored = sorted(((-dot(v, w), j, other) for j, other, w in use if j != i))
        for s, j, _ in [x for x in scored if x[2] == label][:npos]:
            far = [x for x in scored if x[2] != label and 30 * -s <= 100 * -x[0] <= 90 * -s][:nneg]
            out += [(i, j, rank, k, -s, -t) for rank, (t, k, _) in enumerate(far, 1)]
    return sorted(out)


def mined(spark, rows, every=100):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"id": F.lit("x"), "key": F.lit(1), "rank": F.lit(2)})
    out = negatives.hard_negatives(df.repartition(3), F.col("vec_id") % every == 0)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in out.collect())


def clustered(rng, n, d=12, labels=4):
    """Vectors about a few axes, of many lengths: the ranges of coordinates are narrow."""
    axes = rng.normal(size=(6, d)) * (rng.random((6, d)) < 0.3)
    v = axes[rng.integers(0, 6, n)] + 0.05 * rng.normal(size=(n, d))
    v *= rng.lognormal(sigma=0.7, size=(n, 1))
    return [(int(i), int(rng.integers(0, labels)), [float(x) for x in row]) for i, row in enumerate(v)]


@pytest.mark.parametrize("bucket,slot", [(8192, 8), (16, 2)])
def test_equals_brute_force(spark, monkeypatch, bucket, slot):
    monkeypatch.setattr(negatives.buckets, "__defaults__", (bucket,))
    monkeypatch.setattr(negatives.first_rows, "__defaults__", (slot,))
    rows = clustered(np.random.default_rng(bucket), 400)
    want = plain(rows, every=20)
    assert mined(spark, rows, every=20) == want and len(want) > 500


def test_edge_rows(spark):
    rows = [(0, 1, [1.0, 0.5]), (0, 1, [1.0, 0.5]), (100, 1, [0.9, 0.1]), (1, 1, [1.0]), (2, 2, [0.5, 0.25]), (2, 2, [0.5, 0.25]),
            (3, 2, [0.5, 0.25]), (4, None, [1.0, 1.0]), (5, 2, None), (6, 2, [float("nan"), 1.0]), (7, 2, [None, 1.0]),
            (8, 2, [float("inf"), 1.0]), (None, 2, [0.5, 0.5]), (200, 9, []), (9, 9, []), (300, 3, [-1.0, -1.0]), (10, 3, [1.0, 1.0]),
            (400, 4, [3e30, 1.0]), (11, 4, [3e30, 2.0]), (12, 5, [1e30, 1.0]), (13, 5, [1.0, 1.0]), (14, 5, [0.0, 0.0])]
    assert mined(spark, rows) == plain(rows)
    assert mined(spark, []) == []


def test_pruning_keeps_what_reaches_the_score_and_drops_rows():
    rng = np.random.default_rng(2)
    rows = clustered(rng, 600)
    parts = np.array([floor_vec(np.array(v) / np.linalg.norm(v)) for _, _, v in rows])     # of like lengths
    unit, lengths = negatives._unit(parts)
    bucket = Bucket({"label": "a", "longest": float(lengths.max()), "width": parts.shape[1],
                     "ids": np.arange(len(parts)).tobytes(), "parts": parts.astype(np.int32).tobytes(),
                     "orders": np.argsort(unit, axis=0).T.astype(np.int32).tobytes()})
    met = 0
    for anchor in parts[:100]:
        scores = parts @ anchor
        least = float(np.sort(scores)[-5])
        found = bucket.candidates(anchor, least)
        if found is not None:
            assert set(np.flatnonzero(scores >= least)) <= set(found.tolist())
            met += len(found)
    assert met < 0.5 * 100 * len(parts)
