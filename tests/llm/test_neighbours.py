"""NN-descent and graph search: recall against all pairs, exact ties, edge rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sublens.llm import neighbours, queries

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, every, k=5):
    """All pairs, in double precision; rounded, as sums may differ in their last bits."""
    use = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    width = max((len(v) for _, v in use), default=0)
    ids = np.array([i for i, _ in use])
    m = np.array([np.pad(np.array(v, np.float32).astype(float), (0, width - len(v))) for _, v in use])
    out = []
    for i, v in zip(ids.tolist(), m, strict=True):
        if i % every == 0:
            score = np.round(m @ v / np.linalg.norm(v) / np.linalg.norm(m, axis=1), 9)
            order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
            out += [(i, rank, int(ids[j]), float(score[j])) for rank, j in enumerate(order, 1)]
    return sorted(out)


def found(spark, rows, every=50, **options):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"node": F.lit("x"), "query": F.lit(1), "code": F.lit(2)})
    out = neighbours.nearest(df, F.col("vec_id") % every == 0, **options)
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted((*tuple(r)[:3], round(r["score"], 9)) for r in out.collect())


def recall(got, want):
    return len({r[:1] + r[2:3] for r in got} & {r[:1] + r[2:3] for r in want}) / len(want)


def test_whole_query_reaches_the_recall(spark):
    sf = "/root/testdata/sf0.1"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = sorted((*tuple(r)[:3], round(r["score"], 9)) for r in queries.op12_neighbours(spark, sf).collect())
    want = plain(rows, 50)
    assert len(got) == len(want) == 200
    assert recall(got, want) >= 0.9
    exact = {(q, v): s for q, _, v, s in plain(rows, 50, k=len(rows))}
    assert all(s == pytest.approx(exact[q, v], abs=1e-8) for q, _, v, s in got)


def test_descent_and_search_do_the_work(spark):
    """Leaves of a few nodes and one tree: a poor start."""
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(1500, 16)))]
    options = {"leaf": 8, "trees": 1, "keep": 12, "reverse": 12}
    want = plain(rows, 50)
    poor = found(spark, rows, beam=12, rounds=0, **options)
    good = found(spark, rows, beam=60, rounds=5, **options)
    assert recall(poor, want) < 0.9 <= recall(good, want)


def test_equal_and_near_equal_vectors(spark):
    """A third of the rows is one vector: ties go to the smallest ids."""
    rng = np.random.default_rng(5)
    v = rng.normal(size=(900, 8)).astype(np.float32)
    v[::3] = v[0]
    v[1::9] = v[1] + 1e-3 * rng.normal(size=(100, 8))
    rows = [(i, [float(x) for x in row]) for i, row in enumerate(v)]
    got, want = found(spark, rows), plain(rows, 50)
    assert [r for r in got if r[0] % 150 == 0] == [r for r in want if r[0] % 150 == 0]
    assert recall(got, want) >= 0.9


def test_edge_rows(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (50, [0.0, 2.0]), (1, [3.0, 0.1]), (2, [3.0, 0.1]), (3, None), (4, []), (5, [0.0, -0.0]),
            (6, [float("nan"), 1.0]), (7, [None, 1.0]), (8, [float("inf"), 1.0]), (None, [1.0, 1.0]), (9, [5.0]), (100, None),
            (10, [-1.0, 30.0])]
    assert found(spark, rows) == plain(rows, 50)
    assert found(spark, rows[:1]) == []
    assert found(spark, []) == []
