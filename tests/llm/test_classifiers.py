"""Quality and toxicity classifiers: held-out accuracy, their methods, edge cases."""

import pickle
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sublens.llm import linear, quality, toxicity

SF = "/root/testdata/sf0.1"


def accuracy(spark, module, label, folds, held):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    some = labels.filter("doc_id % 3 > 0")
    out = module.classify(docs.join(some.select("doc_id"), "doc_id", "left_semi"), some)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = out.join(some, "doc_id").collect()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % folds == held)
        assert 0 <= r["score"] <= 1
    test = [r for r in rows if r["held_out"]]
    assert len(test) > 300
    return np.mean([r["predicted"] == r[label] for r in test])


def test_quality_held_out(spark):
    assert accuracy(spark, quality, "quality", 4, 2) > 0.97


def test_toxicity_held_out(spark):
    assert accuracy(spark, toxicity, "toxic", 5, 0) > 0.96


@pytest.mark.parametrize("module,label", [(quality, "quality"), (toxicity, "toxic")])
def test_edge_cases(spark, module, label):
    docs = spark.createDataFrame(
        [(1, None, 0.1), (2, "", 0.2), (2, "", 0.2), (None, "words", None), (3, "w " * 200_000, 1.0), (4, "!!! 12", 2.0)],
        "doc_id int, text string, score double")
    labels = spark.createDataFrame([(1, 1, "x"), (2, 0, None), (None, 1, "y"), (3, None, "z"), (4, 1, "q"), (4, 0, "q")],
                                   f"doc_id int, {label} int, text string")
    rows = module.classify(docs, labels).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == ["1", "2", "2", "3", "4", "None"]
    assert all(0 <= r["score"] <= 1 for r in rows)
    rows = module.classify(docs, labels.limit(0)).collect()
    assert {r["score"] for r in rows} == {0.5}
    assert module.classify(docs.limit(0), labels).count() == 0
    assert module.score(docs, module.fit(docs, labels, label), out_col="_s").columns == [*docs.columns, "_s"]


def test_labels_of_the_held_out_fold_and_other_columns_do_not_matter(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    other = labels.withColumn("quality", F.when(linear.fold("doc_id", 4) == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    swapped = docs.withColumn("lang", F.lit("x")).withColumn("source", F.lit("y"))
    a = quality.classify(docs, labels).orderBy("doc_id").collect()
    assert a == quality.classify(swapped, other).orderBy("doc_id").collect()


def test_sample_is_bounded(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    n = linear.labelled_sample(docs, labels, "toxic", 5, 0, 500).count()
    assert 400 < n < 600


def test_log_count_ratios_and_dual_descent():
    rows = [np.array(x) for x in ([0, 1], [0], [1, 2], [2])]
    y = np.array([1, 1, 0, 0])
    p, q = np.array([3, 2, 1]) / 6, np.array([1, 2, 3]) / 6
    assert np.allclose(quality.log_count_ratios(rows, y, 3), np.log(p / q))
    # against projected gradient on the same objective
    rng = np.random.default_rng(4)
    rows = [np.flatnonzero(rng.random(12) < 0.4) for _ in range(60)]
    y, scale = rng.integers(0, 2, 60), rng.normal(size=12)
    w, b = quality.dual_descent(rows, y, scale, epochs=3000)
    x = np.zeros((60, 13))
    for i, r in enumerate(rows):
        x[i, r] = scale[r]
        x[i, 12] = 1
    s = np.where(y == 1, 1.0, -1.0)

    def loss(v):
        return 0.5 * v @ v + np.maximum(0, 1 - s * (x @ v)).sum()
    k, alpha = (x * s[:, None]) @ (x * s[:, None]).T, np.zeros(60)
    for _ in range(20_000):
        alpha = np.clip(alpha - (k @ alpha - 1) / np.linalg.norm(k, 2), 0, 1)
    assert loss(np.append(w, b)) <= loss((x * s[:, None]).T @ alpha) * 1.001


def test_counterfactual_penalty_lowers_scores_of_neutral_mentions(spark):
    rng = np.random.default_rng(2)
    words = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(8) for j in range(8)]

    def say(*extra):
        return " ".join([*rng.choice(words, 8), *extra])
    texts = [say("muslims", "scum") for _ in range(120)] + [say("muslims") for _ in range(5)] + [say() for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 120)) for i in range(len(texts))], "doc_id long, toxic int")
    plain = pickle.loads(toxicity.fit(docs, labels, counterfactual=0.0))
    fair = pickle.loads(toxicity.fit(docs, labels))
    neutral, toxic = "the muslims went home", "these muslims are scum"
    assert fair.score(neutral) < 0.5 * plain.score(neutral)
    assert abs(fair.score(neutral) - fair.score("the people went home")) < 0.05
    assert fair.score(toxic) > 0.5
    pairs = list(toxicity.counterfactuals("Nothing. The muslims left! Women stay"))
    assert len(pairs) == 4 and all(a != b for a, b in pairs)


def test_likelihood_ratio(spark):
    rows = spark.createDataFrame([(5, 0), (0, 0), (10, 90), (40, 3), (100, 900)], "pos long, neg long")
    got = [r[0] for r in rows.select(toxicity.likelihood_ratio(100, 900)).collect()]

    def log_likelihood(k, n, p):
        return (k * np.log(p) if k else 0) + ((n - k) * np.log(1 - p) if k < n else 0)
    for (a, b), g in zip([(5, 0), (0, 0), (10, 90), (40, 3)], got, strict=False):
        p = (a + b) / 1000
        want = 2 * (log_likelihood(a, 100, a / 100) + log_likelihood(b, 900, b / 900)
                    - log_likelihood(a, 100, p) - log_likelihood(b, 900, p))
        assert abs(g - want) < 1e-9
