"""Mixing: posteriors and rates against plain Python, targets, edge cases."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sublens.llm import mixing
from sublens.llm.queries import labelled_domains, op5_mixing

SF = "/root/testdata/sf0.01"


def test_targets_are_met_on_the_whole_table(spark):
    rows = op5_mixing(spark, SF).collect()
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    n = np.array([r["n_tokens"] for r in rows], dtype=float)
    p = np.array([[r[f"p_{d}"] for d in mixing.TARGETS] for r in rows])
    rate = np.array([r["rate"] for r in rows])
    assert n.tolist() == [len(re.findall(r"[^\x20\x09-\x0D]+", docs[r["doc_id"]]["text"])) for r in rows]
    assert np.allclose(p.sum(1), 1) and (rate >= 0).all()
    got = (rate * n) @ p
    assert np.allclose(got / got.sum(), list(mixing.TARGETS.values()), atol=1e-6)
    assert got.sum() == pytest.approx(n.sum(), rel=1e-6)       # the total stays as it is
    named = np.array(list(mixing.TARGETS))[p.argmax(1)]
    assert np.mean([docs[r["doc_id"]]["lang"] == d for r, d in zip(rows, named, strict=True)]) > 0.95
    copies = np.array([r["copies"] for r in rows])
    assert (np.abs(copies - rate) < 1).all()
    assert abs((copies * n).sum() / (rate * n).sum() - 1) < 0.05


def test_posteriors_equal_plain_naive_bayes(spark):
    docs = spark.createDataFrame([(1, "aa bb aa"), (2, "cc dd"), (3, "Aa\tcc"), (4, None), (5, "zz " * 500)],
                                 "doc_id long, text string")
    rows = spark.createDataFrame([("aa bb", "x"), ("cc cc dd", "y"), ("aa", "x"), ("q", None), ("q", "other")],
                                 "text string, domain string")
    priors, table = mixing.fit_domains(rows, ["x", "y", "z"])
    assert np.allclose(np.exp(priors), [3 / 6, 2 / 6, 1 / 6])
    word = {w: b for w, b in spark.createDataFrame([(w,) for w in ("aa", "bb", "cc", "dd", "zz")], "w string").select(
        "w", mixing._bucket(F.col("w"))).collect()}
    assert len(set(word.values())) == 5
    t = np.array(table).reshape(-1, 3)
    assert np.allclose(np.exp(t[word["aa"]]), [3 / 1027, 1 / 1027, 1 / 1024], rtol=1e-4)
    got = {r["doc_id"]: r for r in mixing.posteriors(docs, (priors, table)).collect()}
    for i, words in {1: ["aa", "bb", "aa"], 2: ["cc", "dd"], 3: ["aa", "cc"], 4: [], 5: ["zz"] * 30}.items():
        log = np.array(priors) + sum((t[word[w]] for w in words), np.zeros(3))
        want = np.exp(log - log.max())
        assert np.allclose(got[i]["_p"], want / want.sum(), atol=1e-6)
    assert got[5]["_n"] == 500 and got[4]["_n"] == 0


@pytest.mark.parametrize("weights,total", [([0.2, 0.3, 0.5], None), ([0.05, 0.05, 0.9], 1500.0), ([0.6, 0.2, 0.2], 900.0), ([0.01, 0.01, 0.98], 40_000.0)])
def test_rates_solve_the_least_squares_problem(spark, weights, total):
    """Against many plain projected gradient steps: same residual; optimality
    conditions hold."""
    rng = np.random.default_rng(6)
    n = rng.integers(1, 40, 80).astype(float)
    p = rng.dirichlet([0.4] * 3, 80)
    rows = spark.createDataFrame([(float(a), b.tolist()) for a, b in zip(n, p, strict=True)], "_n double, _p array<double>")
    moves = mixing.solve_rates(rows, weights, total)
    r = np.array([x[0] for x in rows.select(mixing.rate(moves)).collect()])
    w = np.array(weights) / np.sum(weights)
    a = (n[:, None] * p).T
    t = total if total else n.sum()
    x, step = np.ones(80), 1 / np.linalg.eigvalsh(a @ a.T).max()
    for _ in range(20_000):
        x = np.maximum(x - step * a.T @ (a @ x - w * t), 0)
    best = np.linalg.norm(a @ x - w * t)
    assert (r >= 0).all()
    assert np.linalg.norm(a @ r - w * t) <= best + (0.02 if total == 40_000 else 0.001) * t      # the last is out of reach


@pytest.mark.parametrize("soft", [0.05, 1.0])
def test_default_total_loses_no_row_beside_soft_posteriors(spark, soft):
    """Scarce domains are lifted through mixed rows; rates of the large one stay 1 or more and targets are met."""
    rng = np.random.default_rng(3)
    p = np.eye(4)[rng.choice(4, 2000, p=np.array([70, 10, 10, 5]) / 95)]
    mixed = rng.random(2000) < soft
    p[mixed] = rng.dirichlet([2, 0.5, 0.5, 0.5], mixed.sum())
    n = rng.integers(1, 400, 2000).astype(float)
    rows = spark.createDataFrame([(i, float(a), b.tolist()) for i, (a, b) in enumerate(zip(n, p, strict=True))],
                                 "doc_id long, _n double, _p array<double>")
    out = rows.withColumn("_rate", mixing.rate(mixing.solve_rates(rows, [0.4, 0.2, 0.2, 0.2], least=1.0)))
    got = out.orderBy("doc_id").select("_rate", mixing.copies().alias("c")).collect()
    r = np.array([x["_rate"] for x in got])
    assert (r >= 1).all() and all(x["c"] >= 1 for x in got)
    if soft < 1:
        assert np.allclose((r * n) @ p / (r @ n), [0.4, 0.2, 0.2, 0.2], atol=1e-5)


@pytest.mark.parametrize("share", [0.02, 0.003])
def test_scarce_domains_meet_their_targets(spark, share):
    rng = np.random.default_rng(3)
    k = rng.choice(4, 2000, p=[0.4 - share, 0.3, 0.3, share])
    n = rng.integers(1, 400, 2000).astype(float)
    rows = spark.createDataFrame([(float(a), np.eye(4)[i].tolist()) for a, i in zip(n, k, strict=True)], "_n double, _p array<double>")
    r = np.array([x[0] for x in rows.select(mixing.rate(mixing.solve_rates(rows, [0.4, 0.2, 0.2, 0.2], least=1.0))).collect()])
    assert np.allclose(np.bincount(k, r * n) / (r @ n), [0.4, 0.2, 0.2, 0.2], atol=1e-5) and (r >= 1).all()


def test_absent_domain_is_named_and_leaves_the_others_right(spark):
    rows = spark.createDataFrame([(100.0, [1.0, 0.0, 0.0])] * 9 + [(100.0, [0.0, 1.0, 0.0]), (0.0, [0.3, 0.3, 0.4])],
                                 "_n double, _p array<double>")
    with pytest.warns(UserWarning, match="off their targets"):
        solved = mixing.solve_rates(rows, [0.4, 0.4, 0.2], least=1.0)
    r = [x[0] for x in rows.select(mixing.rate(solved)).collect()]
    assert r[:10] == pytest.approx([1.02] * 9 + [1.02 * 9]) and r[10] == 1


def test_many_copies_of_a_row(spark):
    docs = spark.createDataFrame([(i, "the of and " * 300, "en") for i in range(40)] + [(99, "y", "es")], "doc_id long, text string, lang string")
    out = mixing.mix(docs, docs, docs.select("doc_id", "lang"), targets={"en": 0.5, "es": 0.5}, least=1.0)
    got = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert got[99] > mixing.BLOCK and all(got[i] >= 1 for i in range(40))
    rated = mixing.rated(docs, docs, docs.select("doc_id", "lang"), targets={"en": 0.5, "es": 0.5}, least=1.0).collect()
    share = [sum(r["_rate"] * r["_n"] * r["_p"][i] for r in rated) for i in (0, 1)]
    assert share[1] / sum(share) == pytest.approx(0.5, abs=1e-5)


def test_edge_cases(spark):
    docs = spark.createDataFrame(
        [(1, None, "x", 5), (2, "", "y", 6), (2, "", "y", 6), (None, "der die das", None, 7), (4, "the of " * 50_000, "z", 8)],
        "doc_id long, text string, _note string, lang int")
    labelled = spark.createDataFrame([(4, "en"), (4, "en"), (1, None), (None, "de"), (2, "xx")], "doc_id long, lang string")
    out = mixing.mix(docs, docs, labelled)
    assert out.columns == docs.columns
    assert {r["_note"] for r in out.collect()} >= {"z"}
    rows = mixing.rated(docs, docs, labelled).collect()
    assert len(rows) == 5 and all(r["_rate"] >= 0 for r in rows)
    assert mixing.mix(docs.limit(0), docs, labelled).count() == 0
    assert mixing.rated(docs, docs, labelled.limit(0)).count() == 5
    empty = docs.filter("doc_id < 4")
    assert [r["_rate"] for r in mixing.rated(empty, docs, labelled).collect()] == [1.0] * 3


def test_total_cuts_and_repeats(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labelled = labelled_domains(spark, SF)
    rows = mixing.rated(docs, docs, labelled, total=100_000.0)
    got = rows.agg(F.sum(F.col("_rate") * F.col("_n"))).first()[0]
    assert got == pytest.approx(100_000, rel=1e-3)
    tokens = mixing.mix(docs, docs, labelled, total=100_000.0).select(
        F.sum(F.size(F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")))).first()[0]
    assert 60_000 < tokens < 140_000


def test_no_python_in_the_plan(spark):
    plan = op5_mixing(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_columns_may_have_the_names_of_working_columns(spark):
    names = ["_n", "_p", "_w", "_s", "_log", "_e", "_rate", "_left", "_at", "_copy", "c0", "_r"]
    docs = spark.createDataFrame([(i, f"the of and {i}", "en", *[f"{n}{i}" for n in names]) for i in range(6)],
                                 ["doc_id", "_text", "lang", *names])
    out = mixing.mix(docs, docs, docs.select("doc_id", "lang"), text_col="_text", least=1.0)
    assert out.columns == docs.columns
    assert {tuple(r) for r in out.collect()} == {tuple(r) for r in docs.collect()}
