"""Operator-level checks against plain SQL / brute force on small inputs."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sublens.operators import lag, setops


def _vals(df, col):
    return sorted((r[col] for r in df.collect()), key=lambda v: (v is None, v))


@pytest.mark.parametrize("lst,expected", [
    ([], ["a", "b", None]),                 # empty list keeps NULL keys too
    (["a"], ["b"]),                         # NULL key dropped
    (["a", None], []),                      # a NULL in the list drops everything
    ([None], []),
])
def test_not_in_three_valued(spark, lst, expected):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    ls = spark.createDataFrame([(v,) for v in lst], "k string")
    lazy = setops.not_in(df, "k", ls)
    eager = setops.not_in(df, "k", ls, facts=setops.ListFacts.of(ls, "k"))
    df.createOrReplaceTempView("t_df")
    ls.createOrReplaceTempView("t_ls")
    sql = spark.sql("SELECT k FROM t_df WHERE k NOT IN (SELECT k FROM t_ls)")
    assert _vals(lazy, "k") == _vals(eager, "k") == _vals(sql, "k") == \
        sorted(expected, key=lambda v: (v is None, v))


def test_list_facts_many(spark):
    a = spark.createDataFrame([("x",), (None,)], "k string")
    b = spark.createDataFrame([], "k string")
    c = spark.createDataFrame([("y",)], "k string")
    f = setops.ListFacts.many({"a": (a, "k"), "b": (b, "k"), "c": (c, "k")})
    assert f["a"] == setops.ListFacts(True, True)
    assert f["b"] == setops.ListFacts(False, False)
    assert f["c"] == setops.ListFacts(True, False)


def test_is_in_drops_null_keys(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    ls = spark.createDataFrame([("a",), (None,)], "k string")
    assert _vals(setops.is_in(df, "k", ls), "k") == ["a"]


def test_calendar_covers_matches_range_join(spark):
    rnd = random.Random(3)
    base = dt.date(2024, 1, 1)
    cal_days = [base + dt.timedelta(days=i) for i in range(40) if rnd.random() < 0.7]
    rows = []
    for i in range(300):
        s = base + dt.timedelta(days=rnd.randint(-10, 50))
        e = s + dt.timedelta(days=rnd.randint(-3, 8))
        rows.append((i, s, e))
    rows.append((999, None, base))
    df = spark.createDataFrame(rows, "id int, s date, e date")
    cal = spark.createDataFrame([(d,) for d in cal_days], "date_dt date")
    got = {r.id for r in setops.calendar_covers(df, cal, "s", "e").collect()}
    brute = {i for i, s, e in rows if s is not None and any(s <= c <= e for c in cal_days)}
    assert got == brute
    facts = setops.CalendarFacts.of(cal, cal_days[0])
    assert (facts.first, facts.last, facts.holds) == (min(cal_days), max(cal_days), True)
    assert list(facts.dates) == cal_days


def test_rows_at_extremes_keep_ties(spark):
    df = spark.createDataFrame(
        [("a", 1, 5), ("a", 2, 5), ("a", 3, 4), ("b", 4, 1), (None, 5, 2), (None, 6, 2)],
        "g string, id int, v int")
    assert _vals(setops.rows_at_max(df, ["g"], "v"), "id") == [1, 2, 4, 5, 6]
    assert _vals(setops.rows_at_min(df, ["g"], "v"), "id") == [3, 4, 5, 6]


@pytest.mark.parametrize("width,coarse,bound", [(1, 32, 20_000), (4, 3, 20_000), (4, 3, 0), (1 << 20, 32, 20_000)])
def test_prior_row_equals_plain_lag(spark, monkeypatch, width, coarse, bound):
    monkeypatch.setattr(lag, "COARSE", coarse)
    monkeypatch.setattr(lag, "RANGES", coarse * coarse)
    monkeypatch.setattr(lag, "BROADCAST_ROWS", bound)
    rnd = random.Random(width)
    keys = rnd.sample(range(0, 400), 250)
    rows = [(rnd.choice([1, 2, 3, None, 4]), k, rnd.choice(["x", "y", None]),
             rnd.randint(0, 9)) for k in keys]
    # a hot partition: most rows in one group
    rows += [(7, k, "h", k % 5) for k in range(1000, 1400)]
    df = spark.createDataFrame(rows, "p int, k long, s string, n int")
    got = lag.prior_row(df, "p", "k", ["s", "n"], bucket_width=width)
    w = Window.partitionBy("p").orderBy("k")
    want = df.select("*", F.lag("s").over(w).alias("prior_s"), F.lag("n").over(w).alias("prior_n"))
    a = sorted(tuple(r) for r in got.select("k", "prior_s", "prior_n").collect())
    b = sorted(tuple(r) for r in want.select("k", "prior_s", "prior_n").collect())
    assert a == b


def test_sparse_keys_have_no_summary_and_one_shuffle(spark):
    """Keys far apart: no value is hot, so the plan is the plain window."""
    df = spark.range(50_000).select((F.col("id") % 5000).alias("p"), (F.col("id") * 1_000_003).alias("k"))
    assert lag.hot_keys(df, "p", "k", 1 << 10).cuts is None
    out = lag.prior_row(df, "p", "k", ["k"], 1 << 10)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_hot_value_is_cut_into_even_ranges(spark):
    """Keys of a hot value crowd at one end; others stay as they are."""
    df = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(-F.col("id")).alias("p"),
                                    F.expr("id * id * id").alias("k"))
    hot = lag.hot_keys(df, "p", "k", 1000)
    assert (hot.n, hot.ranges) == (1, 20)
    summary_rows = hot.n * hot.ranges
    assert summary_rows < 0.01 * 60_000
    cuts = hot.cuts.first()["_lag_cuts"]
    keys = sorted(r["k"] for r in df.where("p = 7").collect())
    sizes = [sum(lo <= k < hi for k in keys) for lo, hi in zip([-1, *cuts], [*cuts, keys[-1] + 1])]
    assert max(sizes) < 1.3 * 1000
    got = lag.prior_row(df, "p", "k", ["k"], 1000).where("p = 7").select("k", "prior_k").collect()
    assert sorted((r["k"], r["prior_k"]) for r in got) == list(zip(keys, [None, *keys]))


def test_prior_row_with_counts_of_a_wider_table(spark):
    rows = [(v, 1, k, str(k)) for k in range(30) for v in ("x", "y") if (k + len(v)) % 4]
    df = spark.createDataFrame(rows, "t string, p int, k long, s string")
    whole = spark.createDataFrame([(1, k) for k in range(60)] + [(2, 5), (None, 6)], "p int, k long")
    hot = lag.hot_keys(whole, "p", "k", 8)
    assert hot.n == 1
    got = lag.prior_row(df, ["t", "p"], "k", ["s"], hot=hot)
    w = Window.partitionBy("t", "p").orderBy("k")
    want = df.select("*", F.lag("s").over(w).alias("prior_s"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_prior_row_multi_column_partition(spark):
    rows = [("v1", 1, 10, "a"), ("v1", 1, 12, "b"), ("v2", 1, 11, "c"), ("v2", 1, 13, "d")]
    df = spark.createDataFrame(rows, "t string, p int, k long, s string")
    got = {r.k: r.prior_s for r in lag.prior_row(df, ["t", "p"], "k", ["s"], 2).collect()}
    assert got == {10: None, 12: "a", 11: None, 13: "c"}
