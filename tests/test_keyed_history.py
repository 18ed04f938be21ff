"""The keyed history: Bloom filters in the scan, one join, and folds without joins back."""

import re

import pytest
from pyspark.sql import functions as F

from sublens.operators import membership, setops
from sublens.plans import attribution, fused, transitions
from sublens.plans.cohorts import Cohorts
from sublens.sources import fixtures

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in names}
    for k in names:
        spark.conf.set(k, "-1")
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def without_subqueries(plan):
    """Lines of the plan's own tree: a subquery's tree hangs below its ``Subquery`` line."""
    out, deeper = [], None
    for line in plan.splitlines():
        at = len(line) - len(line.lstrip(" :+-"))
        if deeper is not None and at > deeper:
            continue
        deeper = at if re.match(r"[ :+-]*Subquery", line) else None
        if deeper is None:
            out.append(line)
    return "\n".join(out)


def test_filter_holds_every_key_and_few_others(spark):
    keys = spark.range(0, 4000, 2).select(F.when(F.col("id") > 0, F.col("id")).alias("k"))
    bloom = membership.KeyFilter.of(keys, "k", 2000)
    rows = spark.range(0, 40_000).select(F.when(F.col("id") > 0, F.col("id")).alias("k"))
    passed = {r["k"] for r in rows.where(bloom.may_hold(F.col("k"))).collect()}
    assert {r["k"] for r in keys.collect()} <= passed and None in passed
    assert len(passed) < 2000 + 0.02 * 38_000
    assert [membership.bits_for(n) for n in (0, 10 ** 4, 10 ** 12)] == [1 << 12, 1 << 17, 1 << 26]


def test_rows_come_once_for_each_kind(spark):
    rows = spark.createDataFrame([(1, 10, "a"), (2, None, "b"), (3, 30, None), (4, 40, "d"), (4, 40, "d"), (5, 10, "b")],
                                 "id int, k long, a string")
    key_set = spark.createDataFrame([(10,), (10,), (None,)], "k long")
    accounts = spark.createDataFrame([("b",), ("d",)], "a string")
    sets = membership.KeySets.of([("key", key_set, "k"), ("account", accounts, "a")], lambda df: df)
    got = sorted((r["id"], r["kind_of"]) for r in sets.rows(rows, {"key": "k", "account": "a"}, "kind_of").collect())
    assert got == [(1, "key"), (2, "account"), (2, "key"), (4, "account"), (4, "account"), (5, "account"), (5, "key")]
    none = membership.KeySets.of([("key", key_set.limit(0), "k")], lambda df: df)
    assert none.rows(rows, {"key": "k"}, "kind_of").columns == [*rows.columns, "kind_of"]
    assert none.rows(rows, {"key": "k"}, "kind_of").count() == 0


def staged(spark):
    src, ctx = fixtures.load(spark, SF), fixtures.fixture_context()
    base = Cohorts(src, ctx, staged=True)
    return Cohorts(src, ctx, service_rows=base.stage(fused.horizon_slice(src, ctx)), staged=True)


def test_one_join_and_no_shuffle_while_the_keys_are_small(spark):
    plan = without_subqueries(plan_of(fused.keyed_history(staged(spark))))
    assert len(re.findall("BroadcastHashJoin", plan)) == 1 and "SortMergeJoin" not in plan
    assert "Exchange hashpartitioning" not in plan
    assert "getbit" in plan


def test_one_shuffle_beyond_the_broadcast_bound(no_broadcast):
    plan = without_subqueries(plan_of(fused.keyed_history(staged(no_broadcast))))
    assert len(re.findall("SortMergeJoin", plan)) == 1 and "HashAggregate" not in plan
    assert len(re.findall("Exchange hashpartitioning", plan)) == 2           # the rows and the keys
    # rows are dropped by the filter before they are dealt out
    exchange = plan.index("Exchange hashpartitioning")
    assert plan.index("getbit") > exchange and plan.index("FileScan") > plan.index("getbit")


def test_few_rows_pass_the_filter(spark):
    co = staged(spark)
    history = fused.keyed_history(co)
    kept = history.select("dim_service_key").distinct().count()
    sets = membership.KeySets.of([("key", transitions.owners(co, fused.VARIANTS), "dim_account_key")], co.stage)
    passed = co.src.dim_service.where(sets.filters["key"].may_hold(F.col("dim_account_key"))).count()
    assert passed < 0.2 * co.src.dim_service.count() and kept > 0


def test_folds_have_no_join_back(no_broadcast):
    src, ctx = fixtures.load(no_broadcast, SF), fixtures.fixture_context()
    co = Cohorts(src, ctx)
    plan = plan_of(co.campaign)
    assert len(re.findall("SortMergeJoin", plan)) == 1                      # account rows exist: the only join
    assert len(re.findall("SortMergeJoin", plan_of(attribution.unattributed_accounts(co)))) <= \
        1 + len(re.findall("SortMergeJoin", plan_of(attribution.candidates(co))))


def test_rows_at_a_group_minimum(spark):
    rows = spark.createDataFrame([("a", 1, None), ("a", 3, 3), ("b", 2, 2), ("b", 2, None), ("c", None, None), (None, 5, 5)],
                                 "k string, first int, own int")
    got = sorted((r["k"] or "", r["own"]) for r in setops.at_group_min(rows, "k", "first", "own").collect())
    assert got == [("", 5), ("b", 2)]
