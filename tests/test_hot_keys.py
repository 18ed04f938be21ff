"""A key with a third of the rows is split over tasks in the shuffled joins."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sublens.functions import domain as d
from sublens.operators import setops
from sublens.plans import transitions

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture
def shuffled(spark):
    old = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("op", ["is_in", "not_in"])
def test_hot_account_is_split(shuffled, tmp_path, op):
    rows = shuffled.range(300_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("string").alias("account_id"), "id")
    rows.repartition(8).write.parquet(str(tmp_path / "rows"))
    rows = shuffled.read.parquet(str(tmp_path / "rows"))
    lst = shuffled.range(0, 5000, 7).select(F.col("id").cast("string").alias("account_id"))
    facts = {} if op == "is_in" else {"facts": setops.ListFacts(True, False)}
    out = getattr(setops, op)(rows, "account_id", lst, **facts)
    out.write.format("noop").mode("overwrite").save()
    n = out.count()
    hot = rows.where("account_id = '7'").count()
    assert n >= hot if op == "is_in" else n <= 300_000 - hot
    df = out.agg(F.sum("id"))
    df.collect()
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("literal_days", [50_000, 10])
def test_next_day_across_months_without_a_date(spark, monkeypatch, literal_days):
    monkeypatch.setattr(setops, "LITERAL_DAYS", literal_days)
    dates = [dt.date(2024, 1, 5), dt.date(2024, 4, 2), dt.date(2024, 4, 20)]
    cal = spark.createDataFrame([(d,) for d in [*dates, None, dates[1]]], "date_dt date")
    got = {r["_day"]: r["_next_cal"] for r in setops.next_calendar_day(cal).collect()}
    day, last = dates[0], dates[-1]
    assert len(got) == (last - day).days + 1
    while day <= last:
        assert got[day] == min(d for d in dates if d >= day)
        day += dt.timedelta(days=1)
    svc = spark.createDataFrame([(1, dt.date(2024, 2, 1), dt.date(2024, 3, 31)), (2, dt.date(2024, 2, 1), dt.date(2024, 4, 2)),
                                 (3, dt.date(2023, 1, 1), dt.date(2024, 1, 4)), (4, dt.date(2024, 4, 21), dt.date(2025, 1, 1)),
                                 (5, None, dt.date(2024, 4, 2)), (6, dt.date(2024, 4, 20), None)], "id int, s date, e date")
    out = setops.calendar_covers(svc, cal, "s", "e")
    assert [r["id"] for r in out.collect()] == [2]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and ("Join" in plan) == (literal_days == 10)


def test_hot_account_is_split_in_the_transition_joins(shuffled, tmp_path):
    """Lists that are not aggregated below the join, whether staged or not."""
    rows = shuffled.range(300_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("string").alias("account_id"),
        F.lit(d.MONTHLY[0]).alias("product_name"), "id")
    rows.repartition(8).write.parquet(str(tmp_path / "rows"))
    rows = shuffled.read.parquet(str(tmp_path / "rows"))
    variants = [transitions.Variant("a", d.MONTHLY, d.MONTHLY, d.MONTHLY), transitions.Variant("b", d.MONTHLY, d.MONTHLY, ())]
    base = shuffled.range(0, 5000, 7).select(F.lit("a").alias("_bv"), F.col("id").cast("string").alias("_ba"))
    out = transitions._of_base(transitions._by_variant(rows, variants, "history_products"), base).agg(F.sum("id"), F.count("*").alias("n"))
    hot = rows.where("account_id = '7'").count()
    assert out.collect()[0]["n"] >= hot
    assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
