import datetime as dt

from pyspark.sql import functions as F

from sublens.context import ReportContext, parse_date
from sublens.functions import predicates as P


def test_report_clock_derivations():
    c = ReportContext(today=dt.date(2024, 3, 1))
    assert c.report_date == dt.date(2024, 2, 29)
    assert c.short_window == (dt.date(2024, 2, 23), dt.date(2024, 2, 29))
    assert c.long_window == (dt.date(2024, 1, 31), dt.date(2024, 2, 29))
    assert c.upcoming_last == dt.date(2024, 3, 30)
    assert c.suspended_end == dt.date(2024, 2, 28)
    assert ReportContext(today=dt.date(2024, 2, 29)).month_last == dt.date(2024, 2, 29)
    assert ReportContext(today=dt.date(2023, 2, 1)).month_last == dt.date(2023, 2, 28)
    assert c.engagement_floor == dt.date(2024, 1, 31)
    assert parse_date("2024-01-31") == parse_date(dt.datetime(2024, 1, 31, 5)) == dt.date(2024, 1, 31)


def test_raw_active_on_equals_day_form_at_boundaries(spark):
    d = dt.date(2024, 1, 30)
    stamps = ["2024-01-29 23:59:59", "2024-01-30 00:00:00", "2024-01-30 23:59:59.999",
              "2024-01-31 00:00:00", None]
    rows = [(s, e) for s in stamps for e in stamps]
    df = spark.createDataFrame(rows, "s string, e string").select(
        F.col("s").cast("timestamp_ntz").alias("service_start_date"),
        F.col("e").cast("timestamp_ntz").alias("service_end_date"),
        F.lit(None).cast("timestamp_ntz").alias("service_commence_date"))
    df = P.with_days(df).select(
        F.coalesce(P.active_on(d), F.lit(False)).alias("day_form"),
        F.coalesce(P.active_on_raw(d), F.lit(False)).alias("raw_form"))
    assert all(r.day_form == r.raw_form for r in df.collect())
