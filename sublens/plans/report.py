"""The whole daily report: 49 measures as one tidy table sorted by order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from sublens.context import ReportContext
from sublens.plans import measures
from sublens.plans.cohorts import Cohorts
from sublens.sources.staging import RunFolder
from sublens.sources.tables import Sources

REPORT_COLUMNS = ["date", "order", "measure", "value"]


def per_measure_report(src: Sources, ctx: ReportContext) -> DataFrame:
    """One plan per measure, unioned (UNION ALL: every branch has its own
    order literal, so the original's UNION never removes a row)."""
    co = Cohorts(src, ctx)
    parts = [measures.measure(co, n) for n in sorted(measures.MEASURES)]
    return reduce(DataFrame.unionByName, parts).orderBy("order")


def sql_report(src: Sources, ctx: ReportContext) -> DataFrame:
    """The report as one Spark SQL statement in the original's literal form
    (calendar range joins, ``NOT IN`` subqueries, 49 UNION branches) over
    temp views of the inputs — the baseline the DataFrame plans are measured
    against.  Registers temp views named after the inputs (the physical VIP
    list as ``vip_table``)."""
    from dataclasses import fields

    from sublens.checks.oracle_sql import OracleSQL
    spark = src.dim_service.sparkSession
    for f in fields(src):
        getattr(src, f.name).createOrReplaceTempView("vip_table" if f.name == "vip" else f.name)
    sql = OracleSQL(ctx, base_tables=True, dialect="spark").report()
    return spark.sql(sql).orderBy("order")


def daily_report(src: Sources, ctx: ReportContext, plan: str = "fused", run: RunFolder | None = None) -> DataFrame:
    """The report for ``ctx.report_date``; ``plan`` is "fused" (one pass per
    source table), "per_measure" (one plan per measure) or "sql" (the
    literal statement run by Spark SQL).  With ``run``, what the fused plan keeps for
    several readers goes to that folder, which must live until the result is read."""
    if plan == "per_measure":
        return per_measure_report(src, ctx)
    if plan == "sql":
        return sql_report(src, ctx)
    from sublens.plans import fused
    return fused.fused_report(src, ctx, run)
