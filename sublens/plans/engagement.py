"""playback measures (13, 21-25, 32, 37), one plan each (the fused
report reads playback through ``fused.viewer_days`` instead).

Counting distinct viewers only needs the *set* of viewer keys, so the fact is
reduced to distinct ``dim_account_key`` (partially aggregated map-side)
right after the date / play-floor / content filters and before any join to
accounts or cohorts.  The date filter is also given as a raw timestamp range
so it reaches the Parquet scan (and partition pruning when the fact is
partitioned by day).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sublens.functions import predicates as P
from sublens.operators import setops
from sublens.plans.cohorts import Cohorts


def plays(co: Cohorts, first: dt.date, last: dt.date | None = None,
          min_seconds: int | None = None) -> DataFrame:
    """Fact rows on qualifying content with ``first <= day(start) [<= last]``."""
    fe = co.src.fact_engagement
    day = P.day("start_timestamp")
    cond = P.ts_from_day("start_timestamp", first, last) & (day >= F.lit(first))
    if last is not None:
        cond = cond & (day <= F.lit(last))
    if min_seconds is not None:
        cond = cond & (F.col("play_seconds") >= min_seconds)
    content = co.src.dim_content.where(P.qualifying_content(co.ctx.content_label_token)) \
                                .select(F.col("dim_content_key").alias("_ck"))
    # inner join (not semi): a duplicated content key would repeat plays, as in SQL
    return fe.where(cond).join(content, F.col("dim_content_key") == F.col("_ck")).drop("_ck")


def viewer_keys(co: Cohorts, first, last=None, min_seconds=None) -> DataFrame:
    return plays(co, first, last, min_seconds).select("dim_account_key").distinct()


def viewer_accounts(co: Cohorts, first, last=None, min_seconds=None) -> DataFrame:
    """(dim_account_key, account_id) of viewers that have an account row."""
    keys = viewer_keys(co, first, last, min_seconds)
    return keys.join(co.src.dim_account.select("dim_account_key", "account_id"),
                     "dim_account_key")


def viewers_in(co: Cohorts, cohort_accounts: DataFrame, first, last=None,
               min_seconds=None) -> DataFrame:
    """Viewers whose account id is IN the cohort."""
    return setops.is_in(viewer_accounts(co, first, last, min_seconds), "account_id",
                        cohort_accounts, "account_id")


def daily_hours(co: Cohorts, first: dt.date) -> DataFrame:
    """Per day from ``first`` on (no upper bound): whole hours watched,
    truncated per day (integer division of the day's seconds)."""
    return (plays(co, first)
            .groupBy(P.day("start_timestamp").alias("day"))
            .agg(F.expr(f"sum(play_seconds) div {co.ctx.seconds_per_hour}").alias("hours")))
