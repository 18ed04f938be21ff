"""Measure 15: DCB sign-ups on D *not* attributed to the partner (C11, C12).

The original joins every first-DCB row of an account to every service row at
the account's last prior end and every row at its first prior start, and
evaluates a six-arm CASE per combination.  The rows at the last end all share
that end timestamp and the rows at the first start all share that start, so
the only arm that depends on the DCB row (the gap arm) depends on the DCB
day alone, and the arms that depend on the service row do not depend on the
DCB row.  The existence of one combination with no arm true therefore splits
into two per-account existence tests.

The service side is one fold: rows of an account with the same end and start day
differ, for the arms, only in whether some arm on the row alone is true, so they
are combined (map-side) into one row; a window over these few rows gives the account's last
prior end and first prior start, and the rows at that end are judged where
they are.  No row is paired with another and none is joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sublens.functions import domain as d
from sublens.functions import predicates as P
from sublens.plans.cohorts import Cohorts


def _not_true(cond: Column) -> Column:
    return ~F.coalesce(cond, F.lit(False))


def dcb_firsts(co: Cohorts) -> DataFrame:
    """curr_dcb: first DCB start per (account, coupon) over C08 rows."""
    return co.dcb().groupBy("account_id", "coupon_code").agg(
        F.min("service_start_date").alias("dcb_date"))


def candidates(co: Cohorts) -> DataFrame:
    """Accounts with a coupon whose first DCB start is D — the only ones that
    can be counted — with the last first-DCB day over all their coupons.  A
    small list: the joins with the service history filter the scan map-side
    instead of shuffling it.  Made once per run and staged."""
    if "_dcb_candidates" not in co.__dict__:
        co.__dict__["_dcb_candidates"] = co.stage(_make_candidates(co), "attribution")
    return co.__dict__["_dcb_candidates"]


def _make_candidates(co: Cohorts) -> DataFrame:
    return (dcb_firsts(co).groupBy("account_id").agg(
        F.max(P.day("dcb_date")).alias("_last_dcb_day"),
        F.max(P.day("dcb_date") == F.lit(co.D)).alias("_first_dcb_on_d"))
        .where("_first_dcb_on_d"))


def unattributed_accounts(co: Cohorts) -> DataFrame:
    """Accounts counted by measure 15 (``account_id``)."""
    ctx = co.ctx
    per_account = candidates(co)

    trial = F.col("activation_method") == d.FREE_TRIAL
    period = P.day_diff("service_start_date", "service_end_date")
    # what the arms that need nothing but the service row leave open
    open_row = (_not_true(trial & (F.col("service_end_date") < F.lit(ctx.attribution_cutoff))
                          & (period == ctx.attribution_trial_period))
                & _not_true(trial & (period <= 0)) & F.col("activation_method").isNotNull())
    not_prod1 = ~F.col("coupon_code").isin(d.DCB_EXCLUDED_PRIOR_COUPON)
    prior = ~F.col("activation_method").isin(d.INACTIVE) & (F.col(P.ED) <= F.col("_last_dcb_day"))

    # one fold over the accounts' services: a row per (account, end, start day)
    services = co.history_by_account.where(not_prod1 & P.svod()).join(
        per_account.withColumnRenamed("account_id", "_a"), F.col("account_id") == F.col("_a"))
    folded = services.groupBy("account_id", "_last_dcb_day", "service_end_date",
                              P.day("service_start_date").alias("_start_day")).agg(
        F.max(prior).alias("_prior"), F.max(open_row).alias("_open"),
        F.min(F.when(prior, F.col("service_start_date"))).alias("_start"))
    # the last end and the first start among prior services, beside every folded row
    of_account = Window.partitionBy("account_id")
    activation = F.to_date("_activation")
    service_side = (folded.withColumns({
        "_last_end": F.max(F.when(F.col("_prior"), F.col("service_end_date"))).over(of_account),
        "_activation": F.min("_start").over(of_account)})
        .where((F.col("service_end_date") == F.col("_last_end")) & F.col("_open")
               & _not_true(activation == F.col("_start_day"))
               & _not_true(F.datediff(F.col("_start_day"), activation) == ctx.attribution_tenure)))

    gap = F.datediff(F.lit(co.D), P.day("_last_end"))
    return (service_side.where(_not_true(gap > ctx.attribution_max_gap))
            .select("account_id").distinct())
