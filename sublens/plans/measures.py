"""The 49 measures, one DataFrame plan each.

``measure(co, n)`` returns the measure's result rows ``(date, order, measure,
value)`` — one row, or none for the measures whose original groups by the
report date and whose cohort is empty.  ``cohort(co, n)`` returns the rows the
measure counts (one key column), which tests compare key by key.

These per-measure plans are the straightforward form: every measure scans
what it needs.  ``plans.fused`` computes the same 49 values with two passes
over the service table and one over playback.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sublens.functions import domain as d
from sublens.functions import predicates as P
from sublens.operators import setops
from sublens.plans import attribution, engagement, transitions
from sublens.plans.cohorts import Cohorts

ACCOUNT = "account_id"
ACCOUNT_KEY = "dim_account_key"


@dataclass(frozen=True)
class MeasureSpec:
    order: int
    key: str                                  # column counted (distinct)
    rows: Callable[[Cohorts], DataFrame]      # the counted rows
    value: Callable[[DataFrame], Column] | None = None   # override of count(distinct key)

    @property
    def name(self) -> str:
        return d.MEASURE_NAMES[self.order]

    @property
    def no_row_when_empty(self) -> bool:
        return self.order in d.NO_ROW_WHEN_EMPTY


# -- F1 row predicates ----------------------------------------------------------
def _new_free_trialists(products):
    def rows(co: Cohorts):
        return co.not_test(co.current(P.product_in(*products), P.status_not_in(*d.NOT_CURRENT),
                                      P.method_in(d.FREE_TRIAL), P.starts_on(co.D)))
    return rows


def _trial_ended(products, statuses):
    def rows(co: Cohorts):
        return co.not_test(co.current(P.product_in(*products), P.status_in(*statuses),
                                      P.method_in(d.FREE_TRIAL), P.ends_on(co.D)))
    return rows


def _trial_converted(products):
    """a trial that expired on D, on an account that is paying on D."""
    def rows(co: Cohorts):
        expired = _trial_ended(products, [d.EXPIRED])(co)
        return setops.is_in(expired, ACCOUNT, co.paying)
    return rows


def _paying_churn(products):
    def rows(co: Cohorts):
        r = co.current(P.product_in(*products), P.status_in(d.FINAL_BILL), P.ends_on(co.D),
                       P.method_not_in(*d.NON_PAYING_METHODS))
        return co.not_vip(co.not_test(r))
    return rows


def _closing_trialists(products):
    def rows(co: Cohorts):
        return co.not_test(co.current(P.product_in(*products), P.method_in(d.FREE_TRIAL),
                                      P.status_not_in(*d.NOT_CURRENT)))
    return rows


def _new_trialists_l7d(products):
    def rows(co: Cohorts):
        first, last = co.ctx.short_window
        return co.new_trialists(products, first, last)
    return rows


def _total_new(product):
    def rows(co: Cohorts):
        r = co.rows(P.product_in(product), P.status_not_in(*d.NOT_CURRENT),
                    P.method_in(*d.PAID_METHODS), P.commences_on(co.D))
        return co.not_test(co.any_calendar_day(r))
    return rows


def _closing_base(product):
    def rows(co: Cohorts):
        return co.not_test(co.current(P.product_in(product), P.method_in(*d.PAID_METHODS),
                                      P.status_not_in(d.INACTIVE)))
    return rows


def _pending(product):
    def rows(co: Cohorts):
        return co.not_test(co.rows(P.product_in(product), F.col(P.SD) >= F.lit(co.T)))
    return rows


def _m7(co):
    return co.not_test(co.rows(P.dcb_coupon(), P.commences_on(co.D)))


def _m8(co):
    return co.not_test(co.rows(P.dcb_coupon(), P.status_in(d.FINAL_BILL), P.ends_on(co.D)))


def _m9(co):
    return co.not_test(co.rows(P.dcb_coupon(), P.status_in(d.FINAL_BILL),
                               F.col(P.ED) > F.lit(co.D)))


def _m10(co):
    return co.dcb()


def _m11(co):
    trialists = _closing_trialists(d.MONTHLY)(co).select(ACCOUNT)
    return trialists.unionByName(co.campaign)


def _m12(co):
    base = co.direct_paying(co.not_vip_table)
    return setops.not_in(base, ACCOUNT, co.campaign)


def _m14(co):
    r = co.rows(P.product_in(*d.MONTHLY), P.method_in(*d.PAID_METHODS),
                P.status_in(d.HOLDONNPMT), P.ends_on(co.ctx.suspended_end))
    return co.not_test(co.any_calendar_day(r))


def _m44(co):
    r = co.rows(P.partner_coupon(), P.status_in(*d.DCB_STATUSES), P.method_in(d.VOUCHER),
                P.active_on(co.D),
                setops.not_in_values(ACCOUNT, co.ctx.partner_excluded_ids))
    return co.not_test(r)


def _m45(co):
    r = co.rows(P.product_in(*d.ALL_PRODUCTS), P.status_in(d.FINAL_BILL),
                F.col(P.ED).between(F.lit(co.T), F.lit(co.ctx.month_last)),
                P.method_not_in(*d.NON_PAYING_METHODS))
    return co.not_vip(co.not_test(co.any_calendar_day(r)))


# -- F3 transitions -----------------------------------------------------------------
def _transition(sub_products, history_products, product, cls):
    def rows(co: Cohorts):
        t = transitions.transitions(co, sub_products, history_products, [product])
        return t.where(cls(product) if cls is transitions.switch_to else cls())
    return rows


_SP = d.MONTHLY
_SPA = (d.STANDARD, d.PREMIUM, d.ANNUAL)
_ALL = d.ALL_PRODUCTS


def _m3(co):
    t = transitions.transitions(co, _SP, _SP, _SP)
    return t.where(transitions.winback())


# -- F5 attribution ----------------------------------------------------------------------
def _m15(co):
    return attribution.unattributed_accounts(co)


# -- F6 engagement ----------------------------------------------------------------------
def _m13(co):
    return engagement.viewers_in(co, co.dcb_current().select(ACCOUNT), co.D, co.D)


def _m21(co):
    first, last = co.ctx.short_window
    cohort = _new_trialists_l7d(d.MONTHLY)(co).select(ACCOUNT)
    return engagement.viewers_in(co, cohort, first, last, co.ctx.play_floor_seconds)


def _long_window_viewers(cohort_fn):
    def rows(co: Cohorts):
        first, last = co.ctx.long_window
        return engagement.viewers_in(co, cohort_fn(co), first, last, co.ctx.play_floor_seconds)
    return rows


def _annual_payment_base(co):
    return co.not_test(co.current(P.product_in(d.ANNUAL), P.method_in(d.PAYMENT),
                                  P.status_not_in(d.INACTIVE))).select(ACCOUNT)


def _basic_paying_base(co):
    return _closing_base(d.BASIC)(co).select(ACCOUNT)


def _m24_rows(co):
    return engagement.daily_hours(co, co.D)


def _m25(co):
    return engagement.viewer_keys(co, co.D)


MEASURES: dict[int, MeasureSpec] = {s.order: s for s in [
    MeasureSpec(1, ACCOUNT, _new_free_trialists(d.MONTHLY)),
    MeasureSpec(2, ACCOUNT, _trial_converted(d.MONTHLY)),
    MeasureSpec(3, ACCOUNT, _m3),
    MeasureSpec(4, ACCOUNT, _trial_ended(d.MONTHLY, [d.FINAL_BILL])),
    MeasureSpec(5, ACCOUNT, _paying_churn(d.MONTHLY)),
    MeasureSpec(6, ACCOUNT, _trial_ended(d.MONTHLY, [d.EXPIRED, d.FINAL_BILL])),
    MeasureSpec(7, ACCOUNT, _m7),
    MeasureSpec(8, ACCOUNT, _m8),
    MeasureSpec(9, ACCOUNT, _m9),
    MeasureSpec(10, ACCOUNT, _m10),
    MeasureSpec(11, ACCOUNT, _m11),
    MeasureSpec(12, ACCOUNT, _m12),
    MeasureSpec(13, ACCOUNT, _m13),
    MeasureSpec(14, ACCOUNT, _m14),
    MeasureSpec(15, ACCOUNT, _m15),
    MeasureSpec(16, ACCOUNT, _total_new(d.ANNUAL)),
    MeasureSpec(17, ACCOUNT, _transition(_SPA, _ALL, d.ANNUAL, transitions.signup)),
    MeasureSpec(18, ACCOUNT, _transition(_ALL, _ALL, d.ANNUAL, transitions.winback)),
    MeasureSpec(19, ACCOUNT, _transition(_ALL, _ALL, d.ANNUAL, transitions.switch_to)),
    MeasureSpec(20, ACCOUNT, _new_trialists_l7d(d.MONTHLY)),
    MeasureSpec(21, ACCOUNT_KEY, _m21),
    MeasureSpec(22, ACCOUNT, _long_window_viewers(lambda co: co.direct_paying(co.not_vip))),
    MeasureSpec(23, ACCOUNT, _long_window_viewers(lambda co: co.dcb().select(ACCOUNT))),
    MeasureSpec(24, "hours", _m24_rows, value=lambda df: F.sum("hours")),
    MeasureSpec(25, ACCOUNT_KEY, _m25),
    MeasureSpec(26, ACCOUNT, _closing_base(d.ANNUAL)),
    MeasureSpec(27, ACCOUNT_KEY, _pending(d.ANNUAL)),
    MeasureSpec(28, ACCOUNT, _new_free_trialists([d.ANNUAL])),
    MeasureSpec(29, ACCOUNT, _closing_trialists([d.ANNUAL])),
    MeasureSpec(30, ACCOUNT, _trial_converted([d.ANNUAL])),
    MeasureSpec(31, ACCOUNT, _trial_ended([d.ANNUAL], [d.EXPIRED, d.FINAL_BILL])),
    MeasureSpec(32, ACCOUNT, _long_window_viewers(_annual_payment_base)),
    MeasureSpec(33, ACCOUNT, _new_free_trialists([d.BASIC])),
    MeasureSpec(34, ACCOUNT, _closing_trialists([d.BASIC])),
    MeasureSpec(35, ACCOUNT, _trial_converted([d.BASIC])),
    MeasureSpec(36, ACCOUNT, _trial_ended([d.BASIC], [d.EXPIRED, d.FINAL_BILL])),
    MeasureSpec(37, ACCOUNT, _long_window_viewers(_basic_paying_base)),
    MeasureSpec(38, ACCOUNT, _total_new(d.BASIC)),
    MeasureSpec(39, ACCOUNT, _closing_base(d.BASIC)),
    MeasureSpec(40, ACCOUNT, _transition(_ALL, _ALL, d.BASIC, transitions.signup)),
    MeasureSpec(41, ACCOUNT, _transition(_ALL, _ALL, d.BASIC, transitions.winback)),
    MeasureSpec(42, ACCOUNT, _transition(_ALL, _ALL, d.BASIC, transitions.switch_to)),
    MeasureSpec(43, ACCOUNT_KEY, _pending(d.BASIC)),
    MeasureSpec(44, ACCOUNT, _m44),
    MeasureSpec(45, ACCOUNT, _m45),
    MeasureSpec(46, ACCOUNT, _paying_churn([d.BASIC])),
    MeasureSpec(47, ACCOUNT, _paying_churn([d.ANNUAL])),
    MeasureSpec(48, ACCOUNT, _new_trialists_l7d([d.BASIC])),
    MeasureSpec(49, ACCOUNT, _new_trialists_l7d([d.ANNUAL])),
]}


def cohort(co: Cohorts, order: int) -> DataFrame:
    """The distinct keys measure ``order`` counts (one column)."""
    spec = MEASURES[order]
    return spec.rows(co).select(spec.key).where(F.col(spec.key).isNotNull()).distinct()


def result_row(rows: DataFrame, value: Column, order: int, report_date,
               no_row_when_empty: bool) -> DataFrame:
    """Aggregate ``rows`` to the report row ``(date, order, measure, value)``.

    Without a grouping key an aggregate returns one row even on empty input
    (COUNT = 0); grouped by the constant report date it returns none.
    """
    if no_row_when_empty:
        agg = rows.groupBy(F.lit(report_date).alias("date")).agg(value.alias("value"))
    else:
        agg = rows.agg(value.alias("value")).select(F.lit(report_date).alias("date"), "value")
    return agg.select(
        F.col("date"),
        F.lit(order).cast("int").alias("order"),
        F.lit(d.MEASURE_NAMES[order]).alias("measure"),
        F.col("value").cast("bigint").alias("value"))


def measure(co: Cohorts, order: int) -> DataFrame:
    spec = MEASURES[order]
    rows = spec.rows(co)
    value = spec.value(rows) if spec.value else F.count_distinct(F.col(spec.key))
    return result_row(rows, value, order, co.D, spec.no_row_when_empty)
