"""Column builders for the report's row predicates.

All of them are plain Catalyst expressions (codegen'd, pushed to the scan
where the column is raw).  Date literals come from :class:`ReportContext`.

Timestamps are compared as calendar days: ``day(c)`` is ``to_date(c)``.  Where
a filter on a day could prune Parquet row groups, a raw range on the
timestamp is added next to it (``to_date(ts) = d`` alone is not pushed).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from sublens.functions import domain

SD, ED, CD = "_sd", "_ed", "_cd"   # day columns added by `with_days`


def lit_day(day: dt.date) -> Column:
    return F.lit(day)


def day(c: str | Column) -> Column:
    return F.to_date(F.col(c) if isinstance(c, str) else c)


def day_diff(earlier: str | Column, later: str | Column) -> Column:
    """Whole calendar days from ``earlier`` to ``later`` (midnights crossed),
    i.e. ``later - earlier`` on dates; NULL if either is NULL."""
    return F.datediff(day(later), day(earlier))


def ts_from_day(col: str, first: dt.date, last: dt.date | None = None) -> Column:
    """Raw timestamp range equivalent to ``first <= day(col) [<= last]``;
    this form reaches the Parquet reader as pushed filters."""
    c = F.col(col)
    cond = c >= F.lit(first).cast("timestamp_ntz")
    if last is not None:
        cond = cond & (c < F.lit(last + dt.timedelta(days=1)).cast("timestamp_ntz"))
    return cond


def with_days(svc):
    """Add the day of start, end and commence once (`_sd`, `_ed`, `_cd`)."""
    return svc.withColumns({
        SD: day("service_start_date"),
        ED: day("service_end_date"),
        CD: day("service_commence_date"),
    })


def active_on_raw(d: dt.date) -> Column:
    """``active_on(d)`` restated on the raw timestamps (start before the next
    midnight, end at or after midnight of ``d``): the same rows, but in a form
    the Parquet reader can use to skip row groups."""
    nxt = F.lit(d + dt.timedelta(days=1)).cast("timestamp_ntz")
    return ((F.col("service_start_date") < nxt)
            & (F.col("service_end_date") >= F.lit(d).cast("timestamp_ntz")))


# -- service predicates (need `with_days`) ------------------------------------
def active_on(d: dt.date) -> Column:
    """start <= d <= end (both ends inclusive, as days)."""
    return (F.col(SD) <= lit_day(d)) & (F.col(ED) >= lit_day(d))


def starts_on(d: dt.date) -> Column:
    return F.col(SD) == lit_day(d)


def ends_on(d: dt.date) -> Column:
    return F.col(ED) == lit_day(d)


def commences_on(d: dt.date) -> Column:
    return F.col(CD) == lit_day(d)


def starts_between(first: dt.date, last: dt.date) -> Column:
    return F.col(SD).between(lit_day(first), lit_day(last))


def upcoming(ctx) -> Column:
    """start in [T, T + upcoming_days]."""
    return starts_between(ctx.today, ctx.upcoming_last)


def product_in(*products: str) -> Column:
    return F.col("product_name").isin(*products)


def status_in(*statuses: str) -> Column:
    return F.col("service_status").isin(*statuses)


def status_not_in(*statuses: str) -> Column:
    """SQL ``NOT IN`` on literals: a NULL status is dropped."""
    return ~F.col("service_status").isin(*statuses)


def method_in(*methods: str) -> Column:
    return F.col("activation_method").isin(*methods)


def method_not_in(*methods: str) -> Column:
    """SQL ``NOT IN`` on literals: a NULL method is dropped."""
    return ~F.col("activation_method").isin(*methods)


def dcb_coupon() -> Column:
    return F.col("coupon_code").startswith(domain.DCB_COUPON_PREFIX)


def partner_coupon() -> Column:
    return F.col("coupon_code").startswith(domain.PARTNER_COUPON_PREFIX)


def svod() -> Column:
    return F.col("is_svod_flag") == domain.SVOD_YES


# -- engagement predicates -----------------------------------------------------
def qualifying_content(token: str = domain.CONTENT_LABEL_TOKEN) -> Column:
    """Every EPISODE, and FEATUREs whose labels contain ``token`` (any case)."""
    ctype = F.col("content_type")
    return (ctype == domain.EPISODE) | (
        (ctype == domain.FEATURE) & F.lower(F.col("labels")).contains(token.lower()))
