"""The whole report with two passes over the service table.

The original evaluates 49 independent branches and re-reads the service
table 71 times.  Here:

* pass 1 (``horizon_slice``): every day-relative predicate of the report
  implies a start, end or commence day on or after T - 7, so one scan keeps
  those rows (pushed to Parquet as raw timestamp ranges) and checkpoints
  them; all cohorts and the measure pass below read this slice;
* pass 2 (``keyed_history``): the consumers that need an account's whole
  past (transitions, attribution, the campaign's first commence) get one
  scan of the table, filtered there by Bloom filters of their key sets and joined
  once with these, checkpointed.

Every measure of the original is ``COUNT(DISTINCT account)`` over rows that
satisfy a predicate, possibly AND-ed with account-level tests (test / VIP
exclusion, membership of another cohort).  Because "some row of the account
satisfies p or q" is "some row satisfies p" or "some row satisfies q", all
of them are answered from one bit mask per account:

1. one pass over the slice sets a bit per row predicate; rows with no bit
   set are dropped before the shuffle;
2. small account lists (test, VIP, physical VIP, the campaign cohort, the
   current direct base that has an account row, the transition and
   attribution results) are unioned into the same stream, one bit each;
3. one ``groupBy(account_id)`` with ``bit_or`` — a partially aggregated
   (map-side combined) shuffle of one long per account and map task, so a
   hot account costs no more than any other;
4. playback is read once into a checkpointed viewer-day table, reduced to one
   row per viewer key with a few bits, joined to accounts and then to the
   per-account service bits;
5. a single global aggregation counts every measure; the null-aware
   ``NOT IN`` semantics enter through the lists' one-row facts (empty? holds
   a NULL?), read once per run.

Key-counted measures (21, 25, 27, 43) and total hours (24) are small
aggregations of their own.  The result equals ``report.per_measure_report``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sublens.context import ReportContext
from sublens.functions import domain as d
from sublens.functions import predicates as P
from sublens.operators import membership, setops
from sublens.plans import attribution, engagement, transitions
from sublens.plans.cohorts import BY_ACCOUNT, BY_KEY, HISTORY_KIND, Cohorts
from sublens.plans.measures import result_row
from sublens.session import together
from sublens.sources.staging import RunFolder
from sublens.sources.tables import Sources

ACCOUNT = "account_id"
MASK = "_mask"

# bit positions of the per-account mask
BITS = [
    # row predicates on dim_service
    "newft_m", "newft_a", "newft_b",
    "te_m", "te_a", "te_b",            # free trial EXPIRED, ending on D
    "tfb_m", "tfb_a", "tfb_b",         # free trial FINAL BILL, ending on D
    "churn_m", "churn_a", "churn_b",
    "dcb_new", "dcb_churn", "dcb_pending", "dcb_cur", "dcb_up",
    "cltrial_m", "cltrial_a", "cltrial_b",
    "direct_up", "suspended", "tnew_a", "tnew_b", "pchurn_month",
    "l7_m", "l7_a", "l7_b",
    "clbase_a", "clbase_b", "annual_payment", "partner", "paying_raw",
    # account lists unioned into the stream
    "direct_cur", "campaign", "test", "vip", "vip_table",
    "t3", "t17", "t18", "t19", "t40", "t41", "t42", "m15",
]
BIT = {name: i for i, name in enumerate(BITS)}
assert len(BITS) <= 63


def _bit(name: str) -> Column:
    return F.lit(1 << BIT[name]).cast("long")


def _mask_of(flags: dict[str, Column]) -> Column:
    """OR of the bits whose predicate is TRUE (NULL counts as not set)."""
    terms = [F.when(cond, _bit(name)).otherwise(F.lit(0).cast("long"))
             for name, cond in flags.items()]
    return reduce(lambda a, b: a.bitwiseOR(b), terms)


# -- 1. row bits ------------------------------------------------------------------
def _row_flags(co: Cohorts, calendar_any: str) -> dict[str, Column]:
    ctx, D, T = co.ctx, co.D, co.T
    cur = co.on_calendar & P.active_on(D)
    M, A, B = d.MONTHLY, [d.ANNUAL], [d.BASIC]
    current_ok = P.status_not_in(*d.NOT_CURRENT)
    ft = P.method_in(d.FREE_TRIAL)
    paid = P.method_not_in(*d.NON_PAYING_METHODS)
    dcb = P.dcb_coupon() & P.status_in(*d.DCB_STATUSES)
    l7_first, l7_last = ctx.short_window
    on_cal_any = F.col(calendar_any)

    def newft(p):
        return cur & P.product_in(*p) & current_ok & ft & P.starts_on(D)

    def trial_end(p, status):
        return cur & P.product_in(*p) & P.status_in(status) & ft & P.ends_on(D)

    def churn(p):
        return cur & P.product_in(*p) & P.status_in(d.FINAL_BILL) & P.ends_on(D) & paid

    def cltrial(p):
        return cur & P.product_in(*p) & ft & current_ok

    def tnew(p):
        return (on_cal_any & P.product_in(*p) & current_ok & P.method_in(*d.PAID_METHODS)
                & P.commences_on(D))

    def l7(p):
        return cur & P.product_in(*p) & current_ok & ft & P.starts_between(l7_first, l7_last)

    def clbase(p, methods=d.PAID_METHODS):
        return cur & P.product_in(*p) & P.method_in(*methods) & P.status_not_in(d.INACTIVE)

    return {
        "newft_m": newft(M), "newft_a": newft(A), "newft_b": newft(B),
        "te_m": trial_end(M, d.EXPIRED), "te_a": trial_end(A, d.EXPIRED),
        "te_b": trial_end(B, d.EXPIRED),
        "tfb_m": trial_end(M, d.FINAL_BILL), "tfb_a": trial_end(A, d.FINAL_BILL),
        "tfb_b": trial_end(B, d.FINAL_BILL),
        "churn_m": churn(M), "churn_a": churn(A), "churn_b": churn(B),
        "dcb_new": P.dcb_coupon() & P.commences_on(D),
        "dcb_churn": P.dcb_coupon() & P.status_in(d.FINAL_BILL) & P.ends_on(D),
        "dcb_pending": P.dcb_coupon() & P.status_in(d.FINAL_BILL) & (F.col(P.ED) > F.lit(D)),
        "dcb_cur": dcb & P.active_on(D),
        "dcb_up": dcb & P.upcoming(ctx),
        "cltrial_m": cltrial(M), "cltrial_a": cltrial(A), "cltrial_b": cltrial(B),
        "direct_up": (P.product_in(*M) & P.status_in(d.ACTIVE) & P.method_in(*d.PAID_METHODS)
                      & P.upcoming(ctx)),
        "suspended": (on_cal_any & P.product_in(*M) & P.method_in(*d.PAID_METHODS)
                      & P.status_in(d.HOLDONNPMT) & P.ends_on(ctx.suspended_end)),
        "tnew_a": tnew(A), "tnew_b": tnew(B),
        "pchurn_month": (on_cal_any & P.product_in(*d.ALL_PRODUCTS) & P.status_in(d.FINAL_BILL)
                         & F.col(P.ED).between(F.lit(T), F.lit(ctx.month_last)) & paid),
        "l7_m": l7(M), "l7_a": l7(A), "l7_b": l7(B),
        "clbase_a": clbase(A), "clbase_b": clbase(B),
        "annual_payment": clbase(A, [d.PAYMENT]),
        "partner": (P.partner_coupon() & P.status_in(*d.DCB_STATUSES) & P.method_in(d.VOUCHER)
                    & P.active_on(D)
                    & setops.not_in_values(ACCOUNT, ctx.partner_excluded_ids)),
        "paying_raw": cur & P.product_in(*d.ALL_PRODUCTS) & current_ok & paid,
    }


VARIANTS = [
    transitions.Variant("month", d.MONTHLY, d.MONTHLY, d.MONTHLY),
    transitions.Variant("spa", (d.STANDARD, d.PREMIUM, d.ANNUAL), d.ALL_PRODUCTS, (d.ANNUAL,)),
    transitions.Variant("all", d.ALL_PRODUCTS, d.ALL_PRODUCTS, (d.ANNUAL, d.BASIC)),
]


def keyed_history(co: Cohorts) -> DataFrame:
    """Every service row of the account keys / account ids whose whole past a
    consumer reads: the transitions' owners and the campaign candidates (by
    account key), the attribution candidates (by account id); a row that both ask
    for comes once for each.  The key sets come from the day's slice; a Bloom filter of each
    drops other rows in the scan, and one join on (kind, key) decides."""
    sets = membership.KeySets.of([
        (BY_KEY, transitions.owners(co, VARIANTS), "dim_account_key"),
        (BY_KEY, co.campaign_candidates().where(F.col("dim_account_key").isNotNull()), "dim_account_key"),
        (BY_ACCOUNT, attribution.candidates(co).where(F.col(ACCOUNT).isNotNull()), ACCOUNT)], co.stage)
    return sets.rows(co.src.dim_service, {BY_KEY: "dim_account_key", BY_ACCOUNT: ACCOUNT}, HISTORY_KIND)


def _list_stream(df: DataFrame, bit: str, col: str = ACCOUNT) -> DataFrame:
    return df.select(F.col(col).alias(ACCOUNT), _bit(bit).alias(MASK))


def account_masks(co: Cohorts) -> DataFrame:
    """``(account_id, _mask)``: one row per account (NULL included)."""
    src = co.src
    svc = setops.calendar_cover_flag(co.svc, src.dim_date, P.SD, P.ED, "_cal_any", co.calendar)
    rows = (svc.select(F.col(ACCOUNT), _mask_of(_row_flags(co, "_cal_any")).alias(MASK))
               .where(F.col(MASK) != 0))

    direct_cur = co._with_account_row(co.current(
        P.product_in(*d.MONTHLY), P.status_not_in(*d.NOT_CURRENT),
        P.method_not_in(*d.NON_PAYING_METHODS)))

    moves = transitions.transitions_multi(co, VARIANTS)
    variant = F.col(transitions.VARIANT)
    is_annual = (variant == "all") & (F.col("product_name") == d.ANNUAL)
    is_basic = (variant == "all") & (F.col("product_name") == d.BASIC)
    move_bits = moves.select(F.col(ACCOUNT), _mask_of({
        "t3": (variant == "month") & transitions.winback(),
        "t17": (variant == "spa") & transitions.signup(),
        "t18": is_annual & transitions.winback(),
        "t19": is_annual & transitions.switch_to(d.ANNUAL),
        "t40": is_basic & transitions.signup(),
        "t41": is_basic & transitions.winback(),
        "t42": is_basic & transitions.switch_to(d.BASIC),
    }).alias(MASK)).where(F.col(MASK) != 0)

    streams = [
        rows,
        _list_stream(direct_cur, "direct_cur"),
        _list_stream(co.campaign, "campaign"),
        _list_stream(src.test_accounts, "test"),
        _list_stream(co.vip, "vip"),
        _list_stream(src.vip, "vip_table"),
        move_bits,
        _list_stream(attribution.unattributed_accounts(co), "m15"),
    ]
    stream = reduce(DataFrame.unionByName, streams)
    return stream.groupBy(ACCOUNT).agg(F.bit_or(MASK).alias(MASK))


# -- 4. playback ---------------------------------------------------------------------
def viewer_days(co: Cohorts) -> DataFrame:
    """``(dim_account_key, day, seconds, floor_hit)`` over qualifying content
    from the earliest day any measure reads."""
    floor = co.ctx.play_floor_seconds
    return (engagement.plays(co, co.ctx.engagement_floor)
            .groupBy("dim_account_key", P.day("start_timestamp").alias("day"))
            .agg(F.sum("play_seconds").alias("seconds"),
                 F.max(F.col("play_seconds") >= floor).alias("floor_hit")))


def viewer_bits(co: Cohorts, vd: DataFrame) -> DataFrame:
    ctx, D = co.ctx, co.D
    day = F.col("day")
    s_first, s_last = ctx.short_window
    l_first, l_last = ctx.long_window
    hit = F.coalesce(F.col("floor_hit"), F.lit(False))
    return vd.groupBy("dim_account_key").agg(
        F.max(day == F.lit(D)).alias("e_d"),
        F.max(day.between(F.lit(s_first), F.lit(s_last)) & hit).alias("e_l7"),
        F.max(day.between(F.lit(l_first), F.lit(l_last)) & hit).alias("e_l30"),
        F.max(day >= F.lit(D)).alias("e_ged"))


# -- 5. counting ---------------------------------------------------------------------
# Measure membership per account is written as SQL text over the mask bits:
# one parsed expression per measure instead of a tree of Column calls.
def _has_sql(name: str) -> str:
    return f"((_mask & {1 << BIT[name]}) != 0)"


def _keep_sql(facts: setops.ListFacts, bit: str) -> str:
    """``account_id NOT IN (list)`` from the list's facts and the member bit."""
    if not facts.nonempty:
        return "true"
    if facts.has_null:
        return "false"
    return f"(account_id IS NOT NULL AND (_mask & {1 << BIT[bit]}) = 0)"


def membership_sql(co: Cohorts) -> tuple[dict[int, str], str]:
    """SQL boolean per account-counted measure, and the base of measure 12
    (whose ``NOT IN (campaign)`` is resolved after counting)."""
    h = _has_sql
    kt = _keep_sql(co.test_facts, "test")
    kv = _keep_sql(co.vip_facts, "vip")
    kp = _keep_sql(co.vip_table_facts, "vip_table")
    paying = f"({h('paying_raw')} AND {kt} AND {kv})"
    e_d, e_l30 = "coalesce(e_d, false)", "coalesce(e_l30, false)"
    m = {
        1: f"{h('newft_m')} AND {kt}",
        2: f"{h('te_m')} AND {kt} AND {paying}",
        3: h("t3"),
        4: f"{h('tfb_m')} AND {kt}",
        5: f"{h('churn_m')} AND {kt} AND {kv}",
        6: f"({h('te_m')} OR {h('tfb_m')}) AND {kt}",
        7: f"{h('dcb_new')} AND {kt}",
        8: f"{h('dcb_churn')} AND {kt}",
        9: f"{h('dcb_pending')} AND {kt}",
        10: f"({h('dcb_cur')} OR {h('dcb_up')}) AND {kt}",
        11: f"({h('cltrial_m')} AND {kt}) OR {h('campaign')}",
        13: f"{h('dcb_cur')} AND {kt} AND {e_d}",
        14: f"{h('suspended')} AND {kt}",
        15: h("m15"),
        16: f"{h('tnew_a')} AND {kt}",
        17: h("t17"),
        18: h("t18"),
        19: h("t19"),
        20: f"{h('l7_m')} AND {kt}",
        22: f"(({h('direct_cur')} AND {kt} AND {kv}) OR ({h('direct_up')} AND {kt})) AND {e_l30}",
        23: f"({h('dcb_cur')} OR {h('dcb_up')}) AND {kt} AND {e_l30}",
        26: f"{h('clbase_a')} AND {kt}",
        28: f"{h('newft_a')} AND {kt}",
        29: f"{h('cltrial_a')} AND {kt}",
        30: f"{h('te_a')} AND {kt} AND {paying}",
        31: f"({h('te_a')} OR {h('tfb_a')}) AND {kt}",
        32: f"{h('annual_payment')} AND {kt} AND {e_l30}",
        33: f"{h('newft_b')} AND {kt}",
        34: f"{h('cltrial_b')} AND {kt}",
        35: f"{h('te_b')} AND {kt} AND {paying}",
        36: f"({h('te_b')} OR {h('tfb_b')}) AND {kt}",
        37: f"{h('clbase_b')} AND {kt} AND {e_l30}",
        38: f"{h('tnew_b')} AND {kt}",
        39: f"{h('clbase_b')} AND {kt}",
        40: h("t40"),
        41: h("t41"),
        42: h("t42"),
        44: f"{h('partner')} AND {kt}",
        45: f"{h('pchurn_month')} AND {kt} AND {kv}",
        46: f"{h('churn_b')} AND {kt} AND {kv}",
        47: f"{h('churn_a')} AND {kt} AND {kv}",
        48: f"{h('l7_b')} AND {kt}",
        49: f"{h('l7_a')} AND {kt}",
    }
    base12 = f"({h('direct_cur')} AND {kt} AND {kp}) OR ({h('direct_up')} AND {kt})"
    return m, base12


def _sql_str(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def horizon_slice(src: Sources, ctx: ReportContext) -> DataFrame:
    """Service rows whose start, end or commence day is on or after the
    earliest day any day-relative predicate of the report compares with
    (T - 7).  The condition is also stated on the raw timestamps so the
    Parquet reader can skip row groups."""
    first = min(ctx.short_window[0], ctx.suspended_end, ctx.report_date)
    bound = F.lit(first).cast("timestamp_ntz")
    raw = ((F.col("service_end_date") >= bound) | (F.col("service_start_date") >= bound)
           | (F.col("service_commence_date") >= bound))
    days = ((F.to_date("service_end_date") >= F.lit(first))
            | (F.to_date("service_start_date") >= F.lit(first))
            | (F.to_date("service_commence_date") >= F.lit(first)))
    # the order ids are read by no measure
    return src.dim_service.where(raw & days).drop("evergent_order_id", "evergent_ord_prod_id")


def fused_report(src: Sources, ctx: ReportContext, run: RunFolder | None = None) -> DataFrame:
    spark = src.dim_service.sparkSession
    base = Cohorts(src, ctx, staged=True, run=run)
    # pass 1: the day slice; with it what doesn't need it (events are read once, whatever uses them)
    rows, vd, _, _ = together(
        spark, lambda: base.stage(horizon_slice(src, ctx), "slice"), lambda: base.stage(viewer_days(base), "viewer-days"),
        lambda: base.calendar, lambda: base.test_facts)
    co = base.over(rows)
    # what needs the slice alone, then pass 2: the keyed history
    together(spark, lambda: transitions.owners(co, VARIANTS), lambda: attribution.candidates(co), lambda: co.vip_facts)
    co.use_history(co.stage(keyed_history(co), "history"))
    D = co.D
    acct = account_masks(co)

    vbits = viewer_bits(co, vd)
    keyed = vbits.where(F.col("e_d") | F.col("e_l7") | F.col("e_l30")).join(
        src.dim_account.select("dim_account_key", ACCOUNT), "dim_account_key")
    per_account_eng = keyed.groupBy(ACCOUNT).agg(
        F.max("e_d").alias("e_d"), F.max("e_l30").alias("e_l30"))

    members, base12 = membership_sql(co)
    table = acct.join(per_account_eng, ACCOUNT, "left").selectExpr(
        ACCOUNT,
        *[f"coalesce({c}, false) AS _m{n}" for n, c in members.items()],
        f"coalesce({base12}, false) AS _b12",
        f"{_has_sql('campaign')} AS _cmp")
    aggs = []
    for n in members:
        aggs += [f"count_if(_m{n} AND account_id IS NOT NULL) AS v{n}", f"max(_m{n}) AS e{n}"]
    aggs += ["count_if(_b12 AND account_id IS NOT NULL) AS b12_all",
             "count_if(_b12 AND NOT _cmp AND account_id IS NOT NULL) AS b12_kept",
             "max(_cmp) AS cmp_any",
             "max(_cmp AND account_id IS NULL) AS cmp_null"]
    totals = table.agg(*[F.expr(a) for a in aggs])
    # `NOT IN (campaign)`: an empty list keeps all, a NULL in it keeps none
    v12 = ("CASE WHEN NOT coalesce(cmp_any, false) THEN b12_all "
           "WHEN cmp_null THEN 0 ELSE b12_kept END")
    entries = [(n, f"v{n}", "true" if n not in d.NO_ROW_WHEN_EMPTY else f"coalesce(e{n}, false)")
               for n in members] + [(12, v12, "true")]
    structs = ", ".join(
        f"named_struct('order', {n}, 'measure', {_sql_str(d.MEASURE_NAMES[n])}, "
        f"'value', CAST({v} AS BIGINT), 'emit', {e})" for n, v, e in entries)
    account_rows = (totals.selectExpr(f"explode(array({structs})) AS r")
                    .where("r.emit")
                    .select(F.lit(D).alias("date"), F.col("r.order").cast("int").alias("order"),
                            F.col("r.measure").alias("measure"), F.col("r.value").alias("value")))

    # key-counted measures and hours
    # measure 21's cohort straight from the slice (filtering `acct` instead
    # would push an inferred filter below its aggregate and compute it twice)
    l7_accounts = co.new_trialists(d.MONTHLY, *ctx.short_window).select(ACCOUNT)
    m21_rows = setops.is_in(keyed.where("e_l7"), ACCOUNT, l7_accounts)
    m21 = result_row(m21_rows, F.count_distinct("dim_account_key"), 21, D, True)

    key_viewers = vbits.where("e_ged")
    m25 = result_row(key_viewers, F.count_distinct("dim_account_key"), 25, D, True)

    # per-day hours (truncated per day) over every day read; `day >= D` is a
    # condition of the final aggregate, whose "any such day" decides the row
    daily = (vd.groupBy("day")
               .agg(F.expr(f"sum(seconds) div {ctx.seconds_per_hour}").alias("hours")))
    on_or_after_d = F.col("day") >= F.lit(D)
    m24 = (daily.agg(F.sum(F.when(on_or_after_d, F.col("hours"))).alias("value"),
                     F.max(on_or_after_d).alias("emit"))
                .where(F.coalesce(F.col("emit"), F.lit(False)))
                .select(F.lit(D).alias("date"), F.lit(24).alias("order"),
                        F.lit(d.MEASURE_NAMES[24]).alias("measure"),
                        F.col("value").cast("bigint").alias("value")))

    pending = co.not_test(co.svc.where(P.product_in(d.ANNUAL, d.BASIC)
                                       & (F.col(P.SD) >= F.lit(co.T))))
    per_key = pending.groupBy("dim_account_key").agg(
        F.max(F.col("product_name") == d.ANNUAL).alias("a"),
        F.max(F.col("product_name") == d.BASIC).alias("b"))
    pend = per_key.agg(
        F.count_if(F.col("a") & F.col("dim_account_key").isNotNull()).alias("v27"),
        F.count_if(F.col("b") & F.col("dim_account_key").isNotNull()).alias("v43"))
    pend_rows = pend.selectExpr(
        f"explode(array(named_struct('order', 27, 'measure', {_sql_str(d.MEASURE_NAMES[27])}, "
        f"'value', CAST(v27 AS BIGINT)), named_struct('order', 43, 'measure', "
        f"{_sql_str(d.MEASURE_NAMES[43])}, 'value', CAST(v43 AS BIGINT)))) AS r").select(
        F.lit(D).alias("date"), F.col("r.order").cast("int").alias("order"),
        F.col("r.measure").alias("measure"), F.col("r.value").alias("value"))

    return reduce(DataFrame.unionByName, [account_rows, m21, m24, m25, pend_rows]).orderBy("order")
