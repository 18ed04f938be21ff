"""C07: lifecycle transitions (signup, win-back, product switch) on day D.

For the current subscribers' accounts, service history (filtered *before*
the window, as in the original) is ordered by the service key within the
account key and each service is compared with the one before it.  Only the
services starting on D with a paid method are classified, so the history is
first cut down to the account keys that own such a service: the prior-row
lookup touches those accounts only, not the whole base.

Several variants (different subscriber and history product sets) run as one
pass: each history row is tagged with the variants it belongs to and the
prior-row lookup partitions by (variant, account key).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sublens.functions import domain as d
from sublens.functions import predicates as P
from sublens.operators import lag, setops
from sublens.plans.cohorts import Cohorts

TRANSITION_METHODS = (d.PAYMENT, d.PAYMENT_VOUCHER, d.UNKNOWN)
_PRIOR_COLS = ["product_name", "activation_method", "service_status", "service_end_date"]
VARIANT = "_variant"


@dataclass(frozen=True)
class Variant:
    name: str
    sub_products: tuple          # products of the current-subscriber base
    history_products: tuple      # products of the history the lag runs over
    result_products: tuple       # products of the classified services


def _target(v: Variant, D) -> Column:
    return (P.product_in(*v.result_products) & P.status_not_in(*d.NOT_CURRENT)
            & P.method_in(*TRANSITION_METHODS) & P.starts_on(D))


def transitions_multi(co: Cohorts, variants: list[Variant]) -> DataFrame:
    """Target services of every variant with ``_variant``, the previous
    service's columns (``prior_*``) and ``days_ago``.

    Order of work, so that no step shuffles the whole service table:
    1. target candidates — rows starting on D (a selective scan);
    2. owners — (variant, account key) of the candidates whose account is in the
       variant's current-subscriber base;
    3. history rows, once per variant that they belong to, of the owners' account
       keys only, and of these the ones of a base account;
    4. the prior-row lookup over that history.

    Every join is a left semi join on (variant, account key) or (variant,
    account id) with a list that is not aggregated below it, staged or not, so the
    adaptive planner may broadcast the list or split a hot account's rows.
    """
    made = _made(co, variants)
    owner = made.owners.select(F.col(VARIANT).alias("_ov"), F.col("dim_account_key").alias("_owner"))
    history = _by_variant(co.history_by_key.where(made.in_history), variants, "history_products").join(
        owner, (F.col(VARIANT) == F.col("_ov")) & F.col("dim_account_key").eqNullSafe(F.col("_owner")), "left_semi")
    with_prior = lag.prior_row(made.of_base(history), [VARIANT, "dim_account_key"], "dim_service_key",
                               _PRIOR_COLS, hot=_hot_keys(co))
    return (with_prior.where(made.is_target)
            .withColumn("days_ago", P.day_diff("prior_service_end_date", "service_start_date")))


def _hot_keys(co: Cohorts) -> lag.HotKeys:
    """Account keys with many services, counted once per run over the history that the
    lookups read (a superset of what each does)."""
    if "_hot_history" not in co.__dict__:
        co.__dict__["_hot_history"] = lag.hot_keys(co.history_by_key, "dim_account_key", "dim_service_key",
                                                   co.ctx.lag_bucket_width)
    return co.__dict__["_hot_history"]


def owners(co: Cohorts, variants: list[Variant]) -> DataFrame:
    """(variant, ``dim_account_key``) of the services to classify."""
    return _made(co, variants).owners


def _by_variant(df: DataFrame, variants: list[Variant], products: str) -> DataFrame:
    """Rows once for each variant whose ``products`` hold the row's product."""
    names = F.array(*[F.when(P.product_in(*getattr(v, products)), F.lit(v.name)) for v in variants])
    return df.withColumn(VARIANT, F.explode(F.filter(names, lambda n: n.isNotNull())))


@dataclass(frozen=True)
class _Made:
    """What the steps share, made once per run from the day's service rows."""

    in_history: Column
    is_target: Column
    base: DataFrame           # (_bv, _ba): variant and account id of current subscribers
    owners: DataFrame

    def of_base(self, df: DataFrame) -> DataFrame:
        return _of_base(df, self.base)


def _of_base(df: DataFrame, base: DataFrame) -> DataFrame:
    return df.join(base, (F.col(VARIANT) == F.col("_bv")) & (F.col("account_id") == F.col("_ba")), "left_semi")


def _made(co: Cohorts, variants: list[Variant]) -> _Made:
    made = co.__dict__.setdefault("_owners_made", {})
    key = tuple(variants)
    if key not in made:
        made[key] = _make(co, variants)
    return made[key]


def _make(co: Cohorts, variants: list[Variant]) -> _Made:
    all_sub = sorted({p for v in variants for p in v.sub_products})
    all_hist = sorted({p for v in variants for p in v.history_products})
    in_history = P.product_in(*all_hist) & P.status_not_in(d.INACTIVE)

    any_target, is_target = F.lit(False), F.lit(False)
    for v in variants:
        any_target = any_target | _target(v, co.D)
        is_target = F.when(F.col(VARIANT) == v.name, _target(v, co.D)).otherwise(is_target)
    candidates = co.svc.where(in_history & any_target)

    current = co.not_test(co.current(P.product_in(*all_sub), P.status_not_in(*d.NOT_CURRENT)))
    current = setops.is_in(current, "account_id", candidates.select("account_id"))
    base = co.stage(_by_variant(current, variants, "sub_products").select(
        F.col(VARIANT).alias("_bv"), F.col("account_id").alias("_ba")), "subscribers")
    own = co.stage(_of_base(_by_variant(candidates, variants, "history_products").where(is_target), base)
                   .select(VARIANT, "dim_account_key"), "owners")
    return _Made(in_history, is_target, base, own)


def transitions(co: Cohorts, sub_products, history_products, result_products) -> DataFrame:
    """One variant of :func:`transitions_multi`."""
    v = Variant("v", tuple(sub_products), tuple(history_products), tuple(result_products))
    return transitions_multi(co, [v])


def signup() -> Column:
    return F.col("days_ago").isNull()


def winback() -> Column:
    return F.col("days_ago") > 0


def switch_to(product: str) -> Column:
    return (F.col("days_ago") == 0) & (F.col("prior_product_name") != product)
