"""Every arm of the attribution rule and every excluded id decides about a counted account."""

import dataclasses
import datetime as dt

from builders import World
from sublens.context import ReportContext
from sublens.functions import domain as d
from sublens.plans import attribution, measures
from sublens.plans.cohorts import Cohorts
from test_traps import check

# so that a trial can end before the rule's fixed cut-off and within its greatest gap of D
T = dt.date(2020, 8, 20)
D = T - dt.timedelta(days=1)
CTX = ReportContext(today=T)
CALENDAR = (dt.date(2020, 1, 1), dt.date(2020, 12, 31))

# arm -> (services that no arm claims, the nearest ones that this arm alone claims);
# a service: days from D of its start and end, method.  All have an older service first.
OLDER = (-100, -60, "PAYMENT")
ARMS = {
    "trial before the cut-off": [((-43, -20, "PAYMENT"), (-43, -20, "FREE TRIAL")), ((-44, -20, "FREE TRIAL"), (-45, -22, "FREE TRIAL")),
                                 ((-42, -19, "FREE TRIAL"), (-43, -20, "FREE TRIAL"))],
    "trial without a day": [((-10, -10, "PAYMENT"), (-10, -10, "FREE TRIAL")), ((-11, -10, "FREE TRIAL"), (-10, -10, "FREE TRIAL"))],
    "gap": [((-45, -30, "PAYMENT"), (-45, -31, "PAYMENT"))],
    "tenure": [((-85, -5, "PAYMENT"), (-86, -5, "PAYMENT")), ((-87, -5, "PAYMENT"), (-86, -5, "PAYMENT"))],
    "first service": [((-99, -5, "PAYMENT"), (-100, -5, "PAYMENT"))],
}


def world(services):
    w = World(calendar=CALENDAR)
    day = lambda n: D + dt.timedelta(days=n)
    for account, rows in services.items():
        w.service(account, day(0), day(30), coupon="SparkDCBProd2")
        for first, last, method in rows:
            w.service(account, day(first), day(last), method=method, coupon="PROMO")
    return w


def counted(spark, w, ctx, n):
    return measures.measure(Cohorts(w.sources(spark), ctx), n).first()["value"]


def test_each_arm_decides(spark):
    """In one world: per arm, accounts that are free and their neighbours that only this arm claims."""
    assert CTX.attribution_cutoff == D + dt.timedelta(days=-19)
    free, claimed = {}, {}
    for n, pairs in enumerate(ARMS.values()):
        free |= {1000 + 10 * n + i: [OLDER, pair[0]] for i, pair in enumerate(pairs)}
        claimed |= {2000 + 10 * n + i: [OLDER, pair[1]] for i, pair in enumerate(pairs)}
    # a row without a method ties with the last end: the other row at that end decides
    free[1100] = [OLDER, (-30, -10, "FREE TRIAL"), (-20, -10, None)]
    claimed[2100] = [OLDER, (-10, -10, "FREE TRIAL"), (-20, -10, None)]
    w = world(free | claimed)
    got = {r["account_id"] for r in attribution.unattributed_accounts(Cohorts(w.sources(spark), CTX)).collect()}
    assert got == {str(a) for a in free}
    assert check(spark, w, CTX)[15] == len(free)
    # the first arm's own parameter gives its accounts back
    early = dataclasses.replace(CTX, attribution_cutoff=dt.date(2020, 1, 1))
    assert counted(spark, w, early, 15) == len(free) + len(ARMS["trial before the cut-off"])


def test_each_excluded_id_is_left_out(spark):
    ids = CTX.partner_excluded_ids
    w = World(calendar=CALENDAR)
    for account in [*ids, ids[0][:-1], "77"]:
        w.service(account, D - dt.timedelta(days=3), D + dt.timedelta(days=9), method=d.VOUCHER,
                  coupon=d.PARTNER_COUPON_PREFIX + "01")
    assert check(spark, w, CTX)[44] == 2
    for gone in ids:
        fewer = dataclasses.replace(CTX, partner_excluded_ids=tuple(i for i in ids if i != gone) or ("-",))
        assert counted(spark, w, fewer, 44) == 3
