"""Hand-written report inputs for trap tests, and a DuckDB mirror of them.

``World`` collects rows with sensible defaults; ``sources(spark)`` turns them
into a ``Sources`` bundle and ``duck()`` registers the same rows in DuckDB
under the report's table names, so the literal SQL oracle can run on them.
"""

from __future__ import annotations

import datetime as dt
import itertools

import duckdb
import pandas as pd

from sublens.checks.oracle_sql import OracleSQL
from sublens.sources.tables import Sources

SCHEMAS = {
    "dim_service": ("dim_service_key bigint, dim_account_key bigint, account_id string, "
                    "product_name string, activation_method string, service_status string, "
                    "service_start_date timestamp_ntz, service_end_date timestamp_ntz, "
                    "service_commence_date timestamp_ntz, coupon_code string, is_svod_flag string, "
                    "evergent_order_id string, evergent_ord_prod_id string"),
    "dim_date": "date_dt date",
    "dim_account": "dim_account_key bigint, account_id string, first_name string, "
                   "last_name string, email string",
    "dim_content": "dim_content_key bigint, content_type string, labels string",
    "fact_engagement": "dim_account_key bigint, dim_content_key bigint, "
                       "start_timestamp timestamp_ntz, play_seconds bigint",
    "test_accounts": "account_id string",
    "vip": "account_id string",
    "ev_op_promotions": "promotion_id bigint, ord_prod_id bigint",
    "ev_promotions": "id bigint, name string",
    "ev_ordered_product": "ord_prod_id bigint, acct_id bigint, srv_start_date timestamp_ntz, "
                          "validity_end_date timestamp_ntz",
    "ev_account": "acct_id bigint, customer_id string, acct_status_id bigint",
    "ev_account_status": "acct_stat_id bigint, description string",
}

CONTENT = [(1, "EPISODE", "drama"), (2, "FEATURE", "film,NEON"), (3, "FEATURE", "film"),
           (4, "TRAILER", "neon")]


def ts(value) -> dt.datetime | None:
    if value is None or isinstance(value, dt.datetime):
        return value
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day)
    s = str(value)
    return dt.datetime.fromisoformat(s if " " in s or "T" in s else s + " 00:00:00")


class World:
    def __init__(self, calendar=(dt.date(2023, 12, 1), dt.date(2024, 12, 31))):
        self._key = itertools.count(1000)
        self.services: list[tuple] = []
        self.accounts: dict[int, str] | None = None      # None: derive from services
        self.extra_accounts: list[tuple] = []
        first, last = calendar
        self.calendar = [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]
        self.content = list(CONTENT)
        self.plays: list[tuple] = []
        self.test: list = []
        self.vip_table: list = []
        self.promos: list[tuple] = []      # (account_id, name, start, end, status)

    def service(self, account, start, end, product="Standard", method="PAYMENT",
                status="ACTIVE", commence=None, coupon=None, svod="Y", key=None,
                account_key=None):
        k = next(self._key) if key is None else key
        acct_key = (int(account) if account is not None else None) if account_key is None \
            else account_key
        self.services.append((k, acct_key, None if account is None else str(account), product,
                              method, status, ts(start), ts(end),
                              ts(commence if commence is not None else start), coupon, svod,
                              str(k), str(k)))
        return k

    def play(self, account_key, day_time, seconds, content=1):
        self.plays.append((account_key, content, ts(day_time), seconds))

    def vip_promo(self, account, name="VIP", start="2024-01-01", end="2024-12-31",
                  status="Active"):
        self.promos.append((str(account), name, ts(start), ts(end), status))

    # -- tables ----------------------------------------------------------------
    def rows(self) -> dict[str, list[tuple]]:
        if self.accounts is None:
            accts = {s[1]: s[2] for s in self.services if s[1] is not None}
            accts.update({p[0]: str(p[0]) for p in self.plays if p[0] is not None})
        else:
            accts = dict(self.accounts)
        dim_account = [(k, a, "n", "n", "n@x") for k, a in sorted(accts.items())]
        dim_account += self.extra_accounts
        names = {"VIP": 0, "SKY Employee Perk": 1, "OTHER": 2}
        statuses = {"Active": 0, "Closed": 1}
        opp, op, ea = [], [], []
        for i, (acct, name, start, end, status) in enumerate(self.promos):
            pid = 9000 + i
            opp.append((names[name], pid))
            op.append((pid, 5000 + i, start, end))
            ea.append((5000 + i, acct, statuses.get(status, 7)))
        return {
            "dim_service": self.services,
            "dim_date": [(d,) for d in self.calendar],
            "dim_account": dim_account,
            "dim_content": self.content,
            "fact_engagement": self.plays,
            "test_accounts": [(a,) for a in self.test],
            "vip": [(a,) for a in self.vip_table],
            "ev_op_promotions": opp,
            "ev_promotions": [(v, k) for k, v in names.items()],
            "ev_ordered_product": op,
            "ev_account": ea,
            "ev_account_status": [(v, k) for k, v in statuses.items()],
        }

    def sources(self, spark) -> Sources:
        return Sources(**{name: spark.createDataFrame(rows, SCHEMAS[name])
                          for name, rows in self.rows().items()})

    def duck(self) -> duckdb.DuckDBPyConnection:
        con = duckdb.connect()
        for name, rows in self.rows().items():
            cols = [c.strip().split(" ")[0] for c in SCHEMAS[name].split(",")]
            types = [c.strip().split(" ")[1] for c in SCHEMAS[name].split(",")]
            ddl = ", ".join(f"{c} {_duck_type(t)}" for c, t in zip(cols, types))
            view = "vip_table" if name == "vip" else name
            con.execute(f"CREATE TABLE {view} ({ddl})")
            if rows:
                df = pd.DataFrame(rows, columns=cols)
                con.register("_rows", df)
                con.execute(f"INSERT INTO {view} SELECT * FROM _rows")
                con.unregister("_rows")
        return con


def _duck_type(t: str) -> str:
    return {"bigint": "BIGINT", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP",
            "date": "DATE"}[t]


def oracle_report(world: World, ctx) -> list[tuple]:
    o = OracleSQL(ctx, base_tables=True)
    rows = world.duck().execute(o.report()).fetchall()
    return sorted((r[1], r[2], r[3]) for r in rows)


def oracle_cohort(world: World, ctx, order: int, key: str = "account_id") -> set:
    o = OracleSQL(ctx, base_tables=True)
    return {r[0] for r in world.duck().execute(o.cohort_keys(order, key)).fetchall()}


def spark_report(df) -> list[tuple]:
    return sorted((r["order"], r["measure"], r["value"]) for r in df.collect())
