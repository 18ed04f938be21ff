"""Map the driver's generated tables onto the report's input schemas.

The mapping is pure column arithmetic (no hashing, no randomness) so that a
second engine given the same rules produces the same rows.  Every derived
table but the membership lists is a projection of a whole driver table, so its
size grows with the scale factor exactly as the source does; the lists (test
accounts, VIP accounts, promoted orders) hold a fixed share of their sources.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sublens.context import ReportContext
from sublens.sources.tables import Sources

# FIXED VALUES of the fixture mapping
EPOCH = "1995-01-01"          # origin of the order-date offset
SERVICE_BASE_DAY = "2024-01-01"
OFFSET_CYCLE_DAYS = 60
CALENDAR_FIRST = "2023-12-01"
CALENDAR_LAST = "2024-12-31"
CALENDAR_GAP = ("2024-02-05", "2024-02-16")      # days that the calendar lacks
FIXTURE_TODAY = dt.date(2024, 1, 31)
FIXTURE_CAMPAIGN_FIRST = dt.date(2024, 1, 5)
FIXTURE_CAMPAIGN_LAST = dt.date(2024, 1, 11)
FIXTURE_CAMPAIGN_END_CAP = dt.date(2024, 3, 17)
PROMOTIONS = [(0, "VIP"), (1, "SKY Employee Perk"), (2, "OTHER A"), (3, "OTHER B")]
ACCOUNT_STATUSES = [(0, "Active"), (1, "Closed")]


def fixture_context(today: dt.date = FIXTURE_TODAY) -> ReportContext:
    """Report clock and campaign window that give non-empty cohorts on the
    driver's data (events cover 2024-01-01 .. 2024-01-30)."""
    return ReportContext(
        today=today,
        campaign_first=FIXTURE_CAMPAIGN_FIRST,
        campaign_last=FIXTURE_CAMPAIGN_LAST,
        campaign_end_cap=FIXTURE_CAMPAIGN_END_CAP,
    )


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _day_ts(day: Column, plus_days: Column | int = 0) -> Column:
    """date + n days as a timestamp without time zone (midnight)."""
    return F.date_add(day, plus_days).cast("timestamp_ntz")


def _service_columns(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    off = F.datediff(F.to_date("o_orderdate"), F.lit(EPOCH).cast("date")) % OFFSET_CYCLE_DAYS
    start_day = F.date_add(F.lit(SERVICE_BASE_DAY).cast("date"), off)
    return orders.select(
        k.alias("o_orderkey"),
        F.col("o_custkey"),
        F.col("o_orderstatus"),
        F.col("o_orderpriority"),
        start_day.cast("timestamp_ntz").alias("service_start_date"),
        _day_ts(start_day, (k % 31).cast("int")).alias("service_end_date"),
        _day_ts(start_day, F.when(k % 3 == 0, 0).otherwise(k % 10).cast("int") * -1)
        .alias("service_commence_date"),
    )


def dim_service(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    base = _service_columns(orders)
    product = (F.when(F.col("o_orderpriority") == "1-URGENT", "Annual")
               .when(F.col("o_orderpriority") == "2-HIGH", "Premium")
               .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "Basic")
               .otherwise("Standard"))
    m7 = k % 7
    method = (F.when(m7.isin(0, 1), "FREE TRIAL").when(m7 == 2, "PAYMENT_VOUCHER")
              .when(m7 == 3, "VOUCHER").when(m7 == 4, "UNKNOWN").otherwise("PAYMENT"))
    status = (F.when(k % 13 == 0, "INACTIVE").when(k % 11 == 0, "HOLDONNPMT")
              .when(F.col("o_orderstatus") == "F", "EXPIRED")
              .when(F.col("o_orderstatus") == "P", "FINAL BILL")
              .when(F.col("o_orderstatus") == "O", "ACTIVE"))
    m9 = k % 9
    coupon = (F.when(m9 == 0, "SparkDCBProd1").when(m9 == 1, "SparkDCBProd2")
              .when(m9 == 2, "2DGBB01").when(m9.isin(3, 4), F.lit(None).cast("string"))
              .otherwise("PROMO"))
    return base.select(
        k.alias("dim_service_key"),
        F.col("o_custkey").alias("dim_account_key"),
        F.col("o_custkey").cast("string").alias("account_id"),
        product.alias("product_name"),
        method.alias("activation_method"),
        status.alias("service_status"),
        "service_start_date",
        "service_end_date",
        "service_commence_date",
        coupon.alias("coupon_code"),
        F.when(k % 5 == 0, "N").otherwise("Y").alias("is_svod_flag"),
        k.cast("string").alias("evergent_order_id"),
        k.cast("string").alias("evergent_ord_prod_id"),
    )


def dim_account(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.col("c_custkey").alias("dim_account_key"),
        F.col("c_custkey").cast("string").alias("account_id"),
        F.col("c_name").alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.concat(F.col("c_name"), F.lit("@x")).alias("email"),
    )


def dim_date(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(CALENDAR_FIRST).cast("date"),
                             F.lit(CALENDAR_LAST).cast("date"))).alias("date_dt")
    ).where(~F.col("date_dt").between(*[F.lit(d).cast("date") for d in CALENDAR_GAP]))


def dim_content(part: DataFrame) -> DataFrame:
    t = F.col("p_type")
    ctype = (F.when(t.isin("STANDARD", "MEDIUM", "LARGE"), "EPISODE")
             .when(t.isin("PROMO", "SMALL"), "FEATURE").otherwise("TRAILER"))
    labels = F.when(F.col("p_size") % 2 == 0, F.concat(F.col("p_name"), F.lit(",Neon"))) \
              .otherwise(F.col("p_name"))
    return part.select(F.col("p_partkey").alias("dim_content_key"),
                       ctype.alias("content_type"), labels.alias("labels"))


def fact_engagement(events: DataFrame, part: DataFrame) -> DataFrame:
    """Content keys run over the whole part key range."""
    keys = part.select(F.max("p_partkey") + 1).scalar()
    return events.select(
        F.col("user_id").alias("dim_account_key"),
        (F.col("event_id") % keys).alias("dim_content_key"),
        F.col("ts").alias("start_timestamp"),
        F.floor(F.col("value") * 10).cast("bigint").alias("play_seconds"),
    )


def test_accounts(customer: DataFrame) -> DataFrame:
    return customer.where(F.col("c_custkey") % 97 == 0) \
                   .select(F.col("c_custkey").cast("string").alias("account_id"))


def vip_table(customer: DataFrame) -> DataFrame:
    return customer.where(F.col("c_custkey") % 101 == 0) \
                   .select(F.col("c_custkey").cast("string").alias("account_id"))


def ev_op_promotions(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    return orders.where(k % 20 == 0).select(
        (F.floor(k / 20).cast("bigint") % 4).alias("promotion_id"),
        k.alias("ord_prod_id"))


def ev_ordered_product(orders: DataFrame) -> DataFrame:
    return _service_columns(orders).select(
        F.col("o_orderkey").alias("ord_prod_id"),
        F.col("o_custkey").alias("acct_id"),
        F.col("service_start_date").alias("srv_start_date"),
        F.col("service_end_date").alias("validity_end_date"))


def ev_account(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.col("c_custkey").alias("acct_id"),
        F.col("c_custkey").cast("string").alias("customer_id"),
        (F.col("c_nationkey") % 3).cast("bigint").alias("acct_status_id"))


def load(spark: SparkSession, sf_dir: str) -> Sources:
    """All twelve report inputs derived from the driver tables in ``sf_dir``."""
    orders = _read(spark, sf_dir, "orders")
    customer = _read(spark, sf_dir, "customer")
    return Sources(
        dim_service=dim_service(orders),
        dim_date=dim_date(spark),
        dim_account=dim_account(customer),
        dim_content=dim_content(_read(spark, sf_dir, "part")),
        fact_engagement=fact_engagement(_read(spark, sf_dir, "events"), _read(spark, sf_dir, "part")),
        test_accounts=test_accounts(customer),
        vip=vip_table(customer),
        ev_op_promotions=ev_op_promotions(orders),
        ev_promotions=spark.createDataFrame(PROMOTIONS, "id bigint, name string"),
        ev_ordered_product=ev_ordered_product(orders),
        ev_account=ev_account(customer),
        ev_account_status=spark.createDataFrame(ACCOUNT_STATUSES,
                                                "acct_stat_id bigint, description string"),
    )


# The same mapping for DuckDB, used by the SQL oracle.  One CTE per input.
def duckdb_ctes() -> str:
    off = (f"(date_diff('day', DATE '{EPOCH}', CAST(o_orderdate AS DATE)) % {OFFSET_CYCLE_DAYS})")
    start = f"(DATE '{SERVICE_BASE_DAY}' + CAST({off} AS INTEGER))"
    svc_dates = f"""
        CAST({start} AS TIMESTAMP) AS service_start_date,
        CAST({start} + CAST(o_orderkey % 31 AS INTEGER) AS TIMESTAMP) AS service_end_date,
        CAST({start} - CAST(CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_orderkey % 10 END AS INTEGER)
             AS TIMESTAMP) AS service_commence_date"""
    return f"""
dim_service AS (
    SELECT o_orderkey AS dim_service_key,
           o_custkey AS dim_account_key,
           CAST(o_custkey AS VARCHAR) AS account_id,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'Annual' WHEN '2-HIGH' THEN 'Premium'
                WHEN '4-NOT SPECIFIED' THEN 'Basic' ELSE 'Standard' END AS product_name,
           CASE WHEN o_orderkey % 7 IN (0, 1) THEN 'FREE TRIAL' WHEN o_orderkey % 7 = 2 THEN 'PAYMENT_VOUCHER'
                WHEN o_orderkey % 7 = 3 THEN 'VOUCHER' WHEN o_orderkey % 7 = 4 THEN 'UNKNOWN'
                ELSE 'PAYMENT' END AS activation_method,
           CASE WHEN o_orderkey % 13 = 0 THEN 'INACTIVE' WHEN o_orderkey % 11 = 0 THEN 'HOLDONNPMT'
                WHEN o_orderstatus = 'F' THEN 'EXPIRED' WHEN o_orderstatus = 'P' THEN 'FINAL BILL'
                WHEN o_orderstatus = 'O' THEN 'ACTIVE' END AS service_status,
           {svc_dates},
           CASE WHEN o_orderkey % 9 = 0 THEN 'SparkDCBProd1' WHEN o_orderkey % 9 = 1 THEN 'SparkDCBProd2'
                WHEN o_orderkey % 9 = 2 THEN '2DGBB01' WHEN o_orderkey % 9 IN (3, 4) THEN NULL
                ELSE 'PROMO' END AS coupon_code,
           CASE WHEN o_orderkey % 5 = 0 THEN 'N' ELSE 'Y' END AS is_svod_flag,
           CAST(o_orderkey AS VARCHAR) AS evergent_order_id,
           CAST(o_orderkey AS VARCHAR) AS evergent_ord_prod_id
    FROM orders),
dim_account AS (
    SELECT c_custkey AS dim_account_key, CAST(c_custkey AS VARCHAR) AS account_id,
           c_name AS first_name, c_name AS last_name, c_name || '@x' AS email
    FROM customer),
dim_date AS (
    SELECT CAST(generate_series AS DATE) AS date_dt
    FROM generate_series(DATE '{CALENDAR_FIRST}', DATE '{CALENDAR_LAST}', INTERVAL 1 DAY)
    WHERE NOT CAST(generate_series AS DATE) BETWEEN DATE '{CALENDAR_GAP[0]}' AND DATE '{CALENDAR_GAP[1]}'),
dim_content AS (
    SELECT p_partkey AS dim_content_key,
           CASE WHEN p_type IN ('STANDARD', 'MEDIUM', 'LARGE') THEN 'EPISODE'
                WHEN p_type IN ('PROMO', 'SMALL') THEN 'FEATURE' ELSE 'TRAILER' END AS content_type,
           CASE WHEN p_size % 2 = 0 THEN p_name || ',Neon' ELSE p_name END AS labels
    FROM part),
fact_engagement AS (
    SELECT user_id AS dim_account_key, event_id % (SELECT max(p_partkey) + 1 FROM part) AS dim_content_key,
           ts AS start_timestamp, CAST(floor(value * 10) AS BIGINT) AS play_seconds
    FROM events),
test_accounts AS (
    SELECT CAST(c_custkey AS VARCHAR) AS account_id FROM customer WHERE c_custkey % 97 = 0),
vip_table AS (
    SELECT CAST(c_custkey AS VARCHAR) AS account_id FROM customer WHERE c_custkey % 101 = 0),
ev_op_promotions AS (
    SELECT CAST(floor(o_orderkey / 20) AS BIGINT) % 4 AS promotion_id, o_orderkey AS ord_prod_id
    FROM orders WHERE o_orderkey % 20 = 0),
ev_promotions AS (
    SELECT * FROM (VALUES {", ".join(f"({i}, '{n}')" for i, n in PROMOTIONS)}) AS t(id, name)),
ev_ordered_product AS (
    SELECT o_orderkey AS ord_prod_id, o_custkey AS acct_id,
           CAST({start} AS TIMESTAMP) AS srv_start_date,
           CAST({start} + CAST(o_orderkey % 31 AS INTEGER) AS TIMESTAMP) AS validity_end_date
    FROM orders),
ev_account AS (
    SELECT c_custkey AS acct_id, CAST(c_custkey AS VARCHAR) AS customer_id,
           CAST(c_nationkey % 3 AS BIGINT) AS acct_status_id
    FROM customer),
ev_account_status AS (
    SELECT * FROM (VALUES {", ".join(f"({i}, '{n}')" for i, n in ACCOUNT_STATUSES)})
           AS t(acct_stat_id, description))"""
