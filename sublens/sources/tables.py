"""The report's input tables as one bundle of DataFrames.

Only the columns the report reads are named here; loaders select them right
after the scan so Parquet column pruning applies from the start.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession

# table -> columns read by the report
COLUMNS = {
    "dim_service": [
        "dim_service_key", "dim_account_key", "account_id", "product_name",
        "activation_method", "service_status", "service_start_date",
        "service_end_date", "service_commence_date", "coupon_code",
        "is_svod_flag", "evergent_order_id", "evergent_ord_prod_id",
    ],
    "dim_date": ["date_dt"],
    "dim_account": ["dim_account_key", "account_id", "first_name", "last_name", "email"],
    "dim_content": ["dim_content_key", "content_type", "labels"],
    "fact_engagement": ["dim_account_key", "dim_content_key", "start_timestamp", "play_seconds"],
    "test_accounts": ["account_id"],
    "vip": ["account_id"],
    "ev_op_promotions": ["promotion_id", "ord_prod_id"],
    "ev_promotions": ["id", "name"],
    "ev_ordered_product": ["ord_prod_id", "acct_id", "srv_start_date", "validity_end_date"],
    "ev_account": ["acct_id", "customer_id", "acct_status_id"],
    "ev_account_status": ["acct_stat_id", "description"],
}


def _exists(spark: SparkSession, path: str) -> bool:
    """Through Spark's own file systems, so object stores work too."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


@dataclass(frozen=True)
class Sources:
    """DataFrames for the twelve inputs of the report."""

    dim_service: DataFrame
    dim_date: DataFrame
    dim_account: DataFrame
    dim_content: DataFrame
    fact_engagement: DataFrame
    test_accounts: DataFrame
    vip: DataFrame
    ev_op_promotions: DataFrame
    ev_promotions: DataFrame
    ev_ordered_product: DataFrame
    ev_account: DataFrame
    ev_account_status: DataFrame

    @classmethod
    def from_parquet_dir(cls, spark: SparkSession, path: str) -> "Sources":
        """Read ``<path>/<table>`` (a Parquet file or a partitioned folder)
        for every table, keeping only the columns the report uses."""
        frames = {}
        for f in fields(cls):
            loc = f"{path.rstrip('/')}/{f.name}"
            if not _exists(spark, loc) and _exists(spark, loc + ".parquet"):
                loc = loc + ".parquet"
            frames[f.name] = spark.read.parquet(loc).select(*COLUMNS[f.name])
        return cls(**frames)

    @classmethod
    def from_catalog(cls, spark: SparkSession, names: dict[str, str]) -> "Sources":
        """Bind each input to a catalog table, e.g. ``{"dim_service":
        "dwh.dim_service", ...}``."""
        return cls(**{f.name: spark.table(names[f.name]).select(*COLUMNS[f.name])
                      for f in fields(cls)})

    def replace(self, **frames: DataFrame) -> "Sources":
        current = {f.name: getattr(self, f.name) for f in fields(self)}
        current.update(frames)
        return Sources(**current)
