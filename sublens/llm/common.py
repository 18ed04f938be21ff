"""Shared helpers of the training-data operators."""

from __future__ import annotations

import itertools
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sublens.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def aside(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """df with columns that start with an underscore renamed, so that an operator's working
    columns (which all do) clash with none; and the new name of every column."""
    taken = {c.lower() for c in df.columns}
    fresh = (f"c{i}" for i in itertools.count() if f"c{i}" not in taken)
    names = {c: next(fresh) if c.startswith("_") else c for c in df.columns}
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in names.items()]), names


def text_bytes(col: Column) -> Column:
    """UTF-8 bytes of a text column; NULL counts as empty."""
    return F.coalesce(col, F.lit("")).cast("binary")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage in the shared folder (survives a lost executor)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def run_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder for a written table or files."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write as Parquet in the shared folder and read back (column pruning,
    real sizes for the planner).  The shuffle files of the write are no longer
    needed and are freed when it ends."""
    spark = df.sparkSession
    path = run_folder(spark, name)
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(t.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

