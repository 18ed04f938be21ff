"""Session helpers.

On a cluster the session comes from the platform; ``local_session`` is for
tests and the bench.  ``checkpoint_dir`` reads ``spark.checkpoint.dir`` from
the session and only falls back to a scratch folder when it is unset.
"""

from __future__ import annotations

import os
import tempfile
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "sublens", extra: dict | None = None) -> SparkSession:
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         # checkpoints of finished reports are removed once unreferenced
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         .config("spark.driver.memory", os.environ.get("SUBLENS_DRIVER_MEMORY", "8g")))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster in
    ``spark.checkpoint.dir``.  Only a local-mode session (tests, the bench)
    without one gets a fresh scratch folder; on a cluster an unset folder is
    an error, never a machine-local directory."""
    try:
        sc = spark.sparkContext
    except Exception:            # Spark Connect: the server's own setting applies
        return spark.conf.get("spark.checkpoint.dir", None)
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS/S3): "
                               "the fused report checkpoints its intermediate results there")
        d = tempfile.mkdtemp(prefix="sublens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def together(spark: SparkSession, *calls):
    """Results of independent calls that run Spark jobs, started at the same time: their
    small jobs fill the gaps of each other's planning and last tasks.  The first
    failure is raised."""
    with ThreadPoolExecutor(len(calls)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(c)) for c in calls]
        return [s.result() for s in started]
