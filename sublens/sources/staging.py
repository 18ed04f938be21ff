"""Stages of one report run: Parquet tables in a folder of their own.

``RunFolder`` lies below the shared ``spark.checkpoint.dir``, so stages survive a lost
executor.  Each stage is written with the columns its plan has, read back as a table (real
sizes for the planner, columns pruned at the scan) and listed in the folder's
``manifest.json`` with its columns and bytes.  Leaving the ``with`` block removes the folder,
after success or failure alike; ``sweep`` removes what a killed driver has left behind.

    with RunFolder(spark) as run:
        write_report(daily_report(src, ctx, run=run), path)
"""

from __future__ import annotations

import itertools
import json
import threading
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from sublens.session import checkpoint_dir

PREFIX = "report-run-"
MANIFEST = "manifest.json"


def _folder(spark: SparkSession, path: str):
    """The Hadoop path and its file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


class RunFolder:
    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = f"{checkpoint_dir(spark).rstrip('/')}/{PREFIX}{uuid.uuid4().hex}"
        self.stages: list[dict] = []
        self._numbers, self._lock = itertools.count(), threading.Lock()
        self.began = time.time()

    def stage(self, df: DataFrame, name: str = "stage") -> DataFrame:
        """``df`` written and read back."""
        path = f"{self.path}/{next(self._numbers):02d}-{name}"
        began = time.time()
        df.write.parquet(path)
        at, fs = _folder(self.spark, path)
        with self._lock:                  # stages may be written at the same time
            self.stages.append({"path": path, "columns": df.columns, "bytes": fs.getContentSummary(at).getLength(),
                                "seconds": round(time.time() - began, 3)})
            self._write_manifest()
        return self.spark.read.schema(df.schema).parquet(path)

    @property
    def bytes(self) -> int:
        return sum(s["bytes"] for s in self.stages)

    def _write_manifest(self) -> None:
        at, fs = _folder(self.spark, f"{self.path}/{MANIFEST}")
        out = fs.create(at, True)
        try:
            out.write(bytearray(json.dumps({"began": self.began, "stages": self.stages}).encode()))
        finally:
            out.close()

    def remove(self) -> None:
        at, fs = _folder(self.spark, self.path)
        fs.delete(at, True)

    def __enter__(self) -> "RunFolder":
        return self

    def __exit__(self, *exc) -> None:
        self.remove()


def sweep(spark: SparkSession, hours: float = 48) -> list[str]:
    """Remove run folders that nothing has written to for ``hours``; their paths."""
    at, fs = _folder(spark, checkpoint_dir(spark))
    gone = []
    for entry in fs.listStatus(at) if fs.exists(at) else []:
        path = entry.getPath()
        if not path.getName().startswith(PREFIX):
            continue
        last = max([entry.getModificationTime(), *(e.getModificationTime() for e in fs.listStatus(path))])
        if last < (time.time() - 3600 * hours) * 1000:
            fs.delete(path, True)
            gone.append(path.toString())
    return gone
