"""Intermediate tables in the folder that driver and executors share.

A written table ends the lineage: a lost executor costs a re-read and not a re-computation.
"""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a temporary one only in a local session that names none (tests)."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not _local:
        _local.append("file://" + tempfile.mkdtemp(prefix="millrace-core-"))
    return _local[0]


def delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let the context cleaner drop shuffle files of finished jobs whose frames are gone.

    The first round lets go of the plans, the second of what these alone held.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.4)


class Table:
    """A frame that was written, and where; ``by`` names a column whose values get folders of their own."""

    def __init__(self, df: DataFrame, name: str = "table", compression: str = "snappy", by: str | None = None):
        self.path = f"{shared_dir(df.sparkSession)}/millrace-{name}-{uuid.uuid4().hex}"
        self.compression, self.by = compression, by
        self.add(df)

    def add(self, df: DataFrame) -> Table:
        """Write more rows; ``df`` is read anew."""
        write = df.write.mode("append").option("compression", self.compression)
        (write.partitionBy(self.by) if self.by else write).parquet(self.path)
        self.df = df.sparkSession.read.schema(df.schema).parquet(self.path)
        return self

    def drop(self) -> None:
        delete(self.df.sparkSession, self.path)
