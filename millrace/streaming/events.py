"""Event streams: windowed counts with watermarks, sessions, and incremental upserts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def read_stream(spark: SparkSession, folder: str, files_per_trigger: int = 10) -> DataFrame:
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def _late(events: DataFrame, watermark: str) -> DataFrame:
    return events.withWatermark("ts", watermark) if events.isStreaming else events


def tumbling(events: DataFrame, width: str = "1 hour", watermark: str = "10 minutes") -> DataFrame:
    """``window_start, event_type, n, total``; the same plan for tables and streams."""
    sums = _late(events, watermark).groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return sums.select(F.col("window.start").alias("window_start"), "event_type", "n", "total")


def sliding(events: DataFrame, width: str = "1 hour", step: str = "15 minutes", watermark: str = "10 minutes") -> DataFrame:
    sums = _late(events, watermark).groupBy(F.window("ts", width, step), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return sums.select(F.col("window.start").alias("window_start"), "event_type", "n")


def sessions(events: DataFrame, gap: str = "30 minutes", watermark: str = "10 minutes") -> DataFrame:
    """``user_id, session_start, session_end, n``: events of a user no further apart than the gap."""
    sums = _late(events, watermark).groupBy(F.session_window("ts", gap), "user_id").agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("last_event"))
    return sums.select("user_id", F.col("session_window.start").alias("session_start"), "last_event", "n")


def upsert(target: str, key: str, version: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that merges a batch into the Parquet table ``target``: the latest version of a key wins.

    Each merge writes the version after the newest finished one, whatever the batch's number:
    skipped numbers and a restart from 0 lose nothing, and a batch that is repeated after a
    failure changes no row.  The newest two versions stay, so a reader of the last is not cut off.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rest = [c for c in batch.columns if c != key]
        done = versions(spark, target)
        rows = batch.unionByName(spark.read.parquet(f"{target}/v={done[-1]}")) if done else batch
        latest = rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(version, *[c for c in rest if c != version])).alias("r"))
        latest.select(key, "r.*").write.mode("overwrite").parquet(f"{target}/v={done[-1] + 1 if done else 0}")
        for old in done[:-1]:
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/v={old}")
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

    return merge


def versions(spark: SparkSession, target: str) -> list[int]:
    """The finished versions of a table kept by ``upsert``, oldest first; one without its end mark does not count."""
    found = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/v=*/_SUCCESS")
    marks = found.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(found) or []
    return sorted(int(m.getPath().getParent().getName().split("=")[1]) for m in marks)


def read_upserted(spark: SparkSession, target: str) -> DataFrame:
    """The newest finished version."""
    return spark.read.parquet(f"{target}/v={versions(spark, target)[-1]}")


def run_to_end(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Runs a bounded stream to its end into a memory table (for tests and small reports)."""
    query = stream.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.table(name)
