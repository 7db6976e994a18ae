"""Helpers shared by the training-data operators.

``cut`` is the only place that materialises intermediate results.  It writes a
Parquet table under ``spark.checkpoint.dir`` (the folder that driver and
executors share), so a lost executor costs a re-read and not a re-computation.
"""

from __future__ import annotations

import tempfile
import uuid
import weakref
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of most contracts: runs without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

_fallback_dir: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the session names; a temporary one only in a local session that names none (tests)."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not _fallback_dir:
        _fallback_dir.append("file://" + tempfile.mkdtemp(prefix="millrace-"))
    return _fallback_dir[0]


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends here."""
    return read_cut(df.sparkSession, write_cut(df, name), df)


def write_cut(df: DataFrame, name: str) -> str:
    path = f"{shared_dir(df.sparkSession)}/millrace-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return path


def read_cut(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(path)


def drop_cut(spark: SparkSession, path: str) -> None:
    """Remove a table that no later step reads."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let the context cleaner drop shuffle files of finished jobs whose frames are gone.

    The first round lets go of the plans, the second of what these alone held.
    """
    import gc
    import time

    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.4)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))


def fold(column: str, modulus: int):
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it (names ignore case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def by_size(batch, column: int, limit: int = 16 << 20):
    """An Arrow batch in slices of some ``limit`` bytes of one string or binary column, one row at least."""
    values = batch.column(column)
    if not batch.num_rows or values.nbytes <= limit:
        yield batch
        return
    rows = max(1, batch.num_rows * limit // values.nbytes)
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def pieces(batch, rows: int = 1024):
    """An Arrow batch in slices, so that what a task holds besides its input stays small."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)
