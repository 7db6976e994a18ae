"""Image integrity and profiles from file headers; no imaging library is needed.

A file is valid if its header gives a size and its end mark is there.  Pixels are
decoded only where an imaging library is installed and ``decode`` asks for it.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import list_files

_SCHEMA = "path string, status string, format string, width int, height int, size_kb double"


def header(data: bytes) -> tuple[str, int, int] | None:
    """Format, width and height of a PNG or JPEG that is complete, else None."""
    if data[:8] == b"\x89PNG\r\n\x1a\n" and data[12:16] == b"IHDR" and b"IEND" in data[-16:]:
        return ("PNG", *struct.unpack(">II", data[16:24]))
    if data[:2] == b"\xff\xd8" and data.rstrip(b"\x00")[-2:] == b"\xff\xd9":
        at = 2
        while at + 9 < len(data) and data[at] == 0xFF:
            mark, size = data[at + 1], struct.unpack(">H", data[at + 2 : at + 4])[0]
            if 0xC0 <= mark <= 0xCF and mark not in (0xC4, 0xC8, 0xCC):
                height, width = struct.unpack(">HH", data[at + 5 : at + 9])
                return "JPEG", width, height
            at += 2 + size
    return None


def _decodes(data: bytes) -> bool:
    import io

    from PIL import Image

    try:
        Image.open(io.BytesIO(data)).verify()
        return True
    except Exception:  # noqa: BLE001 - any failure means a corrupt file
        return False


def inspect(spark: SparkSession, paths: DataFrame, folder: str, column: str = "image_path", decode: bool = False) -> DataFrame:
    """``path, status, format, width, height, size_kb`` of each listed path; status is valid, corrupt or missing."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [header(bytes(c)) for c in batch["content"]]
            if decode:
                found = [f if f and _decodes(bytes(c)) else None for f, c in zip(found, batch["content"])]
            yield pd.DataFrame(
                {
                    "path": batch["path"],
                    "status": ["valid" if f else "corrupt" for f in found],
                    "format": [f[0] if f else None for f in found],
                    "width": pd.array([f[1] if f else None for f in found], dtype="Int32"),
                    "height": pd.array([f[2] if f else None for f in found], dtype="Int32"),
                    "size_kb": batch["length"] / 1024,
                }
            )

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    files = files.select(F.regexp_replace("path", "^file:(//)?", "").alias("path"), "content", "length")
    wanted = paths.filter(F.col(column) != "").select(F.col(column).alias("path"))
    seen = files.join(wanted.distinct(), "path", "left_semi").mapInPandas(run, _SCHEMA)
    # Empty files are listed but never scanned: they are there, and corrupt.
    there = list_files(spark, folder).withColumn("_there", F.lit("corrupt"))
    out = wanted.join(seen, "path", "left").join(there, "path", "left")
    return out.withColumn("status", F.coalesce("status", "_there", F.lit("missing"))).drop("_there")


def integrity(inspected: DataFrame) -> DataFrame:
    return inspected.agg(*[F.count_if(F.col("status") == s).alias(s) for s in ("valid", "corrupt", "missing")])


def profile(inspected: DataFrame) -> DataFrame:
    """One row: sizes of the valid files."""
    ok = inspected.filter("status = 'valid'")
    return ok.agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("width"), 1).alias("width_mean"),
        F.round(F.avg("height"), 1).alias("height_mean"),
        F.min("width").alias("width_min"),
        F.max("width").alias("width_max"),
        F.min("height").alias("height_min"),
        F.max("height").alias("height_max"),
        F.round(F.avg("size_kb"), 2).alias("size_kb_mean"),
        F.round(F.median("size_kb"), 2).alias("size_kb_median"),
    )


def formats(inspected: DataFrame) -> DataFrame:
    return inspected.filter("status = 'valid'").groupBy("format").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "format")
