"""Raw labels to canonical integers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as X

UNMAPPED = -1


def _lookup(mapping: dict[str, int], key: Column) -> Column:
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.element_at(F.create_map(*pairs), key) if pairs else F.lit(None).cast("int")


def label_of(column: Column, mapping: dict[str, int]) -> Column:
    """The exact key's label, else that of the first key equal up to case and outer blanks, else -1."""
    loose: dict[str, int] = {}
    for k, v in mapping.items():
        loose.setdefault(k.strip().lower(), v)
    return F.coalesce(_lookup(mapping, column), _lookup(loose, X.label_key(column)), F.lit(UNMAPPED)).cast("int")


def apply_label_map(df: DataFrame, mapping: dict[str, int], raw: str = "label_raw") -> DataFrame:
    return df.withColumn("label", label_of(F.col(raw), mapping))


def drop_unmapped(df: DataFrame) -> DataFrame:
    return df.filter(F.col("label") != UNMAPPED)


def unmapped_values(df: DataFrame, raw: str = "label_raw", limit: int = 10) -> DataFrame:
    """The first raw values without a label, and how often each occurs."""
    return df.filter(F.col("label") == UNMAPPED).groupBy(raw).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), raw).limit(limit)


def label_distribution(df: DataFrame, column: str = "label") -> DataFrame:
    """``column, count, pct``, null included, most frequent first."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    share = F.round(100.0 * F.col("count") / F.sum("count").over(W.partitionBy()), 2)
    return counts.withColumn("pct", share).orderBy(F.desc("count"), column)
