"""Deterministic samples and splits: membership depends on seed and id only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def draw(seed: int, id_col: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def sample_k(df: DataFrame, k: int, seed: int = 42, id_col: str = "id") -> DataFrame:
    """``k`` rows without replacement: those with the smallest hashes of seed and id."""
    return df.orderBy(draw(seed, id_col), id_col).limit(k)


def can_stratify(df: DataFrame, label: str = "label") -> bool:
    """Every class has two members at least."""
    least = df.groupBy(label).count().agg(F.min("count")).collect()[0][0]
    return least is not None and least >= 2


def stratified_split(
    df: DataFrame, train: float = 0.8, val: float = 0.1, test: float = 0.1, seed: int = 42, stratify: bool = True, label: str = "label", id_col: str = "id", bits: int = 12
) -> DataFrame:
    """``df`` with ``split``: the first floor(n train) of a stratum by hash, then val, then test.

    Ranks are distributed: rows fall into 2^bits ranges of the hash, ranges are counted
    (a small table), and ranks inside (stratum, range) are added to the counts of the
    earlier ranges, so a large class is not one group.
    """
    if abs(train + val + test - 1.0) >= 1e-6:
        raise ValueError("the ratios must sum to 1")
    stratum = F.col(label) if stratify else F.lit(0)
    h = df.withColumns({"_h": draw(seed, id_col), "_s": F.coalesce(stratum.cast("string"), F.lit(""))})
    h = h.withColumn("_r", F.shiftright(F.conv(F.substring("_h", 1, 8), 16, 10).cast("long"), 32 - bits))
    ranges = h.groupBy("_s", "_r").agg(F.count(F.lit(1)).alias("_n"))
    in_order = W.partitionBy("_s").orderBy("_r").rowsBetween(W.unboundedPreceding, -1)
    ranges = ranges.select("_s", "_r", F.coalesce(F.sum("_n").over(in_order), F.lit(0)).alias("_before"), F.sum("_n").over(W.partitionBy("_s")).alias("_all"))
    placed = h.withColumn("_i", F.row_number().over(W.partitionBy("_s", "_r").orderBy("_h", id_col))).join(ranges, ["_s", "_r"])
    place = F.col("_i") + F.col("_before")
    n_train = F.floor(F.col("_all") * train)
    n_val = F.floor((F.col("_all") - n_train) * (val / (val + test) if val + test else 0.0))
    split = F.when(place <= n_train, "train").when(place <= n_train + n_val, "val").otherwise("test")
    return placed.withColumn("split", split).select(*df.columns, "split")
