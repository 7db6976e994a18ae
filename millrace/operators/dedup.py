"""Keep-first deduplication with an explicit order.

The winner of a key is found by a map-side combined minimum, so a hot key costs one
row per task before the shuffle, and only ids and 256-bit key digests are moved to
find the winners.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X


def _digest(key: Column) -> Column:
    return F.sha2(F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit("")), 256)


def keep_first(df: DataFrame, key: Column, order: str, keep_empty: bool = False) -> DataFrame:
    """Of rows with equal ``key`` the one with the smallest ``order`` (unique); null keys are one key.

    With ``keep_empty`` the rows with an empty key are not taken for equal.
    """
    winner = F.when(key == "", F.concat(F.lit("own"), F.col(order).cast("string"))).otherwise(_digest(key)) if keep_empty else _digest(key)
    first = df.groupBy(winner.alias("_key")).agg(F.min(order).alias("_first"))
    return df.join(first.select(F.col("_first").alias(order)), order, "left_semi")


def drop_exact_duplicates(df: DataFrame, subset: list[str], order: str) -> DataFrame:
    key = F.col(subset[0]) if len(subset) == 1 else F.to_json(F.struct(*subset), {"ignoreNullFields": "false"})
    return keep_first(df, key, order)


def drop_near_duplicates(df: DataFrame, text: str, order: str, preserve_empty_key: bool = False) -> DataFrame:
    """Equal up to case and anything but ASCII letters and digits."""
    return keep_first(df, X.dedup_key(F.col(text)), order, preserve_empty_key)


def duplicate_report(df: DataFrame, text: str) -> DataFrame:
    """One row of totals; near duplicates include exact ones; null counts as one value."""
    n, c = F.count(F.lit(1)), F.col(text)
    sums = df.agg(
        n.alias("total_rows"),
        F.count_distinct(_digest(c)).alias("_texts"),
        F.count_distinct(_digest(X.dedup_key(c))).alias("_keys"),
    )
    exact, near = F.col("total_rows") - F.col("_texts"), F.col("total_rows") - F.col("_keys")
    pct = lambda x: F.round(100.0 * x / F.greatest("total_rows", F.lit(1)), 2)
    return sums.select(
        "total_rows", exact.alias("exact_duplicates"), near.alias("near_duplicates"), pct(exact).alias("exact_pct"), pct(near).alias("near_pct")
    )
