"""Drift of confidence and rate of insufficient data, from histograms of time windows.

A histogram is a count per (module, window, bin): counts of parts add up, so the same plan runs over a
table and over a stream, partial sums are combined before the shuffle, and histograms of finished windows can be
stored and merged with later ones.  Drift compares neighbouring windows of a module.

Defined cases: values outside the range count in the first or last bin; null values and times do not count for the
histogram, a null outcome is not insufficient data; a module's first window has no distance; windows without events do not exist, so
the neighbour is the last one that has any.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def histogram(events: DataFrame, width: str = "1 day", bins: int = 20, watermark: str = "1 hour", at: str = "ts", value: str = "confidence") -> DataFrame:
    """``module, window_start, bin, n``; ``at`` is a timestamp and the values are meant to be in [0, 1]."""
    rows = events.withWatermark(at, watermark) if events.isStreaming else events
    place = F.least(F.greatest(F.floor(F.col(value) * bins), F.lit(0)), F.lit(bins - 1)).cast("int")
    counts = rows.filter(F.col(value).isNotNull() & F.col(at).isNotNull()).groupBy("module", F.window(at, width).alias("w"), place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select("module", F.col("w.start").alias("window_start"), "bin", "n")


def merged(*histograms: DataFrame) -> DataFrame:
    """The histogram of all parts together."""
    whole = histograms[0]
    for more in histograms[1:]:
        whole = whole.unionByName(more)
    return whole.groupBy("module", "window_start", "bin").agg(F.sum("n").alias("n"))


def drift(counts: DataFrame, bins: int = 20) -> DataFrame:
    """``module, window_start, n, distance``: total variation distance to the module's window before, 0 to 1."""
    shares = counts.groupBy("module", "window_start").agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("h"), F.sum("n").alias("n"))
    place = lambda b: F.coalesce(F.element_at("h", b), F.lit(0)) / F.col("n")
    shares = shares.select("module", "window_start", "n", F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), place).alias("p"))
    before = F.lag("p").over(W.partitionBy("module").orderBy("window_start"))
    apart = F.aggregate(F.zip_with("p", "before", lambda x, y: F.abs(x - y)), F.lit(0.0), lambda s, d: s + d) / 2
    return shares.withColumn("before", before).select("module", "window_start", "n", apart.alias("distance"))


def insufficient_rate(events: DataFrame, width: str = "1 day", watermark: str = "1 hour", at: str = "ts", outcome: str = "outcome") -> DataFrame:
    """``module, window_start, n, insufficient, rate``: how often a module had too little to decide."""
    rows = events.withWatermark(at, watermark) if events.isStreaming else events
    sums = rows.filter(F.col(at).isNotNull()).groupBy("module", F.window(at, width).alias("w"))
    sums = sums.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce(F.col(outcome) == "insufficient_data", F.lit(False))).alias("insufficient"))
    return sums.select("module", F.col("w.start").alias("window_start"), "n", "insufficient", (F.col("insufficient") / F.col("n")).alias("rate"))
