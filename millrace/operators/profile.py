"""Profiles and exploratory statistics, over all rows unless a sample is asked for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..storage import Table


#: Numbers by which terms are counted at first; bounds the memory of a task (some 100 bytes each).
BUCKETS = 1 << 18


def column_cardinality(df: DataFrame, approximate: bool = False) -> DataFrame:
    """``column, n_unique, pct_unique, dtype``; nulls are no value."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    sums = df.agg(F.count(F.lit(1)).alias("n"), *[count(F.col(f"`{c}`")).alias(f"u_{i}") for i, c in enumerate(df.columns)])
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"u_{i}").alias("n_unique"), F.lit(kind).alias("dtype")) for i, (c, kind) in enumerate(df.dtypes)]
    long = sums.select("n", F.explode(F.array(*rows)).alias("r")).select("n", "r.*")
    return long.select("column", "n_unique", F.round(100.0 * F.col("n_unique") / F.greatest("n", F.lit(1)), 2).alias("pct_unique"), "dtype")


def length_by_label(df: DataFrame, label: str = "label", text: str = "text") -> DataFrame:
    """Word counts by label: count, mean, median, sample deviation, to one decimal."""
    n = df.select(label, X.word_count(F.col(text)).alias("_n"))
    return n.groupBy(label).agg(
        F.count(F.lit(1)).alias("count"),
        F.round(F.avg("_n"), 1).alias("mean_words"),
        F.round(F.median("_n"), 1).alias("median_words"),
        F.round(F.stddev_samp("_n"), 1).alias("std_words"),
    )


def length_outliers(df: DataFrame, text: str = "text", multiplier: float = 3.0) -> DataFrame:
    """Rows outside the quartiles by ``multiplier`` interquartile ranges; the bounds table has one row."""
    n = df.select(X.word_count(F.col(text)).alias("_n"))
    q = n.agg(F.percentile("_n", F.array(F.lit(0.25), F.lit(0.75))).alias("q"))
    iqr = F.col("q")[1] - F.col("q")[0]
    bounds = q.select((F.col("q")[0] - multiplier * iqr).alias("low"), (F.col("q")[1] + multiplier * iqr).alias("high"))
    sums = n.join(F.broadcast(bounds)).agg(
        F.max("low").alias("low"),
        F.max("high").alias("high"),
        F.count_if(F.col("_n") < F.col("low")).alias("n_outliers_short"),
        F.count_if(F.col("_n") > F.col("high")).alias("n_outliers_long"),
        F.count(F.lit(1)).alias("n"),
    )
    return sums.select(
        F.greatest(F.lit(0), F.bround("low").cast("long")).alias("lower_bound_words"),
        F.bround("high").cast("long").alias("upper_bound_words"),
        "n_outliers_short",
        "n_outliers_long",
        F.round(100.0 * (F.col("n_outliers_short") + F.col("n_outliers_long")) / F.greatest("n", F.lit(1)), 2).alias("pct_outliers"),
    )


def text_length_stats(df: DataFrame, text: str = "text") -> DataFrame:
    c, w = F.length(text), X.word_count(F.col(text))
    n = df.select(c.alias("c"), w.alias("w"))
    return n.agg(
        F.round(F.avg("c"), 1).alias("char_len_mean"),
        F.median("c").cast("long").alias("char_len_median"),
        F.min("c").cast("long").alias("char_len_min"),
        F.max("c").cast("long").alias("char_len_max"),
        F.round(F.avg("w"), 1).alias("word_len_mean"),
        F.median("w").cast("long").alias("word_len_median"),
    )


def length_histogram(df: DataFrame, text: str = "text", bins: int = 50, clip: float = 0.99) -> DataFrame:
    """``bin, count`` of word counts, clipped at a quantile; the last bin is closed."""
    n = df.select(X.word_count(F.col(text)).alias("_n"))
    edge = n.agg(F.percentile("_n", F.lit(clip)).alias("top"), F.min("_n").alias("low"))
    clipped = n.join(F.broadcast(edge)).select(F.least(F.col("_n").cast("double"), "top").alias("x"), "low", F.col("top").alias("high"))
    width = (F.col("high") - F.col("low")) / bins
    place = F.when(width <= 0, 1).otherwise(F.least(F.floor(F.try_divide(F.col("x") - F.col("low"), width)) + 1, F.lit(bins)))
    return clipped.groupBy(place.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))


def _top(terms: DataFrame, k: int, buckets: int = BUCKETS) -> DataFrame:
    """The ``k`` most frequent terms, exactly, without a count of every term.

    No term occurs more often than its bucket has rows.  The terms of the fullest buckets are counted; every bucket with as many rows as the k-th
    best of these can hold one of the k best, so where such buckets are left (many terms are as frequent), their terms are counted too.
    """
    placed = terms.select("term", F.pmod(F.xxhash64("term"), F.lit(buckets)).alias("bucket"))
    loads = Table(placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows")), "loads").df
    count = lambda some: placed.join(some, "bucket", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "term").limit(k)
    fullest = loads.orderBy(F.desc("rows"), "bucket").limit(4 * k)
    best = Table(count(F.broadcast(fullest)), "best").df
    known = best.agg(F.count(F.lit(1)).alias("terms"), F.min("n").alias("least")).collect()[0]
    able = loads.filter(F.col("rows") >= (known["least"] if known["terms"] == k else 0))
    return best.orderBy(F.desc("n"), "term") if able.join(F.broadcast(fullest), "bucket", "left_anti").isEmpty() else count(able)


def vocabulary(df: DataFrame, text: str = "text") -> DataFrame:
    """``term`` of every letter word that is no stop word."""
    return X.once(df.select(text), t=X.alpha_tokens(F.col(text), X.STOP_WORDS)).select(F.explode("t").alias("term"))


def vocab_top(df: DataFrame, text: str = "text", k: int = 15) -> DataFrame:
    return _top(vocabulary(df, text), k)


def vocab_size(df: DataFrame, text: str = "text") -> DataFrame:
    return vocabulary(df, text).agg(F.count_distinct("term").alias("unique_tokens"))


def bigram_top(df: DataFrame, text: str = "text", k: int = 15) -> DataFrame:
    tokens = X.once(df.select(text), t=X.alpha_tokens(F.col(text)))
    return _top(X.once(tokens.select("t"), b=X.bigrams(F.col("t"))).select(F.explode("b").alias("term")), k)


def language_distribution(df: DataFrame, lang: str | Column = "lang", text: str = "text", k: int = 5, min_chars: int = 10) -> DataFrame:
    """The ``k`` most frequent languages with their share of the rows long enough to judge."""
    from pyspark.sql import Window as W

    column = F.col(lang) if isinstance(lang, str) else lang
    counts = df.filter(F.length(text) >= min_chars).groupBy(column.alias("lang")).agg(F.count(F.lit(1)).alias("n"))
    pct = F.round(100.0 * F.col("n") / F.sum("n").over(W.partitionBy()), 1)
    return counts.withColumn("pct", pct).orderBy(F.desc("n"), "lang").limit(k)


def detect_languages(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``lang`` from a detector library, 'unknown' where it gives up; needs that library."""
    import pandas as pd

    try:
        import langdetect
    except ImportError as e:
        raise RuntimeError("no language detector is installed; pass a language column instead") from e

    @F.pandas_udf("string")
    def detect(texts: pd.Series) -> pd.Series:
        langdetect.DetectorFactory.seed = 42

        def one(t: str) -> str:
            try:
                return langdetect.detect(t)
            except langdetect.LangDetectException:
                return "unknown"

        return texts.map(one)

    return df.withColumn("lang", detect(F.col(text)))
