"""Missing values: filters, fills and the report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X


def present(df: DataFrame, name: str) -> Column:
    """Not null, for text not blank, for floating point not NaN."""
    kind = df.schema[name].dataType.simpleString()
    test = F.col(name).isNotNull()
    if kind == "string":
        return test & (X.strip(F.col(name)) != "")
    return test & ~F.isnan(name) if kind in ("double", "float") else test


def drop_rows_missing_required(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [present(df, c) for c in columns]))


def fill_optional_missing(df: DataFrame, defaults: dict) -> DataFrame:
    """Only columns that exist are filled."""
    return df.na.fill({c: v for c, v in defaults.items() if c in df.columns})


def missing_value_report(df: DataFrame) -> DataFrame:
    """``column, n_null, n_blank, pct_missing`` for each column, most missing first: one aggregation."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, (c, kind) in enumerate(df.dtypes):
        null = F.col(f"`{c}`").isNull() | (F.isnan(f"`{c}`") if kind in ("double", "float") else F.lit(False))
        blank = (X.strip(F.col(f"`{c}`")) == "") if kind == "string" else F.lit(False)
        aggs += [F.count_if(null).alias(f"null_{i}"), F.count_if(blank).alias(f"blank_{i}")]
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"null_{i}").alias("n_null"), F.col(f"blank_{i}").alias("n_blank")) for i, c in enumerate(df.columns)]
    long = df.agg(*aggs).select("n", F.explode(F.array(*rows)).alias("r")).select("n", "r.*")
    share = F.round(100.0 * (F.col("n_null") + F.col("n_blank")) / F.greatest("n", F.lit(1)), 2)
    return long.select("column", "n_null", "n_blank", share.alias("pct_missing")).orderBy(F.desc("pct_missing"), "column")
