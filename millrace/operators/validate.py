"""Validation gates; schema, nulls, labels and lengths share one aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import CORE_COLUMNS


class ValidationError(Exception):
    """A gate does not hold."""


def validate_schema(df: DataFrame, columns: list[str] | None = None) -> None:
    missing = [c for c in columns or CORE_COLUMNS if c not in df.columns]
    if missing:
        raise ValidationError(f"missing columns: {missing}")


def measures(df: DataFrame, required: list[str], allowed: list[int], low: int = 3, high: int = 100_000) -> DataFrame:
    """One row: nulls of each required column, labels outside ``allowed``, texts too short and too long."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in required]
    if "label" in df.columns:
        aggs.append(F.count_if(~F.coalesce(F.col("label").isin(allowed), F.lit(False))).alias("bad_labels"))
    if "text" in df.columns:
        aggs += [F.count_if(F.length("text") < low).alias("too_short"), F.count_if(F.length("text") > high).alias("too_long")]
    return df.agg(*aggs)


def validate_no_nulls(df: DataFrame, required: list[str]) -> None:
    found = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required]).collect()[0].asDict()
    for c in required:
        if found[c]:
            raise ValidationError(f"{found[c]} null values in required column {c!r}")


def validate_labels(df: DataFrame, allowed: list[int]) -> None:
    bad = df.filter(~F.coalesce(F.col("label").isin(allowed), F.lit(False))).select("label").distinct().limit(10).collect()
    if bad:
        raise ValidationError(f"labels outside the allowed set: {sorted(str(r[0]) for r in bad)}")


def text_length_counts(df: DataFrame, low: int = 3, high: int = 100_000) -> dict[str, int]:
    """How many texts are too short and too long; a report, not a gate."""
    return df.agg(F.count_if(F.length("text") < low).alias("too_short"), F.count_if(F.length("text") > high).alias("too_long")).collect()[0].asDict()


def run_all(df: DataFrame, allowed: list[int], low: int = 3, high: int = 100_000) -> dict[str, int]:
    """All gates in one job; returns the measures if they hold."""
    validate_schema(df)
    required = ["id", "dataset", "task", "label"]
    found = measures(df, required, allowed, low, high).collect()[0].asDict()
    for c in required:
        if found[f"null_{c}"]:
            raise ValidationError(f"{found[f'null_{c}']} null values in required column {c!r}")
    if found["bad_labels"]:
        raise ValidationError(f"{found['bad_labels']} labels outside the allowed set")
    return found
