"""Raw tables to canonical rows: one declarative mapping for each dataset."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

#: The column that holds a row's 0-based place in the raw input.
ORDINAL = "row_seq"


@dataclass(frozen=True)
class NormalizeSpec:
    dataset: str
    task: str
    modality: str
    text: str | None
    secondary: str | None
    label_raw: str
    image_path: str | None = None


#: The five mappings.
SPECS = {
    "fake_real_news": NormalizeSpec("fake_real_news", "fake_news", "article", "text", "title", "label"),
    "claim_verification": NormalizeSpec("fever", "claim_verification", "claim", "claim", "evidence_text", "label"),
    "fact_checking": NormalizeSpec("liar", "fact_checking", "claim", "statement", "context", "label"),
    "ai_text_detection": NormalizeSpec("gpt2_output", "ai_text_detection", "article", "text", None, "source"),
    "image_forensics": NormalizeSpec("cifake", "image_forensics", "image", None, None, "label", "image_path"),
}


def optional(df: DataFrame, name: str | None) -> Column:
    """The column, or empty text if the table has none of this name."""
    return F.col(name) if name and name in df.columns else F.lit("")


def normalize(df: DataFrame, spec: NormalizeSpec, ordinal: str = ORDINAL) -> DataFrame:
    """Canonical columns before labels; every column that no field uses goes to ``metadata`` as JSON."""
    used = {spec.text, spec.secondary, spec.label_raw, spec.image_path, ordinal}
    return df.select(
        X.row_id(spec.dataset, F.col(ordinal)).alias("id"),
        F.lit(spec.dataset).alias("dataset"),
        F.lit(spec.task).alias("task"),
        F.lit(spec.modality).alias("modality"),
        optional(df, spec.text).alias("text"),
        optional(df, spec.secondary).alias("text_secondary"),
        F.col(spec.label_raw).cast("string").alias("label_raw"),
        (F.lit("{}") if spec.modality == "image" else X.json_of(c for c in df.columns if c not in used)).alias("metadata"),
        optional(df, spec.image_path).alias("image_path"),
        F.col(ordinal),
    )


def with_ordinal(df: DataFrame, order: list[str], name: str = ORDINAL) -> DataFrame:
    """0-based place in ``order`` without moving all rows to one task.

    Rows are range-partitioned and sorted; each partition counts from the sum of the
    earlier ones' sizes, a table of one row per partition.
    """
    from pyspark.sql import Window as W

    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    placed = placed.withColumns({"_part": F.spark_partition_id(), "_index": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = placed.groupBy("_part").count().select("_part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_start"))
    return placed.join(starts, "_part").withColumn(name, F.col("_start") + F.col("_index")).drop("_part", "_index", "_start")
