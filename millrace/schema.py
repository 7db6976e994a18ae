"""The canonical table: one schema for articles, claims and images."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA_VERSION = "1.0"
MODALITIES = ("article", "claim", "image")
_TEXT = ["id", "dataset", "task", "modality", "text", "text_secondary", "image_path", "label_raw"]
LINEAGE_COLUMNS = ["schema_version", "dataset_version", "pipeline_version", "ingested_at"]
CANONICAL = T.StructType(
    [
        *(T.StructField(c, T.StringType(), False) for c in _TEXT),
        T.StructField("label", T.IntegerType(), False),
        T.StructField("metadata", T.StringType(), False),
        *(T.StructField(c, T.StringType(), False) for c in LINEAGE_COLUMNS),
    ]
)
CANONICAL_COLUMNS = CANONICAL.fieldNames()
#: The narrower table without modality and lineage.
CORE_COLUMNS = ["id", "dataset", "task", "text", "text_secondary", "label_raw", "label", "metadata", "image_path"]
PRE_LABEL_COLUMNS = [c for c in CORE_COLUMNS if c != "label"]


def core_view(df: DataFrame) -> DataFrame:
    return df.select(*CORE_COLUMNS)


def canonical_view(df: DataFrame) -> DataFrame:
    """All canonical columns in order; text columns that are absent are empty, never null."""
    have = set(df.columns)
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in have else F.lit("")
    return df.select(*[F.col(c).cast("int").alias(c) if c == "label" else text(c).alias(c) for c in CANONICAL_COLUMNS])


def record(modality: str, values: dict) -> dict:
    """A single record of a modality as a flat row: fields of other modalities are empty."""
    if modality not in MODALITIES:
        raise KeyError(f"unknown modality {modality!r}; known: {', '.join(MODALITIES)}")
    main, second = {"article": ("body", "headline"), "claim": ("claim_text", "context"), "image": ("", "")}[modality]
    return {
        **{k: values.get(k, "") for k in ("id", "dataset", "task", "label_raw")},
        "modality": modality,
        "text": values.get(main, "") if main else "",
        "text_secondary": values.get(second, "") if second else "",
        "image_path": values.get("image_path", "") if modality == "image" else "",
        "metadata": values.get("metadata", {}),
    }
