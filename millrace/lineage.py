"""Lineage: stamps on rows and a manifest of row counts by stage."""

from __future__ import annotations

import json
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .schema import SCHEMA_VERSION

#: Stage names in their order.
STAGES = ["raw_loaded", "after_schema_normalization", "after_missing_value_drop", "after_exact_dedup", "after_near_dedup", "after_label_mapping"]


def now_iso() -> str:
    return datetime.now(timezone.utc).isoformat(timespec="seconds")


def stamp(df: DataFrame, dataset_version: str, pipeline_version: str, ingested_at: str | None = None) -> DataFrame:
    """The four lineage columns, overwritten where they exist."""
    return df.withColumns(
        {
            "schema_version": F.lit(SCHEMA_VERSION),
            "dataset_version": F.lit(dataset_version),
            "pipeline_version": F.lit(pipeline_version),
            "ingested_at": F.lit(ingested_at or now_iso()),
        }
    )


class LineageTracker:
    """Row counts by stage.

    ``observe`` counts rows as they pass, in the job that writes the result; ``checkpoint``
    takes a number that is known already.  ``about`` holds the dataset's name, modality, task and source.
    """

    def __init__(self, dataset: str, dataset_version: str = "unknown", pipeline_version: str = "unknown", about: dict[str, str] | None = None):
        self.dataset, self.dataset_version, self.pipeline_version = dataset, dataset_version, pipeline_version
        self.about, self.started_at = about or {}, now_iso()
        self._stages: list[tuple[str, int | Observation]] = []

    def observe(self, stage: str, df: DataFrame) -> DataFrame:
        seen = Observation(f"{self.dataset}:{stage}:{len(self._stages)}")
        self._stages.append((stage, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("n"))

    def checkpoint(self, stage: str, n_rows: int) -> None:
        self._stages.append((stage, n_rows))

    def finalize(self, df: DataFrame, path: str | Path | None = None, label: str = "label") -> dict:
        counts = {str(r[0]): r[1] for r in df.groupBy(label).agg(F.count(F.lit(1))).collect()}
        # The key names of the manifest.
        manifest = {
            "dataset_key": self.dataset,
            "dataset_name": self.about.get("name", self.dataset),
            **{k: self.about.get(k) for k in ("modality", "task", "source")},
            "dataset_version": self.dataset_version,
            "schema_version": SCHEMA_VERSION,
            "pipeline_version": self.pipeline_version,
            "pipeline_run_started_at": self.started_at,
            "pipeline_run_finished_at": now_iso(),
            "row_count_checkpoints": [{"stage": s, "n_rows": x if isinstance(x, int) else x.get["n"]} for s, x in self._stages],
            "final_row_count": sum(counts.values()),
            "final_label_distribution": counts,
        }
        if path:
            Path(path).parent.mkdir(parents=True, exist_ok=True)
            Path(path).write_text(json.dumps(manifest, indent=2, ensure_ascii=False))
        return manifest
