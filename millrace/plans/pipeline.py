"""Dataset jobs: clean, explore, profile, split; each reports OK, SKIPPED or FAILED and stops no other."""

from __future__ import annotations

import logging
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..lineage import STAGES, LineageTracker, stamp
from ..operators import dedup, labels, missing, profile, split, validate
from ..operators.normalize import ORDINAL, SPECS, NormalizeSpec, normalize
from ..registry import DatasetManager, DatasetSpec
from ..schema import canonical_view
from ..sources import sinks
from ..sources.readers import LOADERS

log = logging.getLogger(__name__)


def clean(raw: DataFrame, spec: NormalizeSpec, label_map: dict[str, int], settings: dict, tracker: LineageTracker | None = None) -> DataFrame:
    """Raw rows (with their ordinal) to labelled canonical rows, one lazy plan; ``row_seq`` stays for order."""
    see = tracker.observe if tracker else lambda stage, df: df
    df = see(STAGES[0], raw)
    df = see(STAGES[1], normalize(df, spec))
    if spec.modality == "image":
        df = see(STAGES[2], missing.drop_rows_missing_required(df, ["image_path", "label_raw"]))
        df = see(STAGES[3], dedup.drop_exact_duplicates(df, ["image_path"], ORDINAL))
    else:
        df = df.withColumn("text", X.clean_text(F.col("text")))
        df = see(STAGES[2], missing.drop_rows_missing_required(df, ["text", "label_raw"]))
        if settings.get("language_filter") and "lang" in df.columns:
            df = df.filter(F.col("lang") == settings["language_filter"])
        df = see(STAGES[3], dedup.drop_exact_duplicates(df, settings.get("drop_duplicates_on") or ["text"], ORDINAL))
        df = see(STAGES[4], dedup.drop_near_duplicates(df, "text", ORDINAL))
        if settings.get("enforce_text_length"):
            df = df.filter(F.length("text").between(settings["min_text_length"], settings["max_text_length"]))
    return see(STAGES[5], labels.drop_unmapped(labels.apply_label_map(df, label_map)))


def clean_one(spark: SparkSession, manager: DatasetManager, config: dict, key: str, loader: Callable | None = None) -> dict:
    """Cleans one dataset to a staged table, validates it and publishes it; returns the manifest."""
    spec: DatasetSpec = manager.get(key)
    sinks.restore(spark, manager.processed_path(key))
    raw = (loader or LOADERS[key])(spark, manager.raw_dir(key))
    tracker = LineageTracker(key, spec.dataset_version, config["pipeline_version"], {k: getattr(spec, k) for k in ("name", "modality", "task", "source")})
    rows = clean(raw, SPECS[key], spec.label_map, config["cleaning"], tracker)
    rows = canonical_view(stamp(rows, spec.dataset_version, config["pipeline_version"]))
    final = manager.processed_path(key)
    staged = final.with_name(f"_staged_{final.name}")
    sinks.write_table(rows, staged)
    done = spark.read.parquet(str(staged))
    limits = config["cleaning"]
    found = validate.run_all(done, sorted(set(spec.label_map.values())), limits["min_text_length"], limits["max_text_length"])
    if found["too_short"] or found["too_long"]:
        log.warning("%s: %s texts too short, %s too long", key, found["too_short"], found["too_long"])
    sinks.publish(spark, staged, final)
    published = spark.read.parquet(str(final))
    log.info("%s: missing values\n%s", key, sinks.markdown_table(missing.missing_value_report(published)))
    return tracker.finalize(published, manager.lineage_path(key))


def _each(manager: DatasetManager, job: Callable[[str], object]) -> dict[str, str]:
    outcome = {}
    for key in manager.list_keys():
        try:
            job(key)
            outcome[key] = "OK"
        except FileNotFoundError as e:
            outcome[key] = f"SKIPPED: {e}"
        except Exception as e:  # noqa: BLE001 - one dataset's failure stops no other
            log.exception("%s failed", key)
            outcome[key] = f"FAILED: {e}"
    return outcome


def clean_all(spark: SparkSession, manager: DatasetManager, config: dict) -> dict[str, str]:
    return _each(manager, lambda key: clean_one(spark, manager, config, key))


def _processed(spark: SparkSession, manager: DatasetManager, key: str) -> DataFrame:
    path = manager.processed_path(key)
    if not path.exists():
        raise FileNotFoundError(f"{path} not found; clean first")
    return spark.read.parquet(str(path))


def eda_section(spark: SparkSession, manager: DatasetManager, key: str, figures: str | Path | None = None) -> str:
    df = _processed(spark, manager, key)
    table = sinks.markdown_table
    distribution = labels.label_distribution(df)
    parts = [f"## {key}", f"- **Rows:** {df.count()}", "### Classes", table(distribution), "### Missing values", table(missing.missing_value_report(df))]
    if figures:
        sinks.bar_chart([(str(r[0]), r[1]) for r in distribution.collect()], Path(figures) / f"{key}_class_distribution.png", f"{key}: classes")
    if manager.get(key).modality != "image":
        histogram = profile.length_histogram(df).orderBy("bin")
        parts += ["### Duplicates", table(dedup.duplicate_report(df, "text")), "### Lengths", table(profile.text_length_stats(df))]
        parts += ["### Word counts (clipped at the 99th percentile)", table(histogram)]
        parts += ["### Vocabulary", table(profile.vocab_size(df)), table(profile.vocab_top(df))]
        if figures:
            sinks.bar_chart([(str(r[0]), r[1]) for r in histogram.collect()], Path(figures) / f"{key}_word_length_hist.png", f"{key}: word counts")
    return "\n\n".join(parts) + "\n"


def profile_section(spark: SparkSession, manager: DatasetManager, key: str) -> str:
    df, spec, table = _processed(spark, manager, key), manager.get(key), sinks.markdown_table
    parts = [f"## {key}", f"- modality {spec.modality}, task {spec.task}, version {spec.dataset_version}", "### Cardinality", table(profile.column_cardinality(df))]
    if spec.modality == "image":
        from ..operators import images

        seen = images.inspect(spark, df, str(manager.raw_dir(key))).cache()
        parts += [table(images.integrity(seen)), table(images.formats(seen)), table(images.profile(seen))]
        seen.unpersist()
    else:
        parts += ["### Word count by label", table(profile.length_by_label(df)), "### Outliers", table(profile.length_outliers(df)), "### Bigrams", table(profile.bigram_top(df))]
    return "\n\n".join(parts) + "\n"


def _report(manager: DatasetManager, title: str, section: Callable[[str], str], path: Path) -> dict[str, str]:
    text = [f"# {title}\n"]
    outcome = _each(manager, lambda key: text.append(section(key)))
    text += [f"## {k}\n\n_{v}_\n" for k, v in outcome.items() if v != "OK"]
    sinks.write_text("\n".join(text), path)
    return outcome


def eda_all(spark: SparkSession, manager: DatasetManager, figures: str | Path | None = None) -> dict[str, str]:
    return _report(manager, "Exploratory report", lambda key: eda_section(spark, manager, key, figures), manager.eda_path())


def profile_all(spark: SparkSession, manager: DatasetManager) -> dict[str, str]:
    return _report(manager, "Profile", lambda key: profile_section(spark, manager, key), manager.profiling_path())


def split_one(spark: SparkSession, manager: DatasetManager, config: dict, key: str) -> None:
    df, s = _processed(spark, manager, key), config["splitting"]
    stratify = s["stratify"] and split.can_stratify(df)
    if s["stratify"] and not stratify:
        log.warning("%s: a class has fewer than two rows; splitting without strata", key)
    rows = split.stratified_split(df, s["train_ratio"], s["val_ratio"], s["test_ratio"], s["random_seed"], stratify)
    sinks.write_table(rows, manager.splits_dir(key) / "all.parquet", ["split"])


def split_all(spark: SparkSession, manager: DatasetManager, config: dict) -> dict[str, str]:
    return _each(manager, lambda key: split_one(spark, manager, config, key))


def run_all(spark: SparkSession, manager: DatasetManager, config: dict) -> dict[str, dict[str, str]]:
    """All stages; later ones run whatever earlier ones report."""
    return {
        "clean": clean_all(spark, manager, config),
        "eda": eda_all(spark, manager),
        "profile": profile_all(spark, manager),
        "split": split_all(spark, manager, config),
    }
