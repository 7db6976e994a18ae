"""Cleaning, labels, validation, splits: small tables with known results."""

import pytest
from pyspark.sql import functions as F

from millrace import registry, schema
from millrace.functions.text import alpha_tokens, bigrams
from millrace.lineage import LineageTracker, stamp
from millrace.operators import dedup, labels, missing, profile, split, validate
from millrace.operators.normalize import SPECS, normalize, with_ordinal


def test_dedup(spark):
    df = spark.createDataFrame([(0, "a"), (1, "a"), (2, "b"), (3, "c"), (4, "c"), (5, None), (6, None)], "id long, text string")
    assert sorted(r[0] for r in dedup.drop_exact_duplicates(df, ["text"], "id").collect()) == [0, 2, 3, 5]
    near = spark.createDataFrame([(0, "Hello World!"), (1, "hello   world"), (2, "Goodbye"), (3, "日本"), (4, "中国")], "id long, text string")
    assert sorted(r[0] for r in dedup.drop_near_duplicates(near, "text", "id").collect()) == [0, 2, 3]
    assert sorted(r[0] for r in dedup.drop_near_duplicates(near, "text", "id", True).collect()) == [0, 2, 3, 4]
    assert dedup.duplicate_report(df, "text").collect()[0].asDict() == {"total_rows": 7, "exact_duplicates": 3, "near_duplicates": 3, "exact_pct": 42.86, "near_pct": 42.86}


def test_dedup_does_not_depend_on_partitioning(spark):
    df = spark.range(500).select("id", (F.col("id") % 37).cast("string").alias("text"))
    results = [sorted(r[0] for r in dedup.drop_exact_duplicates(df.repartition(n), ["text"], "id").collect()) for n in (1, 17)]
    assert results[0] == results[1] == list(range(37))


def test_missing(spark):
    df = spark.createDataFrame([("ok", "a"), ("", "b"), (None, "c"), ("  ", "e"), ("fine", "d")], "text string, label_raw string")
    assert [r[0] for r in missing.drop_rows_missing_required(df, ["text", "label_raw"]).collect()] == ["ok", "fine"]
    report = {r["column"]: (r["n_null"], r["n_blank"], r["pct_missing"]) for r in missing.missing_value_report(df).collect()}
    assert report == {"text": (1, 2, 60.0), "label_raw": (0, 0, 0.0)}
    numbers = spark.createDataFrame([(1.0, "x"), (None, ""), (3.0, "z")], "a double, b string")
    assert {r["column"] for r in missing.missing_value_report(numbers).collect()} == {"a", "b"}
    assert missing.fill_optional_missing(numbers, {"a": 0.0, "zz": 1}).filter("a = 0").count() == 1


def test_label_map(spark):
    df = spark.createDataFrame([("Fake",), ("True",), ("Unknown",), (" fAKE ",), (None,)], "label_raw string")
    out = labels.apply_label_map(df, {"Fake": 0, "True": 1, "fake": 9})
    assert [r["label"] for r in out.collect()] == [0, 1, -1, 0, -1]
    assert {r[0]: r[1] for r in labels.unmapped_values(out).collect()} == {None: 1, "Unknown": 1}
    assert labels.apply_label_map(df, {}).filter("label != -1").count() == 0
    assert [(r[0], r[1], r[2]) for r in labels.label_distribution(out).collect()] == [(-1, 2, 40.0), (0, 2, 40.0), (1, 1, 20.0)]


def test_validation(spark):
    good = spark.createDataFrame([("a", "d", "t", "x" * 5, "", "l", 1, "{}", "")], schema.CORE_COLUMNS)
    assert validate.run_all(good, [0, 1])["too_short"] == 0
    with pytest.raises(validate.ValidationError):
        validate.validate_schema(good.drop("label"))
    with pytest.raises(validate.ValidationError):
        validate.run_all(good, [0])
    with pytest.raises(validate.ValidationError):
        validate.validate_labels(good, [5])
    with pytest.raises(validate.ValidationError):
        validate.validate_no_nulls(good.withColumn("id", F.lit(None)), ["id"])
    assert validate.text_length_counts(good, 10, 100) == {"too_short": 1, "too_long": 0}


def test_registry():
    config = registry.load_config()
    assert {"paths", "datasets", "cleaning", "splitting", "pipeline_version"} <= set(config) and len(config["datasets"]) == 5
    m = registry.DatasetManager.from_config(config)
    assert set(m.list_keys()) == {"fake_real_news", "claim_verification", "fact_checking", "image_forensics", "ai_text_detection"}
    assert [len(m.by_modality(x)) for x in schema.MODALITIES] == [2, 2, 1]
    assert m.get("fact_checking").label_map["true"] == 5 and m.by_task("fake_news") == ["fake_real_news"]
    with pytest.raises(KeyError):
        m.get("nope")
    m.register("mine", registry.DatasetSpec("mine", "n", "claim", "t", "url", "raw"))
    assert "mine" in m.list_keys() and m.get("mine").dataset_version == "unknown"
    assert registry.DatasetSpec.from_dict("k", {"name": "n", "modality": "claim", "task": "t", "source": "s", "raw_subdir": "r", "odd": 1}).extra == {"odd": 1}
    with pytest.raises(KeyError):
        registry.DatasetSpec.from_dict("k", {"name": "n"})


def test_records():
    a = schema.record("article", {"body": "b", "headline": "h"})
    assert (a["text"], a["text_secondary"], a["image_path"], a["modality"]) == ("b", "h", "", "article")
    assert schema.record("claim", {"claim_text": "c", "context": "x"})["text"] == "c"
    image = schema.record("image", {"image_path": "p.png"})
    assert (image["text"], image["image_path"]) == ("", "p.png")
    assert {"modality", *schema.LINEAGE_COLUMNS} <= set(schema.CANONICAL_COLUMNS)


def test_normalize_and_lineage(spark, tmp_path):
    raw = spark.createDataFrame([(0, "body", "head", "s", None, "Fake")], "row_seq long, text string, title string, subject string, date string, label string")
    row = normalize(raw, SPECS["fake_real_news"]).collect()[0]
    assert (row["id"], row["text_secondary"], row["metadata"]) == ("fake_real_news_0000000", "head", '{"subject":"s","date":null}')
    no_title = normalize(raw.drop("title"), SPECS["fake_real_news"]).collect()[0]
    assert no_title["text_secondary"] == ""
    df = stamp(spark.createDataFrame([("a", 0), ("b", 1), ("c", 0), ("d", 1), ("e", 1)], "text string, label int"), "v1", "p1")
    assert set(schema.LINEAGE_COLUMNS) <= set(df.columns)
    tracker = LineageTracker("d", "v1", "p1")
    seen = tracker.observe("raw_loaded", df)
    tracker.checkpoint("after_label_mapping", 5)
    seen.write.mode("overwrite").parquet(str(tmp_path / "x.parquet"))
    manifest = tracker.finalize(spark.read.parquet(str(tmp_path / "x.parquet")), tmp_path / "m.json")
    assert manifest["final_row_count"] == 5 and manifest["final_label_distribution"]["1"] == 3
    assert [c["n_rows"] for c in manifest["row_count_checkpoints"]] == [5, 5] and (tmp_path / "m.json").exists()


def test_ordinal(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"))
    assert with_ordinal(df, ["k"]).filter("k != row_seq").count() == 0


@pytest.mark.parametrize("n", [1, 2, 11, 399])
def test_split(spark, n):
    df = spark.range(n).select("id", (F.col("id") % 3).cast("int").alias("label"))
    results = []
    for parts in (1, 7):
        rows = split.stratified_split(df.repartition(parts), stratify=n > 3).collect()
        assert len(rows) == n and len({r["id"] for r in rows}) == n
        results.append(sorted((r["id"], r["split"]) for r in rows))
    assert results[0] == results[1]
    strata = {}
    for r in rows:
        strata.setdefault(r["label"] if n > 3 else 0, []).append(r["split"])
    for s in strata.values():
        assert s.count("train") == int(len(s) * 0.8)


def test_split_guards(spark):
    df = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "id long, label int")
    assert not split.can_stratify(df) and split.can_stratify(df.filter("label = 0"))
    with pytest.raises(ValueError):
        split.stratified_split(df, 0.5, 0.1, 0.1)
    assert [r["id"] for r in split.sample_k(df, 2).collect()] == [r["id"] for r in split.sample_k(df.repartition(3), 2).collect()]


def test_profiles(spark):
    df = spark.createDataFrame([(0, "a b c"), (0, "a"), (1, "a b")], "label int, text string")
    rows = {r["label"]: r for r in profile.length_by_label(df).collect()}
    assert rows[0]["mean_words"] == 2.0 and rows[1]["std_words"] is None
    same = spark.createDataFrame([("a b",)] * 5, "text string")
    out = profile.length_outliers(same).collect()[0]
    assert (out["lower_bound_words"], out["upper_bound_words"], out["pct_outliers"]) == (2, 2, 0.0)
    assert [tuple(r) for r in profile.length_histogram(same).collect()] == [(1, 5)]
    ties = spark.createDataFrame([("pear apple fig",), ("fig apple pear",)], "text string")
    assert [r["term"] for r in profile.vocab_top(ties, k=2).collect()] == ["apple", "fig"]


def test_top_terms_count_few_terms(spark):
    from collections import Counter

    words = [f"{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyz'[i // 100 % 6]}" for i in range(600)]
    texts = [" ".join([*words[i * 6 : i * 6 + 6], *(words[n] for n in range(i % 7))]) for i in range(100)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    flat = spark.createDataFrame([(" ".join(words),)] * 2, "text string")
    for rows, data in ((df, texts), (flat, [" ".join(words)] * 2)):
        pairs = Counter(f"{a} {b}" for t in data for a, b in zip(t.split(), t.split()[1:]))
        expected = sorted(pairs.items(), key=lambda x: (-x[1], x[0]))
        terms = rows.select(F.explode(bigrams(alpha_tokens(F.col("text")))).alias("term"))
        for k, buckets in ((5, 1 << 20), (5, 7), (5000, 64)):
            assert [tuple(r) for r in profile._top(terms, k, buckets).collect()] == expected[:k]
    # Where the best stand out, what is left to count is the terms of the fullest buckets, not of all.
    plan = profile.bigram_top(df, k=2)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan
