import re
from collections import Counter

import public_tokenizers as P
import pytest

import corpus_pipeline as pipeline

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark, docs, tmp_path):
    assert [n for n, _ in pipeline.STAGES] == ["quality_rules", "exact_dedup", "simhash_near_dedup", "source_mixing", "byte_bpe"]
    now, seen = docs, {"start": docs}
    for name, stage in pipeline.STAGES:
        out = stage(spark, now, SF)
        out.write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        if name != "byte_bpe":
            assert now.columns == docs.columns
        seen[name] = now
    n = {k: v.count() for k, v in seen.items()}
    assert n["start"] > n["quality_rules"] > n["exact_dedup"] >= n["simhash_near_dedup"] > 0 and n["byte_bpe"] == n["source_mixing"]
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "") for r in seen["exact_dedup"].collect()]
    assert len(set(texts)) == len(texts) == len({re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "") for r in seen["quality_rules"].collect()})
    assert max(Counter(r["doc_id"] for r in seen["source_mixing"].collect()).values()) <= 3


def test_run(spark):
    out = pipeline.run(spark, SF)
    assert out.count() > 0 and out.filter("size(token_ids) != n_tokens").count() == 0


@pytest.mark.parametrize("stage", [s for _, s in pipeline.STAGES], ids=[n for n, _ in pipeline.STAGES])
def test_empty_input(spark, nothing, stage):
    assert stage(spark, nothing, SF).count() == 0


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names and {int(n[2:].split("_")[0]) for n in names if re.match(r"op\d+_", n)} == set(range(1, 14))
    assert set(entry.oracle_sql()) <= names and P.PATTERN
