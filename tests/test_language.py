"""Rank-order profiles against a plain version, defined cases, and accuracy on rows that were not learned from."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.operators import language as L

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, lang string, text string"


def plain_ranks(texts, size):
    grams = Counter()
    for t in texts:
        for word in re.findall(r"[^\W\d_]+", (t or "").lower()):
            edged = "_" + word + "_"
            grams.update(edged[i:j] for i in range(len(edged)) for j in range(i + 1, min(i + 3, len(edged)) + 1) if edged[i:j] != "_")
    return sorted(grams, key=lambda g: (-grams[g], g))[:size]


def plain_detect(text, learned, size):
    if text is None or len(text) < 10:
        return None, None
    own = plain_ranks([text], size)
    far = {lang: sum(abs(i - p.index(g)) if g in p else size for i, g in enumerate(own)) for lang, p in learned.items() if set(own) & set(p)}
    if not far:
        return "unknown", None
    lang = min(far, key=lambda x: (far[x], x))
    return lang, far[lang]


ROWS = [
    (1, "xx", "the cat sat on the mat, the cat"), (2, "xx", "the dog and the other"), (3, "yy", "der Hund und die Katze ÄÖ"), (4, "yy", "und der andere Hund"),
    (5, None, "the hound und die others"), (6, None, None), (7, None, ""), (8, None, "the"), (9, None, "123456 7890 !!"), (10, "zz", None), (11, "zz", ""),
    (12, None, "привет мир"), (13, None, "ThE THE the der DER der"), (14, None, "the cat " * 30000), (14, None, "x" * 200000), (15, "yy", "der Hund und die Katze ÄÖ"),
]


@pytest.mark.parametrize("size", [5, 300])
def test_equal_to_plain_version(spark, size):
    df = spark.createDataFrame(ROWS, SCHEMA)
    texts = {}
    for _, lang, text in ROWS:
        if lang:
            texts.setdefault(lang, []).append(text)
    expected = {lang: plain_ranks(t, size) for lang, t in texts.items()}
    learned = {}
    profiles = L.learn(df, size=size)
    for r in profiles.orderBy("rank").collect():
        learned.setdefault(r["lang"], []).append(r["gram"])
    assert learned == {lang: g for lang, g in expected.items() if g}
    got = L.detect(df, profiles, size=size).select("doc_id", "text", "detected.lang", "detected.distance").collect()
    assert len(got) == len(ROWS)
    for r in got:
        assert (r["lang"], r["distance"]) == plain_detect(r["text"], learned, size), r["doc_id"]


def test_empty_tables_and_clashing_columns(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).withColumns({"gram": F.lit(1), "rank": F.lit("a"), "n": F.lit(None), "word": F.lit(2)})
    assert L.detect(df, L.learn(df)).filter("detected.lang = 'xx'").count() >= 3
    none = df.limit(0)
    assert L.learn(none).count() == 0
    assert {r[0] for r in L.detect(df, L.learn(none)).select("detected.lang").collect()} == {None, "unknown"}
    assert L.detect(none, L.learn(df)).count() == 0
    assert L.sampled_distribution(none, L.learn(df)).count() == 0


def test_too_many_languages_are_refused(spark, monkeypatch):
    monkeypatch.setattr(L, "MAX_LANGUAGES", 1)
    df = spark.createDataFrame([(1, "a", "abcdef"), (2, "b", "ghijkl")], SCHEMA)
    with pytest.raises(ValueError, match="languages"):
        L.detect(df, L.learn(df, size=5), size=5)


def test_accuracy_on_rows_not_learned_from(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("lang IS NOT NULL AND text IS NOT NULL")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    found = L.detect(docs.filter(held), L.learn(docs.filter(~held))).filter("detected.lang != 'unknown'")
    right, n = found.agg(F.count_if(F.col("detected.lang") == F.col("lang")), F.count(F.lit(1))).first()
    assert n > 150 and right / n > 0.95, (right, n)


def test_sample_is_seeded(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    profiles = L.learn(docs)
    one, two = (L.sampled_distribution(docs.repartition(k), profiles, sample_n=100).collect() for k in (2, 7))
    assert one == two and sum(r["n"] for r in one) <= 100
    assert one[0]["shown"] == f"{one[0]['n']} ({one[0]['pct']:.1f}%)"
