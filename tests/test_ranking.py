"""Bounded top-k against scoring everything."""

import math
from collections import Counter

import numpy as np
import pytest

from millrace.operators import ranking as R


def brute(claims, texts, k):
    bags = {i: Counter((t or "").lower().split()) for i, t in texts}
    mean = max(sum(sum(b.values()) for b in bags.values()) / len(bags), 1.0)
    df = Counter(w for b in bags.values() for w in b)
    impact = lambda b, w: math.log(1 + (len(bags) - df[w] + 0.5) / (df[w] + 0.5)) * b[w] * 2.2 / (b[w] + 1.2 * (0.25 + 0.75 * sum(b.values()) / mean))
    out = []
    for c, text in claims:
        words = {*(text or "").lower().split()}
        scored = sorted((-round(sum(impact(b, w) for w in words if b[w]), 9), i) for i, b in bags.items() if any(b[w] for w in words))
        out += [(c, i, n + 1) for n, (_, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.fixture(scope="module")
def corpus():
    """Words by Zipf: the first is in nearly every text."""
    rng = np.random.default_rng(8)
    word = lambda: "w" + "abcdefghij"[(n := min(int(rng.zipf(1.4)), 400)) % 10] + "klmnopqrst"[n // 10 % 10] + "uvxyz"[n // 100]
    texts = [(i, " ".join(word() for _ in range(int(rng.integers(1, 40))))) for i in range(600)]
    texts += [(600, None), (601, ""), (602, texts[3][1]), (603, texts[3][1])]
    claims = [(i, " ".join(word() for _ in range(int(rng.integers(1, 12))))) for i in range(60)]
    return [*claims, (60, None), (61, "unheard"), (62, texts[3][1]), (63, "wbku wbku wbku")], texts


@pytest.mark.parametrize(("k", "block_texts", "part_rows", "seeds"), [(1, 8, 50, 1), (5, 16, 1000, 3), (20, 600, 7, 8)])
def test_equals_scoring_everything(spark, corpus, k, block_texts, part_rows, seeds):
    claims, texts = corpus
    known = R.index(spark.createDataFrame(texts, "evidence_id int, text string"), block_texts=block_texts, part_rows=part_rows)
    found = R.rank(spark.createDataFrame(claims, "claim_id int, text string"), known, k, seed_terms=seeds)
    assert sorted((r["claim_id"], r["evidence_id"], r["rank"]) for r in found.collect()) == brute(claims, texts, k)


def test_frequent_terms_are_not_joined_out(spark, corpus):
    """Far fewer texts are scored than share a term with a claim, and inessential terms exist."""
    claims, texts = corpus
    known = R.index(spark.createDataFrame(texts, "evidence_id int, text string"), block_texts=8)
    words = spark.createDataFrame(claims, "claim_id int, text string").selectExpr("claim_id", "explode(array_distinct(split(lower(text), ' '))) AS term")
    asked = words.join(known.terms, "term")
    share = asked.join(known.postings, "term").select("claim_id", "evidence_id").distinct().count()
    assert R.candidates(asked, known, 3).count() < 0.35 * share


def test_parts_of_a_frequent_term(spark, corpus):
    known = R.index(spark.createDataFrame(corpus[1], "evidence_id int, text string"), part_rows=20)
    rows = known.postings.groupBy("term", "part").count().join(known.terms, "term").collect()
    assert max(r["count"] for r in rows if r["df"] > 200) < 60


def test_counts_inside_a_row(spark):
    rows = spark.createDataFrame([(["b", "a", "b", "b"],), ([],), (None,), (["x"],)], "w array<string>").select(R.counts(__import__("pyspark.sql.functions", fromlist=["x"]).col("w")).alias("c")).collect()
    assert [sorted(map(tuple, r["c"] or [])) for r in rows] == [[("a", 1, 4), ("b", 3, 4)], [], [], [("x", 1, 1)]]


def test_empty(spark):
    none = spark.createDataFrame([], "evidence_id int, text string")
    known = R.index(none)
    assert R.rank(spark.createDataFrame([(1, "a")], "claim_id int, text string"), known).count() == 0
    known = R.index(spark.createDataFrame([(1, "a b")], "evidence_id int, text string"))
    assert R.rank(spark.createDataFrame([], "claim_id int, text string"), known).count() == 0


@pytest.mark.parametrize("k", [1, 5, 20])
def test_pairs_in_cells_equal_scoring_everything(spark, corpus, k):
    """Many claims of frequent words: no table of pairs is written, ties and copies are ranked as before."""
    claims, texts = corpus
    known = R.index(spark.createDataFrame([*texts, *((700 + i, t) for i, t in texts[:50])], "evidence_id int, text string"))
    found = R.rank(spark.createDataFrame(claims, "claim_id int, text string"), known, k, pair_rows=0)
    assert sorted((r["claim_id"], r["evidence_id"], r["rank"]) for r in found.collect()) == brute(claims, [*texts, *((700 + i, t) for i, t in texts[:50])], k)


def test_texts_are_read_and_split_once(spark, corpus):
    from pyspark.sql import functions as F

    claims, texts = corpus
    read = spark.sparkContext.accumulator(0)

    def seen(text):
        read.add(1)
        return text

    evidence = spark.createDataFrame(texts, "evidence_id int, text string").withColumn("text", F.udf(seen, "string")("text"))
    asked = R.claim_terms(spark.createDataFrame(claims, "claim_id int, text string"))
    known = R.index(evidence, only=asked)
    assert known.postings.count() > 0 and read.value == len(texts)
    assert known.terms.filter("term = ''").count() == 0


@pytest.mark.parametrize(("k", "claim_rows", "text_rows"), [(1, 50, 1000), (5, 10**6, 10**6), (20, 10**6, 300)])
def test_whole_texts_in_cells_equal_scoring_everything(spark, corpus, k, claim_rows, text_rows):
    """Texts are dealt whole: no posting is moved to its term, and copies and ties are ranked as before."""
    claims, texts = corpus
    texts = [*texts, *((700 + i, t) for i, t in texts[:50])]
    found = R.ranked(spark.createDataFrame(claims, "claim_id int, text string"), spark.createDataFrame(texts, "evidence_id int, text string"), k, asked_rows=0, claim_rows=claim_rows, text_rows=text_rows)
    assert sorted((r["claim_id"], r["evidence_id"], r["rank"]) for r in found.collect()) == brute(claims, texts, k)
    assert "term" not in found._jdf.queryExecution().optimizedPlan().toString().split("FlatMapCoGroupsInArrow")[0]


def test_words_of_one_hash_stay_apart(spark, corpus, monkeypatch):
    from pyspark.sql import functions as F

    claims, texts = corpus
    monkeypatch.setattr(R, "_hash", lambda term, seed: F.xxhash64(F.lit(seed), term) if seed else F.length(term).cast("bigint"))
    found = R.ranked(spark.createDataFrame(claims, "claim_id int, text string"), spark.createDataFrame(texts, "evidence_id int, text string"), 3, asked_rows=0)
    assert sorted((r["claim_id"], r["evidence_id"], r["rank"]) for r in found.collect()) == brute(claims, texts, 3)
    none = spark.createDataFrame([], "evidence_id int, text string")
    assert R.ranked(spark.createDataFrame([(1, "a")], "claim_id int, text string"), none, 3, asked_rows=0).count() == 0


@pytest.mark.parametrize(("frequent", "matrix", "scored", "k"), [(16, 1 << 20, 1 << 20, 10), (10**9, 1 << 30, 7, 3), (1, 0, 100, 1), (8, 9000, 50, 700)])
def test_best_of_a_cell_is_exact(monkeypatch, frequent, matrix, scored, k):
    """Sums in single precision only choose what is scored, by matrix, by postings or by both."""
    monkeypatch.setattr(R, "FREQUENT", frequent)
    monkeypatch.setattr(R, "MATRIX_BYTES", matrix)
    monkeypatch.setattr(R, "SCORED_ROWS", scored)
    rng = np.random.default_rng(5)
    lists = lambda n, most: [np.unique(rng.zipf(1.3, rng.integers(0, most)) % 90) for _ in range(n)]
    claims, texts = lists(70, 30), lists(500, 40)
    texts += texts[:40]
    impacts = [1e3 * (1 + 1e-9 * np.sin(t)) + t for t in texts]
    ends = lambda rows: np.r_[0, np.cumsum([len(r) for r in rows])]
    order = rng.permutation(len(texts))
    parts = list(R._best(ends(claims), np.concatenate(claims), ends(texts), np.concatenate(texts), np.concatenate(impacts), 90, order, k))
    got = {(c, t): s for part in parts for c, t, s in zip(*(x.tolist() for x in part))}
    for c, words in enumerate(claims):
        scores = [(-round(float(sum(i[np.isin(t, words)])), 9), order[n], n) for n, (t, i) in enumerate(zip(texts, impacts)) if np.isin(t, words).any()]
        for s, _, n in sorted(scores)[:k]:
            assert got[c, n] == pytest.approx(-s, abs=1e-8)
