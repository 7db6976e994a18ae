import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from millrace.llm import toxicity as X


def test_index_is_exact():
    rng = np.random.default_rng(1)
    vectors = []
    for _ in range(700):
        ids = np.sort(rng.choice(60, rng.integers(0, 7), replace=False))
        w = rng.random(len(ids)) + 0.1
        vectors.append((ids, w / np.sqrt((w * w).sum()) if len(w) else w))
    vectors += [(v[0].copy(), v[1].copy()) for v in vectors[:100]]  # ties
    index = X.BlockMaxIndex(vectors)
    dense = np.zeros((len(vectors), 60))
    for i, (ids, w) in enumerate(vectors):
        dense[i, ids] = w
    for i in range(0, len(vectors), 7):
        ids, w = vectors[i]
        cosines = dense[:, ids] @ w if len(ids) else np.zeros(len(vectors))
        want = [j for j in np.lexsort((np.arange(len(cosines)), -np.round(cosines, 12))) if cosines[j] > 1e-12][:15]
        got, found = index.search(ids, w, 15)
        assert np.allclose(found, cosines[want]) and len(got) == len(want)
        assert set(got) >= {j for j in want if cosines[j] > cosines[want[-1]] + 1e-9}
        assert i not in index.search(ids, w, 15, without=i)[0]


def planted(spark, n=1200):
    rng, bad = random.Random(2), ["wretch", "rascal", "villain"]
    rows, labels = [], []
    for i in range(n):
        words = [f"n{rng.randrange(4000)}o".replace("0", "a").translate(str.maketrans("123456789", "bcdefghij")) for _ in range(60)]
        toxic = i % 8 == 0
        if toxic:
            for _ in range(4):
                words[rng.randrange(60)] = rng.choice(bad)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_planted(spark):
    docs, labels = planted(spark)
    out = X.score_toxicity(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in out if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    assert all(r["predicted"] == r["toxic"] for r in held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in out)
    train = {r["doc_id"] for r in out if not r["held_out"]}
    assert all(set(r["evidence"]) <= train for r in out)
    few = X.score_toxicity(docs, labels, max_examples=300).join(labels, "doc_id").filter("held_out and predicted != toxic").count()
    assert few <= 0.02 * len(held)


def brute_scores(docs, labels, k=15, floor=0.05, half=40.0):
    """Scores and neighbours from dense vectors over every word of two examples."""
    import math
    from collections import Counter

    texts = sorted(docs)
    label = {}
    for d, t in labels:
        if t is not None and zlib.crc32(str(d).encode()) % 5:
            label[d] = max(label.get(d, 0), int(t == 1))
    bags = [Counter(X.words_of(t)) for _, t in texts]
    example = [i for i, (d, _) in enumerate(texts) if d in label]
    y = np.array([label[texts[i][0]] for i in example], float)
    present = Counter(w for i in example for w in bags[i])
    pos = Counter(w for i, c in zip(example, y) if c for w in bags[i])
    terms = sorted(w for w, n in present.items() if n >= 2)
    n1, n0 = y.sum(), len(y) - y.sum()

    def g2(w):
        p, n = pos[w], present[w] - pos[w]
        cells = ((p, n1, p + n), (n, n0, p + n), (n1 - p, n1, n1 + n0 - p - n), (n0 - n, n0, n1 + n0 - p - n))
        return 2 * sum(s * math.log(s * (n1 + n0) / (a * t)) for s, a, t in cells if s > 0)

    g = np.array([max(g2(w), 0) for w in terms])
    df = Counter(w for b in bags for w in b)
    weight = (np.log((1 + len(texts)) / (1 + np.array([df[w] for w in terms]))) + 1) * (floor + (g / (g + half)) ** 2)
    at = {w: i for i, w in enumerate(terms)}
    dense = np.zeros((len(texts), len(terms)))
    for i, b in enumerate(bags):
        for w, n in b.items():
            if w in at:
                dense[i, at[w]] = (1 + math.log(n)) * weight[at[w]]
    norm = np.linalg.norm(dense, axis=1, keepdims=True)
    dense /= np.where(norm > 0, norm, 1)
    cosines = dense @ dense[example].T

    def neighbours(c):
        return [j for j in np.lexsort((np.arange(len(c)), -np.round(c, 13))) if c[j] > 1e-12][:k]

    def vote(best, c):
        w = 1 / (1.05 - np.minimum(c[best], 1))
        return (w * y[best]).sum() / w.sum()

    votes = []
    for j, i in enumerate(example):
        c = cosines[i].copy()
        c[j] = 0
        best = neighbours(c)
        votes.append(vote(best, c) if best else None)
    has = [v is not None for v in votes]
    slope, offset = X._logistic(np.array([v for v in votes if v is not None]), y[has], np.ones(sum(has)))
    fallback = (y[[not h for h in has]].sum() + y.mean()) / (len(has) - sum(has) + 1)
    out = {}
    for i, (d, _) in enumerate(texts):
        best = neighbours(cosines[i])
        out[d] = (1 / (1 + math.exp(-(slope * vote(best, cosines[i]) + offset))) if best else fallback, [texts[example[j]][0] for j in best[:5]], cosines[i][best] if best else [])
    return out


def test_scores_and_evidence_against_brute_force(spark):
    real = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    for docs, labels in (planted(spark, 500), real):
        expected = brute_scores([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["doc_id"], r["toxic"]) for r in labels.collect()])
        out = X.score_toxicity(docs, labels).collect()
        assert len(out) == len(expected)
        for r in out:
            score, evidence, cosines = expected[r["doc_id"]]
            assert abs(r["score"] - score) < 1e-6
            if len(cosines) > 5 and np.diff(cosines[:6]).max() < -1e-9:  # without ties
                assert r["evidence"] == evidence


def test_repeated_labelled_ids_do_not_depend_on_order(spark):
    docs, labels = planted(spark, 200)
    twice = docs.unionByName(docs.filter("doc_id % 8 = 0").withColumn("text", F.lit("another text of this id rascal")))
    a, b = ([(r["doc_id"], r["score"]) for r in X.score_toxicity(x, labels).orderBy("doc_id", "score").collect()] for x in (twice, twice.repartition(5)))
    assert np.allclose([x[1] for x in a], [x[1] for x in b])


def test_held_out_labels_are_not_used(spark):
    docs, labels = planted(spark, 400)
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    flipped = labels.withColumn("toxic", F.when(fold, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ({r["doc_id"]: r["score"] for r in X.score_toxicity(docs, x).collect()} for x in (labels, flipped))
    assert a == b


def test_edges(docs, labels, nothing):
    out = X.score_toxicity(docs, labels)
    assert out.count() == docs.count() and out.filter("score is null or score < 0 or score > 1").count() == 0
    assert X.score_toxicity(nothing, labels).count() == 0
    blind = X.score_toxicity(docs, labels.filter("false")).select("score").distinct().collect()
    assert [r[0] for r in blind] == [0.0]
