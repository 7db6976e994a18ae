import zlib

import numpy as np

from millrace.llm import langid as L


def test_held_out_accuracy(docs):
    out = L.language_id(docs).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    for r in out:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1
    held = [r for r in out if r["held_out"] and r["doc_id"] < 10_000 and len(r["text"]) > 50]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.95 * len(held)


def test_edges(docs):
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in L.language_id(docs).collect()}
    assert len(found) == docs.select("doc_id").distinct().count()
    for i in (10_001, 10_002, 10_003, 10_012):
        assert found[i] == ("und", 0.0)
    assert found[10_010][0] != "und" and None in found


def test_small_training_sets(spark, nothing):
    assert L.language_id(nothing).count() == 0
    one = spark.createDataFrame([(i, "bonjour le monde", "fr") for i in range(8)] + [(99, "12 !", None)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in L.language_id(one).collect()}
    assert got[99] == "und" and {got[i] for i in range(8)} == {"fr"}
    none = one.filter("lang is null")
    assert [r["lang_pred"] for r in L.language_id(none).collect()] == ["und"]


def test_prediction_does_not_see_the_label(docs):
    from pyspark.sql import functions as F

    model = L.train(docs)
    a = {r["doc_id"]: r["lang_pred"] for r in L.identify(docs, model).collect()}
    b = {r["doc_id"]: r["lang_pred"] for r in L.identify(docs.withColumn("lang", F.lit("xx")).repartition(5), model).collect()}
    assert a == b


def test_penalty_makes_weights_sparse():
    rng = np.random.default_rng(0)
    rows = []
    for i in range(200):
        ids = np.array([i % 2, *sorted(rng.choice(np.arange(100, 3000), 5, replace=False))])
        rows.append((ids, np.full(6, 1 / np.sqrt(6))))
    y = np.arange(200) % 2
    w, b = L.fit_ftrl(rows, y, 2, l1=0.5)
    assert (w[:, :2] != 0).all() and (w[:, 100:] != 0).mean() < 0.01
