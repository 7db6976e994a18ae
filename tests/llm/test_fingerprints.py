import hashlib
import math
from statistics import mean

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import fingerprints as P


@pytest.fixture(scope="module")
def report(docs):
    return P.fingerprint_report(docs).collect()


def next_of(docs):
    """(id, text) and the text of the following row, ordered by id, hash of the text, nulls last."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text")).collect()
    rows.sort(key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["h"]))
    return [(r["doc_id"], r["text"], rows[(i + 1) % len(rows)]["text"]) for i, r in enumerate(rows)]


def test_edited_texts(docs, report):
    want = []
    for doc_id, text, following in next_of(docs):
        n = len(text) // 4
        edit = text[: len(text) - n] + following[:n]
        want.append((doc_id, len(text), hashlib.sha256(edit.encode()).hexdigest()))
    order = lambda t: (t[0] is None, t)
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in report), key=order) == sorted(want, key=order)


def test_likeness(report):
    apart = lambda a, b: (int(a, 16) ^ int(b, 16)).bit_count()
    for r in report:
        assert len(r["fingerprint"]) == 64
        assert r["near_edited"] == pytest.approx(max(0.0, math.cos(math.pi * apart(r["fingerprint"], r["edited_fingerprint"]) / 256)))
        assert 0 <= r["near_next"] <= 1
    usual = [r for r in report if r["doc_id"] is not None and r["doc_id"] < 10_000 and r["n_chars"] > 60]
    assert mean(r["near_edited"] for r in usual) > 0.65 and mean(r["near_next"] for r in usual) < 0.15
    assert mean(r["near_edited"] > r["near_next"] for r in usual) > 0.99


def test_votes_by_hand(spark):
    """A bit is set if its weight is over half of all, by plain sums over each bit."""
    rows = spark.createDataFrame([(1, 5), (1, 8), (1, -3), (2, 7), (3, None)], "k int, t bigint")
    hashed = rows.select("k", "t", F.xxhash64("t", F.lit(0)).alias("a"), F.xxhash64("t", F.lit(1)).alias("b")).collect()
    for r in P.votes(rows, ["k"], "t", 128).collect():
        mine = [h for h in hashed if h["k"] == r["k"] and h["t"] is not None]
        weights = [(h["t"] & 1) + 1 for h in mine]
        for name, column in (("w0", "a"), ("w1", "b")):
            bits = [2 * sum(w for h, w in zip(mine, weights) if h[column] >> i & 1) > sum(weights) for i in range(64)]
            assert r[name] & (1 << 64) - 1 == sum(1 << i for i, bit in enumerate(bits) if bit)


def test_equal_texts_have_equal_fingerprints(report, docs):
    texts = {}
    for r in docs.filter("doc_id IN (10004, 10005, 10006, 10007, 10008, 10001, 10002)").select("doc_id", "text").collect():
        texts[r["doc_id"]] = r["text"] or ""
    of = {r["doc_id"]: r["fingerprint"] for r in report}
    assert of[10_004] == of[10_005] == of[10_006]  # the same words
    assert of[10_007] == of[10_008]
    assert of[10_001] == of[10_002] == "0" * 64


@pytest.mark.parametrize(("bits", "radius", "blocks", "block_rows"), [(64, 3, 4, 2048), (64, 5, 8, 7), (128, 7, 8, 3), (256, 7, 8, 2048)])
def test_within_equals_all_pairs(spark, bits, radius, blocks, block_rows):
    rng = np.random.default_rng(bits + radius)
    words = bits // 64
    base = rng.integers(-(1 << 63), 1 << 63, (12, words), dtype=np.int64)
    rows = []
    for k in range(400):
        fp = base[k % 12].copy()
        for at in rng.integers(0, bits, int(rng.integers(0, radius + 4))):
            fp[at // 64] ^= np.int64(np.uint64(1) << np.uint64(at % 64))
        rows.append(tuple(int(v) for v in fp))
    rows += rows[:30] + [(0,) * words] * 5
    columns = P.names(bits)
    frame = spark.createDataFrame(rows, ", ".join(f"{c} bigint" for c in columns))
    queries = spark.createDataFrame(rows[::9] + [(0,) * words], frame.schema)
    found = set()
    for r in P.within(queries, frame, bits, radius, blocks, block_rows).collect():
        for m in r["found"]:
            key = tuple(r[: words]), tuple(m[c] for c in columns), m["distance"], m["n"]
            assert key not in found, "reported twice"
            found.add(key)
    gap = lambda a, b: sum(((x ^ y) & (1 << 64) - 1).bit_count() for x, y in zip(a, b))
    want = {(q, m, gap(q, m), rows.count(m)) for q in set(map(tuple, queries.collect())) for m in set(rows) if gap(q, m) <= radius}
    assert found == want


def test_n_within(report):
    fps = [int(r["fingerprint"], 16) for r in report]
    for r in report:
        if r["doc_id"] is None or r["doc_id"] % 100:
            assert r["n_within"] is None
        else:
            assert r["n_within"] == sum((int(r["fingerprint"], 16) ^ f).bit_count() <= 7 for f in fps)


def test_blocks_must_exceed_the_radius(spark):
    frame = spark.createDataFrame([(0,)], "w0 bigint")
    with pytest.raises(ValueError):
        P.within(frame, frame, 64, 4, 4)


def test_small_tables(spark, nothing, docs):
    assert P.fingerprint_report(nothing).count() == 0
    one = P.fingerprint_report(docs.filter("doc_id = 10004")).collect()
    assert one[0]["edited_sha256"] == hashlib.sha256(b"same text here"[:11] + b"sam").hexdigest() and one[0]["near_next"] == 1.0
    unnamed = spark.createDataFrame([(None, f"text {i} of many") for i in range(50)], "doc_id bigint, text string")
    rows = P.fingerprint_report(unnamed).collect()
    assert len(rows) == 50
    assert sorted(r["edited_sha256"] for r in rows) == sorted(
        hashlib.sha256((t[: len(t) - len(t) // 4] + f[: len(t) // 4]).encode()).hexdigest() for _, t, f in next_of(unnamed)
    )


def test_invariance(docs, report):
    again = P.fingerprint_report(docs.repartition(5, F.rand(1))).collect()
    order = lambda r: (r["doc_id"] is None, *map(str, r))
    assert sorted(again, key=order) == sorted(report, key=order)
