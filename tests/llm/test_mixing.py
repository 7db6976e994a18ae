import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.llm import mixing as M


def brute_targets(sizes):
    """Water filling by repeated capping."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        open_ = [s for s in order if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: 3.0 * sizes[s] for s in over}


def by_source(docs):
    sizes = defaultdict(int)
    for r in docs.select("source", "text").collect():
        sizes[r["source"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    return sizes


def test_targets_and_shares(docs):
    sizes = by_source(docs)
    want = brute_targets(sizes)
    taken, largest = defaultdict(int), defaultdict(int)
    source = {(r["doc_id"], r["text"]): r["source"] for r in docs.collect()}
    plan = M.plan(docs).collect()
    assert len(plan) == docs.count() and len(source) <= len(plan)
    for r in plan:
        s = r["_source"][1:] or None
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s])
        assert 0 <= r["copies"] <= 3
        taken[s] += r["copies"] * r["size"]
        largest[s] = max(largest[s], r["size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 2 * largest[s] + 1


def test_reruns_and_partitionings_agree(docs):
    rows = lambda d: sorted(map(str, M.mix_report(d).collect()))
    assert rows(docs) == rows(docs.repartition(1)) == rows(docs.repartition(7))


def test_mix_repeats_rows(docs):
    plan = {(r["doc_id"], r["size"]): r["copies"] for r in M.plan(docs).collect()}
    out = M.mix(docs)
    assert out.columns == docs.columns
    n = defaultdict(int)
    for r in out.select("doc_id", "text").collect():
        n[(r["doc_id"], len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")))] += 1
    for key, copies in plan.items():
        if key[0] != 10_005:  # two rows that share the count of either
            assert n[key] == copies


def test_empty_and_wordless(spark, nothing):
    assert M.mix_report(nothing).count() == 0 and M.mix(nothing).count() == 0
    blank = spark.createDataFrame([(1, " ", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [tuple(r) for r in M.mix_report(blank).orderBy("doc_id").collect()] == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_rows_with_equal_keys_keep_their_own_counts(spark):
    """Null ids of one size, and equal rows: every source takes what the plan gives it."""
    rows = [(None, f"a{i} b", s) for i in range(101) for s in ("s", "t", "u")] + [(5, "c d", s) for _ in range(50) for s in ("s", "u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = {r["_source"]: r["n"] for r in M.plan(docs).groupBy("_source").agg(F.sum("copies").alias("n")).collect()}
    got = M.mix(docs).groupBy("source").count().collect()
    assert {"=" + r["source"]: r["count"] for r in got} == plan
