"""Claim, evidence and graph rules on small tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.operators import graph, knowledge as K


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_claims(spark):
    c = spark.createDataFrame([(1, True, None), (2, False, "opinion"), (3, True, "opinion"), (4, False, None)], "claim_id int, checkable boolean, reason string")
    assert rows(K.checkability(c), "claim_id", "route") == [(1, "analyse"), (2, "not_checkable"), (3, "invalid"), (4, "invalid")]
    s = spark.createDataFrame([(1, "supports"), (1, "refutes"), (2, "supports")], "claim_id int, stance string")
    summary = K.stance_summary(c, s)
    assert rows(summary, "claim_id", "stance", "sufficiency")[:3] == [(1, "conflicting", "sufficient"), (2, "supports", "sufficient"), (3, "not_enough_info", "insufficient_data")]
    full = summary.withColumns({"confidence": F.lit(0.9), "worst_tier": F.lit(3), "all_tier3": F.lit(True), "image_manipulated": F.col("claim_id") == 2, "claim_type": F.lit("x")})
    fused = K.fuse(full)
    assert {r["claim_id"]: (r["verdict"], r["fused_confidence"]) for r in fused.collect()} == {1: ("conflicting", 0.5), 2: ("misleading_context", 0.6), 3: ("unverifiable", 0.0), 4: ("unverifiable", 0.0)}
    assert {r["claim_id"]: r["rules"] for r in fused.collect()}[1] == ["trust", "conflict"]
    decided = K.decide(fused, spark.createDataFrame([("x", 0.55)], "claim_type string, threshold double"))
    assert rows(decided, "claim_id", "decision")[:2] == [(1, "unverifiable"), (2, "misleading_context")]


def test_chains(spark):
    chain = spark.createDataFrame([(1, 1, "fusion", "a"), (1, 2, "decision", "b"), (2, 1, "decision", "c"), (2, 2, "fusion", "d"), (3, 1, "fusion", "e"), (3, 3, "fusion", "f")], "claim_id int, sequence_order int, kind string, text string")
    assert [r["claim_id"] for r in K.chain_violations(chain).orderBy("claim_id").collect()] == [2, 3]
    d = spark.createDataFrame([(1, "supports"), (9, "refutes")], "claim_id int, decision string")
    out = {r["claim_id"]: (r["n_steps"], r["explanation"]) for r in K.render_explanations(chain, d).collect()}
    assert out == {1: (2, "a b"), 9: (0, "No explanation could be rendered for 9.")}


def test_ranking(spark):
    claims = spark.createDataFrame([(1, "red apple"), (2, "zebra")], "claim_id int, text string")
    evidence = spark.createDataFrame([(10, "a red apple fell"), (11, "red car and red bus"), (12, "blue")], "evidence_id int, text string")
    assert [(r["claim_id"], r["evidence_id"]) for r in K.rank_evidence(claims, evidence, 1).collect()] == [(1, 10)]


def test_integrity(spark):
    t = spark.createDataFrame([("clm_1", ["ev_1", "ev_9"], 0.5, "1.2"), ("bad", [], 1.5, "2.0")], "id string, refs array<string>, conf double, schema_version string")
    e = spark.createDataFrame([("ev_1",)], "id string")
    assert [r["id"] for r in K.bad_ids(t, "id", ["clm"]).collect()] == ["bad"]
    assert [r["_ref"] for r in K.dangling(t, "refs", e, "id").collect()] == ["ev_9"]
    assert [r["id"] for r in K.out_of_range(t, ["conf"]).collect()] == ["bad"]
    assert [r["id"] for r in K.incompatible_versions(t, 1).collect()] == ["bad"]
    x = spark.createDataFrame([(1, None), (None, None), (1, 2)], "a int, b int")
    assert K.not_exactly_one(x, ["a", "b"]).count() == 2
    c = spark.createDataFrame([("x", "hello", None)], "id string, content string, who string").withColumn("sha256", F.sha2("content", 256))
    assert K.altered(c).count() == 0 and K.altered(c.withColumn("content", F.lit("no"))).count() == 1
    assert K.unanswered(c, ["id", "who"]).collect()[0]["unanswered"] == ["who"]
    assert K.tier_violations(spark.createDataFrame([("web", 1), ("web", 2), ("wiki", 1)], "corpus string, tier int")).count() == 1


def test_time(spark):
    day = lambda n: dt.date(2020, 1, n)
    e = spark.createDataFrame([("s", "p", "a", day(1)), ("s", "p", "b", day(5)), ("s", "q", "c", day(2))], "subject string, predicate string, object string, valid_from date")
    s = K.succession(e)
    assert rows(K.current(s), "object") == [("b",), ("c",)]
    assert rows(K.as_of(s, F.lit(day(5))), "object") == [("a",), ("b",), ("c",)]
    assert rows(K.conflicting_edges(e), "subject", "predicate") == [("s", "p")]
    left = spark.createDataFrame([(1, "k", 5), (2, "k", 0), (3, "z", 9)], "id int, k string, at int")
    right = spark.createDataFrame([("k", 1, "one"), ("k", 5, "five"), ("k", 6, "six")], "k string, since int, v string")
    assert rows(K.as_of_join(left, right, "k", "at", "since"), "id", "v") == [(1, "five"), (2, None), (3, None)]
    v = spark.createDataFrame([("e", 1, "x"), ("e", 3, "y")], "evidence_id string, created_at int, t string")
    assert rows(K.current_version(v), "t") == [("y",)] and rows(K.current_version(v, until=F.lit(2)), "t") == [("x",)]
    h = spark.createDataFrame([("k", 1, False), ("k", 2, True), ("m", 1, False)], "id string, version int, retracted boolean")
    assert rows(K.latest_state(h, "id"), "id") == [("m",)]


def test_entities(spark):
    nodes = spark.createDataFrame([("n1", "org", ["United  Nations", "UN"], {"wd": "Q1"}), ("n2", "org", ["UN"], {"wd": "Q2"})], "node_id string, type string, aliases array<string>, external_ids map<string,string>")
    m = spark.createDataFrame([("m1", "org", "united nations", {}), ("m2", "org", "un", {}), ("m3", "org", "x", {}), ("m4", "org", "y", {"wd": "Q2"})], "mention_id string, type string, surface string, external_ids map<string,string>")
    out = K.resolution_outcome(m, K.match_entities(m, nodes))
    assert rows(out, "mention_id", "outcome") == [("m1", "merge"), ("m2", "ambiguous"), ("m3", "new_node"), ("m4", "merge")]
    n = spark.createDataFrame([("a", ["x"], 1), ("b", ["y", "x"], 2)], "node_id string, aliases array<string>, mention_count int")
    merged = K.merge_nodes(n, spark.createDataFrame([("b", "a")], "absorbed string, survivor string")).collect()
    assert [(r["node_id"], r["aliases"], r["mention_count"]) for r in merged] == [("a", ["x", "y"], 3)]
    s = spark.createDataFrame([("i", 1, "new"), ("i", 2, "done"), ("i", 3, "new")], "item_id string, seq int, state string")
    legal = spark.createDataFrame([("new", "done")], "previous string, state string")
    assert rows(K.illegal_transitions(s, legal), "seq") == [(3,)]


def test_graph(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    assert {r["root"] for r in graph.connected_components(e, "a", "b").collect()} == {0, 100}
    t = e.select(F.col("a").alias("subject"), F.col("b").alias("object"))
    start = spark.createDataFrame([(5,)], "node long")
    assert rows(graph.traverse(t, start, 2), "node", "hops") == [(5, 0), (6, 1), (7, 2)]
    assert rows(graph.traverse(t, start, 1, True), "node") == [(4,), (5,), (6,)]


def test_assertions(spark):
    a = spark.createDataFrame([(1, "x", "supports", "e1"), (1, "x", "refutes", "e2"), (1, "y", "supports", "e3")], "claim_id int, assertion string, stance string, evidence_id string")
    links = spark.createDataFrame([("e1", "e3")], "a string, b string")
    roots = K.independent_sources(links, a.select("evidence_id"))
    assert rows(roots, "evidence_id", "root") == [("e1", "e1"), ("e2", "e2"), ("e3", "e1")]
    assert rows(K.contradictions(a), "assertion") == [("x",)]
    assert K.corroboration(a, roots).count() == 3
    asked = spark.createDataFrame([(1, "x"), (1, "z")], "claim_id int, assertion string")
    assert rows(K.unresolved(asked, a), "assertion") == [("z",)]
    with pytest.raises(PermissionError):
        K.visible(a, {"public": []}, "other")
    assert K.visible(a, {"public": ["stance"]}, "public").columns == ["stance"]


def test_runs(spark):
    x = spark.createDataFrame([("r", "m", 1, "failed", True, 1.0), ("r", "m", 2, "succeeded", True, 1.0), ("r", "o", 1, "failed", False, 1.0)], "run_id string, module string, attempt int, status string, required boolean, seconds double")
    assert [tuple(r) for r in K.run_rollup(x).collect()] == [("r", 3.0, 1, "PARTIAL_FAILURE")]
    f = spark.createDataFrame([("a", "validated"), ("b", "new")], "id string, status string")
    assert rows(K.export_feedback(f, "b1"), "id", "batch_id") == [("a", "b1")]


def test_policies_by_equal_columns_do_not_multiply_items(spark):
    items = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, None), (1, "b")], "item_id int, topic string")
    rows = [(i, i % 5 if i % 5 else None, i % 3 > 0, "ab"[i % 2]) for i in range(60)]
    policies = spark.createDataFrame([*rows, (90, 0, True, None)], "policy_id int, priority int, active boolean, about string")
    plain = K.apply_policies(items, policies, F.col("topic") == F.col("about"))
    found = K.apply_policies(items, policies, {"topic": "about"})
    key = lambda r: tuple(map(str, r))
    assert found.columns == plain.columns and sorted(found.collect(), key=key) == sorted(plain.collect(), key=key)
    joins = found.drop("priority")._jdf.queryExecution().optimizedPlan().toString()
    assert joins.index("Join") < joins.index("Aggregate"), "policies are reduced below the join"
