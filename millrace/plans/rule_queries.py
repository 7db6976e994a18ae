"""Registered queries of the rules over claims, evidence, graphs and runs, each with its SQL.

The star-schema tables stand in for the rules' own: orders are claims, line items their
evidence or relations, suppliers and customers sources and entities, events log rows.
Every query reads whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import knowledge, labels
from .catalogue import _STANCE, _q, _stances, _t


def _key():
    return F.col("o_orderkey")


def _joined(column: str):
    return F.array_join(F.col(column).cast("array<string>"), ",")


# ---- claims ---------------------------------------------------------------------------------

_REASON = "CASE WHEN o_orderpriority = '5-LOW' THEN 'opinion' WHEN o_orderstatus = 'P' THEN 'too_vague' END"


@_q(
    f"SELECT claim_id, checkable, reason, CASE WHEN (reason IS NOT NULL) <> (NOT checkable) THEN 'invalid' WHEN checkable THEN 'analyse' ELSE 'not_checkable' END AS route "
    f"FROM (SELECT o_orderkey AS claim_id, o_orderstatus <> 'P' AS checkable, {_REASON} AS reason FROM orders)"
)
def claim_checkability(spark, sf_dir):
    claims = _t(spark, sf_dir, "orders").select(_key().alias("claim_id"), (F.col("o_orderstatus") != "P").alias("checkable"), F.expr(_REASON).alias("reason"))
    return knowledge.checkability(claims)


@_q("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'N' AND l_linenumber % 3 = 0")
def evidence_tier_violations(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem").withColumns({"corpus": F.when(F.col("l_returnflag") == "N", "web").otherwise("fact_check"), "tier": F.col("l_linenumber") % 3 + 1})
    return knowledge.tier_violations(rows).select("l_orderkey", "l_linenumber")


def _summary(spark, sf_dir) -> DataFrame:
    """A summary row per order as the fusion rules expect it."""
    orders = _t(spark, sf_dir, "orders")
    rows = knowledge.stance_summary(orders.select(_key().alias("claim_id")), _stances(spark, sf_dir)).join(orders, F.col("claim_id") == _key())
    tier = _key() % 3 + 1
    return rows.select(
        "claim_id", "stance", "n_evidence", F.col("o_orderpriority").alias("claim_type"), (_key() % 101 / F.lit(100.0)).alias("confidence"),
        tier.alias("worst_tier"), ((tier == 3) & (F.col("o_custkey") % 2 == 0)).alias("all_tier3"), (F.col("o_custkey") % 5 == 0).alias("image_manipulated"),
    )


_SUMMARY = (
    f"WITH c AS (SELECT l_orderkey AS k, count(*) AS n, count(*) FILTER (s = 'supports') AS p, count(*) FILTER (s = 'refutes') AS r FROM (SELECT *, {_STANCE} AS s FROM lineitem) GROUP BY 1), "
    "s AS (SELECT o_orderkey AS claim_id, o_orderpriority AS claim_type, coalesce(n, 0) AS n_evidence, (o_orderkey % 101) / 100.0::DOUBLE AS confidence, o_orderkey % 3 + 1 AS worst_tier, o_custkey % 5 = 0 AS image_manipulated, "
    "o_orderkey % 3 = 2 AND o_custkey % 2 = 0 AS all_tier3, CASE WHEN p > 0 AND r > 0 THEN 'conflicting' WHEN p > 0 THEN 'supports' WHEN r > 0 THEN 'refutes' ELSE 'not_enough_info' END AS stance FROM orders LEFT JOIN c ON k = o_orderkey), "
    "a AS (SELECT *, CASE WHEN n_evidence = 0 THEN 0.0::DOUBLE ELSE greatest(0.0::DOUBLE, confidence - 0.1::DOUBLE * (worst_tier - 1)) END AS c1 FROM s), "
    "b AS (SELECT *, CASE WHEN all_tier3 THEN least(c1, 0.6::DOUBLE) ELSE c1 END AS c2, stance = 'supports' AND image_manipulated AS misleading FROM a), "
    "f AS (SELECT *, CASE WHEN stance = 'conflicting' THEN least(c2, 0.5::DOUBLE) ELSE c2 END AS fused_confidence, "
    "CASE WHEN n_evidence = 0 THEN 'unverifiable' WHEN misleading THEN 'misleading_context' WHEN stance = 'not_enough_info' THEN 'unverifiable' ELSE stance END AS verdict, "
    "concat_ws(',', CASE WHEN n_evidence = 0 THEN 'sufficiency' END, CASE WHEN worst_tier > 1 THEN 'trust' END, CASE WHEN misleading THEN 'independent_axes' END, "
    "CASE WHEN n_evidence > 1 AND stance <> 'conflicting' THEN 'corroboration' END, CASE WHEN stance = 'conflicting' THEN 'conflict' END) AS rules FROM b) "
)


@_q(_SUMMARY + "SELECT claim_id, stance, fused_confidence, verdict, rules FROM f")
def fusion_rules(spark, sf_dir):
    return knowledge.fuse(_summary(spark, sf_dir)).select("claim_id", "stance", "fused_confidence", "verdict", F.array_join("rules", ",").alias("rules"))


@_q(_SUMMARY + "SELECT claim_id, verdict, fused_confidence, CASE WHEN fused_confidence < CASE claim_type WHEN '1-URGENT' THEN 0.7::DOUBLE WHEN '3-MEDIUM' THEN 0.5::DOUBLE ELSE 0.4::DOUBLE END THEN 'unverifiable' ELSE verdict END AS decision FROM f")
def decision_threshold(spark, sf_dir):
    fused = knowledge.fuse(_summary(spark, sf_dir))
    types = _t(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("claim_type")).filter("claim_type != '3-MEDIUM'").distinct()
    limits = types.withColumn("threshold", F.when(F.col("claim_type") == "1-URGENT", F.lit(0.7)).otherwise(F.lit(0.4)))
    return knowledge.decide(fused, limits).select("claim_id", "verdict", "fused_confidence", "decision")


@_q(
    "SELECT item_id, policy_id FROM (SELECT o_orderkey AS item_id, s_suppkey AS policy_id, row_number() OVER (PARTITION BY o_orderkey ORDER BY s_suppkey % 7 NULLS LAST, s_suppkey) AS r "
    "FROM orders LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) ON o_custkey % 25 = s_nationkey) WHERE r = 1"
)
def policy_rules(spark, sf_dir):
    items = _t(spark, sf_dir, "orders").select(_key().alias("item_id"), (F.col("o_custkey") % 25).cast("int").alias("topic"))
    policies = _t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("policy_id"), (F.col("s_suppkey") % 7).alias("priority"), (F.col("s_acctbal") > 0).alias("active"), "s_nationkey")
    return knowledge.apply_policies(items, policies, {"topic": "s_nationkey"}).select("item_id", "policy_id")


_KIND = "CASE l_linenumber % 3 WHEN 0 THEN 'fusion' WHEN 1 THEN 'decision' ELSE 'step' END"


@_q(
    f"SELECT * FROM (SELECT l_orderkey AS claim_id, min(l_linenumber) AS low, max(l_linenumber) AS high, count(*) AS n, count(DISTINCT l_linenumber) AS distinct_n, max(l_linenumber) FILTER ({_KIND} = 'fusion') AS last_fusion, "
    f"min(l_linenumber) FILTER ({_KIND} = 'decision') AS first_decision FROM lineitem GROUP BY 1) WHERE high - low + 1 <> n OR n <> distinct_n OR coalesce(last_fusion > first_decision, false)"
)
def chain_order(spark, sf_dir):
    chain = _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("claim_id"), F.col("l_linenumber").alias("sequence_order"), F.expr(_KIND).alias("kind"))
    return knowledge.chain_violations(chain)


@_q(
    "SELECT o_orderkey AS claim_id, o_orderstatus AS decision, coalesce(n, 0) AS n_steps, coalesce(t, 'No explanation could be rendered for ' || o_orderkey || '.') AS explanation FROM orders LEFT JOIN "
    "(SELECT l_orderkey, count(*) AS n, string_agg(l_returnflag || l_linenumber, ' ' ORDER BY l_linenumber, l_returnflag) AS t FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey"
)
def explanations(spark, sf_dir):
    line = _t(spark, sf_dir, "lineitem")
    chain = line.select(F.col("l_orderkey").alias("claim_id"), F.col("l_linenumber").alias("sequence_order"), F.concat("l_returnflag", F.col("l_linenumber").cast("string")).alias("text"))
    decisions = _t(spark, sf_dir, "orders").select(_key().alias("claim_id"), F.col("o_orderstatus").alias("decision"))
    return knowledge.render_explanations(chain, decisions)


@_q(
    "SELECT a.l_orderkey AS doc_id, a.l_linenumber AS claim_a, b.l_linenumber AS claim_b FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_returnflag = b.l_returnflag AND a.l_linestatus = b.l_linestatus "
    "AND a.l_linenumber < b.l_linenumber AND a.l_suppkey <> b.l_suppkey"
)
def cross_claims(spark, sf_dir):
    claims = _t(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("claim_id"), F.col("l_returnflag").alias("subject"), F.col("l_linestatus").alias("predicate"), F.col("l_suppkey").alias("object")
    )
    return knowledge.cross_claim_notes(claims)


# ---- integrity ------------------------------------------------------------------------------

_ID = "CASE WHEN o_orderkey % 7 = 0 THEN 'clm ' || o_orderkey WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN 'ev_' || o_orderkey ELSE 'clm_' || o_orderkey || '-a' END"


@_q(f"SELECT o_orderkey, id FROM (SELECT o_orderkey, {_ID} AS id FROM orders) WHERE NOT coalesce(regexp_full_match(id, '(clm|ev)_[A-Za-z0-9-]+'), false)")
def id_grammar(spark, sf_dir):
    return knowledge.bad_ids(_t(spark, sf_dir, "orders").select("o_orderkey", F.expr(_ID).alias("id")), "id", ["clm", "ev"])


@_q("SELECT o_orderkey FROM orders WHERE (o_orderstatus = 'F')::INT + (o_custkey % 3 = 0)::INT <> 1")
def conditional_fields(spark, sf_dir):
    rows = _t(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", 1).alias("a"), F.when(F.col("o_custkey") % 3 == 0, 1).alias("b"))
    return knowledge.not_exactly_one(rows, ["a", "b"]).select("o_orderkey")


@_q("SELECT o_orderkey, (o_orderkey % 3) || '.' || (o_orderkey % 5) AS schema_version FROM orders WHERE o_orderkey % 3 <> 1")
def schema_versions(spark, sf_dir):
    rows = _t(spark, sf_dir, "orders").select("o_orderkey", F.concat_ws(".", (_key() % 3).cast("string"), (_key() % 5).cast("string")).alias("schema_version"))
    return knowledge.incompatible_versions(rows, 1)


@_q("SELECT doc_id, concat_ws(',', CASE WHEN lang IS NULL THEN 'lang' END, CASE WHEN source IS NULL THEN 'source' END, CASE WHEN quality IS NULL THEN 'quality' END) AS unanswered FROM documents LEFT JOIN labels USING (doc_id) WHERE lang IS NULL OR source IS NULL OR quality IS NULL")
def provenance_questions(spark, sf_dir):
    rows = _t(spark, sf_dir, "documents").join(_t(spark, sf_dir, "labels"), "doc_id", "left")
    return knowledge.unanswered(rows, ["lang", "source", "quality"]).select("doc_id", F.array_join("unanswered", ",").alias("unanswered"))


@_q("SELECT doc_id FROM documents WHERE doc_id % 10 = 0 AND text IS NOT NULL")
def custody_altered(spark, sf_dir):
    rows = _t(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"), F.when(F.col("doc_id") % 10 == 0, F.concat("text", F.lit("."))).otherwise(F.col("text")).alias("content"))
    return knowledge.altered(rows).select("doc_id")


# ---- entities and graph ---------------------------------------------------------------------


@_q(
    "WITH m AS (SELECT c_custkey AS mention_id, c_nationkey AS t, '  SUPPLIER#' || lpad((c_custkey % 500)::VARCHAR, 9, '0') || ' ' AS surface FROM customer) "
    "SELECT DISTINCT * FROM (SELECT mention_id, s_suppkey AS node_id, 'alias' AS how FROM m JOIN supplier ON lower(s_name) = lower(trim(surface)) AND s_nationkey = t "
    "UNION ALL SELECT mention_id, s_suppkey, 'external_id' FROM m JOIN supplier ON mention_id % 1000 = s_suppkey)"
)
def entity_match(spark, sf_dir):
    c, s = _t(spark, sf_dir, "customer"), _t(spark, sf_dir, "supplier")
    mentions = c.select(
        F.col("c_custkey").alias("mention_id"), F.col("c_nationkey").alias("type"),
        F.concat(F.lit("  SUPPLIER#"), F.lpad((F.col("c_custkey") % 500).cast("string"), 9, "0"), F.lit(" ")).alias("surface"),
        F.create_map(F.lit("reg"), (F.col("c_custkey") % 1000).cast("string")).alias("external_ids"),
    )
    nodes = s.select(F.col("s_suppkey").alias("node_id"), F.col("s_nationkey").alias("type"), F.array("s_name").alias("aliases"), F.create_map(F.lit("reg"), F.col("s_suppkey").cast("string")).alias("external_ids"))
    return knowledge.match_entities(mentions, nodes)


@_q(
    "SELECT mention_id, CASE WHEN n IS NULL THEN 'new_node' WHEN n = 1 THEN 'merge' ELSE 'ambiguous' END AS outcome, CASE WHEN n = 1 THEN node_id END AS node_id FROM "
    "(SELECT c_custkey AS mention_id, n, node_id FROM customer LEFT JOIN (SELECT o_custkey, count(DISTINCT o_orderpriority) AS n, min(o_orderpriority) AS node_id FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) ON o_custkey = c_custkey)"
)
def resolution_outcomes(spark, sf_dir):
    mentions = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("mention_id"))
    matches = _t(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("mention_id"), F.col("o_orderpriority").alias("node_id"))
    return knowledge.resolution_outcome(mentions, matches)


@_q(
    "SELECT item_id, seq, previous, state FROM (SELECT o_custkey AS item_id, o_orderkey AS seq, o_orderstatus AS state, lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS previous FROM orders) "
    "WHERE previous IS NOT NULL AND previous <> state AND previous || state NOT IN ('OP', 'PF', 'OF')"
)
def state_transitions(spark, sf_dir):
    states = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("item_id"), _key().alias("seq"), F.col("o_orderstatus").alias("state"))
    legal = spark.createDataFrame([("O", "P"), ("P", "F"), ("O", "F")], "previous string, state string")
    return knowledge.illegal_transitions(states, legal).select("item_id", "seq", "previous", "state")


@_q("SELECT l_orderkey AS edge_id, max(s_nationkey % 3 + 1) AS tier, count(DISTINCT l_suppkey) AS n_evidence FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1")
def facts(spark, sf_dir):
    edges = _t(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("edge_id")).agg(F.collect_list("l_suppkey").alias("evidence_ids"))
    evidence = _t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("evidence_id"), (F.col("s_nationkey") % 3 + 1).alias("tier"))
    return knowledge.generate_facts(edges, evidence).select("edge_id", "tier", "n_evidence")


@_q("SELECT l_orderkey AS claim_id, l_linenumber AS evidence_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderkey % 4 = 0 OR l_shipdate >= o_orderdate + INTERVAL 30 DAY")
def stale_evidence(spark, sf_dir):
    evidence = _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("claim_id"), F.col("l_linenumber").alias("evidence_id"), F.col("l_shipdate").alias("captured_on"))
    claims = _t(spark, sf_dir, "orders").select(_key().alias("claim_id"), F.when(_key() % 4 != 0, F.col("o_orderdate") + F.expr("INTERVAL 30 DAY")).alias("event_date"))
    return knowledge.usable_evidence(evidence, claims).select("claim_id", "evidence_id")


@_q(f"SELECT l_orderkey AS claim_id, l_linestatus AS assertion, {_STANCE} AS stance, count(DISTINCT l_suppkey % 10) AS n_independent FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL")
def corroboration_groups(spark, sf_dir):
    found = _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("claim_id"), F.col("l_linestatus").alias("assertion"), F.expr(_STANCE).alias("stance"), F.col("l_suppkey").alias("evidence_id"))
    roots = _t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("evidence_id"), (F.col("s_suppkey") % 10).alias("root"))
    return knowledge.corroboration(found, roots)


@_q("SELECT o_orderkey AS claim_id, a AS assertion FROM orders, (VALUES ('O'), ('F')) v(a) WHERE (o_orderkey, a) NOT IN (SELECT l_orderkey, l_linestatus FROM lineitem)")
def unresolved_assertions(spark, sf_dir):
    asked = _t(spark, sf_dir, "orders").select(_key().alias("claim_id"), F.explode(F.array(F.lit("O"), F.lit("F"))).alias("assertion"))
    return knowledge.unresolved(asked, _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("claim_id"), F.col("l_linestatus").alias("assertion")))


_ASSERTED = f"(SELECT l_orderkey AS claim_id, l_partkey % 3 AS assertion, {_STANCE} AS stance FROM lineitem)"


def _asserted(spark, sf_dir):
    return _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("claim_id"), (F.col("l_partkey") % 3).alias("assertion"), F.expr(_STANCE).alias("stance"))


@_q(
    "SELECT claim_id, assertion, stance, n_evidence FROM (SELECT *, count(*) OVER (PARTITION BY claim_id) AS n FROM (SELECT claim_id, assertion, any_value(stance) AS stance, count(*) AS n_evidence "
    f"FROM {_ASSERTED} WHERE stance IN ('supports', 'refutes') GROUP BY ALL HAVING count(DISTINCT stance) = 1)) WHERE n > 1"
)
def complementary_evidence(spark, sf_dir):
    return knowledge.complementary(_asserted(spark, sf_dir))


@_q(
    "SELECT claim_id, CASE WHEN list_contains(s, 'supports') AND list_contains(s, 'refutes') THEN 'conflicting' WHEN list_contains(s, 'supports') THEN 'supports' "
    f"WHEN list_contains(s, 'refutes') THEN 'refutes' ELSE 'not_enough_info' END AS stance FROM (SELECT claim_id, list(stance) AS s FROM {_ASSERTED} GROUP BY 1)"
)
def synthesised_stance(spark, sf_dir):
    return knowledge.synthesised_stance(_asserted(spark, sf_dir))


_FACTORS = {"quality": 2, "corroboration": 3, "consistency": 5, "coverage": 7, "completeness": 11}


@_q("SELECT o_orderkey AS claim_id, (" + " + ".join(f"(o_orderkey % {m}) / {m}.0::DOUBLE" for m in _FACTORS.values()) + ") / 5.0::DOUBLE AS confidence FROM orders")
def confidence_factors(spark, sf_dir):
    rows = _t(spark, sf_dir, "orders").select(_key().alias("claim_id"), *[(_key() % m / F.lit(float(m))).alias(k) for k, m in _FACTORS.items()])
    return knowledge.confidence_factors(rows).select("claim_id", "confidence")


_RETRIEVAL = "SELECT l_orderkey AS claim_id, count(*) AS n_found, count(DISTINCT l_suppkey) AS n_sources, l_orderkey % 5 + 1 AS n_targets"


@_q(f"SELECT claim_id, n_found >= n_targets AND n_sources >= 2 AND has_a AND has_n AS done FROM ({_RETRIEVAL}, bool_or(l_returnflag = 'A') AS has_a, bool_or(l_returnflag = 'N') AS has_n FROM lineitem GROUP BY l_orderkey)")
def retrieval_stop(spark, sf_dir):
    plan = _t(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("claim_id")).agg(
        F.count(F.lit(1)).alias("n_found"), F.count_distinct("l_suppkey").alias("n_sources"), F.collect_set("l_returnflag").alias("have")
    )
    plan = plan.withColumns({"n_targets": F.col("claim_id") % 5 + 1, "wanted": F.array(F.lit("A"), F.lit("N"))})
    return knowledge.retrieval_done(plan).select("claim_id", "done")


@_q(
    "SELECT coalesce(x.s, c.c_custkey) AS node_id, string_agg(DISTINCT c.c_mktsegment, ',' ORDER BY c.c_mktsegment) AS aliases, sum(c.c_nationkey)::BIGINT AS mention_count "
    "FROM customer c LEFT JOIN (SELECT c_custkey AS a, c_custkey - c_custkey % 10 AS s FROM customer WHERE c_custkey % 10 IN (3, 4)) x ON x.a = c.c_custkey GROUP BY 1"
)
def node_merge(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    nodes = c.select(F.col("c_custkey").alias("node_id"), F.array("c_mktsegment").alias("aliases"), F.col("c_nationkey").cast("bigint").alias("mention_count"))
    merges = c.filter("c_custkey % 10 IN (3, 4)").select(F.col("c_custkey").alias("absorbed"), (F.col("c_custkey") - F.col("c_custkey") % 10).alias("survivor"))
    return knowledge.merge_nodes(nodes, merges).withColumn("aliases", _joined("aliases"))


@_q("SELECT o_orderkey AS mention_id, CASE WHEN o_orderstatus = 'P' THEN -o_custkey ELSE o_custkey END AS node_id FROM orders")
def node_split(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    moved = o.filter("o_orderstatus = 'P'").select(_key().alias("mention_id"), (-F.col("o_custkey")).alias("new_node_id"))
    return knowledge.split_node(o.select(_key().alias("mention_id"), F.col("o_custkey").alias("node_id")), moved)


@_q(
    f"SELECT o_orderkey AS claim_id, e AS evidence FROM orders LEFT JOIN (SELECT l_orderkey, string_agg(l_suppkey || ':' || s, ',' ORDER BY l_suppkey, s) AS e FROM (SELECT *, {_STANCE} AS s FROM lineitem) GROUP BY 1) ON l_orderkey = o_orderkey"
)
def evidence_bundle(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("claim_id"), F.col("l_suppkey").alias("evidence_id"), F.expr(_STANCE).alias("stance"))
    out = knowledge.bundle(_t(spark, sf_dir, "orders").select(_key().alias("claim_id")), rows)
    return out.withColumn("evidence", F.array_join(F.transform("evidence", lambda e: F.concat_ws(":", e["evidence_id"].cast("string"), e["stance"])), ","))


@_q(
    "SELECT doc_id AS item_id, CASE WHEN lang IN ('en', 'de') THEN 'claims' || CASE WHEN lang = 'en' THEN ',stance' ELSE '' END ELSE '' END AS analysers, CASE WHEN lang IN ('en', 'de') THEN 'ok' ELSE 'unsupported_language' END AS status FROM documents"
)
def analyser_fit(spark, sf_dir):
    items = _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("item_id"), F.lit("text").alias("modality"), F.col("lang").alias("language"))
    analysers = spark.createDataFrame([("claims", ["text"], ["en", "de"]), ("stance", ["text"], ["en"]), ("forensics", ["image"], ["en"])], "analyser string, modalities array<string>, languages array<string>")
    return knowledge.applicable(items, analysers).withColumn("analysers", F.array_join("analysers", ","))


@_q("SELECT o_orderkey, o_orderstatus FROM orders")
def access_policy(spark, sf_dir):
    return knowledge.visible(_t(spark, sf_dir, "orders"), {"public": ["o_orderkey", "o_orderstatus"], "staff": ["o_custkey"]}, "public")


@_q(
    "SELECT o_custkey AS fact_id, o_orderkey AS edge_id, l_linenumber AS relation_id, l_suppkey AS claim_id, s_nationkey AS doc_id FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey, l_linenumber, l_suppkey FROM lineitem) ON l_orderkey = o_orderkey LEFT JOIN supplier ON s_suppkey = l_suppkey"
)
def provenance_chain(spark, sf_dir):
    line = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey").distinct()
    found = F.struct("l_linenumber", "l_suppkey")
    facts_ = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("fact_id"), _key().alias("edge_id"))
    edges = line.groupBy(F.col("l_orderkey").alias("edge_id")).agg(F.collect_set(found).alias("relation_ids"))
    relations = line.select(found.alias("relation_id"), F.col("l_suppkey").alias("claim_id")).distinct()
    claims = _t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("claim_id"), F.col("s_nationkey").alias("doc_id"))
    return knowledge.provenance(facts_, edges, relations, claims).withColumn("relation_id", F.col("relation_id.l_linenumber"))


# ---- runs, logs and records -----------------------------------------------------------------


@_q("SELECT user_id AS run_id, event_type AS claim_id, bool_and(value <= 90) AS ready FROM events GROUP BY ALL")
def fusion_ready(spark, sf_dir):
    runs = _t(spark, sf_dir, "events").select(F.col("user_id").alias("run_id"), F.col("event_type").alias("claim_id"), F.when(F.col("value") > 90, "running").otherwise("succeeded").alias("status"))
    return knowledge.ready_for_fusion(runs)


@_q("SELECT event_id, event_type AS level FROM events WHERE date_diff('day', ts::DATE, DATE '2024-03-01') <= CASE event_type WHEN 'error' THEN 90 WHEN 'click' THEN 31 ELSE 45 END")
def log_retention(spark, sf_dir):
    logs = _t(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("level"), "ts")
    return knowledge.retained(logs, {"error": 90, "click": 31}, F.lit("2024-03-01").cast("date"), 45).select("event_id", "level")


@_q("SELECT doc_id, toxic, 'batch-1' AS batch_id FROM labels WHERE quality = 1")
def feedback_export(spark, sf_dir):
    rows = _t(spark, sf_dir, "labels").withColumn("status", F.when(F.col("quality") == 1, "validated").otherwise("open"))
    return knowledge.export_feedback(rows, "batch-1").select("doc_id", "toxic", "batch_id")


@_q("SELECT key, version FROM (SELECT o_custkey AS key, o_orderkey AS version, o_orderstatus = 'P' AS retracted, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS r FROM orders) WHERE r = 1 AND NOT retracted")
def rollback_view(spark, sf_dir):
    history = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"), _key().alias("version"), (F.col("o_orderstatus") == "P").alias("retracted"))
    return knowledge.latest_state(history, "key").select("key", "version")


@_q("SELECT item_id, 'first' AS attempt, NULL::DOUBLE AS gain FROM benchmark UNION ALL SELECT item_id, 'second', -0.5::DOUBLE FROM benchmark")
def experiment_log(spark, sf_dir):
    items = _t(spark, sf_dir, "benchmark").select("item_id")
    return knowledge.experiment_log(items.withColumn("attempt", F.lit("first")), items.withColumns({"attempt": F.lit("second"), "gain": F.lit(-0.5)}))


# ---- columns --------------------------------------------------------------------------------


@_q("SELECT event_id, CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 0 END AS label FROM events WHERE event_type IN ('click', 'view')")
def drop_unmapped(spark, sf_dir):
    rows = labels.apply_label_map(_t(spark, sf_dir, "events").withColumn("label_raw", F.col("event_type")), {"click": 1, "view": 0})
    return labels.drop_unmapped(rows).select("event_id", F.col("label").cast("int").alias("label"))


_PATH = "p_brand || CASE p_size % 4 WHEN 0 THEN '/a.JPG' WHEN 1 THEN '/b.png' WHEN 2 THEN '/c.txt' ELSE '/jpg' END"


@_q(f"SELECT p_partkey, {_PATH} AS path FROM part WHERE regexp_matches(lower({_PATH}), '\\.(jpg|png)$')")
def image_paths(spark, sf_dir):
    rows = _t(spark, sf_dir, "part").select("p_partkey", F.expr(_PATH).alias("path"))
    return rows.filter(X.has_image_suffix(F.col("path")))


@_q("SELECT event_id, json_object('user_id', user_id, 'event_type', event_type)::VARCHAR AS metadata FROM events")
def json_columns(spark, sf_dir):
    return _t(spark, sf_dir, "events").select("event_id", X.json_of(["user_id", "event_type"]).alias("metadata"))
