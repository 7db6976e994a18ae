"""Relational rules over claims, evidence and a temporal knowledge graph.

Only the deterministic parts are here.  Where a design leaves a formula open, the one
chosen is stated in the docstring as a choice.  Nothing that needs a trained model
is imitated.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import graph

# ---- claims and evidence ----------------------------------------------------------------

#: Why a claim may be uncheckable, trust tiers and stances.
REASONS = ("opinion", "prediction", "question", "too_vague", "satire")
STANCES = ("supports", "refutes", "not_enough_info")


def checkability(claims: DataFrame) -> DataFrame:
    """``route``: analyse, not_checkable, or invalid where flag and reason disagree."""
    consistent = F.col("reason").isNotNull() == ~F.col("checkable")
    return claims.withColumn("route", F.when(~consistent, "invalid").when(F.col("checkable"), "analyse").otherwise("not_checkable"))


def tier_violations(evidence: DataFrame) -> DataFrame:
    """Evidence from the open web is never of the first tier."""
    return evidence.filter((F.col("corpus") == "web") & (F.col("tier") == 1))


def rank_evidence(claims: DataFrame, evidence: DataFrame, k: int = 5, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """``claim_id, evidence_id, score, rank``: the top k by BM25; see ``ranking`` for how frequent terms are bounded."""
    from . import ranking

    return ranking.ranked(claims, evidence, k, k1, b)


def stance_summary(claims: DataFrame, stances: DataFrame) -> DataFrame:
    """Per claim: counts and an overall stance; conflicting needs both sides, no evidence is never a refutation."""
    counts = stances.groupBy("claim_id").agg(*[F.count_if(F.col("stance") == s).alias(s) for s in STANCES], F.count(F.lit(1)).alias("n_evidence"))
    filled = claims.select("claim_id").join(counts, "claim_id", "left").na.fill(0)
    stance = (
        F.when((F.col("supports") > 0) & (F.col("refutes") > 0), "conflicting")
        .when(F.col("supports") > 0, "supports")
        .when(F.col("refutes") > 0, "refutes")
        .otherwise("not_enough_info")
    )
    return filled.withColumns({"stance": stance, "sufficiency": F.when(F.col("n_evidence") == 0, "insufficient_data").otherwise("sufficient")})


def fuse(summary: DataFrame, tier3_cap: float = 0.6, conflict_cap: float = 0.5, penalty: float = 0.1) -> DataFrame:
    """The ordered fusion rules: sufficiency, trust, independent axes, corroboration, conflict.

    Expects ``stance, n_evidence, confidence, worst_tier, all_tier3, image_manipulated``.
    Caps and the penalty per tier are choices.  ``rules`` lists what fired, in order.
    """
    c = F.col("confidence")
    no_evidence = F.col("n_evidence") == 0
    adjusted = F.when(no_evidence, 0.0).otherwise(F.greatest(F.lit(0.0), c - penalty * (F.col("worst_tier") - 1)))
    adjusted = F.when(F.col("all_tier3"), F.least(adjusted, F.lit(tier3_cap))).otherwise(adjusted)
    adjusted = F.when(F.col("stance") == "conflicting", F.least(adjusted, F.lit(conflict_cap))).otherwise(adjusted)
    misleading = (F.col("stance") == "supports") & F.col("image_manipulated")
    verdict = F.when(no_evidence, "unverifiable").when(misleading, "misleading_context").when(F.col("stance") == "not_enough_info", "unverifiable").otherwise(F.col("stance"))
    fired = F.array(
        F.when(no_evidence, "sufficiency"),
        F.when(F.col("worst_tier") > 1, "trust"),
        F.when(misleading, "independent_axes"),
        F.when((F.col("n_evidence") > 1) & (F.col("stance") != "conflicting"), "corroboration"),
        F.when(F.col("stance") == "conflicting", "conflict"),
    )
    return summary.withColumns({"fused_confidence": adjusted, "verdict": verdict, "rules": F.array_compact(fired)})


def decide(fused: DataFrame, thresholds: DataFrame, default: float = 0.5) -> DataFrame:
    """Below the claim type's threshold a verdict becomes unverifiable; the confidence stays."""
    low = F.col("fused_confidence") < F.coalesce("threshold", F.lit(default))
    return fused.join(thresholds, "claim_type", "left").withColumn("decision", F.when(low, "unverifiable").otherwise(F.col("verdict")))


def apply_policies(items: DataFrame, policies: DataFrame, matches: Column | dict[str, str]) -> DataFrame:
    """Each item with its first active policy by priority; ``matches`` relates both sides.

    A condition meets every pair that it holds for.  Where columns must be equal, ``matches`` names them
    (item column: policy column), and only the first policy of each value is joined, so items do not multiply.
    """
    active = policies.filter("active")
    if isinstance(matches, dict):
        first = F.min_by(F.struct(*active.columns), F.struct(F.col("priority").isNull(), "priority", "policy_id"))
        active = active.groupBy(*[F.col(c).alias(f"_{i}") for i, c in enumerate(matches.values())]).agg(first.alias("_p")).select("_p.*")
        matches = reduce(Column.__and__, [items[i] == active[p] for i, p in matches.items()])
    joined = items.join(active, matches, "left")
    order = W.partitionBy("item_id").orderBy(F.asc_nulls_last("priority"), "policy_id")
    return joined.withColumn("_r", F.row_number().over(order)).filter("_r = 1").drop("_r")


def chain_violations(chain: DataFrame) -> DataFrame:
    """Claims whose steps are not numbered 1.. without gap, or where a decision precedes a fusion."""
    sums = chain.groupBy("claim_id").agg(
        F.min("sequence_order").alias("low"),
        F.max("sequence_order").alias("high"),
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("sequence_order").alias("distinct_n"),
        F.max(F.when(F.col("kind") == "fusion", F.col("sequence_order"))).alias("last_fusion"),
        F.min(F.when(F.col("kind") == "decision", F.col("sequence_order"))).alias("first_decision"),
    )
    gap = (F.col("high") - F.col("low") + 1 != F.col("n")) | (F.col("n") != F.col("distinct_n"))
    return sums.filter(gap | F.coalesce(F.col("last_fusion") > F.col("first_decision"), F.lit(False)))


def render_explanations(chain: DataFrame, decisions: DataFrame, template: str = "No explanation could be rendered for %s.") -> DataFrame:
    """The steps' texts in order, with the decision's label; a fixed sentence where there is none."""
    steps = chain.groupBy("claim_id").agg(F.array_sort(F.collect_list(F.struct("sequence_order", "text"))).alias("s"), F.count(F.lit(1)).alias("n_steps"))
    text = F.array_join(F.transform("s", lambda x: x["text"]), " ")
    return decisions.join(steps, "claim_id", "left").select(
        "claim_id", "decision", F.coalesce("n_steps", F.lit(0)).alias("n_steps"), F.coalesce(text, F.format_string(template, F.col("claim_id").cast("string"))).alias("explanation")
    )


def document_summary(decisions: DataFrame, labels: list[str]) -> DataFrame:
    """Per document: claims, and how many of each decision."""
    return decisions.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_claims"), *[F.count_if(F.col("decision") == x).alias(f"n_{x}") for x in labels])


def cross_claim_notes(claims: DataFrame) -> DataFrame:
    """Pairs of a document's claims with one subject and predicate and different objects."""
    pair = claims.alias("a").join(
        claims.alias("b"),
        (F.col("a.doc_id") == F.col("b.doc_id")) & (F.col("a.subject") == F.col("b.subject")) & (F.col("a.predicate") == F.col("b.predicate")) & (F.col("a.claim_id") < F.col("b.claim_id")) & (F.col("a.object") != F.col("b.object")),
    )
    return pair.select(F.col("a.doc_id").alias("doc_id"), F.col("a.claim_id").alias("claim_a"), F.col("b.claim_id").alias("claim_b"))


# ---- integrity ---------------------------------------------------------------------------


def bad_ids(df: DataFrame, column: str, prefixes: list[str]) -> DataFrame:
    """Rows whose id is not ``prefix_token`` with one of the prefixes."""
    return df.filter(~F.coalesce(F.col(column).rlike(f"^({'|'.join(prefixes)})_[A-Za-z0-9-]+$"), F.lit(False)))


def dangling(df: DataFrame, column: str, target: DataFrame, key: str) -> DataFrame:
    """References that no target row answers; array columns are looked through element by element."""
    many = df.schema[column].dataType.simpleString().startswith("array")
    refs = df.withColumn("_ref", F.explode(column) if many else F.col(column)).filter(F.col("_ref").isNotNull())
    return refs.join(target.select(F.col(key).alias("_ref")).distinct(), "_ref", "left_anti")


def out_of_range(df: DataFrame, columns: list[str], low: float = 0.0, high: float = 1.0) -> DataFrame:
    test = F.lit(False)
    for c in columns:
        test = test | ~F.coalesce(F.col(c).between(low, high), F.lit(True))
    return df.filter(test)


def out_of_order(df: DataFrame, earlier: str, later: str) -> DataFrame:
    return df.filter(F.col(later) < F.col(earlier))


def created_before_referenced(df: DataFrame, ref: str, target: DataFrame, key: str, created: str = "created_at") -> DataFrame:
    other = target.select(F.col(key).alias("_k"), F.col(created).alias("_c"))
    return df.join(other, F.col(ref) == F.col("_k")).filter(F.col(created) < F.col("_c")).drop("_k", "_c")


def not_exactly_one(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.filter(sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0)) != 1)


def not_exactly_one_child(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """``key, n``: parents that do not end in exactly one child."""
    n = children.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return parents.select(key).join(n, key, "left").select(key, F.coalesce("n", F.lit(0)).alias("n")).filter("n != 1")


def incompatible_versions(df: DataFrame, major: int, column: str = "schema_version") -> DataFrame:
    return df.filter(~F.coalesce(F.split(column, r"\.")[0] == str(major), F.lit(False)))


def over_one_per_group(df: DataFrame, keys: list[str], where: Column) -> DataFrame:
    """Groups with more than one row that fulfils ``where``."""
    return df.filter(where).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def unanswered(evidence: DataFrame, questions: list[str]) -> DataFrame:
    """Which provenance questions a row leaves open."""
    open_ = F.array_compact(F.array(*[F.when(F.col(q).isNull(), F.lit(q)) for q in questions]))
    return evidence.withColumn("unanswered", open_).filter(F.size("unanswered") > 0)


def altered(evidence: DataFrame, content: str = "content", digest: str = "sha256") -> DataFrame:
    """Rows whose content no longer has the digest taken at capture."""
    return evidence.filter(F.sha2(content, 256) != F.col(digest))


# ---- entities and graph ------------------------------------------------------------------


def match_entities(mentions: DataFrame, nodes: DataFrame) -> DataFrame:
    """``mention_id, node_id, how``: same type and equal alias, or a shared external id."""
    norm = lambda c: F.regexp_replace(F.lower(F.trim(c)), r"\s+", " ")
    alias = nodes.select("node_id", "type", F.explode("aliases").alias("a")).select("node_id", "type", norm(F.col("a")).alias("k"))
    by_alias = mentions.select("mention_id", "type", norm(F.col("surface")).alias("k")).join(alias, ["type", "k"]).select("mention_id", "node_id", F.lit("alias").alias("how"))
    ext = nodes.select("node_id", F.explode("external_ids").alias("src", "ext"))
    by_id = mentions.select("mention_id", F.explode("external_ids").alias("src", "ext")).join(ext, ["src", "ext"]).select("mention_id", "node_id", F.lit("external_id").alias("how"))
    return by_alias.unionByName(by_id).distinct()


def resolution_outcome(mentions: DataFrame, matches: DataFrame) -> DataFrame:
    """Merge with one candidate, new node with none, ambiguous with several."""
    n = matches.groupBy("mention_id").agg(F.count_distinct("node_id").alias("n"), F.min("node_id").alias("node_id"))
    joined = mentions.select("mention_id").join(n, "mention_id", "left")
    outcome = F.when(F.col("n").isNull(), "new_node").when(F.col("n") == 1, "merge").otherwise("ambiguous")
    return joined.select("mention_id", outcome.alias("outcome"), F.when(F.col("n") == 1, F.col("node_id")).alias("node_id"))


def illegal_transitions(states: DataFrame, legal: DataFrame, key: str = "item_id") -> DataFrame:
    """State changes (by ``seq``) that the legal table (``previous, state``) lacks."""
    moved = states.withColumn("previous", F.lag("state").over(W.partitionBy(key).orderBy("seq"))).filter("previous IS NOT NULL AND previous != state")
    return moved.join(F.broadcast(legal), ["previous", "state"], "left_anti")


def aggregate_nodes(mentions: DataFrame) -> DataFrame:
    return mentions.groupBy("node_id").agg(
        F.count(F.lit(1)).alias("mention_count"), F.array_sort(F.collect_set("surface")).alias("aliases"), F.min("seen_at").alias("first_seen"), F.max("seen_at").alias("last_updated")
    )


def aggregate_edges(relations: DataFrame) -> DataFrame:
    """One edge per subject, predicate and object; its confidence is the largest of its relations'."""
    return relations.groupBy("subject", "predicate", "object").agg(
        F.array_sort(F.collect_set("relation_id")).alias("relation_ids"), F.max("confidence").alias("confidence"), F.count(F.lit(1)).alias("n_relations")
    )


def conflicting_edges(edges: DataFrame) -> DataFrame:
    """Subjects and predicates with several current objects; all are kept."""
    return edges.groupBy("subject", "predicate").agg(F.array_sort(F.collect_set("object")).alias("objects")).filter(F.size("objects") > 1)


def succession(edges: DataFrame) -> DataFrame:
    """``valid_until`` of an edge is the start of its successor; the last one is open."""
    order = W.partitionBy("subject", "predicate").orderBy("valid_from", "object")
    return edges.withColumn("valid_until", F.lead("valid_from").over(order))


def current(edges: DataFrame) -> DataFrame:
    return edges.filter(F.col("valid_until").isNull())


def as_of(edges: DataFrame, when: Column) -> DataFrame:
    """Edges whose window holds the moment, both ends included."""
    return edges.filter((F.col("valid_from") <= when) & (F.col("valid_until").isNull() | (when <= F.col("valid_until"))))


def as_of_join(left: DataFrame, right: DataFrame, key: str, at: str, since: str) -> DataFrame:
    """Each left row with the latest right row of its key that is not later: one union and one window, no range join."""
    names = [c for c in right.columns if c != key]
    a = left.withColumns({"_at": F.col(at), "_side": F.lit(1), "_r": F.lit(None).cast(right.select(F.struct(*names)).schema[0].dataType)})
    b = right.select(key, F.col(since).alias("_at"), F.lit(0).alias("_side"), F.struct(*names).alias("_r"))
    both = a.unionByName(b, allowMissingColumns=True)
    order = W.partitionBy(key).orderBy("_at", "_side").rowsBetween(W.unboundedPreceding, 0)
    found = both.withColumn("_r", F.last("_r", ignorenulls=True).over(order)).filter("_side = 1")
    return found.select(*left.columns, *[F.col(f"_r.{c}").alias(c if c not in left.columns else f"right_{c}") for c in names])


def generate_facts(edges: DataFrame, evidence: DataFrame) -> DataFrame:
    """Facts with the worst (largest) tier of their evidence."""
    refs = edges.select("edge_id", F.explode("evidence_ids").alias("evidence_id")).join(evidence, "evidence_id")
    worst = refs.groupBy("edge_id").agg(F.max("tier").alias("tier"), F.count_distinct("evidence_id").alias("n_evidence"))
    return edges.join(worst, "edge_id")


def independent_sources(links: DataFrame, evidence: DataFrame) -> DataFrame:
    """``evidence_id, root``: linked evidence (copies, syndication, mirrors, translations) counts as one."""
    roots = graph.connected_components(links, "a", "b")
    return evidence.select("evidence_id").join(roots, F.col("evidence_id") == F.col("node"), "left").select("evidence_id", F.coalesce("root", "evidence_id").alias("root"))


def current_version(versions: DataFrame, key: str = "evidence_id", at: str = "created_at", until: Column | None = None) -> DataFrame:
    """The latest capture of each item (up to ``until``)."""
    rows = versions if until is None else versions.filter(F.col(at) <= until)
    rest = [c for c in versions.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(F.col(at), *[c for c in rest if c != at])).alias("v")).select(key, "v.*")


def usable_evidence(evidence: DataFrame, claims: DataFrame) -> DataFrame:
    """Without evidence older than the event its claim is about."""
    return evidence.join(claims.select("claim_id", "event_date"), "claim_id").filter(F.col("event_date").isNull() | (F.col("captured_on") >= F.col("event_date")))


def who_cites(df: DataFrame, refs: str, key: str) -> DataFrame:
    """``target, citing``: the inverse of an array of references."""
    return df.select(F.explode(refs).alias("target"), F.col(key).alias("citing")).groupBy("target").agg(F.array_sort(F.collect_set("citing")).alias("citing"))


def provenance(facts: DataFrame, edges: DataFrame, relations: DataFrame, claims: DataFrame) -> DataFrame:
    """Fact to edge to relation to claim to article, every link kept."""
    e = facts.join(edges.select("edge_id", F.explode_outer("relation_ids").alias("relation_id")), "edge_id", "left")
    r = e.join(relations.select("relation_id", "claim_id"), "relation_id", "left")
    return r.join(claims.select("claim_id", "doc_id"), "claim_id", "left").select("fact_id", "edge_id", "relation_id", "claim_id", "doc_id")


def corroboration(assertions: DataFrame, roots: DataFrame) -> DataFrame:
    """Independent sources for each assertion and stance, net of syndication."""
    return assertions.join(roots, "evidence_id").groupBy("claim_id", "assertion", "stance").agg(F.count_distinct("root").alias("n_independent"))


def contradictions(assertions: DataFrame) -> DataFrame:
    """Assertions with evidence on both sides."""
    sums = assertions.groupBy("claim_id", "assertion").agg(*[F.count_if(F.col("stance") == s).alias(s) for s in STANCES[:2]])
    return sums.filter("supports > 0 AND refutes > 0")


def complementary(assertions: DataFrame) -> DataFrame:
    """``claim_id, assertion, stance, n_evidence``: assertions of one claim that evidence addresses apart from each other.

    An assertion with evidence on both sides is a contradiction and does not count; a claim
    needs two others.  Evidence that says too little addresses nothing.
    """
    by = assertions.filter(F.col("stance").isin(*STANCES[:2])).groupBy("claim_id", "assertion")
    one_sided = by.agg(F.min("stance").alias("stance"), F.max("stance").alias("_other"), F.count(F.lit(1)).alias("n_evidence")).filter("stance = _other").drop("_other")
    return one_sided.withColumn("_n", F.count(F.lit(1)).over(W.partitionBy("claim_id"))).filter("_n > 1").drop("_n")


def synthesised_stance(assertions: DataFrame) -> DataFrame:
    """``claim_id, stance``: what all evidence of a claim shows together, by its shape and never by weights.

    Both sides, on one assertion or on different ones, are ``conflicting``; one side alone is
    that side; else there is not enough information.
    """
    on = lambda stance: F.bool_or(F.coalesce(F.col("stance") == stance, F.lit(False)))
    sides = assertions.groupBy("claim_id").agg(on(STANCES[0]).alias("_for"), on(STANCES[1]).alias("_against"))
    stance = F.when(F.col("_for") & F.col("_against"), "conflicting").when(F.col("_for"), STANCES[0]).when(F.col("_against"), STANCES[1]).otherwise(STANCES[2])
    return sides.select("claim_id", stance.alias("stance"))


def unresolved(asserted: DataFrame, addressed: DataFrame) -> DataFrame:
    """Assertions that no evidence speaks to."""
    return asserted.join(addressed.select("claim_id", "assertion").distinct(), ["claim_id", "assertion"], "left_anti")


def confidence_factors(summary: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """A weighted mean of the five factors; the weights are our choice (equal by default)."""
    w = weights or dict.fromkeys(("quality", "corroboration", "consistency", "coverage", "completeness"), 1.0)
    return summary.withColumn("confidence", sum((F.col(k) * v for k, v in w.items()), F.lit(0.0)) / sum(w.values()))


def retrieval_done(plan: DataFrame, min_sources: int = 2) -> DataFrame:
    """Stops when all targets are found in enough sources and all wanted categories are there (our rule)."""
    done = (F.col("n_found") >= F.col("n_targets")) & (F.col("n_sources") >= min_sources) & (F.size(F.array_except("wanted", "have")) == 0)
    return plan.withColumn("done", done)


def merge_nodes(nodes: DataFrame, merges: DataFrame) -> DataFrame:
    """Survivors take over aliases and mentions of what ``merges`` (absorbed, survivor) maps to them."""
    to = F.coalesce("survivor", "node_id")
    return nodes.join(merges, F.col("node_id") == F.col("absorbed"), "left").select(to.alias("node_id"), "aliases", "mention_count").groupBy("node_id").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("aliases")))).alias("aliases"), F.sum("mention_count").alias("mention_count")
    )


def split_node(mentions: DataFrame, reassigned: DataFrame) -> DataFrame:
    """Mentions move to the node that ``reassigned`` (mention_id, new_node_id) names; the others stay."""
    return mentions.join(reassigned, "mention_id", "left").withColumn("node_id", F.coalesce("new_node_id", "node_id")).drop("new_node_id")


def bundle(claims: DataFrame, evidence: DataFrame) -> DataFrame:
    """A claim's evidence as one array: a view, never stored."""
    rows = evidence.groupBy("claim_id").agg(F.array_sort(F.collect_list(F.struct("evidence_id", "stance"))).alias("evidence"))
    return claims.select("claim_id").join(rows, "claim_id", "left")


def applicable(items: DataFrame, analysers: DataFrame) -> DataFrame:
    """Analysers for an item by modality and language; 'unsupported_language' where only the language is missing."""
    fits = items.join(F.broadcast(analysers), F.array_contains("modalities", F.col("modality")), "left")
    ok = F.array_contains("languages", F.col("language"))
    return fits.groupBy("item_id").agg(F.array_sort(F.collect_set(F.when(ok, F.col("analyser")))).alias("analysers"), F.max(F.coalesce(ok, F.lit(False))).alias("_ok")).select(
        "item_id", "analysers", F.when(F.col("_ok"), "ok").otherwise("unsupported_language").alias("status")
    )


def visible(rows: DataFrame, policy: dict[str, list[str]], consumer: str) -> DataFrame:
    """Only the columns that the policy grants to the consumer's category."""
    if consumer not in policy:
        raise PermissionError(f"no access for {consumer!r}")
    return rows.select(*[c for c in rows.columns if c in policy[consumer]])


# ---- runs and logs ------------------------------------------------------------------------


def module_latency(events: DataFrame, start: str = "start", end: str = "complete") -> DataFrame:
    """Seconds between the first start and the last completion of each run and module."""
    at = lambda kind, pick: pick(F.when(F.col("event") == kind, F.col("ts")))
    sums = events.groupBy("run_id", "module").agg(at(start, F.min).alias("started"), at(end, F.max).alias("completed"))
    return sums.withColumn("seconds", F.col("completed").cast("timestamp").cast("double") - F.col("started").cast("timestamp").cast("double"))


def error_rate(events: DataFrame, key: str = "module") -> DataFrame:
    return events.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("level") == "ERROR").alias("errors")).withColumn("rate", F.col("errors") / F.col("n"))


def run_rollup(executions: DataFrame) -> DataFrame:
    """Per run: duration, retries and a status from the last attempts of required and optional modules."""
    last = executions.groupBy("run_id", "module").agg(
        F.max_by("status", "attempt").alias("status"), F.max("attempt").alias("attempts"), F.sum("seconds").alias("seconds"), F.bool_or("required").alias("required")
    )
    failed = F.col("status") == "failed"
    return last.groupBy("run_id").agg(
        F.sum("seconds").alias("seconds"),
        F.sum(F.col("attempts") - 1).alias("retries"),
        F.when(F.bool_or(failed & F.col("required")), "FAILED").when(F.bool_or(failed), "PARTIAL_FAILURE").otherwise("SUCCEEDED").alias("status"),
    )


def ready_for_fusion(executions: DataFrame, terminal: tuple[str, ...] = ("succeeded", "failed", "skipped")) -> DataFrame:
    """Runs and claims all of whose modules have come to an end."""
    return executions.groupBy("run_id", "claim_id").agg(F.bool_and(F.col("status").isin(*terminal)).alias("ready"))


def retained(logs: DataFrame, days: dict[str, int], now: Column, default: int = 30) -> DataFrame:
    """Log rows still inside the retention of their level."""
    limit = F.lit(default)
    for level, n in days.items():
        limit = F.when(F.col("level") == level, n).otherwise(limit)
    return logs.filter(F.datediff(now, F.col("ts")) <= limit)


def export_feedback(feedback: DataFrame, batch: str) -> DataFrame:
    return feedback.filter(F.col("status") == "validated").withColumn("batch_id", F.lit(batch))


def latest_state(history: DataFrame, key: str, version: str = "version") -> DataFrame:
    """The state after all corrections: of an append-only history the last version of each key that is not retracted."""
    rest = [c for c in history.columns if c != key]
    last = history.groupBy(key).agg(F.max_by(F.struct(*rest), version).alias("v")).select(key, "v.*")
    return last.filter(~F.coalesce(F.col("retracted"), F.lit(False))) if "retracted" in history.columns else last


def experiment_log(log: DataFrame, attempt: DataFrame) -> DataFrame:
    """Append only: negative results stay."""
    return log.unionByName(attempt, allowMissingColumns=True)


# ---- conditional fields, provenance questions, applicability by claim type ------------------


def broken_conditions(df: DataFrame, rules: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Rows that break a rule, with the names of those in ``broken``, in the order given.

    A rule is a condition and a test of being filled: the field must be filled if and only if the condition
    holds.  A condition that is null does not hold; a test that is null is of an empty field.
    """
    no = F.lit(False)
    broken = F.array_compact(F.array(*[F.when(F.coalesce(when, no) != F.coalesce(filled, no), F.lit(name)) for name, (when, filled) in rules.items()]))
    return df.withColumn("broken", broken).filter(F.size("broken") > 0)


#: The questions that every evidence item must answer, in order.
QUESTIONS = ["where_from", "published_by", "retrieved_at", "original_source", "collected_by", "created_by_pipeline", "referenced_by_claims", "derived_facts"]


def provenance_answers(evidence: DataFrame, articles: DataFrame, claims: DataFrame, facts: DataFrame) -> DataFrame:
    """``evidence_id`` and the answers to the eight questions; null where a row leaves one open.

    ``evidence``: evidence_id, article_id, created_at, produced_by, schema_version.  ``articles``: article_id (unique),
    source_url, publisher, origin_id (null or itself for an original).  ``claims`` and ``facts`` name an evidence_id in
    each row and are counted before they are joined.  A pipeline is known by module and version together.  Evidence
    of an unknown article, and a variant whose original is unknown, leave these questions open.
    """
    count = lambda df, name: df.groupBy("evidence_id").agg(F.count(F.lit(1)).alias(name))
    origins = articles.select(F.col("article_id").alias("_origin"), F.col("source_url").alias("original_source"))
    known = articles.select("article_id", "source_url", "publisher", F.coalesce("origin_id", "article_id").alias("_origin")).join(origins, "_origin", "left")
    rows = evidence.join(known, "article_id", "left").join(count(claims, "referenced_by_claims"), "evidence_id", "left").join(count(facts, "derived_facts"), "evidence_id", "left")
    return rows.select(
        "evidence_id",
        F.col("source_url").alias("where_from"),
        F.col("publisher").alias("published_by"),
        F.col("created_at").alias("retrieved_at"),
        "original_source",
        F.col("produced_by").alias("collected_by"),
        F.concat("produced_by", F.lit("@"), F.col("schema_version").cast("string")).alias("created_by_pipeline"),
        "referenced_by_claims",
        "derived_facts",
    )


def applicable_to_claims(items: DataFrame, analysers: DataFrame) -> DataFrame:
    """``item_id, analysers, status`` by modality, claim type and language (item_id unique).

    ``unsupported_language`` where analysers fit but for the language, ``not_applicable`` where none fits at all.
    """
    # The registry names each analyser once and is small by nature; it becomes one array, so no item is repeated.
    listed = analysers.agg(F.collect_list(F.struct("analyser", "modalities", "claim_types", "languages")).alias("_all"))
    has = lambda names, value: F.coalesce(F.array_contains(names, value), F.lit(False))
    near = F.filter("_all", lambda a: has(a["modalities"], F.col("modality")) & has(a["claim_types"], F.col("claim_type")))
    out = items.join(F.broadcast(listed)).withColumn("_near", near)
    ok = F.array_sort(F.transform(F.filter("_near", lambda a: has(a["languages"], F.col("language"))), lambda a: a["analyser"]))
    status = F.when(F.size(ok) > 0, "ok").when(F.size("_near") > 0, "unsupported_language").otherwise("not_applicable")
    return out.select("item_id", ok.alias("analysers"), status.alias("status"))
