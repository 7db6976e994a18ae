"""Registered queries of conditional fields, provenance questions, applicability and the steps of cleaning, with their SQL.

The shop's tables stand in for records: sales for evidence, clients for articles, sale lines for claims and facts.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import dedup, knowledge, labels, missing
from ..operators.normalize import normalize
from ..storage import Table
from .catalogue import _DOCS, _KEY, _clean_sql, _labelled, _q, _t


@_q(
    """SELECT * FROM (SELECT sale_id, sold_at, arrived_at, concat_ws(',', CASE WHEN coalesce(status <> 'held', false) <> (total IS NOT NULL) THEN 'total' END,
      CASE WHEN coalesce(total > 0, false) <> (sold_at IS NOT NULL) THEN 'sold_at' END, CASE WHEN coalesce(status IN ('open', 'held'), false) <> (priority IS NOT NULL) THEN 'priority' END) AS broken FROM sales)
    WHERE broken <> ''"""
)
def conditional_rules(spark, sf_dir):
    """Sales with a field that is filled though its condition does not hold, or the other way round."""
    rules = {
        "total": (F.col("status") != "held", F.col("total").isNotNull()),
        "sold_at": (F.col("total") > 0, F.col("sold_at").isNotNull()),
        "priority": (F.col("status").isin("open", "held"), F.col("priority").isNotNull()),
    }
    rows = knowledge.broken_conditions(_t(spark, sf_dir, "sales"), rules)
    return rows.select("sale_id", "sold_at", "arrived_at", F.array_join("broken", ",").alias("broken"))


def _answers(spark, sf_dir):
    sales, lines, clients = (_t(spark, sf_dir, t) for t in ("sales", "sale_lines", "clients"))
    last = clients.filter("client_id IS NOT NULL").groupBy("client_id").agg(*[F.min(c).alias(c) for c in ("email", "source", "master_id")])
    articles = last.select(F.col("client_id").alias("article_id"), F.col("email").alias("source_url"), F.col("source").alias("publisher"), F.col("master_id").alias("origin_id"))
    evidence = sales.select(
        F.col("sale_id").alias("evidence_id"), F.col("client_id").alias("article_id"), F.col("sold_at").alias("created_at"), F.col("status").alias("produced_by"), F.col("priority").alias("schema_version")
    )
    claims = lines.filter("flag = 'kept'").select(F.col("sale_id").alias("evidence_id"))
    facts = lines.filter("shipped_at IS NOT NULL AND quantity > 25").select(F.col("sale_id").alias("evidence_id"))
    return knowledge.provenance_answers(evidence, articles, claims, facts)


_ANSWERS = """WITH a AS (SELECT client_id, min(email) AS email, min(source) AS source, min(master_id) AS master_id FROM clients WHERE client_id IS NOT NULL GROUP BY client_id),
    c AS (SELECT sale_id, count(*) AS n FROM sale_lines WHERE flag = 'kept' GROUP BY sale_id), f AS (SELECT sale_id, count(*) AS n FROM sale_lines WHERE shipped_at IS NOT NULL AND quantity > 25 GROUP BY sale_id),
    q AS (SELECT s.sale_id AS evidence_id, a.email AS where_from, a.source AS published_by, s.sold_at AS retrieved_at, o.email AS original_source, s.status AS collected_by,
      s.status || '@' || s.priority AS created_by_pipeline, c.n AS referenced_by_claims, f.n AS derived_facts FROM sales s LEFT JOIN a ON a.client_id = s.client_id
      LEFT JOIN a o ON o.client_id = coalesce(a.master_id, a.client_id) LEFT JOIN c ON c.sale_id = s.sale_id LEFT JOIN f ON f.sale_id = s.sale_id)"""


@_q(f"{_ANSWERS} SELECT * FROM q")
def provenance_answers(spark, sf_dir):
    return _answers(spark, sf_dir)


@_q(
    f"{_ANSWERS} SELECT unanswered, count(*) AS n FROM (SELECT concat_ws(',', "
    + ", ".join(f"CASE WHEN {q} IS NULL THEN '{q}' END" for q in knowledge.QUESTIONS)
    + ") AS unanswered FROM q) WHERE unanswered <> '' GROUP BY unanswered"
)
def provenance_eight_questions(spark, sf_dir):
    """How many evidence items leave which of the eight questions open."""
    rows = knowledge.unanswered(_answers(spark, sf_dir), knowledge.QUESTIONS)
    return rows.groupBy(F.array_join("unanswered", ",").alias("unanswered")).agg(F.count(F.lit(1)).alias("n"))


@_q(
    """SELECT doc_id AS item_id, CASE WHEN n = '' THEN '' ELSE n END AS analysers, CASE WHEN n <> '' THEN 'ok' WHEN fits THEN 'unsupported_language' ELSE 'not_applicable' END AS status
    FROM (SELECT doc_id, concat_ws(',', CASE WHEN kind IN ('factual', 'statistical') AND lang IN ('en', 'de') THEN 'claims' END, CASE WHEN kind = 'statistical' AND lang = 'en' THEN 'numbers' END) AS n,
      coalesce(kind IN ('factual', 'statistical'), false) AS fits FROM (SELECT doc_id, lang, CASE WHEN regexp_matches(text, '[0-9]') THEN 'statistical' WHEN length(text) >= 200 THEN 'factual' WHEN text IS NOT NULL THEN 'opinion' END AS kind FROM documents))"""
)
def analysers_by_claim_type(spark, sf_dir):
    kind = F.when(F.col("text").rlike("[0-9]"), "statistical").when(F.length("text") >= 200, "factual").when(F.col("text").isNotNull(), "opinion")
    items = _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("item_id"), F.lit("text").alias("modality"), kind.alias("claim_type"), F.col("lang").alias("language"))
    analysers = spark.createDataFrame(
        [("numbers", ["text"], ["statistical"], ["en"]), ("claims", ["text"], ["factual", "statistical"], ["en", "de"]), ("forensics", ["image"], ["factual"], ["en"])],
        "analyser string, modalities array<string>, claim_types array<string>, languages array<string>",
    )
    return knowledge.applicable_to_claims(items, analysers).withColumn("analysers", F.array_join("analysers", ","))


@_q(
    f"WITH c AS (SELECT doc_id, {_clean_sql('text')} AS text, quality FROM documents LEFT JOIN labels USING (doc_id)), r AS (SELECT * FROM c WHERE text <> '' AND quality IS NOT NULL), "
    "e AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1), "
    f"k AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY {_KEY.format('text')} ORDER BY doc_id) = 1) "
    "SELECT '1_loaded' AS step, count(*) AS n FROM c UNION ALL SELECT '2_required', count(*) FROM r UNION ALL SELECT '3_exact', count(*) FROM e UNION ALL SELECT '4_near', count(*) FROM k UNION ALL SELECT '5_labelled', count(*) FROM k WHERE quality IN (0, 1)"
)
def cleaning_steps(spark, sf_dir):
    """Rows left after each step of cleaning; exact copies go before near ones."""
    loaded = normalize(_labelled(spark, sf_dir).drop("toxic"), _DOCS, "doc_id")
    # Cleaned once and written as digests: each later step reads the rows twice, for winners and for what stays.
    required = missing.drop_rows_missing_required(X.once(loaded, text=X.clean_text(F.col("text"))), ["text", "label_raw"])
    required = required.select("doc_id", F.sha2("text", 256).alias("exact"), F.sha2(X.dedup_key(F.col("text")), 256).alias("near"), "label_raw")
    required = Table(required, "required").df
    exact = dedup.drop_exact_duplicates(required, ["exact"], "doc_id")
    near = dedup.keep_first(exact, F.col("near"), "doc_id")
    labelled = labels.drop_unmapped(labels.apply_label_map(near, {"0": 0, "1": 1}))
    steps = {"1_loaded": loaded, "2_required": required, "3_exact": exact, "4_near": near, "5_labelled": labelled}
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("step"), "n") for name, df in steps.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out
