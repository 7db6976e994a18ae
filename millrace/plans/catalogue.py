"""Registered queries of the library's own operators, each with its SQL where SQL can say it.

Every query reads whole tables.  ``_q`` registers a function and its oracle together.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..lineage import stamp
from ..operators import dedup, graph, knowledge, labels, missing, profile, split, validate
from ..operators.normalize import NormalizeSpec, normalize
from ..schema import canonical_view
from ..storage import Table
from ..streaming import events as streams

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def _q(sql: str | None = None):
    def register(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return register


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels, null where there is none."""
    return _t(spark, sf_dir, "documents").join(_t(spark, sf_dir, "labels"), "doc_id", "left")


_DOCS = NormalizeSpec("documents", "quality", "article", "text", None, "quality")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalise, clean, drop, deduplicate, label; the result is the labels' distribution."""
    rows = _labelled(spark, sf_dir).drop("toxic")
    # Texts are cleaned once, for what they say and for their keys; the rows are read twice, for winners and for what stays.
    rows = X.once(normalize(rows, _DOCS, "doc_id"), text=X.clean_text(F.col("text")))
    rows = missing.drop_rows_missing_required(rows, ["text", "label_raw"])
    # Equal texts have equal keys, so the near key alone leaves the same rows as both steps.
    rows = Table(rows.withColumn("near", F.sha2(X.dedup_key(F.col("text")), 256)), "cleaned").df
    rows = dedup.keep_first(rows, F.col("near"), "doc_id").drop("near")
    rows = labels.drop_unmapped(labels.apply_label_map(rows, {"0": 0, "1": 1}))
    return labels.label_distribution(canonical_view(stamp(rows, "synthetic", "1.0.0", "")))


# ---- text --------------------------------------------------------------------------------

_HTML = "regexp_replace({0}, '<[^>]+>', ' ', 'g')"
_URL = r"regexp_replace({0}, 'https?://\S+|www\.\S+', ' ', 'g')"
_DATELINE = r"regexp_replace({0}, '^[A-Z .,''-]{{3,40}}\(Reuters\)\s*-\s*', '')"
_CONTROL = r"regexp_replace({0}, '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]', '', 'g')"
_SPACE = r"regexp_replace(regexp_replace(regexp_replace({0}, '[ \t]+', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g')"
_KEY = "regexp_replace(lower({0}), '[^a-z0-9]+', '', 'g')"
_WORDS = r"len(list_filter(regexp_split_to_array({0}, '\s+'), lambda w: w <> ''))"
_ALPHA = r"list_transform(list_filter(regexp_split_to_array({0}, '\s+'), lambda w: regexp_full_match(w, '\pL+')), lambda w: lower(w))"


def _clean_sql(column: str) -> str:
    out = f"coalesce({column}, '')"
    for step in (_HTML, _URL, _DATELINE, _CONTROL, _SPACE):
        out = step.format(out)
    return out


@_q(f"SELECT page_id, {_clean_sql('html')} AS text FROM pages")
def clean_text_pages(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select("page_id", X.clean_text(F.col("html")).alias("text"))


@_q(f"SELECT doc_id, {_clean_sql('text')} AS text FROM documents")
def clean_text_documents(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", X.clean_text(F.col("text")).alias("text"))


@_q(f"SELECT page_id, {_HTML.format('html')} AS text FROM pages")
def strip_html(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select("page_id", X.strip_html(F.col("html")).alias("text"))


@_q(f"SELECT page_id, {_URL.format('html')} AS text FROM pages")
def strip_urls(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select("page_id", X.strip_urls(F.col("html")).alias("text"))


@_q(f"SELECT doc_id, {_CONTROL.format('text || chr(1) || chr(9) || chr(127)')} AS text FROM documents")
def control_chars(spark, sf_dir):
    dirty = F.concat("text", F.lit("\x01\t\x7f"))
    return _t(spark, sf_dir, "documents").select("doc_id", X.remove_control_chars(dirty).alias("text"))


_SPACED = "'  ' || replace(text, ' ', '  ') || chr(10) || chr(10) || chr(10) || 'end '"


@_q(f"SELECT doc_id, {_SPACE.format(_SPACED)} AS text FROM documents")
def whitespace(spark, sf_dir):
    spaced = F.concat(F.lit("  "), F.replace("text", F.lit(" "), F.lit("  ")), F.lit("\n\n\nend "))
    return _t(spark, sf_dir, "documents").select("doc_id", X.normalize_whitespace(spaced).alias("text"))


_DATED = "'NEW YORK, N.Y. (Reuters) - ' || text"


@_q(f"SELECT doc_id, {_DATELINE.format(_DATED)} AS text FROM documents")
def dateline(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", X.strip_dateline(F.concat(F.lit("NEW YORK, N.Y. (Reuters) - "), "text")).alias("text"))


@_q(f"SELECT doc_id, {_KEY.format('text')} AS dedup_key, length(text)::BIGINT AS n_chars, {_WORDS.format('text')}::BIGINT AS n_words FROM documents")
def text_measures(spark, sf_dir):
    c = F.col("text")
    return _t(spark, sf_dir, "documents").select(
        "doc_id", X.dedup_key(c).alias("dedup_key"), X.char_length(c).cast("bigint").alias("n_chars"), X.word_count(c).cast("bigint").alias("n_words")
    )


# ---- missing values, duplicates, labels --------------------------------------------------

_MISSING = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS n_null, "
    + (f"count(*) FILTER (regexp_replace({c}, '^\\s+|\\s+$', '', 'g') = '')" if c in ("text", "lang", "source") else "0::BIGINT")
    + " AS n_blank, count(*) AS n FROM d"
    for c in ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")
)


@_q(
    f"WITH d AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id)), m AS ({_MISSING}) "
    'SELECT "column", n_null, n_blank, round(100.0 * (n_null + n_blank) / greatest(n, 1), 2)::DOUBLE AS pct_missing FROM m'
)
def missing_report(spark, sf_dir):
    return missing.missing_value_report(_labelled(spark, sf_dir))


@_q("SELECT doc_id, quality FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL AND trim(text) <> ''")
def drop_missing_required(spark, sf_dir):
    return missing.drop_rows_missing_required(_labelled(spark, sf_dir), ["text", "quality"]).select("doc_id", "quality")


@_q("SELECT doc_id, coalesce(quality, -1) AS quality, coalesce(toxic, 0) AS toxic FROM documents LEFT JOIN labels USING (doc_id)")
def fill_optional(spark, sf_dir):
    return missing.fill_optional_missing(_labelled(spark, sf_dir), {"quality": -1, "toxic": 0, "absent": 1}).select("doc_id", "quality", "toxic")


@_q("SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS r FROM documents) WHERE r = 1")
def dedup_exact(spark, sf_dir):
    return dedup.drop_exact_duplicates(_t(spark, sf_dir, "documents"), ["text"], "doc_id").select("doc_id")


@_q(f"SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY {_KEY.format('text')} ORDER BY doc_id) AS r FROM documents) WHERE r = 1")
def dedup_near(spark, sf_dir):
    return dedup.drop_near_duplicates(_t(spark, sf_dir, "documents"), "text", "doc_id").select("doc_id")


@_q(
    f"WITH s AS (SELECT count(*) AS n, count(DISTINCT text) AS t, count(DISTINCT {_KEY.format('text')}) AS k FROM documents) "
    "SELECT n AS total_rows, n - t AS exact_duplicates, n - k AS near_duplicates, round(100.0 * (n - t) / n, 2)::DOUBLE AS exact_pct, round(100.0 * (n - k) / n, 2)::DOUBLE AS near_pct FROM s"
)
def duplicate_report(spark, sf_dir):
    return dedup.duplicate_report(_t(spark, sf_dir, "documents"), "text")


_PRIORITIES = {"1-urgent": 0, "2-HIGH": 1, " 3-medium ": 2, "4-NOT SPECIFIED": 3}


@_q(
    "SELECT o_orderkey, CASE lower(trim(o_orderpriority)) WHEN '1-urgent' THEN 0 WHEN '2-high' THEN 1 WHEN '3-medium' THEN 2 WHEN '4-not specified' THEN 3 ELSE -1 END AS label FROM orders"
)
def label_map(spark, sf_dir):
    return labels.apply_label_map(_t(spark, sf_dir, "orders"), _PRIORITIES, "o_orderpriority").select("o_orderkey", "label")


@_q("SELECT event_type, count(*) AS n FROM events WHERE event_type NOT IN ('click', 'view') GROUP BY event_type ORDER BY n DESC, event_type LIMIT 10")
def label_map_unmapped(spark, sf_dir):
    return labels.unmapped_values(labels.apply_label_map(_t(spark, sf_dir, "events"), {"click": 0, "view": 1}, "event_type"), "event_type")


@_q('SELECT quality, count(*) AS "count", round(100.0 * count(*) / sum(count(*)) OVER (), 2)::DOUBLE AS pct FROM documents LEFT JOIN labels USING (doc_id) GROUP BY quality')
def label_distribution(spark, sf_dir):
    return labels.label_distribution(_labelled(spark, sf_dir), "quality")


# ---- schema ------------------------------------------------------------------------------


@_q(
    "SELECT 'documents_' || lpad(doc_id::VARCHAR, 7, '0') AS id, 'documents' AS dataset, 'quality' AS task, 'article' AS modality, text, '' AS text_secondary, "
    "quality::VARCHAR AS label_raw, '' AS image_path, lang AS meta_lang, source AS meta_source FROM documents LEFT JOIN labels USING (doc_id)"
)
def normalize_canonical(spark, sf_dir):
    rows = normalize(_labelled(spark, sf_dir), _DOCS, "doc_id")
    meta = lambda k: F.get_json_object("metadata", f"$.{k}").alias(f"meta_{k}")
    return rows.select("id", "dataset", "task", "modality", "text", "text_secondary", "label_raw", "image_path", meta("lang"), meta("source"))


@_q("SELECT conv_id, turn, text, 'human' AS source FROM conversations WHERE role = 'user' UNION ALL SELECT conv_id, turn, text, 'machine' FROM conversations WHERE role = 'assistant'")
def union_tagged(spark, sf_dir):
    c = _t(spark, sf_dir, "conversations")
    part = lambda role, tag: c.filter(F.col("role") == role).select("conv_id", "turn", "text", F.lit(tag).alias("source"))
    return part("user", "human").unionByName(part("assistant", "machine"))


@_q("SELECT doc_id, '1.0' AS schema_version, 'synthetic' AS dataset_version, '1.0.0' AS pipeline_version FROM documents")
def lineage_stamp(spark, sf_dir):
    return stamp(_t(spark, sf_dir, "documents"), "synthetic", "1.0.0").select("doc_id", "schema_version", "dataset_version", "pipeline_version")


@_q(
    "SELECT count(*) AS n_rows, count(*) FILTER (doc_id IS NULL) AS null_doc_id, count(*) FILTER (source IS NULL) AS null_source, "
    "count(*) FILTER (quality IS NULL OR quality NOT IN (0, 1)) AS bad_labels, count(*) FILTER (length(text) < 200) AS too_short, count(*) FILTER (length(text) > 5000) AS too_long "
    "FROM documents LEFT JOIN labels USING (doc_id)"
)
def validate_measures(spark, sf_dir):
    return validate.measures(_labelled(spark, sf_dir).withColumnRenamed("quality", "label"), ["doc_id", "source"], [0, 1], 200, 5000)


# ---- profiles ------------------------------------------------------------------------------

_CARDINALITY = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_unique, round(100.0 * count(DISTINCT {c}) / count(*), 2)::DOUBLE AS pct_unique, '{kind}' AS dtype FROM customer"
    for c, kind in (("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"), ("c_mktsegment", "string"))
)


@_q(_CARDINALITY)
def column_cardinality(spark, sf_dir):
    return profile.column_cardinality(_t(spark, sf_dir, "customer"))


_N = f"WITH w AS (SELECT quality, text, {_WORDS.format('text')} AS n FROM documents LEFT JOIN labels USING (doc_id)) "


@_q(_N + 'SELECT quality, count(*) AS "count", round(avg(n), 1) AS mean_words, round(median(n), 1) AS median_words, round(stddev_samp(n), 1) AS std_words FROM w GROUP BY quality')
def length_by_label(spark, sf_dir):
    return profile.length_by_label(_labelled(spark, sf_dir), "quality")


@_q(
    _N + ", q AS (SELECT quantile_cont(n, 0.25) AS a, quantile_cont(n, 0.75) AS b FROM w), l AS (SELECT a - 3.0 * (b - a) AS lo, b + 3.0 * (b - a) AS hi FROM q) "
    "SELECT greatest(0, round_even(any_value(lo), 0)::BIGINT) AS lower_bound_words, round_even(any_value(hi), 0)::BIGINT AS upper_bound_words, count(*) FILTER (n < lo) AS n_outliers_short, "
    "count(*) FILTER (n > hi) AS n_outliers_long, round(100.0 * count(*) FILTER (n < lo OR n > hi) / count(*), 2)::DOUBLE AS pct_outliers FROM w, l"
)
def length_outliers(spark, sf_dir):
    return profile.length_outliers(_t(spark, sf_dir, "documents"))


@_q(
    _N + "SELECT round(avg(length(text)), 1) AS char_len_mean, trunc(median(length(text)))::BIGINT AS char_len_median, min(length(text))::BIGINT AS char_len_min, max(length(text))::BIGINT AS char_len_max, "
    "round(avg(n), 1) AS word_len_mean, trunc(median(n))::BIGINT AS word_len_median FROM w"
)
def length_stats(spark, sf_dir):
    return profile.text_length_stats(_t(spark, sf_dir, "documents"))


@_q(
    _N + ", e AS (SELECT quantile_cont(n, 0.99) AS hi, min(n)::DOUBLE AS lo FROM w) "
    'SELECT least(floor((least(n::DOUBLE, hi) - lo) / ((hi - lo) / 50)) + 1, 50)::INT AS bin, count(*) AS "count" FROM w, e GROUP BY 1'
)
def length_histogram(spark, sf_dir):
    return profile.length_histogram(_t(spark, sf_dir, "documents"))


_STOPS = ", ".join(f"'{w}'" for w in X.STOP_WORDS)
_TERMS = f"SELECT unnest(list_filter({_ALPHA.format('text')}, lambda w: w NOT IN ({_STOPS}))) AS term FROM documents"


@_q(f"SELECT term, count(*) AS n FROM ({_TERMS}) GROUP BY term ORDER BY n DESC, term LIMIT 15")
def vocab_top(spark, sf_dir):
    return profile.vocab_top(_t(spark, sf_dir, "documents"))


@_q(f"SELECT count(DISTINCT term) AS unique_tokens FROM ({_TERMS})")
def vocab_size(spark, sf_dir):
    return profile.vocab_size(_t(spark, sf_dir, "documents"))


@_q(
    f"WITH t AS (SELECT {_ALPHA.format('text')} AS t FROM documents), b AS (SELECT unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS term FROM t) "
    "SELECT term, count(*) AS n FROM b GROUP BY term ORDER BY n DESC, term LIMIT 15"
)
def bigram_top(spark, sf_dir):
    return profile.bigram_top(_t(spark, sf_dir, "documents"))


@_q("SELECT lang, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 1)::DOUBLE AS pct FROM documents WHERE length(text) >= 10 GROUP BY lang ORDER BY n DESC, lang LIMIT 5")
def lang_distribution(spark, sf_dir):
    return profile.language_distribution(_t(spark, sf_dir, "documents"))


# ---- samples and splits -------------------------------------------------------------------


@_q("SELECT doc_id FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 100")
def sample_k(spark, sf_dir):
    return split.sample_k(_t(spark, sf_dir, "documents"), 100, id_col="doc_id").select("doc_id")


_SPLIT = (
    "WITH r AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5('42:' || doc_id), doc_id) AS i, count(*) OVER (PARTITION BY quality) AS n FROM documents JOIN labels USING (doc_id)), "
    "s AS (SELECT doc_id, quality, CASE WHEN i <= floor(n * 0.8::DOUBLE) THEN 'train' WHEN i <= floor(n * 0.8::DOUBLE) + floor((n - floor(n * 0.8::DOUBLE)) * 0.5::DOUBLE) THEN 'val' ELSE 'test' END AS split FROM r) "
)


@_q(_SPLIT + "SELECT doc_id, quality, split FROM s")
def split_stratified(spark, sf_dir):
    rows = _t(spark, sf_dir, "documents").select("doc_id").join(_t(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
    return split.stratified_split(rows, label="quality", id_col="doc_id")


@_q(_SPLIT + "SELECT quality, split, count(*) AS n FROM s GROUP BY ALL")
def split_counts(spark, sf_dir):
    return split_stratified(spark, sf_dir).groupBy("quality", "split").agg(F.count(F.lit(1)).alias("n"))


# ---- claims, evidence, graph ----------------------------------------------------------------


def _relations(spark, sf_dir):
    """Line items read as relations: an order ships parts from suppliers."""
    return _t(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("subject"), F.col("l_returnflag").alias("predicate"), F.col("l_suppkey").alias("object"), F.col("l_linenumber").alias("relation_id"), F.col("l_discount").alias("confidence")
    )


@_q(
    "SELECT l_orderkey AS subject, l_returnflag AS predicate, l_suppkey AS object, max(l_discount) AS confidence, count(*) AS n_relations, array_to_string(list_sort(list(DISTINCT l_linenumber)), ',') AS relation_ids FROM lineitem GROUP BY ALL"
)
def edge_aggregate(spark, sf_dir):
    edges = knowledge.aggregate_edges(_relations(spark, sf_dir))
    return edges.withColumn("relation_ids", F.array_join(F.col("relation_ids").cast("array<string>"), ","))


@_q(
    "SELECT l_orderkey AS subject, l_returnflag AS predicate, array_to_string(list_sort(list(DISTINCT l_suppkey)), ',') AS objects FROM lineitem GROUP BY ALL HAVING count(DISTINCT l_suppkey) > 1"
)
def edge_conflicts(spark, sf_dir):
    found = knowledge.conflicting_edges(_relations(spark, sf_dir))
    return found.withColumn("objects", F.array_join(F.col("objects").cast("array<string>"), ","))


def _versions(spark, sf_dir):
    """Orders read as successive states of a customer."""
    return _t(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("subject"), F.col("o_orderpriority").alias("predicate"), F.col("o_orderkey").alias("object"), F.col("o_orderdate").alias("valid_from")
    )


_SUCCESSION = (
    "WITH e AS (SELECT o_custkey AS subject, o_orderpriority AS predicate, o_orderkey AS object, o_orderdate AS valid_from, "
    "lead(o_orderdate) OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate, o_orderkey) AS valid_until FROM orders) "
)


@_q(_SUCCESSION + "SELECT * FROM e")
def edge_succession(spark, sf_dir):
    return knowledge.succession(_versions(spark, sf_dir))


@_q(_SUCCESSION + "SELECT subject, predicate, object FROM e WHERE valid_until IS NULL")
def edge_current(spark, sf_dir):
    return knowledge.current(knowledge.succession(_versions(spark, sf_dir))).select("subject", "predicate", "object")


@_q(_SUCCESSION + "SELECT subject, predicate, object FROM e WHERE valid_from <= TIMESTAMP '1997-06-30' AND (valid_until IS NULL OR TIMESTAMP '1997-06-30' <= valid_until)")
def edge_as_of(spark, sf_dir):
    return knowledge.as_of(knowledge.succession(_versions(spark, sf_dir)), F.lit("1997-06-30").cast("timestamp")).select("subject", "predicate", "object")


@_q(
    "WITH o AS (SELECT o_custkey AS k, o_orderdate AS since, max(o_orderkey) AS last_order FROM orders GROUP BY ALL) "
    "SELECT l.o_orderkey, o.last_order FROM (SELECT o_orderkey, o_custkey, o_orderdate - INTERVAL 30 DAY AS at FROM orders) l ASOF LEFT JOIN o ON l.o_custkey = o.k AND l.at >= o.since"
)
def as_of_join(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    right = o.groupBy(F.col("o_custkey").alias("k"), F.col("o_orderdate").alias("since")).agg(F.max("o_orderkey").alias("last_order"))
    left = o.select("o_orderkey", F.col("o_custkey").alias("k"), F.expr("o_orderdate - INTERVAL 30 DAY").alias("at"))
    return knowledge.as_of_join(left, right, "k", "at", "since").select("o_orderkey", "last_order")


@_q(
    "SELECT o_custkey AS node_id, count(*) AS mention_count, array_to_string(list_sort(list(DISTINCT o_orderpriority)), ',') AS aliases, min(o_orderdate) AS first_seen, max(o_orderdate) AS last_updated FROM orders GROUP BY 1"
)
def node_aggregate(spark, sf_dir):
    mentions = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("node_id"), F.col("o_orderpriority").alias("surface"), F.col("o_orderdate").alias("seen_at"))
    return knowledge.aggregate_nodes(mentions).withColumn("aliases", F.array_join("aliases", ","))


@_q("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10)")
def integrity_dangling(spark, sf_dir):
    target = _t(spark, sf_dir, "part").filter("p_size > 10")
    return knowledge.dangling(_t(spark, sf_dir, "lineitem"), "l_partkey", target, "p_partkey").select("l_orderkey", "l_linenumber", "l_partkey")


@_q("SELECT l_orderkey, l_linenumber FROM lineitem WHERE NOT (l_discount BETWEEN 0.02 AND 0.08) OR NOT (l_tax BETWEEN 0.02 AND 0.08)")
def integrity_ranges(spark, sf_dir):
    return knowledge.out_of_range(_t(spark, sf_dir, "lineitem"), ["l_discount", "l_tax"], 0.02, 0.08).select("l_orderkey", "l_linenumber")


@_q("SELECT l.l_orderkey, l.l_linenumber FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE l.l_shipdate < o.o_orderdate")
def integrity_order(spark, sf_dir):
    lines = _t(spark, sf_dir, "lineitem").withColumnRenamed("l_shipdate", "created_at")
    orders = _t(spark, sf_dir, "orders").withColumnRenamed("o_orderdate", "created_at")
    return knowledge.created_before_referenced(lines, "l_orderkey", orders, "o_orderkey").select("l_orderkey", "l_linenumber")


@_q("SELECT c_custkey AS o_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1 HAVING count(o_orderkey) <> 1")
def integrity_orphans(spark, sf_dir):
    parents = _t(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return knowledge.not_exactly_one_child(parents, _t(spark, sf_dir, "orders"), "o_custkey")


@_q("SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL HAVING count(*) > 1")
def integrity_unique(spark, sf_dir):
    return knowledge.over_one_per_group(_t(spark, sf_dir, "orders"), ["o_custkey", "o_orderpriority"], F.col("o_orderstatus") == "F")


_STANCE = "CASE l_returnflag WHEN 'A' THEN 'supports' WHEN 'R' THEN 'refutes' ELSE 'not_enough_info' END"


def _stances(spark, sf_dir):
    flag = F.col("l_returnflag")
    stance = F.when(flag == "A", "supports").when(flag == "R", "refutes").otherwise("not_enough_info")
    return _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("claim_id"), stance.alias("stance"), "l_tax", "l_linenumber", "l_suppkey")


@_q(
    f"WITH s AS (SELECT l_orderkey AS claim_id, {_STANCE} AS stance FROM lineitem), c AS (SELECT o_orderkey AS claim_id, count(*) FILTER (stance = 'supports') AS supports, "
    "count(*) FILTER (stance = 'refutes') AS refutes, count(*) FILTER (stance = 'not_enough_info') AS not_enough_info, count(stance) AS n_evidence FROM orders LEFT JOIN s ON o_orderkey = claim_id GROUP BY 1) "
    "SELECT *, CASE WHEN supports > 0 AND refutes > 0 THEN 'conflicting' WHEN supports > 0 THEN 'supports' WHEN refutes > 0 THEN 'refutes' ELSE 'not_enough_info' END AS stance, "
    "CASE WHEN n_evidence = 0 THEN 'insufficient_data' ELSE 'sufficient' END AS sufficiency FROM c"
)
def stance_summary(spark, sf_dir):
    claims = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("claim_id"))
    return knowledge.stance_summary(claims, _stances(spark, sf_dir))


@_q(
    f"SELECT l_orderkey AS claim_id, l_suppkey AS assertion, count(*) FILTER (s = 'supports') AS supports, count(*) FILTER (s = 'refutes') AS refutes FROM (SELECT *, {_STANCE} AS s FROM lineitem) "
    "GROUP BY ALL HAVING supports > 0 AND refutes > 0"
)
def contradictions(spark, sf_dir):
    return knowledge.contradictions(_stances(spark, sf_dir).withColumnRenamed("l_suppkey", "assertion"))


@_q("SELECT o_custkey AS doc_id, count(*) AS n_claims, count(*) FILTER (o_orderstatus = 'F') AS \"n_F\", count(*) FILTER (o_orderstatus = 'O') AS \"n_O\", count(*) FILTER (o_orderstatus = 'P') AS \"n_P\" FROM orders GROUP BY 1")
def document_summary(spark, sf_dir):
    rows = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc_id"), F.col("o_orderstatus").alias("decision"))
    return knowledge.document_summary(rows, ["F", "O", "P"])


@_q(
    "SELECT * FROM (SELECT l_orderkey AS claim_id, min(l_linenumber) AS low, max(l_linenumber) AS high, count(*) AS n, count(DISTINCT l_linenumber) AS distinct_n, "
    "max(l_linenumber) FILTER (l_returnflag = 'R') AS last_fusion, min(l_linenumber) FILTER (l_returnflag = 'A') AS first_decision FROM lineitem GROUP BY 1) "
    "WHERE high - low + 1 <> n OR n <> distinct_n OR last_fusion > first_decision"
)
def chain_violations(spark, sf_dir):
    chain = _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("claim_id"), F.col("l_linenumber").alias("sequence_order"), F.when(F.col("l_returnflag") == "R", "fusion").when(F.col("l_returnflag") == "A", "decision").otherwise("step").alias("kind"))
    return knowledge.chain_violations(chain)


@_q(
    "SELECT evidence_id, owner, created_at FROM (SELECT o_custkey AS evidence_id, o_orderkey AS owner, o_orderdate AS created_at, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders WHERE o_orderdate <= TIMESTAMP '1996-12-31') WHERE r = 1"
)
def evidence_version_as_of(spark, sf_dir):
    versions = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("evidence_id"), F.col("o_orderkey").alias("owner"), F.col("o_orderdate").alias("created_at"))
    return knowledge.current_version(versions, until=F.lit("1996-12-31").cast("timestamp"))


@_q(
    "SELECT o_custkey AS target, array_to_string(list_sort(list(DISTINCT o_orderkey)), ',') AS citing FROM orders GROUP BY 1"
)
def cited_by(spark, sf_dir):
    rows = _t(spark, sf_dir, "orders").select("o_orderkey", F.array("o_custkey").alias("refs"))
    return knowledge.who_cites(rows, "refs", "o_orderkey").withColumn("citing", F.array_join(F.col("citing").cast("array<string>"), ","))


_RUNS = (
    "WITH e AS (SELECT user_id AS run_id, event_type AS module, (event_id % 3)::INT AS attempt, CASE WHEN value > 50 THEN 'failed' ELSE 'succeeded' END AS status, event_type = 'click' AS required, value AS seconds, event_id FROM events), "
    "l AS (SELECT run_id, module, arg_max(status, attempt * 100000000 + event_id) AS status, max(attempt) AS attempts, bool_or(required) AS required, sum(seconds) AS seconds FROM e GROUP BY ALL) "
)


@_q(
    _RUNS + "SELECT run_id, round(sum(seconds), 3) AS seconds, sum(attempts - 1)::BIGINT AS retries, CASE WHEN bool_or(status = 'failed' AND required) THEN 'FAILED' WHEN bool_or(status = 'failed') THEN 'PARTIAL_FAILURE' ELSE 'SUCCEEDED' END AS status FROM l GROUP BY 1"
)
def run_rollup(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    runs = e.select(
        F.col("user_id").alias("run_id"),
        F.col("event_type").alias("module"),
        (F.col("event_id") % 3).cast("int").alias("_a"),
        "event_id",
        F.when(F.col("value") > 50, "failed").otherwise("succeeded").alias("status"),
        (F.col("event_type") == "click").alias("required"),
        F.col("value").alias("seconds"),
    )
    # Attempts repeat in this table; the later event of an attempt counts.
    last = runs.groupBy("run_id", "module", F.col("_a").alias("attempt")).agg(F.max_by("status", "event_id").alias("status"), F.bool_or("required").alias("required"), F.sum("seconds").alias("seconds"))
    return knowledge.run_rollup(last).withColumn("seconds", F.round("seconds", 3))


@_q("SELECT event_type, count(*) AS n, count(*) FILTER (value > 50) AS errors, count(*) FILTER (value > 50) / count(*) AS rate FROM events GROUP BY 1")
def error_rate(spark, sf_dir):
    e = _t(spark, sf_dir, "events").withColumn("level", F.when(F.col("value") > 50, "ERROR").otherwise("INFO"))
    return knowledge.error_rate(e, "event_type")


@_q(
    "SELECT user_id AS run_id, event_type AS module, min(ts) AS started, max(ts) FILTER (value > 50) AS completed, round((epoch_us(max(ts) FILTER (value > 50)) - epoch_us(min(ts))) / 1e6::DOUBLE, 3)::DOUBLE AS seconds FROM events GROUP BY ALL"
)
def module_latency(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select(F.col("user_id").alias("run_id"), F.col("event_type").alias("module"), "ts", "value")
    both = e.withColumn("event", F.lit("start")).unionByName(e.filter("value > 50").withColumn("event", F.lit("complete")))
    return knowledge.module_latency(both).withColumn("seconds", F.round("seconds", 3))


@_q("WITH RECURSIVE t(node, hops) AS (SELECT 1::BIGINT, 0 UNION SELECT e.d, t.hops + 1 FROM t JOIN (SELECT DISTINCT r_regionkey + 1 AS s, n_nationkey + 100 AS d FROM region JOIN nation ON r_regionkey = n_regionkey UNION SELECT DISTINCT s_nationkey + 100, s_suppkey + 1000 FROM supplier) e ON e.s = t.node WHERE t.hops < 3) SELECT node, min(hops)::INT AS hops FROM t GROUP BY node")
def graph_traverse(spark, sf_dir):
    n, s = _t(spark, sf_dir, "nation"), _t(spark, sf_dir, "supplier")
    edges = n.select((F.col("n_regionkey") + 1).cast("bigint").alias("subject"), (F.col("n_nationkey") + 100).cast("bigint").alias("object")).unionByName(
        s.select((F.col("s_nationkey") + 100).cast("bigint").alias("subject"), (F.col("s_suppkey") + 1000).cast("bigint").alias("object"))
    )
    return graph.traverse(edges, spark.createDataFrame([(1,)], "node bigint"), 3)


_BM25 = """WITH d AS (SELECT doc_id, coalesce({words}, []) AS t FROM documents), z AS (SELECT count(*) AS docs, greatest(avg(len(t)), 1) AS mean FROM d),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(t) AS n, unnest(t) AS term FROM d) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
p AS (SELECT doc_id, term, ln(1 + (docs - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n / mean)) AS impact FROM tf JOIN df USING (term), z),
q AS (SELECT DISTINCT claim_id, unnest({words}) AS term FROM ({claims})),
s AS (SELECT claim_id, doc_id AS evidence_id, sum(impact) AS score FROM q JOIN p USING (term) GROUP BY ALL),
r AS (SELECT *, (row_number() OVER (PARTITION BY claim_id ORDER BY round(score, 9) DESC, evidence_id))::INT AS rank FROM s)
SELECT claim_id, evidence_id, round(score, 6) AS score, rank FROM r WHERE rank <= {k}"""


def _ranked(spark, sf_dir, claims, k):
    evidence = _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("evidence_id"), "text")
    return knowledge.rank_evidence(claims, evidence, k).withColumn("score", F.round("score", 6))


@_q(_BM25.format(words=_ALPHA.format("text"), claims="SELECT item_id AS claim_id, text FROM benchmark", k=5))
def evidence_ranking(spark, sf_dir):
    """The five passages most like each benchmark item, by BM25."""
    return _ranked(spark, sf_dir, _t(spark, sf_dir, "benchmark").select(F.col("item_id").alias("claim_id"), "text"), 5)


@_q(_BM25.format(words=_ALPHA.format("text"), claims="SELECT conv_id * 1000 + turn AS claim_id, text FROM conversations", k=10))
def evidence_ranking_turns(spark, sf_dir):
    """The ten passages most like each turn of each conversation: many claims of frequent words."""
    turns = _t(spark, sf_dir, "conversations")
    return _ranked(spark, sf_dir, turns.select((F.col("conv_id") * 1000 + F.col("turn")).alias("claim_id"), "text"), 10)


# ---- event windows -------------------------------------------------------------------------


@_q("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 3) AS total FROM events GROUP BY ALL")
def events_tumbling(spark, sf_dir):
    return streams.tumbling(_t(spark, sf_dir, "events")).withColumn("total", F.round("total", 3))


@_q(
    "SELECT time_bucket(INTERVAL 15 MINUTE, ts) - k * INTERVAL 15 MINUTE AS window_start, event_type, count(*) AS n FROM events, range(4) r(k) GROUP BY ALL"
)
def events_sliding(spark, sf_dir):
    return streams.sliding(_t(spark, sf_dir, "events"))


@_q(
    "WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w >= INTERVAL 30 MINUTE OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS first FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), "
    "s AS (SELECT *, sum(first) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g) "
    "SELECT user_id, min(ts) AS session_start, max(ts) AS last_event, count(*) AS n FROM s GROUP BY user_id, k"
)
def events_sessions(spark, sf_dir):
    return streams.sessions(_t(spark, sf_dir, "events"))


@_q('SELECT quality, count(*) AS "count", round(100.0 * count(*) / sum(count(*)) OVER (), 2)::DOUBLE AS pct FROM (SELECT doc_id, quality, row_number() OVER (PARTITION BY ' + _KEY.format(_clean_sql("text")) + " ORDER BY doc_id) AS r FROM documents JOIN labels USING (doc_id)) WHERE r = 1 GROUP BY quality")
def flagship_distribution(spark, sf_dir):
    return flagship(spark, sf_dir).withColumnRenamed("label", "quality")


from . import access_queries, claim_queries, custody_queries, drift_queries, encoding_queries, entity_queries, evidence_queries, history_queries, ingest_queries, language_queries, rule_queries  # noqa: E402, F401  register their queries


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
