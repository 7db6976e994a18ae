"""Registered queries of provenance paths and abbreviated names, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import abbreviations, provenance
from .catalogue import _q, _t

_LINE = "l_orderkey || '-' || l_linenumber"
_ENTITY = "l_partkey || '-' || l_suppkey"


@_q(
    f"""SELECT c_custkey::VARCHAR AS fact_id, 'graph' AS branch, 'fact:' || c_custkey || coalesce(' > edge:' || o_orderkey, '') || coalesce(' > relation:' || line, '') || coalesce(' > entity:' || entity, '')
      || coalesce(' > claim:' || s_suppkey, '') || coalesce(' > article:' || s_nationkey, '') AS path,
      CASE WHEN o_orderkey IS NULL THEN 'edge' WHEN line IS NULL THEN 'relation' WHEN entity IS NULL THEN 'entity' WHEN s_suppkey IS NULL THEN 'claim' WHEN s_nationkey IS NULL THEN 'article' END AS missing
    FROM customer LEFT JOIN (SELECT DISTINCT o_custkey, o_orderkey FROM orders) ON o_custkey = c_custkey
    LEFT JOIN (SELECT DISTINCT l_orderkey, {_LINE} AS line, {_ENTITY} AS entity, l_suppkey FROM lineitem) ON l_orderkey = o_orderkey
    LEFT JOIN (SELECT DISTINCT s_suppkey, s_nationkey FROM supplier WHERE s_suppkey % 10 <> 3) ON s_suppkey = l_suppkey
    UNION ALL SELECT c_custkey::VARCHAR, 'evidence', 'fact:' || c_custkey || coalesce(' > evidence:' || event_id, '') || coalesce(' > article:' || event_type, ''),
      CASE WHEN event_id IS NULL THEN 'evidence' WHEN event_type IS NULL THEN 'article' END
    FROM customer LEFT JOIN (SELECT DISTINCT user_id, event_id, event_type FROM events) ON user_id = c_custkey"""
)
def provenance_paths(spark, sf_dir):
    """Every path behind each fact, over the graph and over the evidence; some claims are not there."""
    line, events = _t(spark, sf_dir, "lineitem"), _t(spark, sf_dir, "events")
    item, entity = F.expr(_LINE), F.expr(_ENTITY)
    supplier = _t(spark, sf_dir, "supplier").filter("s_suppkey % 10 != 3")
    named = line.join(supplier.select(F.col("s_suppkey").alias("l_suppkey")), "l_suppkey")
    graph = [
        _t(spark, sf_dir, "orders").select("o_custkey", "o_orderkey"),
        line.select("l_orderkey", item.alias("line")),
        line.select(item.alias("line"), entity.alias("entity")),
        named.select(entity.alias("entity"), "l_suppkey"),
        supplier.select("s_suppkey", "s_nationkey"),
    ]
    evidence = [events.select("user_id", "event_id"), events.select("event_id", "event_type")]
    paths = provenance.fact_provenance(_t(spark, sf_dir, "customer").select("c_custkey"), graph, evidence)
    return paths.withColumn("path", provenance.shown(F.col("path")))


_NAME_WORDS = r"list_filter(list_transform(string_split_regex(lower({0}), '[\s-]+'), lambda t: regexp_replace(t, '[.,]', '', 'g')), lambda t: t <> '')"
_INITIALS = "list_aggregate(list_transform({0}, lambda w: w[1]), 'string_agg', '')"
_SMALL = ", ".join(f"'{w}'" for w in abbreviations.SMALL)
#: A vendor's name as a sale line may give it: initials, first initial, beginnings of words, or whole.
_SURFACE = (
    "CASE ({id}) % 4 WHEN 0 THEN concat(substr({first}, 1, 1), '.', substr({rest}, 1, 1), '.') WHEN 1 THEN concat(substr({first}, 1, 1), '. ', {rest}) "
    "WHEN 2 THEN concat(substr({first}, 1, 4), '. ', substr({rest}, 1, 5), '.') ELSE name END"
)


@_q(
    f"""WITH v AS (SELECT *, {_NAME_WORDS.format("name")} AS aw FROM vendors WHERE name IS NOT NULL), m AS (SELECT DISTINCT sale_id * 1000 + line_no AS mention_id, nation_id,
      {_SURFACE.format(id="sale_id + line_no", first="split_part(name, ' ', 1)", rest="split_part(name, ' ', 2)")} AS surface FROM sale_lines JOIN vendors USING (vendor_id) WHERE sale_id IS NOT NULL AND line_no IS NOT NULL),
    t AS (SELECT *, {_NAME_WORDS.format("surface")} AS mw FROM m WHERE surface IS NOT NULL)
    SELECT DISTINCT mention_id, vendor_id AS node_id, CASE WHEN len(mw) = 1 THEN 'acronym' ELSE 'abbreviation' END AS how FROM t JOIN v USING (nation_id)
    WHERE len(aw) > 1 AND CASE WHEN len(mw) = 1 THEN length(mw[1]) > 1 AND (mw[1] = {_INITIALS.format("aw")} OR mw[1] = {_INITIALS.format(f"list_filter(aw, lambda w: w NOT IN ({_SMALL}))")})
      ELSE len(mw) = len(aw) AND mw <> aw AND len(list_filter(range(1, len(mw) + 1), lambda i: starts_with(aw[i], mw[i]))) = len(mw) END"""
)
def entity_abbreviations(spark, sf_dir):
    """Vendors that a sale line's abbreviated name can mean, within a nation."""
    vendors = _t(spark, sf_dir, "vendors")
    lines = _t(spark, sf_dir, "sale_lines").filter("sale_id IS NOT NULL AND line_no IS NOT NULL").join(vendors, "vendor_id")
    surface = _SURFACE.format(id="sale_id + line_no", first="split_part(name, ' ', 1)", rest="split_part(name, ' ', 2)")
    mentions = lines.select(F.expr("sale_id * 1000 + line_no").alias("mention_id"), F.col("nation_id").alias("type"), F.expr(surface).alias("surface"))
    return abbreviations.matches(mentions, vendors.select(F.col("vendor_id").alias("node_id"), F.col("nation_id").alias("type"), "name"))
