"""Registered queries of evidence classes, with recursive SQL.

Documents stand in for evidence: their source is the outlet, an address has some hundred captures, and
arithmetic on ids adds links of the kinds that content cannot show.  Whole tables are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators import evidence as E
from ..operators import graph
from .catalogue import _q, _t


def _evidence(spark, sf_dir):
    d = _t(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("evidence_id"), F.col("text").alias("content"), F.col("source").alias("outlet"), (F.col("doc_id") % 300).alias("url"), F.col("doc_id").alias("captured_at"))


def _links(spark, sf_dir):
    ids = _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("a"))
    kinds = [("translation_of", 50, 3, False), ("archived_copy_of", 70, 7, False), ("near_copy", 90, 9, True), ("retraction_of", 110, 11, True)]
    more = [ids.filter(F.col("a") % each == step).select("a", (F.col("a") - step).alias("b"), F.lit(k).alias("kind"), F.lit(c).alias("changed")) for k, each, step, c in kinds]
    return reduce(lambda x, y: x.unionByName(y), more, E.derive_links(_evidence(spark, sf_dir)))


def _components(name: str, nodes: str, links: str) -> str:
    """SQL of ``name(id, root)``: labels are lowered along both directions of ``links`` (x, y) until none changes."""
    return f"""{name}(id, root) USING KEY (id) AS (SELECT id, id FROM ({nodes}) UNION (
      SELECT DISTINCT ON (u.id) u.id, v.root FROM recurring.{name} u, {name} v, ({links}) e
      WHERE e.x = u.id AND e.y = v.id AND v.root < u.root ORDER BY u.id, v.root))"""


_BOTH = "SELECT a AS x, b AS y FROM l WHERE {0} UNION SELECT b, a FROM l WHERE {0}"
_MERGED = "kind IN ('exact_copy', 'near_copy') AND NOT changed"
_LINKED = "kind NOT IN ('updated_version_of', 'retraction_of') AND NOT changed"

_CLASSES = f"""WITH RECURSIVE ev AS MATERIALIZED (
  SELECT doc_id AS id, source AS outlet, doc_id % 300 AS url, sha256(text) AS exact, sha256(coalesce(nullif(regexp_replace(lower(text), '[^a-z0-9]+', '', 'g'), ''), text)) AS near
  FROM documents WHERE text IS NOT NULL
), g AS (SELECT near, min(id) AS id FROM ev GROUP BY near
), s AS (SELECT id AS a, lag(id) OVER w AS b, near, lag(near) OVER w AS before FROM ev WINDOW w AS (PARTITION BY url ORDER BY id)
), l AS MATERIALIZED (
  SELECT e.id AS a, f.id AS b, CASE WHEN e.outlet <> f.outlet THEN 'syndicated_copy_of' WHEN e.outlet = f.outlet AND e.url <> f.url THEN 'mirrored_at'
         WHEN e.exact = f.exact THEN 'exact_copy' ELSE 'near_copy' END AS kind, false AS changed
  FROM ev e JOIN g ON g.near = e.near AND g.id <> e.id JOIN ev f ON f.id = g.id
  UNION ALL SELECT a, b, 'updated_version_of', true FROM s WHERE near <> before
  UNION ALL SELECT doc_id, doc_id - 3, 'translation_of', false FROM documents WHERE doc_id % 50 = 3
  UNION ALL SELECT doc_id, doc_id - 7, 'archived_copy_of', false FROM documents WHERE doc_id % 70 = 7
  UNION ALL SELECT doc_id, doc_id - 9, 'near_copy', true FROM documents WHERE doc_id % 90 = 9
  UNION ALL SELECT doc_id, doc_id - 11, 'retraction_of', true FROM documents WHERE doc_id % 110 = 11
), {_components('m', 'SELECT doc_id AS id FROM documents', _BOTH.format(_MERGED))}, {_components('d', 'SELECT doc_id AS id FROM documents', _BOTH.format(_LINKED))},
own AS (SELECT a, min(CASE WHEN changed OR kind IN ('updated_version_of', 'retraction_of') THEN 6 ELSE list_position(['translation_of', 'archived_copy_of', 'mirrored_at', 'syndicated_copy_of', 'near_copy', 'exact_copy'], kind) - 1 END) AS place FROM l GROUP BY a
), o AS (SELECT root, coalesce(min(id) FILTER (WHERE id NOT IN (SELECT a FROM l WHERE {_LINKED})), min(id)) AS origin FROM d GROUP BY root
), items AS (
  SELECT m.id AS evidence_id, CASE WHEN place IS NULL THEN 'original' WHEN place = 6 THEN 'version' ELSE ['translation_of', 'archived_copy_of', 'mirrored_at', 'syndicated_copy_of', 'near_copy', 'exact_copy'][place + 1] END AS class,
         m.root AS collection, d.root, o.origin, m.id IN (SELECT b FROM l WHERE kind = 'retraction_of') AS retracted
  FROM m JOIN d ON d.id = m.id JOIN o ON o.root = d.root LEFT JOIN own ON own.a = m.id)"""


@_q(f"{_CLASSES} SELECT * FROM items")
def evidence_classes(spark, sf_dir):
    """Class, collection, root and origin of every document."""
    return E.classes(_evidence(spark, sf_dir), _links(spark, sf_dir))


@_q(f"{_CLASSES} SELECT * FROM items")
def evidence_classes_arriving(spark, sf_dir):
    """The same when the links come in three parts, each added to the components so far."""
    links = _links(spark, sf_dir)
    part = F.pmod(F.xxhash64("a", "b"), F.lit(3))
    known = E.components(links.filter(part == 0))
    for i in (1, 2):
        known = E.extend(known, links.filter(part == i))
    return E.classes(_evidence(spark, sf_dir), links, known)


@_q(
    f"""{_CLASSES} SELECT doc_id % 200 AS claim_id, CASE WHEN lang = 'en' THEN 'supports' ELSE 'refutes' END AS stance, count(DISTINCT doc_id) AS n_items, count(DISTINCT root) AS n_independent
    FROM documents JOIN items ON evidence_id = doc_id AND NOT retracted GROUP BY ALL"""
)
def independent_support(spark, sf_dir):
    """Items and independent sources behind each claim and stance."""
    d = _t(spark, sf_dir, "documents")
    stances = d.select((F.col("doc_id") % 200).alias("claim_id"), F.when(F.col("lang") == "en", "supports").otherwise("refutes").alias("stance"), F.col("doc_id").alias("evidence_id"))
    return E.independent_support(stances, E.classes(_evidence(spark, sf_dir), _links(spark, sf_dir)))


@_q(
    f"""WITH RECURSIVE v AS MATERIALIZED (SELECT o_orderkey AS a, lag(o_orderkey) OVER w AS b FROM orders WINDOW w AS (PARTITION BY o_custkey, date_trunc('year', o_orderdate) ORDER BY o_orderkey)),
    {_components('c', 'SELECT a AS id FROM v WHERE b IS NOT NULL UNION SELECT b FROM v WHERE b IS NOT NULL', 'SELECT a AS x, b AS y FROM v WHERE b IS NOT NULL UNION SELECT b, a FROM v WHERE b IS NOT NULL')}
    SELECT id AS evidence_id, root AS chain, (row_number() OVER (PARTITION BY root ORDER BY id))::INT AS version FROM c"""
)
def evidence_version_chains(spark, sf_dir):
    """A customer's orders of one year as versions of one item."""
    from pyspark.sql import Window as W

    before = F.lag("o_orderkey").over(W.partitionBy("o_custkey", F.trunc("o_orderdate", "year")).orderBy("o_orderkey"))
    links = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("a"), before.alias("b"), F.lit("updated_version_of").alias("kind"), F.lit(True).alias("changed"))
    return E.versions(links.filter("b IS NOT NULL"))


_PARTS = """WITH RECURSIVE e AS MATERIALIZED (
  SELECT DISTINCT m.a, l.l_partkey AS b FROM lineitem l JOIN (SELECT l_orderkey, l_discount, min(l_partkey) AS a FROM lineitem GROUP BY 1, 2) m
  ON m.l_orderkey = l.l_orderkey AND m.l_discount = l.l_discount AND m.a <> l.l_partkey), """ + _components("c", "SELECT a AS id FROM e UNION SELECT b FROM e", "SELECT a AS x, b AS y FROM e UNION SELECT b, a FROM e") + " SELECT id AS node, root FROM c"


def _part_links(spark, sf_dir):
    lines = _t(spark, sf_dir, "lineitem")
    a = lines.groupBy("l_orderkey", "l_discount").agg(F.min("l_partkey").alias("a"))
    return lines.join(a, ["l_orderkey", "l_discount"]).filter("l_partkey != a").select("a", F.col("l_partkey").alias("b"))


@_q(_PARTS)
def graph_components(spark, sf_dir):
    """Parts connected by being in one order with the same discount."""
    return graph.connected_components(_part_links(spark, sf_dir), "a", "b")


@_q(_PARTS)
def graph_components_arriving(spark, sf_dir):
    """The same, when half of the links come later."""
    links = _part_links(spark, sf_dir)
    first = F.pmod(F.xxhash64("a", "b"), F.lit(2)) == 0
    return graph.extend_components(graph.connected_components(links.filter(first), "a", "b"), links.filter(~first))
