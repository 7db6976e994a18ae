"""The registered query of custody chains, with its SQL: an order's line items are its events, and some are tampered with."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import custody
from .catalogue import _q, _t

_LINK = "sha256(concat_ws('|', {before}, {item}, '=' || {seq}, '=' || {actor}, '=' || {action}, '=' || {digest}))"
_HASH = lambda p, before: _LINK.format(before=before, item=f"{p}item_id", seq=f"{p}seq", actor=f"{p}actor", action=f"{p}action", digest=f"{p}digest")


@_q(
    f"""WITH RECURSIVE ev AS MATERIALIZED (SELECT l_orderkey AS item_id, (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey))::INT AS seq, l_suppkey AS actor, l_returnflag AS action,
      md5(l_partkey::VARCHAR) AS digest FROM lineitem),
    c AS (SELECT *, '' AS before, {_HASH('', "''")} AS hash FROM ev WHERE seq = 1
      UNION ALL SELECT e.*, c.hash, {_HASH('e.', 'c.hash')} FROM ev e JOIN c ON c.item_id = e.item_id AND e.seq = c.seq + 1),
    t AS (SELECT item_id, CASE WHEN item_id % 50 = 13 AND seq <= 2 THEN 3 - seq ELSE seq END AS seq, actor, CASE WHEN item_id % 50 = 7 AND seq = 2 THEN 'X' ELSE action END AS action, digest, before, hash
      FROM c WHERE NOT (item_id % 50 = 11 AND seq = 2)),
    w AS (SELECT *, coalesce(lag(seq) OVER o, 0) AS last, coalesce(lag(hash) OVER o, '') AS previous FROM t WINDOW o AS (PARTITION BY item_id ORDER BY seq, hash)),
    b AS (SELECT item_id, seq, CASE WHEN seq <> last + 1 THEN 'gap' WHEN before <> previous THEN 'link' WHEN hash <> {_HASH('', 'before')} THEN 'content' END AS reason FROM w)
    SELECT item_id, min(seq)::INT AS seq, arg_min(reason, seq) AS reason FROM b WHERE reason IS NOT NULL GROUP BY item_id"""
)
def custody_breaks(spark, sf_dir):
    """Where chains break after events were altered, taken out or put in another order."""
    by = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey")
    events = _t(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("item_id"), F.row_number().over(by).alias("seq"), F.col("l_suppkey").alias("actor"), F.col("l_returnflag").alias("action"), F.md5(F.col("l_partkey").cast("string")).alias("digest")
    )
    chain = custody.seal(events)
    kind = F.col("item_id") % 50
    chain = chain.filter(~((kind == 11) & (F.col("seq") == 2)))
    chain = chain.withColumn("action", F.when((kind == 7) & (F.col("seq") == 2), "X").otherwise(F.col("action")))
    return custody.breaks(chain.withColumn("seq", F.when((kind == 13) & (F.col("seq") <= 2), 3 - F.col("seq")).otherwise(F.col("seq"))))
