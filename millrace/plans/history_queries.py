"""Registered queries of the replayed history, with their SQL: sales are mentions of clients, whose changes merge them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import history
from .catalogue import _q, _t

_RECORDED, _VALID = "2024-04-10", "2024-04-01"
#: A column of each event, by kind: id, mention, node, survivor, target, if a review is asked for, valid and recorded time.
_FROM_CHANGES = {
    "merge": ("'m' || change_id", "NULL", "client_id", "client_id DIV 2", "NULL", "coalesce(balance > 5000, false)", "valid_at", 0, "change_id % 5 = 0"),
    "rollback": ("'r' || change_id", "NULL", "NULL", "NULL", "'m' || change_id", "false", "valid_at", 5, "change_id % 35 = 0"),
    "rollback2": ("'q' || change_id", "NULL", "NULL", "NULL", "'r' || change_id", "false", "valid_at", 10, "change_id % 105 = 0"),
    "review": ("'v' || change_id", "NULL", "NULL", "NULL", "'m' || change_id", "false", "valid_at", 1, "change_id % 10 = 0"),
}
_FROM_SALES = {
    "assign": ("'a' || sale_id", "sale_id", "client_id", "NULL", "NULL", "false", "sold_at", 0, "true"),
    "split": ("'s' || sale_id", "sale_id", "-1 - client_id", "NULL", "NULL", "true", "sold_at + INTERVAL 20 DAYS", 21, "sale_id % 4 = 0"),
    "review": ("'w' || sale_id", "NULL", "NULL", "NULL", "'s' || sale_id", "false", "sold_at", 22, "sale_id % 12 = 0"),
}


def _events(spark, sf_dir) -> DataFrame:
    changes = _t(spark, sf_dir, "client_changes").filter("change_id IS NOT NULL AND client_id IS NOT NULL AND valid_at IS NOT NULL")
    sales = _t(spark, sf_dir, "sales").filter("sale_id IS NOT NULL AND client_id IS NOT NULL AND sold_at IS NOT NULL AND arrived_at IS NOT NULL")
    changes = changes.withColumn("recorded", F.expr("valid_at + make_dt_interval(cast(change_id % 10 AS int))"))
    sales = sales.withColumn("recorded", F.col("arrived_at"))
    parts = []
    for rows, kinds in ((changes, _FROM_CHANGES), (sales, _FROM_SALES)):
        for kind, (event, mention, node, survivor, target, asks, valid, days, when) in kinds.items():
            parts.append(
                rows.filter(when).selectExpr(
                    f"{event} AS event_id", f"'{kind.rstrip('2')}' AS kind", f"cast({mention} AS bigint) AS mention_id", f"cast({node} AS bigint) AS node", f"cast({survivor} AS bigint) AS survivor",
                    f"cast({target} AS string) AS target", f"{asks} AS needs_review", f"{valid} AS valid_at", f"recorded + INTERVAL {days} DAYS AS recorded_at",
                )
            )
    return reduce(DataFrame.unionByName, parts)


def _sql(recorded: str, valid: str) -> str:
    """Standing merges and placements in one order, then each mention is carried from merge to merge."""
    seen = lambda days, table: f"{'r' if table == 'c' else 'arrived_at'} + INTERVAL {days} DAY <= {recorded}"
    return f"""WITH RECURSIVE c AS MATERIALIZED (SELECT DISTINCT change_id AS i, client_id AS n, client_id // 2 AS s, valid_at AS v, valid_at + (change_id % 10)::INT * INTERVAL 1 DAY AS r, coalesce(balance > 5000, false) AS high
      FROM client_changes WHERE change_id % 5 = 0 AND client_id IS NOT NULL AND valid_at IS NOT NULL),
    sa AS (SELECT * FROM sales WHERE sale_id IS NOT NULL AND client_id IS NOT NULL AND sold_at IS NOT NULL AND arrived_at IS NOT NULL),
    undo2 AS (SELECT i FROM c WHERE i % 105 = 0 AND {seen(10, "c")}), undo AS (SELECT i FROM c WHERE i % 35 = 0 AND {seen(5, "c")} AND i NOT IN (FROM undo2)),
    review AS (SELECT i FROM c WHERE i % 10 = 0 AND {seen(1, "c")}),
    standing AS MATERIALIZED (SELECT *, high AND i NOT IN (FROM review) AS held FROM c WHERE {seen(0, "c")} AND i NOT IN (FROM undo)),
    e AS (SELECT v, r, 'm' || i AS id, n, s, NULL AS mention FROM standing WHERE NOT held AND n <> s AND v <= {valid}
      UNION SELECT sold_at, arrived_at, 'a' || sale_id, client_id, NULL, sale_id FROM sa WHERE {seen(0, "s")} AND sold_at <= {valid}
      UNION SELECT sold_at + INTERVAL 20 DAY, arrived_at + INTERVAL 21 DAY, 's' || sale_id, -1 - client_id, NULL, sale_id FROM sa WHERE sale_id % 4 = 0 AND {seen(21, "s")} AND sold_at + INTERVAL 20 DAY <= {valid}
        AND sale_id IN (SELECT sale_id FROM sa WHERE sale_id % 12 = 0 AND {seen(22, "s")})),
    p AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY v, r, id, n, s NULLS FIRST) AS pos FROM e),
    k AS MATERIALIZED (SELECT n, s, pos, coalesce(lag(pos) OVER (PARTITION BY n ORDER BY pos), 0) AS since FROM p WHERE mention IS NULL),
    start AS MATERIALIZED (SELECT mention, arg_max(n, pos) AS named, max(pos) AS pos FROM p WHERE mention IS NOT NULL GROUP BY 1),
    w AS (SELECT mention, named, named AS node, pos FROM start UNION ALL SELECT w.mention, w.named, k.s, k.pos FROM w JOIN k ON k.n = w.node AND k.since <= w.pos AND w.pos < k.pos),
    placed AS (SELECT mention AS mention_id, any_value(named) AS named, arg_max(node, pos) AS node FROM w GROUP BY 1) """


@_q(_sql(f"TIMESTAMP '{_RECORDED}'", f"TIMESTAMP '{_VALID}'") + "SELECT mention_id, named, node FROM placed")
def history_as_of(spark, sf_dir):
    """Each mention's node on one day, as it was known on another."""
    at = lambda day: F.lit(day).cast("timestamp_ntz")
    return history.replay(_events(spark, sf_dir), at(_RECORDED), at(_VALID))


_NOW = "TIMESTAMP '9999-01-01'"


@_q(_sql(_NOW, _NOW) + "SELECT node, count(*) AS mention_count, count(DISTINCT named) AS n_named FROM placed GROUP BY 1")
def history_nodes(spark, sf_dir):
    """The nodes after all events so far."""
    return history.nodes(history.replay(_events(spark, sf_dir)))


@_q(
    _sql(_NOW, _NOW) + "SELECT 'm' || i AS event_id, 'merge' AS kind, n AS node, s AS survivor, NULL::BIGINT AS mention_id FROM standing WHERE held "
    "UNION ALL SELECT DISTINCT 's' || sale_id, 'split', -1 - client_id, NULL, sale_id FROM sa WHERE sale_id % 4 = 0 AND sale_id % 12 <> 0"
)
def history_waiting(spark, sf_dir):
    """High-stakes merges and splits that no review has let through."""
    return history.waiting(_events(spark, sf_dir))
