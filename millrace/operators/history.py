"""Nodes and mentions with valid and recorded time: an append-only table of events that is replayed.

An event has ``event_id, kind, mention_id, node, survivor, target, needs_review, valid_at, recorded_at``:

* ``assign``: the mention belongs to ``node``;
* ``split``: a mention is moved out of its node, to ``node``; ``merge``: all that ``node`` holds then goes to ``survivor``;
* ``review``: lets the split or merge ``target`` take effect;
* ``rollback``: takes the earlier recorded event ``target`` back, a rollback too.

Nothing is changed or deleted: a correction is one more event, so the state of any recorded and
valid time can be read.  Splits, and merges that ``needs_review`` marks, wait for a review.

Defined cases: changes take effect in the order of ``valid_at``, ``recorded_at``, ``event_id``, node and survivor,
nulls first; an event without ``valid_at`` holds from the beginning; one without ``recorded_at`` counts as
recorded first; repeated rows are one event; changes without a node (merges: two different nodes) do
nothing; a rollback of an unknown, same or later recorded event does nothing; a node that was merged away
and is named again is a node again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..storage import Table

#: The columns of an event.
COLUMNS = ("event_id", "kind", "mention_id", "node", "survivor", "target", "needs_review", "valid_at", "recorded_at")


def _recorded(events: DataFrame, until: Column | None) -> DataFrame:
    rows = events.select(*COLUMNS).distinct()
    return rows if until is None else rows.filter(F.coalesce(F.col("recorded_at") <= until, F.lit(True)))


def _rolled_back(rows: DataFrame) -> DataFrame:
    """``event_id`` of what rollbacks take back.  Those that nobody takes back act first; a round settles one step
    of each chain of rollbacks, over the rollbacks alone."""
    at = F.struct("recorded_at", "event_id")
    acts = rows.filter("kind = 'rollback'").select(F.col("event_id").alias("by"), at.alias("later"), F.col("target").alias("undone"))
    known = rows.select(F.col("event_id").alias("undone"), at.alias("earlier"))
    open_ = Table(acts.join(known, "undone").filter("later > earlier").select("by", "undone").distinct(), "rollbacks")
    out = rows.sparkSession.createDataFrame([], rows.select("event_id").schema)
    while not open_.df.isEmpty():
        acting = open_.df.join(open_.df.select(F.col("undone").alias("by")).distinct(), "by", "left_anti")
        fallen = acting.select("undone").distinct()
        # What has fallen needs no further rollback and takes nothing back itself.
        rest = Table(open_.df.join(fallen, "undone", "left_anti").join(fallen.withColumnRenamed("undone", "by"), "by", "left_anti"), "rollbacks")
        fallen = Table(fallen.withColumnRenamed("undone", "event_id"), "fallen")
        out = out.unionByName(fallen.df)
        open_.drop()
        open_ = rest
    open_.drop()
    return out


def _standing(events: DataFrame, recorded: Column | None) -> DataFrame:
    """The recorded events that no rollback takes back, with ``_held`` where a review is missing."""
    rows = _recorded(events, recorded)
    rows = rows.join(_rolled_back(rows), "event_id", "left_anti")
    reviewed = rows.filter("kind = 'review'").select(F.col("target").alias("event_id")).distinct().withColumn("_reviewed", F.lit(True))
    asks = (F.col("kind") == "split") | (F.col("kind") == "merge") & F.coalesce("needs_review", F.lit(False))
    return rows.join(reviewed, "event_id", "left").withColumn("_held", asks & F.col("_reviewed").isNull())


def waiting(events: DataFrame, recorded: Column | None = None) -> DataFrame:
    """``event_id, kind, node, survivor, mention_id``: splits and merges that wait for a review."""
    return _standing(events, recorded).filter("_held").select("event_id", "kind", "node", "survivor", "mention_id")


def _first_after(rows: DataFrame, merges: DataFrame, node: str, at: str) -> DataFrame:
    """``rows`` with ``hit``: when the first merge of ``node`` after ``at`` took place, null if none did.

    Rows and merges are dealt by ranges of (node, time), so a node with any share of them is spread over tasks; what
    follows a node's part is carried over from its next parts, of which there are few.
    """
    none = F.lit(None).cast(merges.schema["at"].dataType)
    left = rows.select(F.col(node).alias("_node"), F.col(at).alias("_at"), none.alias("_merge"), F.struct(*rows.columns).alias("_row"))
    right = merges.select(F.col("node").alias("_node"), F.col("at").alias("_at"), F.col("at").alias("_merge"), F.lit(None).cast(left.schema["_row"].dataType).alias("_row"))
    dealt = Table(left.unionByName(right).repartitionByRange("_node", "_at").withColumn("_part", F.spark_partition_id()), "dealt").df
    # From the last moment to the first: at the same moment the row comes before the merge, which is not after it.
    back = W.partitionBy("_part", "_node").orderBy(F.col("_at").desc(), F.col("_merge").isNotNull()).rowsBetween(W.unboundedPreceding, 0)
    found = dealt.withColumn("_hit", F.last("_merge", ignorenulls=True).over(back)).filter("_row IS NOT NULL")
    parts = dealt.groupBy("_part", "_node").agg(F.min("_merge").alias("_first"))
    later = W.partitionBy("_node").orderBy(F.col("_part").desc()).rowsBetween(W.unboundedPreceding, -1)
    carried = parts.select("_part", "_node", F.last("_first", ignorenulls=True).over(later).alias("_carried")).filter("_carried IS NOT NULL")
    return found.join(carried, ["_part", "_node"], "left").select("_row.*", F.coalesce("_hit", "_carried").alias("hit"))


def _ends(merges: DataFrame) -> DataFrame:
    """``at, final``: where what a merge moves ends up.  Each leads to the first later merge of its survivor; ends are
    found by doubling the steps, so rounds grow with the logarithm of the longest chain."""
    ends = Table(_first_after(merges.select("survivor", "at"), merges, "survivor", "at").select("at", F.col("survivor").alias("final"), F.col("hit").alias("next")), "ends")
    while not ends.df.filter("next IS NOT NULL").isEmpty():
        ahead = ends.df.select(F.col("at").alias("next"), F.col("final").alias("further"), F.col("next").alias("beyond"))
        moved = Table(ends.df.join(ahead, "next", "left").select("at", F.coalesce("further", "final").alias("final"), F.col("beyond").alias("next")), "ends")
        ends.drop()
        ends = moved
    return ends.df.select("at", "final")


def replay(events: DataFrame, recorded: Column | None = None, valid: Column | None = None) -> DataFrame:
    """``mention_id, named, node``: where each mention was put last, and the node that merges have made of that since.

    As known at ``recorded``, for the moment ``valid``; null for all.  Mentions are combined before they
    move, and each meets only the first merge after it.
    """
    rows = _standing(events, recorded).filter("NOT _held AND node IS NOT NULL")
    if valid is not None:
        rows = rows.filter(F.coalesce(F.col("valid_at") <= valid, F.lit(True)))
    rows = rows.withColumn("at", F.struct("valid_at", "recorded_at", "event_id", "node", "survivor"))
    merges = rows.filter("kind = 'merge' AND node != survivor").select("node", "survivor", "at")
    put = rows.filter("kind IN ('assign', 'split') AND mention_id IS NOT NULL").groupBy("mention_id").agg(F.max("at").alias("put"))
    merges = Table(merges, "merges").df
    placed = _first_after(put.select("mention_id", F.col("put.node").alias("named"), "put"), merges, "named", "put")
    ends = _ends(merges).withColumnRenamed("at", "hit")
    return placed.join(ends, "hit", "left").select("mention_id", "named", F.coalesce("final", "named").alias("node"))


def nodes(placed: DataFrame) -> DataFrame:
    """``node, mention_count, n_named``: mentions of each node, and how many nodes they were put in."""
    by_name = placed.groupBy("node", "named").agg(F.count(F.lit(1)).alias("n"))
    return by_name.groupBy("node").agg(F.sum("n").alias("mention_count"), F.count(F.lit(1)).alias("n_named"))
