"""Chain of custody: hash-linked events of an item, sealed in order and verified by one window.

An event is ``item_id, seq, actor, action, digest`` (what was done, by whom, and the content's digest
after it).  Its hash covers the hash before it, so no event can be altered, moved, added or
taken out without breaking the chain from there on; what is cut off at the end shows only
against a known last hash (``heads``).

Scale: verification is one window per item over narrow rows, with no order between items.  Sealing folds an
item's events one after another, so it holds the events of one item at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

FIELDS = ("seq", "actor", "action", "digest")


def link(item: Column, before: Column, *fields: Column) -> Column:
    """The hash of an event; null fields differ from empty ones."""
    return F.sha2(F.concat_ws("|", before, item.cast("string"), *[F.coalesce(F.concat(F.lit("="), f.cast("string")), F.lit("-")) for f in fields]), 256)


def seal(events: DataFrame) -> DataFrame:
    """The events with ``before`` and ``hash``, chained in the order of ``seq`` within their item."""
    item = F.col("item_id")
    listed = events.groupBy("item_id").agg(F.array_sort(F.collect_list(F.struct(*FIELDS))).alias("events"))

    def fold(hashes: Column, e: Column) -> Column:
        return F.concat(hashes, F.array(link(item, F.element_at(hashes, -1), *[e[f] for f in FIELDS])))

    chained = listed.withColumn("hashes", F.aggregate("events", F.array(F.lit("")), fold))
    rows = chained.select("item_id", F.posexplode("events").alias("at", "e"), "hashes")
    return rows.select("item_id", "e.*", F.get("hashes", F.col("at")).alias("before"), F.get("hashes", F.col("at") + 1).alias("hash"))


def breaks(chain: DataFrame, heads: DataFrame | None = None) -> DataFrame:
    """``item_id, seq, reason``: the first break of each item that has one.

    ``gap``: a number is missing or comes twice, or the first is not 1.  ``link``: the event does not follow the one before
    it.  ``content``: the event is not what was sealed.  ``end``: the chain does not end at the hash in
    ``heads`` (``item_id, head``), reported one after its last event, or at 1 if none is left.
    """
    order = W.partitionBy("item_id").orderBy("seq", "hash")
    tests = (
        F.when(F.col("seq") != F.coalesce(F.lag("seq").over(order), F.lit(0)) + 1, "gap")
        .when(~F.col("before").eqNullSafe(F.coalesce(F.lag("hash").over(order), F.lit(""))), "link")
        .when(~F.col("hash").eqNullSafe(link(F.col("item_id"), F.col("before"), *[F.col(f) for f in FIELDS])), "content")
    )
    found = chain.select("item_id", "seq", tests.alias("reason")).filter("reason IS NOT NULL")
    if heads is not None:
        last = chain.groupBy("item_id").agg(F.max("seq").alias("last"), F.max_by("hash", F.struct("seq", "hash")).alias("hash"))
        ends = heads.join(last, "item_id", "left").filter(~F.col("hash").eqNullSafe(F.col("head")))
        found = found.unionByName(ends.select("item_id", (F.coalesce("last", F.lit(0)) + 1).cast(chain.schema["seq"].dataType).alias("seq"), F.lit("end").alias("reason")))
    return found.groupBy("item_id").agg(F.min(F.struct("seq", "reason")).alias("b")).select("item_id", "b.seq", "b.reason")
