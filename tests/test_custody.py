"""Planted breaks of custody chains are found where they are."""

from pyspark.sql import functions as F

from millrace.operators import custody as C

SCHEMA = "item_id int, seq int, actor string, action string, digest string"


def test_planted_breaks(spark):
    events = [(i, s, "a", None if s == 2 else "crop", f"d{s}") for i in range(1, 9) for s in range(1, 5)]
    chain = C.seal(spark.createDataFrame(events, SCHEMA))
    heads = chain.groupBy("item_id").agg(F.max_by("hash", "seq").alias("head"))
    assert C.breaks(chain, heads).count() == 0
    at = lambda i, s: (F.col("item_id") == i) & (F.col("seq") == s)
    bad = chain.filter(~at(2, 2) & ~at(3, 4) & ~at(6, 1) & (F.col("item_id") != 8))
    bad = bad.withColumn("action", F.when(at(1, 2), "").otherwise(F.col("action")))
    bad = bad.withColumn("seq", F.when(at(4, 2), 3).when(at(4, 3), 2).otherwise(F.col("seq")))
    forged = C.seal(spark.createDataFrame([(5, 1, "b", "swap", "d9"), (5, 2, "b", "swap", "d9")], SCHEMA)).filter("seq = 2")
    bad = bad.filter(~at(5, 2)).unionByName(forged)
    got = {r["item_id"]: (r["seq"], r["reason"]) for r in C.breaks(bad, heads).collect()}
    assert got == {1: (2, "content"), 2: (3, "gap"), 3: (4, "end"), 4: (2, "link"), 5: (2, "link"), 6: (2, "gap"), 8: (1, "end")}


def test_repeated_and_empty(spark):
    chain = C.seal(spark.createDataFrame([(1, 1, "a", "x", "d")], SCHEMA))
    assert C.breaks(chain.union(chain)).collect()[0]["reason"] == "gap"
    assert C.breaks(C.seal(spark.createDataFrame([], SCHEMA))).count() == 0
