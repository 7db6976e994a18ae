"""Graph steps as joins: components and traversal, iterated over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import Table


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root``: the smallest node each node is connected to.

    Labels are lowered over the edges and then along themselves (pointer jumping), so
    the number of rounds grows with the logarithm of the longest path.
    """
    ends = edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    both = Table(ends.select(F.col(a).alias("u"), F.col(b).alias("v")).union(ends.select(F.col(b).alias("u"), F.col(a).alias("v"))).distinct(), "edges")
    labels = Table(both.df.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("root")).withColumnRenamed("u", "node"), "labels")
    while True:
        near = both.df.join(labels.df, F.col("v") == F.col("node")).groupBy("u").agg(F.min("root").alias("near"))
        low = labels.df.join(near, F.col("node") == F.col("u"), "left").select("node", "root", F.least("root", "near").alias("low"))
        up = low.select(F.col("node").alias("at"), F.col("low").alias("higher"))
        joined = low.join(up, F.col("low") == F.col("at"), "left").select("node", F.least("low", "higher").alias("root"), (F.least("low", "higher") < F.col("root")).alias("lowered"))
        after = Table(joined, "labels")
        changed = not after.df.filter("lowered").isEmpty()
        labels.drop()
        labels = after
        if not changed:
            both.drop()
            return labels.df.drop("lowered")


def extend_components(labels: DataFrame, links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` after new links, from the components so far: the old links are not looked at again.

    New links are carried over to the roots of their ends, the components of these few roots are found,
    and only rows of a root that is lowered change.  Nodes that only the new links name are added.
    The links may come in any order and more than once; the result is that of all links together.
    """
    links = links.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("a"), F.col(b).alias("b")).distinct()
    known = lambda end: labels.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}"))
    placed = links.join(known("a"), "a", "left").join(known("b"), "b", "left").select("a", "b", F.coalesce("root_a", "a").alias("x"), F.coalesce("root_b", "b").alias("y"))
    placed = Table(placed, "placed")
    moved = connected_components(placed.df.filter("x != y"), "x", "y").withColumnRenamed("node", "old").withColumnRenamed("root", "new")
    fresh = placed.df.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(labels.select("node"), "node", "left_anti").select("node", F.col("node").alias("root"))
    every = labels.select("node", "root").unionByName(fresh)
    out = Table(every.join(moved, F.col("root") == F.col("old"), "left").select("node", F.coalesce("new", "root").alias("root")), "labels")
    placed.drop()
    return out.df


def traverse(edges: DataFrame, start: DataFrame, depth: int, any_direction: bool = False, src: str = "subject", dst: str = "object") -> DataFrame:
    """``node, hops``: nodes within ``depth`` edges of the start nodes (column ``node``), each at its shortest distance."""
    steps = edges.select(F.col(src).alias("s"), F.col(dst).alias("d"))
    if any_direction:
        steps = steps.union(steps.select("d", "s"))
    steps = steps.distinct()
    seen = start.select("node").distinct().withColumn("hops", F.lit(0))
    front = seen
    for hop in range(1, depth + 1):
        reached = front.join(steps, F.col("node") == F.col("s")).select(F.col("d").alias("node")).distinct()
        front = Table(reached.join(seen, "node", "left_anti").withColumn("hops", F.lit(hop)), "front").df
        if front.isEmpty():
            break
        seen = Table(seen.unionByName(front), "seen").df
    return seen


def _forest_depths(steps: DataFrame) -> DataFrame:
    """``depths`` of steps (``c, p``) with one parent each: the node that each looks at and the way to it, null where it looks past the first."""
    firsts = steps.select(F.col("p").alias("node")).distinct().join(steps.select(F.col("c").alias("node")), "node", "left_anti")
    below = steps.select(F.col("c").alias("node"), F.col("p").alias("at"), F.lit(1).alias("depth"))
    rows = Table(below.unionByName(firsts.select("node", F.lit(None).cast(below.schema["at"].dataType).alias("at"), F.lit(0).alias("depth"))), "ways")
    left = rows.df.filter("at IS NOT NULL").count()
    while left:
        ahead = rows.df.select(F.col("node").alias("at"), F.col("at").alias("next"), F.col("depth").alias("more"))
        after = Table(rows.df.join(ahead, "at", "left").select("node", F.col("next").alias("at"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")), "ways")
        rows.drop()
        rows, before, left = after, left, after.df.filter("at IS NOT NULL").count()
        if left == before:  # only cycles and what is below them
            break
    return rows.df.filter("at IS NULL").select("node", "depth")


def depths(steps: DataFrame, child: str, parent: str) -> DataFrame:
    """``node, depth``: the longest way from each node to one without a parent.

    Each round moves the front one step down, so rounds grow with the longest chain; where no node has two
    parents, each looks twice as far up in every round, and rounds grow with its logarithm.  Nodes on a cycle
    and below one have no longest way and are left out.
    """
    steps = Table(steps.select(F.col(child).alias("c"), F.col(parent).alias("p")).distinct(), "steps")
    waiting = steps.df.groupBy("c").agg(F.count(F.lit(1)).alias("need"), F.count_if(F.col("p").isNull()).alias("nulls")).withColumnRenamed("c", "node")
    seen = waiting.agg(F.max("need").alias("need"), F.sum("nulls").alias("nulls"), F.count_if(F.col("node").isNull()).alias("unnamed")).collect()[0]
    if seen["need"] == 1 and not seen["nulls"] and not seen["unnamed"]:
        return _forest_depths(steps.df)
    waiting = waiting.drop("nulls")
    front = Table(steps.df.select(F.col("p").alias("node")).distinct().join(waiting.select("node"), "node", "left_anti").withColumn("depth", F.lit(0)), "front")
    done = front.df
    while not front.df.isEmpty():
        # A node follows when all its parents are done; it is one below the last of them.
        met = steps.df.join(done, F.col("p") == F.col("node")).groupBy("c").agg(F.count(F.lit(1)).alias("have"), (F.max("depth") + 1).alias("depth"))
        ready = met.join(waiting, F.col("c") == F.col("node")).filter("have = need").select("node", "depth").join(done.select("node"), "node", "left_anti")
        front = Table(ready, "front")
        done = Table(done.unionByName(front.df), "done").df
    return done
