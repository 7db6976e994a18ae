"""Provenance of facts: every path through a branching graph of references, to the end or to the missing link."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What a fact rests on, branch by branch.
BRANCHES = {"graph": ("edge", "relation", "entity", "claim", "article"), "evidence": ("evidence", "article")}


def walk(starts: DataFrame, hops: list[tuple[str, DataFrame]], start_kind: str = "fact") -> DataFrame:
    """``start, path, missing``: one row for each path from each id of ``starts`` (its first column).

    ``hops`` are (kind, links) in order, links of two columns: from and to.  A path is an array of
    (kind, id); ``missing`` is the kind of the first link that is not there, null for a whole path.
    A path is a row and not part of its start's row, so a start with any number of paths is spread
    over tasks, and paths that have ended join under keys of their own.  Null ids are no ids; repeated links and starts count once; a start without any link
    keeps its row.
    """
    # Kinds, the start and what is missing follow from the place in the path, so only ids are moved.
    kinds = F.array(*map(F.lit, [start_kind, *(kind for kind, _ in hops)]))
    rows = starts.select(F.col(starts.columns[0]).cast("string").alias("_id")).filter("_id IS NOT NULL").distinct()
    rows = rows.select(F.concat(F.lit("id:"), "_id").alias("_at"), F.array("_id").alias("_path"))
    for _, links in hops:
        a, b = links.columns[:2]
        known = links.select(F.concat(F.lit("id:"), F.col(a).cast("string")).alias("_at"), F.col(b).cast("string").alias("_to")).dropna().distinct()
        rows = rows.join(known, "_at", "left").select(
            F.coalesce(F.concat(F.lit("id:"), "_to"), F.concat(F.lit("ended:"), F.xxhash64("_path").cast("string"))).alias("_at"),
            F.when(F.col("_to").isNull(), F.col("_path")).otherwise(F.concat("_path", F.array("_to"))).alias("_path"),
        )
    path = F.transform("_path", lambda id_, i: F.struct(F.get(kinds, i).alias("kind"), id_.alias("id")))
    return rows.select(F.get("_path", F.lit(0)).alias("start"), path.alias("path"), F.get(kinds, F.size("_path")).alias("missing"))


def fact_provenance(facts: DataFrame, graph: list[DataFrame], evidence: list[DataFrame]) -> DataFrame:
    """``fact_id, branch, path, missing`` over both branches; ``graph`` and ``evidence`` are their links in the order of ``BRANCHES``."""
    of = lambda name, links: walk(facts, list(zip(BRANCHES[name], links, strict=True))).withColumn("branch", F.lit(name))
    return of("graph", graph).unionByName(of("evidence", evidence)).select(F.col("start").alias("fact_id"), "branch", "path", "missing")


def shown(path: Column) -> Column:
    """A path as text: ``fact:1 > edge:7``."""
    return F.array_join(F.transform(path, lambda s: F.concat_ws(":", s["kind"], s["id"])), " > ")
