"""Evidence classes: which items are copies of each other, and which are independent.

Links between items are typed.  What a type means for an item:

=====================  ==========  ===========  ==================================
type                   collection  independent  reading
=====================  ==========  ===========  ==================================
exact_copy, near_copy  the same    no           one article, several retrievals
syndicated_copy_of     its own     no           trust is the originating outlet's
mirrored_at            its own     no           the same content elsewhere
archived_copy_of       its own     no           a preserved snapshot
translation_of         its own     no           a presentation, not new evidence
updated_version_of     its own     yes          a version: judged by itself
retraction_of          its own     yes          withdraws the version before
=====================  ==========  ===========  ==================================

A link whose substance changed is a version whatever its type says.  ``derive_links`` finds
types from content; ``classes`` gives every item its collection, the root of what is not
independent of it, its origin and its version chain.  ``extend`` takes new links without
looking at the old ones again.

Scale: links that are found go from every member of a group to its first, so a group of any size
gives as many links as members; groups are keyed by digests and their firsts found by map-side
minima.  Components need rounds that grow with the logarithm of the longest chain.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import dedup_key
from ..storage import Table
from . import graph

#: The kinds of link.
MERGED = ("exact_copy", "near_copy")
LINKED = ("syndicated_copy_of", "mirrored_at", "archived_copy_of", "translation_of")
VERSIONS = ("updated_version_of", "retraction_of")


def derive_links(evidence: DataFrame) -> DataFrame:
    """``a, b, kind, changed``: links that content and place show, from each item to the first of its group.

    ``evidence`` has ``evidence_id, content, outlet, url, captured_at``.  Of items with equal content
    (``exact_copy``) or content equal up to case and marks (``near_copy``), an item of another outlet than
    the first is its ``syndicated_copy_of``, and one of the same outlet and another address is
    ``mirrored_at``.  Items of one address whose content differs are versions: each is an
    ``updated_version_of`` the one captured before, with ``changed`` set.  Content without letters or digits
    is compared exactly only; null content links nothing; null outlets and addresses are unknown, not equal.
    Keys and links are written, so content is read once however often the links are.
    """
    key = F.nullif(dedup_key(F.col("content")), F.lit(""))
    rows = evidence.filter(F.col("content").isNotNull()).select(
        "evidence_id", "outlet", "url", "captured_at", F.sha2("content", 256).alias("exact"), F.sha2(F.coalesce(key, F.col("content")), 256).alias("near")
    )
    rows = Table(rows, "keys").df
    first = F.min_by(F.struct("evidence_id", "outlet", "url", "exact"), F.struct("captured_at", "evidence_id"))
    links = rows.join(rows.groupBy("near").agg(first.alias("f")), "near").filter(F.col("evidence_id") != F.col("f.evidence_id"))
    kind = (
        F.when(F.col("outlet") != F.col("f.outlet"), "syndicated_copy_of")
        .when((F.col("outlet") == F.col("f.outlet")) & (F.col("url") != F.col("f.url")), "mirrored_at")
        .when(F.col("exact") == F.col("f.exact"), "exact_copy")
        .otherwise("near_copy")
    )
    links = links.select(F.col("evidence_id").alias("a"), F.col("f.evidence_id").alias("b"), kind.alias("kind"), F.lit(False).alias("changed"))
    # One step per state of an address: the first capture of each stretch of equal content.
    order = W.partitionBy("url").orderBy("captured_at", "evidence_id")
    steps = rows.filter("url IS NOT NULL").withColumn("before", F.lag(F.struct("evidence_id", "near")).over(order)).filter("near != before.near")
    steps = steps.select(F.col("evidence_id").alias("a"), F.col("before.evidence_id").alias("b"), F.lit("updated_version_of").alias("kind"), F.lit(True).alias("changed"))
    return Table(links.unionByName(steps), "links").df


def _same_substance(kinds: tuple[str, ...]) -> Column:
    return F.col("kind").isin(*kinds) & ~F.coalesce(F.col("changed"), F.lit(False))


@dataclass(frozen=True)
class Components:
    """``node, root`` of merged items and of all items that are not independent."""

    merged: DataFrame
    dependent: DataFrame


def components(links: DataFrame) -> Components:
    return Components(
        graph.connected_components(links.filter(_same_substance(MERGED)), "a", "b"),
        graph.connected_components(links.filter(_same_substance(MERGED + LINKED)), "a", "b"),
    )


def extend(known: Components, links: DataFrame) -> Components:
    """The components after more links."""
    return Components(
        graph.extend_components(known.merged, links.filter(_same_substance(MERGED))),
        graph.extend_components(known.dependent, links.filter(_same_substance(MERGED + LINKED))),
    )


def origins(links: DataFrame, dependent: DataFrame) -> DataFrame:
    """``root, origin``: of each group of dependent items the one that is no copy of another; the smallest of several.

    A cycle of copies has no origin of its own and takes its smallest item.
    """
    copies = links.filter(_same_substance(MERGED + LINKED)).select(F.col("a").alias("node")).distinct().withColumn("copy", F.lit(True))
    rows = dependent.join(copies, "node", "left")
    return rows.groupBy("root").agg(F.coalesce(F.min(F.when(F.col("copy").isNull(), F.col("node"))), F.min("node")).alias("origin"))


def classes(evidence: DataFrame, links: DataFrame, known: Components | None = None) -> DataFrame:
    """``evidence_id, class, collection, root, origin, retracted`` of every item of ``evidence``.

    ``class`` is how an item entered: the type of its link to an earlier item, most specific first
    (translation, archive, mirror, syndication, near, exact), ``version`` or ``original``.  ``collection``
    is the smallest item it is merged with, ``root`` that of all items it is not independent of.
    """
    known = known or components(links)
    rank = [*reversed(LINKED), *reversed(MERGED)]
    own = links.withColumn(
        "place",
        F.when(_same_substance(tuple(rank)), F.coalesce(*[F.when(F.col("kind") == k, i) for i, k in enumerate(rank)])).otherwise(len(rank)),
    )
    own = own.groupBy(F.col("a").alias("evidence_id")).agg(F.min("place").alias("place"))
    gone = links.filter(F.col("kind") == "retraction_of").select(F.col("b").alias("evidence_id")).distinct().withColumn("retracted", F.lit(True))
    named = lambda frame, name: frame.select(F.col("node").alias("evidence_id"), F.col("root").alias(name))
    rows = evidence.select("evidence_id").distinct().join(own, "evidence_id", "left").join(gone, "evidence_id", "left")
    rows = rows.join(named(known.merged, "collection"), "evidence_id", "left").join(named(known.dependent, "root"), "evidence_id", "left")
    rows = rows.withColumns({"collection": F.coalesce("collection", "evidence_id"), "root": F.coalesce("root", "evidence_id")})
    rows = rows.join(origins(links, known.dependent), "root", "left")
    what = F.when(F.col("place").isNull(), "original")
    for i, k in enumerate(rank):
        what = what.when(F.col("place") == i, k)
    return rows.select(
        "evidence_id", what.otherwise("version").alias("class"), "collection", "root", F.coalesce("origin", "evidence_id").alias("origin"), F.coalesce("retracted", F.lit(False)).alias("retracted")
    )


def versions(links: DataFrame) -> DataFrame:
    """``evidence_id, chain, version``: chains of changed substance, each version retained, numbered from 1.

    A chain is named by its smallest item; a version stands one after the latest it was made from.
    """
    steps = links.filter(F.col("kind").isin(*VERSIONS) | F.coalesce(F.col("changed"), F.lit(False))).select("a", "b").filter("a != b").distinct()
    chains = graph.connected_components(steps, "a", "b")
    return chains.join(graph.depths(steps, "a", "b"), "node").select(F.col("node").alias("evidence_id"), F.col("root").alias("chain"), (F.col("depth") + 1).alias("version"))


def independent_support(stances: DataFrame, items: DataFrame) -> DataFrame:
    """``claim_id, stance, n_items, n_independent``: support net of copies; retracted items do not count.

    Copies of one origin, however many outlets carry them, are one independent source.
    """
    rows = stances.join(items.filter("NOT retracted").select("evidence_id", "root"), "evidence_id")
    return rows.groupBy("claim_id", "stance").agg(F.count_distinct("evidence_id").alias("n_items"), F.count_distinct("root").alias("n_independent"))
