"""Mixing sources to target weights by systematic sampling (DataFrame functions only).

Sources in code-point order (null last) weigh 1, 2, 3, 1, ... and share the size of
the whole corpus; no target exceeds ``cap`` times its source's size, and what a
capped source leaves is shared again by weight (water filling, solved in closed
form by prefix sums over the sources ordered by cap per weight).

Within a source every document expects ``target / source_size`` copies.  The
documents are put in the order (size, id), the expected copies are prefix-summed
from one random offset, and a document is emitted once per integer boundary that
its interval crosses.  As neighbours have like sizes, the words taken differ from
the target by little more than the largest document.

The prefix sum is distributed: a range partitioning on (source, size, id) spreads
a hot source over all tasks, each row gets its index inside its partition, and
only the counts of the pieces (partition, source) are summed.  Offsets are derived
from a seed and the source's name, so reruns and any partitioning agree.

Defined cases: null text has size 0; a null source is a source of its own, the
last; a source of size 0 has target 0 and takes nothing; an empty table gives an
empty result; rows that repeat an id are documents of their own; extra columns
are ignored by ``plan`` and kept by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, cut, partitions, text_or_empty

SEED = 20


def _source_key(column):
    """A never-null key: '' is the null source, '=name' any other."""
    return F.coalesce(F.concat(F.lit("="), column), F.lit(""))


def sizes(docs: DataFrame, id_col: str, source_col: str, text_col: str, digest: bool = False) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("doc_id"),
        _source_key(F.col(source_col)).alias("_source"),
        F.regexp_count(text_or_empty(text_col), F.lit(WORD)).cast("long").alias("size"),
        *([F.xxhash64(text_col).alias("_digest")] if digest else []),
    )


def targets(sized: DataFrame, cap: float = 3.0) -> DataFrame:
    """``_source, source_size, target, rate``: one row per source.

    The windows below have no partition key, as shares are relative to the whole;
    their input is one row per source.
    """
    per_source = sized.groupBy("_source").agg(F.sum("size").alias("source_size"))
    ordered = W.orderBy((F.col("_source") == "").cast("int"), "_source")
    everything = W.partitionBy()
    s = per_source.select(
        "*",
        ((F.row_number().over(ordered) - 1) % 3 + 1).cast("double").alias("weight"),
        (F.col("source_size") * F.lit(cap)).alias("most"),
        F.sum("source_size").over(everything).cast("double").alias("total"),
    )
    by_ratio = W.orderBy((F.col("most") / F.col("weight")), "_source")
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    level_before = (F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    s = s.withColumn("capped", F.col("most") / F.col("weight") <= level_before)
    left = F.max("total").over(everything) - F.sum(F.when(F.col("capped"), F.col("most")).otherwise(0.0)).over(everything)
    open_weight = F.sum(F.when(F.col("capped"), 0.0).otherwise(F.col("weight"))).over(everything)
    s = s.withColumn(
        "target", F.when(F.col("capped"), F.col("most")).otherwise(F.col("weight") * left / F.nullif(open_weight, F.lit(0.0)))
    )
    return s.select(
        "_source",
        "source_size",
        "target",
        F.coalesce(F.least(F.try_divide("target", F.col("source_size").cast("double")), F.lit(cap)), F.lit(0.0)).alias("rate"),
    )


def plan(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    cap: float = 3.0,
    seed: int = SEED,
    digest: bool = False,
) -> DataFrame:
    """``doc_id, _source, size, source_size, target, copies`` for every row, and ``_digest`` of its text if asked for."""
    spark = docs.sparkSession
    sized = cut(sizes(docs, id_col, source_col, text_col, digest), "sizes")
    order = ["_source", "size", "doc_id", *(["_digest"] if digest else [])]
    placed = (
        sized.repartitionByRange(partitions(spark), *order)
        .sortWithinPartitions(*order)
        .select(
            *order,
            F.spark_partition_id().alias("_part"),
            # The lower 33 bits of the generated id are the row's index in its partition.
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_index"),
        )
    )
    placed = cut(placed, "placed")
    pieces = placed.groupBy("_part", "_source").agg(F.min("_index").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = W.partitionBy("_source").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    pieces = pieces.withColumn("_offset", F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1)
    start = F.conv(F.substring(F.md5(F.concat(F.lit(f"mix:{seed}:"), "_source")), 1, 8), 16, 10).cast("double") / 2.0**32
    known = pieces.drop("_n", "_first").join(targets(sized, cap), "_source").withColumn("_start", start)
    rank = (F.col("_index") + F.col("_offset")).cast("double")
    whole = F.floor("rate")
    part = F.col("rate") - whole
    crossed = F.floor(F.col("_start") + part * rank) - F.floor(F.col("_start") + part * (rank - 1))
    return placed.join(known, ["_part", "_source"]).select(
        "doc_id", "_source", "size", "source_size", "target", (whole + crossed).alias("copies"), *order[3:]
    )


def mix_report(docs: DataFrame, **named) -> DataFrame:
    """``doc_id, size, source_size, target, taken``: what the mix takes from each row."""
    return plan(docs, **named).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **named) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as the plan takes it, columns unchanged.

    Each row keeps its own count.  Rows equal in id, source, size and text differ by one at
    most; as many of them as the plan gives one more take it, in no particular order.
    """
    key = lambda doc_id, size, source, digest: F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("")), size, source, digest)
    copies = (
        plan(docs, id_col, source_col, text_col, digest=True, **named)
        .groupBy(key(F.col("doc_id"), F.col("size"), F.col("_source"), F.col("_digest")).alias("_key"))
        .agg(F.min("copies").alias("_low"), (F.sum("copies") - F.count(F.lit(1)) * F.min("copies")).alias("_more"))
        .filter("_low + _more > 0")
    )
    size = F.regexp_count(text_or_empty(text_col), F.lit(WORD)).cast("long")
    # The columns of the documents travel as one, so that no name of theirs can clash.
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
        key(F.col(id_col), size, _source_key(F.col(source_col)), F.xxhash64(text_col)).alias("_key"),
    )
    # One row per document grows with the table, so the plan is the same at any size: no broadcast.
    kept = keyed.join(copies.hint("merge"), "_key").withColumn("_nth", F.row_number().over(W.partitionBy("_key").orderBy("_low")))
    taken = F.col("_low") + (F.col("_nth") <= F.col("_more")).cast("bigint")
    kept = kept.select("_doc", taken.alias("_copies")).filter("_copies > 0")
    return kept.select("_doc", F.explode(F.sequence(F.lit(1).cast("bigint"), "_copies")).alias("_copy")).select("_doc.*")
