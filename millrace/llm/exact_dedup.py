r"""Exact deduplication by content-defined chunk recipes (DataFrame functions only).

A text is cut into chunks at places that its own characters decide, so two texts
that share a passage share its inner chunks.  Every chunk gets an identifier
that is *verified*: SHA-256 names the content, and the chunk dictionary checks
that all occurrences of a name agree in length and in an independent 64-bit
hash; a disagreement stops the job instead of merging different contents.
A document becomes its recipe, the ordered list of chunk identifiers.  Texts are
equal exactly if their recipes are, so only recipes (some 40 bytes for each
kilobyte of text) are compared and the query moves no document.  The filtering form
``keep_first`` joins the documents with the rows that stay, which moves each once.

Defined cases: a null text counts as empty; empty texts equal one another (their
recipe has no chunk); exactly one row of a group stays, the one with the smallest
doc_id, nulls last, and among rows that repeat this id the first one read.  ``keep_first``
keeps any one of the rows that are equal in id and text, so where their other columns
differ a rerun may keep another.  The query ignores extra columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, drop_cut, free_name, free_shuffles, read_cut, text_or_empty, write_cut

#: A run of white space that is not already one single space.
_UNEVEN_SPACE = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
#: About half of the characters of any script.
_HALF = r"a-mA-M0-4\u0080-\u00E4\u0370-\u03B0\u0400-\u0430\u0590-\u0630\u0900-\u0930\u3040-\u6FFF\uAC00-\uC2FF"
#: At least 256 characters, then up to the first place where four characters of that half
#: and three others follow each other (one place in 128, so two texts that share a passage
#: soon cut it alike); 4,096 at most.
CHUNK = rf"[\s\S]{{256,4089}}?(?:[{_HALF}]{{4}}[^{_HALF}]{{3}})|[\s\S]{{1,4096}}"


def normalised(text):
    """Each run of ASCII white space becomes one space."""
    return F.regexp_replace(text, _UNEVEN_SPACE, " ")


def recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, _row, text_sha256, recipe array<struct<id binary, n_chars int, check bigint>>``."""
    text = docs.select(
        F.col(id_col), F.monotonically_increasing_id().alias("_row"), normalised(text_or_empty(text_col)).alias("_t")
    )
    chunk = lambda c: F.struct(
        F.unhex(F.sha2(c, 256)).alias("id"), F.length(c).alias("n_chars"), F.xxhash64(c).alias("check")
    )
    return text.select(
        id_col,
        "_row",
        F.sha2(F.col("_t"), 256).alias("text_sha256"),
        F.transform(F.regexp_extract_all("_t", F.lit(CHUNK), F.lit(0)), chunk).alias("recipe"),
    )


def chunk_dictionary(recipe_rows: DataFrame) -> DataFrame:
    """One row per chunk identifier: ``id, n_chars, uses, verified``."""
    return (
        recipe_rows.select(F.explode("recipe").alias("c"))
        .groupBy(F.col("c.id").alias("id"))
        .agg(
            F.max("c.n_chars").alias("n_chars"),
            F.count(F.lit(1)).alias("uses"),
            ((F.min("c.check") == F.max("c.check")) & (F.min("c.n_chars") == F.max("c.n_chars"))).alias("verified"),
        )
    )


def chunk_store(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The deduplicated contents: one row ``id, chunk`` for each distinct chunk."""
    chunks = docs.select(
        F.explode(F.regexp_extract_all(normalised(text_or_empty(text_col)), F.lit(CHUNK), F.lit(0))).alias("chunk")
    )
    return chunks.groupBy(F.unhex(F.sha2("chunk", 256)).alias("id")).agg(F.any_value("chunk").alias("chunk"))


def restore(recipe_rows: DataFrame, store: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The normalised texts again, from recipes and the chunk store."""
    parts = recipe_rows.select(id_col, F.posexplode_outer("recipe").alias("pos", "c")).select(
        id_col, "pos", F.col("c.id").alias("id")
    )
    return (
        parts.join(store, "id", "left")
        .groupBy(id_col)
        .agg(F.array_sort(F.collect_list(F.struct("pos", "chunk"))).alias("p"))
        .select(id_col, F.coalesce(F.array_join("p.chunk", ""), F.lit("")).alias("text"))
    )


def _decide(rows: DataFrame, id_col: str) -> DataFrame:
    broken = chunk_dictionary(rows).filter(~F.col("verified")).limit(1).collect()
    if broken:
        raise ValueError(f"chunk identifier {broken[0]['id'].hex()} names different contents")
    listed = rows.select(
        F.col(id_col), "_row", "text_sha256", F.size("recipe").alias("n_chunks"), F.col("recipe.id").alias("ids")
    )
    order = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col("_row").alias("row"))
    # Map-side combining makes a hot group one row per task before the shuffle.
    groups = listed.groupBy("ids").agg(F.min(order).alias("keep"), F.count(F.lit(1)).alias("group_size"))
    # A plain equi join on both shuffled sides: adaptive execution splits a hot group's rows.
    return listed.join(groups, "ids").select(
        id_col,
        F.col("keep.id").alias("keep_id"),
        "group_size",
        (F.col("_row") == F.col("keep.row")).alias("kept"),
        "text_sha256",
        F.col("n_chunks").cast("long").alias("n_chunks"),
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256, n_chunks`` for every row."""
    return _decide(cut(recipes(docs, id_col, text_col), "recipes"), id_col)


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The filtering form: one row of ``docs`` for each distinct normalised text, all columns kept."""
    key = lambda sha: F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("")), sha)
    listed = recipes(docs, id_col, text_col)
    path = write_cut(listed, "recipes")
    kept = cut(_decide(read_cut(docs.sparkSession, path, listed), id_col).filter("kept").select(key(F.col("text_sha256")).alias("_key")), "kept")
    drop_cut(docs.sparkSession, path)
    free_shuffles(docs.sparkSession)
    name = free_name(docs, "_key")
    keyed = docs.withColumn(name, key(F.sha2(normalised(text_or_empty(text_col)), 256)))
    # Rows that repeat id and text meet in the partition where the join has put them.
    return keyed.join(kept.withColumnRenamed("_key", name), name, "left_semi").dropDuplicates([name]).drop(name)
