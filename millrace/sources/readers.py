"""Readers: each returns the raw columns and ``row_seq``, the row's 0-based place in its files.

Line order is restored from the file's rank and the position Spark's file source
gives (block start, then row order inside the block), never from an unordered id.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import has_image_suffix
from ..operators.normalize import ORDINAL

#: The columns of the headerless statement file, in order.
STATEMENT_COLUMNS = (
    "id label statement subject speaker speaker_job state_info party barely_true_c false_c half_true_c mostly_true_c pants_fire_c context".split()
)
#: What a delimited file's field holds where it has no value.
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
ARTICLE_COLUMNS = ["title", "text", "subject", "date"]
CORRUPT = "_corrupt_record"


def _strings(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def _require(*paths: Path) -> None:
    for p in paths:
        if not p.exists():
            raise FileNotFoundError(str(p))


def _numbered(parts: list[DataFrame]) -> DataFrame:
    """The union of the parts in their order, with consecutive ordinals.

    A split's tasks read ascending blocks of one file, so (part, block start, index in
    the task) is the line order; tasks are counted once to turn it into a sequence.
    """
    from pyspark.sql import Window as W

    placed = [
        p.withColumns(
            {
                "_part": F.lit(i),
                "_block": F.col("_metadata.file_block_start"),
                "_task": F.spark_partition_id(),
                "_index": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
            }
        )
        for i, p in enumerate(parts)
    ]
    rows = placed[0]
    for p in placed[1:]:
        rows = rows.unionByName(p)
    keys = ["_part", "_block"]
    blocks = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_index").alias("_first"))
    earlier = W.orderBy(*keys).rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.select(*keys, (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    out = rows.join(blocks, keys).withColumn(ORDINAL, F.col("_index") + F.col("_shift"))
    return out.drop("_part", "_block", "_task", "_index", "_shift")


def read_csv(spark: SparkSession, path: str | Path, columns: list[str], header: bool = True, sep: str = ",", quote: str | None = '"') -> DataFrame:
    """Delimited text with quoted line breaks; all columns as strings."""
    options = {"header": header, "sep": sep, "multiLine": quote is not None, "escape": '"', "mode": "PERMISSIVE", "quote": quote or ""}
    return spark.read.schema(_strings(columns)).options(**options).csv(str(path))


def read_jsonl(spark: SparkSession, path: str | Path, schema: T.StructType, on_bad_record: str = "fail") -> DataFrame:
    """One JSON object a line.  A malformed line ends the job (``fail``) or is kept aside (``skip``).

    With ``skip`` the bad lines stay in a column ``_corrupt_record``; ``good_lines`` and
    ``bad_lines`` part them, so they can be counted.
    """
    if on_bad_record == "fail":
        return spark.read.schema(schema).option("mode", "FAILFAST").json(str(path))
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return spark.read.schema(wide).options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT).json(str(path))


def good_lines(df: DataFrame) -> DataFrame:
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def bad_lines(df: DataFrame) -> DataFrame:
    return df.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def read_articles(spark: SparkSession, raw_dir: str | Path) -> DataFrame:
    """The pair of CSV files; the label is that of the file, Fake before True."""
    files = [(Path(raw_dir) / "Fake.csv", "Fake"), (Path(raw_dir) / "True.csv", "True")]
    _require(*(f for f, _ in files))
    return _numbered([read_csv(spark, f, ARTICLE_COLUMNS).select("*", "_metadata").withColumn("label", F.lit(v)) for f, v in files]).select(
        *ARTICLE_COLUMNS, "label", ORDINAL
    )


#: Evidence is nested lists of mixed items; as text it survives whatever they hold.
CLAIM_SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("claim", T.StringType()), T.StructField("label", T.StringType()), T.StructField("evidence", T.StringType())])


def read_claims(spark: SparkSession, raw_dir: str | Path, on_bad_record: str = "fail") -> DataFrame:
    path = Path(raw_dir) / "train.jsonl"
    _require(path)
    rows = read_jsonl(spark, path, CLAIM_SCHEMA, on_bad_record)
    names = CLAIM_SCHEMA.fieldNames() + ([CORRUPT] if on_bad_record != "fail" else [])
    rows = _numbered([rows.select("*", "_metadata")]).select(*names, ORDINAL)
    return good_lines(rows) if on_bad_record != "fail" else rows


def missing_as_null(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The tokens for a missing value, null."""
    return rows.withColumns({c: F.when(~F.col(c).isin(NA_TOKENS), F.col(c)) for c in columns})


def read_statements(spark: SparkSession, raw_dir: str | Path, quote: str | None = '"', na_tokens: bool = True) -> DataFrame:
    """Headerless tab-separated file; a field that begins with a quote runs to its end, across lines too.

    With ``quote=None`` quotes are ordinary characters, so an unpaired one swallows nothing
    and the file can be split; with ``na_tokens=False`` the tokens for missing values stay text.
    """
    path = Path(raw_dir) / "train.tsv"
    _require(path)
    rows = read_csv(spark, path, STATEMENT_COLUMNS, header=False, sep="\t", quote=quote).select("*", "_metadata")
    rows = missing_as_null(rows, STATEMENT_COLUMNS) if na_tokens else rows
    return _numbered([rows]).select(*STATEMENT_COLUMNS, ORDINAL)


def read_generated_text(spark: SparkSession, raw_dir: str | Path) -> DataFrame:
    """Two JSONL files, ``text`` only, with their source: human before machine."""
    files = [(Path(raw_dir) / "webtext.train.jsonl", "human"), (Path(raw_dir) / "small-117M.train.jsonl", "machine")]
    _require(*(f for f, _ in files))
    schema = _strings(["text"])
    parts = [read_jsonl(spark, f, schema).select("*", "_metadata").withColumns({"text": F.coalesce("text", F.lit("")), "source": F.lit(v)}) for f, v in files]
    return _numbered(parts).select("text", "source", ORDINAL)


def list_files(spark: SparkSession, folder: str | Path) -> DataFrame:
    """``path`` of every file below a folder, empty ones too (Spark's scans skip those).

    The listing is what any scan does on the driver; names only.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(str(folder))
    found = []
    fs = root.getFileSystem(conf)
    if fs.exists(root):
        files = fs.listFiles(root, True)
        while files.hasNext():
            found.append((files.next().getPath().toUri().getPath(),))
    return spark.createDataFrame(found, "path string")


def list_images(spark: SparkSession, raw_dir: str | Path) -> DataFrame:
    """Image paths of ``{train,test}/{REAL,FAKE}``, REAL first, by path inside a folder; contents are not read."""
    from ..operators.normalize import with_ordinal

    files = list_files(spark, raw_dir).select(F.col("path").alias("image_path")).filter(has_image_suffix(F.col("image_path")))
    label, fold = F.regexp_extract("image_path", "/(REAL|FAKE)/[^/]*$", 1), F.regexp_extract("image_path", "/(train|test)/(?:REAL|FAKE)/[^/]*$", 1)
    rows = files.withColumns({"label": label, "_fold": fold}).filter("label != '' AND _fold != ''")
    rows = rows.withColumn("_folder", F.when(F.col("label") == "FAKE", 2).otherwise(0) + F.when(F.col("_fold") == "test", 1).otherwise(0))
    if rows.isEmpty():
        raise FileNotFoundError(f"no images below {raw_dir}")
    return with_ordinal(rows, ["_folder", "image_path"]).select("image_path", "label", ORDINAL)


def read_table(spark: SparkSession, path: str | Path) -> DataFrame:
    """By suffix: Parquet, JSON lines (bad lines dropped after being kept aside), else CSV with a header."""
    path = str(path)
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    if path.rstrip("/").endswith(".jsonl"):
        rows = spark.read.options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT).json(path)
        return good_lines(rows.cache()) if CORRUPT in rows.columns else rows
    return spark.read.options(header=True, multiLine=True, escape='"', inferSchema=True).csv(path)


LOADERS = {
    "fake_real_news": read_articles,
    "claim_verification": read_claims,
    "fact_checking": read_statements,
    "image_forensics": list_images,
    "ai_text_detection": read_generated_text,
}
