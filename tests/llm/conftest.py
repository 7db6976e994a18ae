import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
#: Nulls, empty and blank texts, ties, repeated rows, one very long text, odd characters.
EDGE = [
    (10_001, None, "en", "src0", 0),
    (10_002, "", "en", "src0", 0),
    (10_003, " \t\n ", None, None, 4),
    (10_004, "same text here", "en", "src1", 14),
    (10_005, "same  text\nhere", "en", "src1", 15),
    (10_005, "same  text\nhere", "en", "src1", 15),
    (10_006, "Same Text Here", None, "src2", 14),
    (10_007, LONG, "en", None, len(LONG)),
    (10_008, LONG, "en", "src9", len(LONG)),
    (10_009, "one", "fr", "src9", 3),
    (10_010, "日本語 テキスト 😀 ﬁ ß İ \x85\xa0", "de", "src9", 20),
    (10_011, "a b a b a b a b\na b\na b\n\n \n", "es", "src9", 30),
    (10_012, "### $$$ | < > & * %", "es", "src9", 20),
    (None, "no id at all", "en", "src0", 12),
]
CLASHING = ["words", "size", "kept", "fp", "label", "score", "bucket", "text_sha256", "copies", "_key", "_copy", "_copies", "_row", "_doc"]


@pytest.fixture(scope="session")
def docs(spark):
    """The smallest documents, the edge rows, and columns whose names operators might use."""
    from pyspark.sql import functions as F

    rows = spark.read.parquet(f"{SF}/documents.parquet").unionByName(spark.createDataFrame(EDGE, SCHEMA))
    return rows.withColumns({c: F.lit("clash") for c in CLASHING}).cache()


@pytest.fixture(scope="session")
def texts(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def labels(spark):
    rows = spark.read.parquet(f"{SF}/labels.parquet")
    more = spark.createDataFrame([(10_004, None, None), (999_999, 0, 1), (10_005, 1, 0), (10_005, 1, 0)], rows.schema)
    return rows.unionByName(more)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
