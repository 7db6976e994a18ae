"""The windows give the same on a table and on a stream of its files."""

from millrace.streaming import events


def _files(spark, tmp_path):
    table = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", __import__("pyspark.sql.functions", fromlist=["x"]).col("ts").cast("timestamp"))
    folder = str(tmp_path / "in")
    table.orderBy("ts").coalesce(1).write.parquet(folder)
    return table, folder


def test_windows(spark, tmp_path):
    table, folder = _files(spark, tmp_path)
    for f, name in ((events.tumbling, "tumbling"), (events.sliding, "sliding"), (events.sessions, "sessions")):
        got = events.run_to_end(f(events.read_stream(spark, folder)), name, "complete" if name != "sessions" else "append")
        want = f(table)
        lost = want.drop("total").exceptAll(got.drop("total")).count()
        # In append mode the windows that the watermark has not passed are still open at the end.
        assert got.drop("total").exceptAll(want.drop("total")).count() == 0 and lost <= (0 if name != "sessions" else 0.2 * want.count())


def test_upsert(spark, tmp_path):
    merge = events.upsert(str(tmp_path / "t"), "k", "version")
    merge(spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], "k string, version int, v string"), 0)
    merge(spark.createDataFrame([("a", 2, "z"), ("b", 0, "old")], "k string, version int, v string"), 1)
    merge(spark.createDataFrame([("a", 2, "z"), ("b", 0, "old")], "k string, version int, v string"), 1)
    assert sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "t/v=1")).select("k", "v").collect()) == [("a", "z"), ("b", "y")]


def test_upsert_keeps_history(spark, tmp_path):
    merge = events.upsert(str(tmp_path / "t"), "k", "version")
    for i, batch_id in enumerate((0, 1, 3, 0)):
        merge(spark.createDataFrame([(f"k{i}", 1, "x"), ("a", i, str(i))], "k string, version int, v string"), batch_id)
    got = sorted(tuple(r) for r in events.read_upserted(spark, str(tmp_path / "t")).select("k", "v").collect())
    assert got == [("a", "3"), ("k0", "x"), ("k1", "x"), ("k2", "x"), ("k3", "x")]
    (tmp_path / "t/v=9").mkdir()
    assert events.versions(spark, str(tmp_path / "t")) == [2, 3]
