"""Distances by hand, and the same histogram from a table, from parts and from a stream."""

import datetime as dt

import pytest

from millrace.operators import drift as D
from millrace.streaming.events import run_to_end

SCHEMA = "module string, ts timestamp, confidence double, outcome string"
DAY = lambda d, h=0: dt.datetime(2024, 3, d, h)
ROWS = [
    ("a", DAY(1), 0.05, None), ("a", DAY(1, 5), 0.05, "insufficient_data"), ("a", DAY(2), 0.05, "x"), ("a", DAY(2), 0.95, "x"), ("a", DAY(4), 1.7, "x"), ("a", DAY(4), -3.0, "x"),
    ("b", DAY(1), 0.5, "x"), ("b", DAY(2), None, "insufficient_data"), ("b", None, 0.5, "x"),
]


def test_by_hand(spark):
    log = spark.createDataFrame(ROWS, SCHEMA)
    got = {(r["module"], r["window_start"].day): (r["n"], r["distance"]) for r in D.drift(D.histogram(log)).collect()}
    # Bins of module a: 1, 1; then 1, 19; then 19 and, as -3 is below the range, 0.
    assert got == {("a", 1): (2, None), ("a", 2): (2, pytest.approx(0.5)), ("a", 4): (2, pytest.approx(0.5)), ("b", 1): (1, None)}
    rates = {(r["module"], r["window_start"].day): (r["n"], r["rate"]) for r in D.insufficient_rate(log).collect()}
    assert rates == {("a", 1): (2, 0.5), ("a", 2): (2, 0.0), ("a", 4): (2, 0.0), ("b", 1): (1, 0.0), ("b", 2): (1, 1.0)}
    assert D.drift(D.histogram(log.limit(0))).count() == 0


def test_parts_and_stream(spark, tmp_path):
    log = spark.createDataFrame(ROWS, SCHEMA)
    whole = sorted(map(tuple, D.histogram(log).collect()))
    parts = D.merged(*[D.histogram(log.filter(f"module = '{m}'")) for m in "ab"])
    assert sorted(map(tuple, parts.collect())) == whole
    log.write.parquet(str(tmp_path / "in"))
    stream = D.histogram(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in")))
    assert sorted(map(tuple, run_to_end(stream, "drift_histogram", "complete").collect())) == whole
