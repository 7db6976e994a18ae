"""Registered queries of drift, with their SQL: events stand in for a log, their values for confidences."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import drift
from .catalogue import _q, _t


def _log(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    outcome = F.when(F.col("value") < 10, "insufficient_data").otherwise("decided")
    return e.select(F.col("event_type").alias("module"), "ts", (F.col("value") / 100).alias("confidence"), outcome.alias("outcome"))


@_q(
    """WITH h AS (SELECT event_type AS module, time_bucket(INTERVAL 1 DAY, ts) AS window_start, least(greatest(floor(value / 100 * 20), 0), 19)::INT AS bin, count(*) AS n
      FROM events WHERE value IS NOT NULL AND ts IS NOT NULL GROUP BY ALL),
    s AS (SELECT module, window_start, sum(n) AS n FROM h GROUP BY module, window_start),
    t AS (SELECT *, lag(window_start) OVER (PARTITION BY module ORDER BY window_start) AS before FROM s),
    p AS (SELECT h.module, h.window_start, bin, h.n / t.n AS share FROM h JOIN t USING (module, window_start)),
    d AS (SELECT t.module, t.window_start, sum(abs(coalesce(a.share, 0) - coalesce(b.share, 0))) / 2 AS distance FROM t, range(20) r(bin)
      LEFT JOIN p a ON a.module = t.module AND a.window_start = t.window_start AND a.bin = r.bin LEFT JOIN p b ON b.module = t.module AND b.window_start = t.before AND b.bin = r.bin
      WHERE t.before IS NOT NULL GROUP BY ALL)
    SELECT t.module, t.window_start, t.n::BIGINT AS n, round(d.distance, 9) AS distance FROM t LEFT JOIN d USING (module, window_start)"""
)
def confidence_drift(spark, sf_dir):
    """How far each day's confidences are from those of the day before, per module; two halves of the log are merged."""
    log = _log(spark, sf_dir)
    half = F.pmod(F.xxhash64("ts", "confidence"), F.lit(2)) == 0
    whole = drift.merged(drift.histogram(log.filter(half)), drift.histogram(log.filter(~F.coalesce(half, F.lit(False)))))
    return drift.drift(whole).withColumn("distance", F.round("distance", 9))


@_q(
    """SELECT event_type AS module, time_bucket(INTERVAL 1 DAY, ts) AS window_start, count(*) AS n, count(*) FILTER (value < 10) AS insufficient,
    round(count(*) FILTER (value < 10) / count(*), 9) AS rate FROM events WHERE ts IS NOT NULL GROUP BY ALL"""
)
def insufficient_data_rate(spark, sf_dir):
    return drift.insufficient_rate(_log(spark, sf_dir)).withColumn("rate", F.round("rate", 9))
