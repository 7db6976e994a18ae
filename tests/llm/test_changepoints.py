import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import changepoints as C

SF = "/root/testdata/sf0.001"
SCHEMA = "vendor_id bigint, quantity int, shipped_at timestamp_ntz, total string, key string, day string, cost string"


def cost_of(x, s, t):
    n, w = t - s, [int(v) for v in x[s:t]]
    total, squares = sum(w), sum(v * v for v in w)
    v = 1 + (n * squares - total * total) // (n * n)
    return n * math.floor(1000 * math.log(v))


def brute(x, least, penalty):
    """Every cut of every prefix; starts compare from the last segment backwards."""
    n = len(x)
    if n < 2 * least:
        return cost_of(x, 0, n), [(0, n)]
    best = {0: (-penalty, 0, ())}
    for t in range(least, n + 1):
        ways = [(best[s][0] + cost_of(x, s, t) + penalty, best[s][1] + 1, (s, *best[s][2])) for s in range(t - least + 1) if s in best]
        if ways:
            best[t] = min(ways)
    starts = best[n][2][::-1]
    return best[n][0], list(zip(starts, [*starts[1:], n]))


@pytest.mark.parametrize("top", [2, 3, 50, 10**6, 10**11])
def test_equal_to_brute_force(top):
    rng = np.random.default_rng(top % 1000)
    for turn in range(60):
        n, least = int(rng.integers(1, 60)), int(rng.integers(1, 6))
        x = rng.integers(0, top, n) * (rng.random(n) < 0.7)
        if turn % 3 == 0:
            x = np.where(np.arange(n) // 15 % 2 == 0, x, x // 2)
        penalty = int(rng.choice([0, 1, 500, 5_000, 40_000]))
        found, whole = C.cut_series(x, least, penalty)
        assert (whole, [(s.first, s.first + s.n) for s in found]) == brute(x, least, penalty)


def test_series_together():
    """Series of different lengths and sizes, some beyond 64-bit products, give what each gives alone."""
    rng = np.random.default_rng(11)
    many = [rng.integers(0, int(rng.choice([3, 1000, 10**12])), int(rng.integers(1, 120))) for _ in range(60)]
    assert C.cut_many(many, 4, 3_000) == [C.cut_series(x, 4, 3_000) for x in many]
    assert C.cut_many([]) == []


def test_what_the_floors_lose_is_bounded():
    rng = np.random.default_rng(5)
    for _ in range(3_000):
        n, m = int(rng.integers(1, 40)), int(rng.integers(1, 40))
        x = rng.integers(0, int(rng.choice([2, 4, 30, 1000])), n + m)
        spread = C.Series([x]).costs(np.array([0]), np.array([n]))[1]
        bound = C.lost(np.array([n]), spread, np.array([n + m + int(rng.integers(0, 50))]))[0]
        assert cost_of(x, 0, n) + cost_of(x, n, n + m) - cost_of(x, 0, n + m) <= bound


def test_starts_are_dropped():
    """Pruning has to happen where a large and a small spread follow each other."""
    x = np.where(np.arange(400) // 100 % 2 == 0, np.arange(400) * 7919 % 50_000, np.arange(400) % 7)
    asked = []
    whole = C.Series.costs

    class Counting(C.Series):
        def costs(self, starts, ends):
            asked.append(len(starts))
            return whole(self, starts, ends)

    plain, C.Series = C.Series, Counting
    try:
        C.cut_series(x)
    finally:
        C.Series = plain
    assert sum(asked) < 0.6 * sum(range(400 - 14))


def test_rows(spark):
    day = lambda k: dt.datetime(2024, 1, 1, 5) + dt.timedelta(days=k)
    rows = [(1, 5, day(0)), (1, 5, day(0)), (1, None, day(90)), (1, 7, None), (1, 2, day(3)), (2, 9, day(4)), (None, 1, day(0)), (None, 3, day(1))]
    rows = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SCHEMA)
    found = {r["vendor_id"]: r for r in C.segments(rows).collect()}
    base = (dt.date(2024, 1, 1) - dt.date(1970, 1, 1)).days
    assert (found[1]["first_day"], found[1]["n_days"], found[1]["total"], found[1]["n_segments"]) == (base, 4, 12, 1)
    # n*Q - S*S = 4 * 104 - 144 = 272; 272 // 16 = 17
    assert (found[1]["spread"], found[1]["cost"]) == (18, 4 * math.floor(1000 * math.log(18)))
    assert (found[2]["n_days"], found[2]["spread"], found[2]["cost"]) == (1, 1, 0)
    assert found[None]["total"] == 4
    assert C.segments(rows.limit(0)).count() == 0


def test_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/sale_lines.parquet")
    found = {}
    for r in C.segments(rows, least=5, penalty=4_000).orderBy("vendor_id", "segment_no").collect():
        found.setdefault(r["vendor_id"], []).append(r)
    sums = {}
    for r in C.daily(rows, "vendor_id", "quantity", "shipped_at").collect():
        sums.setdefault(r["key"], {})[r["day"]] = r["total"]
    assert found.keys() == sums.keys()
    for key, days in sums.items():
        first = min(days)
        x = [days.get(first + i, 0) for i in range(max(days) - first + 1)]
        whole, cuts = brute(x, 5, 4_000)
        assert [(r["first_day"] - first, r["first_day"] - first + r["n_days"]) for r in found[key]] == cuts
        assert {r["best_cost"] for r in found[key]} == {whole}
        assert [r["total"] for r in found[key]] == [sum(x[s:t]) for s, t in cuts]


def test_series_that_batches_cut(spark):
    """Keys go on over the edges of Arrow batches and of groups of series."""
    rows = spark.read.parquet(f"{SF}/sale_lines.parquet")
    whole = sorted(C.segments(rows).collect())
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 17)
    together, C.TOGETHER = C.TOGETHER, 300
    try:
        assert sorted(C.segments(rows).collect()) == whole
    finally:
        C.TOGETHER = together
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_invariance(spark):
    rows = spark.read.parquet(f"{SF}/sale_lines.parquet")
    assert sorted(C.segments(rows).collect()) == sorted(C.segments(rows.repartition(7, F.rand(3))).collect())
