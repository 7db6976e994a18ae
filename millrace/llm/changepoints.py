r"""Penalised change points of daily sums: exact PELT with a minimum length.

A key's series is the sum of a value per day, from its first to its last day, with zeros
between.  ``segments`` cuts it so that the costs of the segments and a penalty for each cut
are least.  With n days, sum S and sum of squares Q a segment costs
``n * floor(1000 * ln(V))`` where ``V = 1 + floor((n*Q - S*S) / (n*n))``.

Pruning.  Without the two floors this cost is superadditive: splitting never makes it
larger, since n times the variance of a union is at least that of its parts and ln is
concave.  The floors lose a little of that.  Let A be a segment that ends where B begins, U
their union, and W = (nA*VA + nB*VB) / n.  Then

    cost(A) + cost(B) <= 1000 * n * ln(W)           (ln is concave)
    cost(U) > n * (1000 * ln(VU) - 1)               (floor of the logarithm)
    W < VU + 1                                       (floor of the variance)

so what is lost is below ``n * (1000 * ln(1 + 1/VU) + 1)``.  VU is at least
``1 + floor(nA*(VA-1)/n)`` and n at most the days from the start of A to the end of the
series; with both the bound holds for every B at once.  A start s is dropped at the day t
if ``best(s) + cost(s, t) - bound > best(t)``: strictly, so a start that could take part in
a tie stays.  It is dropped only for ends at least a minimum length after t, as before that
no segment from t to there exists.

Scale: rows become (key, day) sums on the map side first, so a key with a third of all rows
sends one row per task and day.  A task then gets a key's days, whose number is that
of the calendar and not of the rows.

Defined cases: rows without value or time do not count; a null key is a key of its own;
repeated rows count as often as they occur; a series shorter than twice the minimum is
one segment; an empty table gives no segment; extra columns are ignored.  Values are whole
numbers, sums of any size stay exact.  Ties: fewest segments, then earliest starts, compared
from the last segment backwards.  A key whose days are centuries apart costs time
with the square of its days.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_DAYS = 14
PENALTY = 40_000
#: Series times the days of the longest that one call cuts together; the number changes the time only.
TOGETHER = 40_000


@dataclass(frozen=True)
class Segment:
    first: int
    n: int
    total: int
    spread: int
    cost: int


class Series:
    """Exact segment statistics of several series of whole numbers by prefix sums.

    Positions are those of the joined prefix sums: ``at[k]`` is where series k begins.
    """

    def __init__(self, many: list[np.ndarray]):
        self.lengths = np.array([len(x) for x in many], dtype=np.int64)
        self.at = np.cumsum(np.concatenate([[0], self.lengths[:-1] + 1]))
        # The spread does not change if all values of a series move by the same amount.
        self.low = [int(x.min()) for x in many]
        tops = [int(x.max()) - low for x, low in zip(many, self.low)]
        safe = all(n * n * top * top < 1 << 62 for n, top in zip(self.lengths.tolist(), tops))
        kind = np.int64 if safe else object
        moved = [np.array([0, *(v - low for v in x.tolist())], dtype=kind) for x, low in zip(many, self.low)]
        self.sums = np.concatenate([np.cumsum(x) for x in moved])
        self.squares = np.concatenate([np.cumsum(x * x) for x in moved])

    def costs(self, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Costs and spreads of the segments between positions of the prefix sums."""
        n = ends - starts
        s, q = self.sums[ends] - self.sums[starts], self.squares[ends] - self.squares[starts]
        v = 1 + (n * q - s * s) // (n * n)
        return n * np.floor(1000 * np.log(v.astype(np.float64))).astype(np.int64), v.astype(np.int64) if v.dtype != object else v

    def segments(self, k: int, cuts: list[int]) -> list[Segment]:
        """The segments of series k between consecutive ``cuts``."""
        where = self.at[k] + np.array(cuts)
        costs, spreads = self.costs(where[:-1], where[1:])
        return [
            Segment(s, t - s, int(self.sums[self.at[k] + t] - self.sums[self.at[k] + s]) + (t - s) * self.low[k], int(v), int(c))
            for s, t, v, c in zip(cuts, cuts[1:], spreads, costs)
        ]


def lost(n: np.ndarray, spread: np.ndarray, longest: np.ndarray) -> np.ndarray:
    """What splitting behind a segment of ``n`` days can add to the cost of any union of up to ``longest`` days."""
    union = 1 + (n * (spread - 1)) // longest
    return np.ceil(longest * (1000 * np.log1p(1 / union.astype(np.float64)) + 1)).astype(np.int64) + 1


def cut_many(many: list[np.ndarray], least: int = MIN_DAYS, penalty: int = PENALTY) -> list[tuple[list[Segment], int]]:
    """The best segments of each series and their whole cost with penalties.

    All series take each step together; a step is a few operations on all their open starts.
    """
    if not many:
        return []
    order = sorted(range(len(many)), key=lambda k: -len(many[k]))
    series = Series([many[k] for k in order])
    lengths, at = series.lengths, series.at
    longest = int(lengths[0])
    size = (len(order), longest + 1)
    never = np.iinfo(np.int64).max
    best = np.zeros(size, dtype=np.int64)
    best[:, 0] = -penalty
    used, previous = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
    gone = np.full(size, never, dtype=np.int64)  # from which end on a start is dropped
    open_ = np.zeros(size, dtype=bool)
    open_[:, 0] = True
    for end in range(least, longest + 1):
        active = int(np.searchsorted(-lengths, -end, side="right"))  # the longest series come first
        if end >= 2 * least:
            open_[:active, end - least] = True
        open_[:active, : end + 1] &= gone[:active, : end + 1] > end
        k, start = np.nonzero(open_[:active, : end - least + 1])
        first = np.searchsorted(k, np.arange(active))
        cost, spread = series.costs(at[k] + start, at[k] + end)
        reached = best[k, start] + cost
        least_cost = np.minimum.reduceat(reached, first)
        tied = reached == least_cost[k]
        cuts = np.where(tied, used[k, start], never)
        fewest = np.minimum.reduceat(cuts, first)
        earliest = np.minimum.reduceat(np.where(tied & (cuts == fewest[k]), start, never), first)
        best[:active, end], used[:active, end], previous[:active, end] = least_cost + penalty, fewest + 1, earliest
        drop = np.flatnonzero(reached - lost(end - start, spread, lengths[k] - start) > best[k, end])
        if len(drop):
            gone[k[drop], start[drop]] = np.minimum(gone[k[drop], start[drop]], end + least)
    out: list = [None] * len(many)
    for i, k in enumerate(order):
        n = int(lengths[i])
        if n < 2 * least:
            one = series.segments(i, [0, n])
            out[k] = one, one[0].cost
            continue
        cuts = [n]
        while cuts[-1]:
            cuts.append(int(previous[i, cuts[-1]]))
        out[k] = series.segments(i, cuts[::-1]), int(best[i, n])
    return out


def cut_series(values: np.ndarray, least: int = MIN_DAYS, penalty: int = PENALTY) -> tuple[list[Segment], int]:
    return cut_many([values], least, penalty)[0]


def daily(rows: DataFrame, key_col: str, value_col: str, time_col: str) -> DataFrame:
    """``key, day, total``: sums per key and day (days since 1970) of the rows that have both."""
    return (
        rows.filter(F.col(value_col).isNotNull() & F.col(time_col).isNotNull())
        .groupBy(F.col(key_col).alias("key"), F.unix_date(F.to_date(F.col(time_col))).alias("day"))
        .agg(F.sum(F.col(value_col).cast("bigint")).alias("total"))
    )


_OUT = "segment_no int, first_day bigint, n_days bigint, total bigint, spread bigint, cost bigint, n_segments bigint, best_cost bigint"


def segments(
    rows: DataFrame,
    key_col: str = "vendor_id",
    value_col: str = "quantity",
    time_col: str = "shipped_at",
    least: int = MIN_DAYS,
    penalty: int = PENALTY,
) -> DataFrame:
    """The best segments of every key's series, one row per segment."""
    key_type = rows.schema[key_col].dataType.simpleString()
    names = [field.split()[0] for field in _OUT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []  # series that are whole

        def flush() -> pa.RecordBatch:
            out = []
            for (key, first, _), (found, whole) in zip(waiting, cut_many([w[2] for w in waiting], least, penalty)):
                out += [(key, i + 1, first + s.first, s.n, s.total, s.spread, s.cost, len(found), whole) for i, s in enumerate(found)]
            waiting.clear()
            kinds = [kind, pa.int32(), *[pa.int64()] * 7]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["key", *names])

        kind, rest = None, None
        for batch in batches:
            if kind is None:
                kind = batch.schema.field("key").type
            whole = pa.concat_tables([rest, pa.Table.from_batches([batch])]) if rest is not None else pa.Table.from_batches([batch])
            *ready, rest = list(_runs(whole))
            for part in map(_dense, ready):
                if waiting and (len(waiting) + 1) * max(len(part[2]), *(len(w[2]) for w in waiting)) > TOGETHER:
                    yield flush()
                waiting.append(part)
        if rest is not None:
            waiting.append(_dense(rest))
        if waiting:
            yield flush()

    days = daily(rows, key_col, value_col, time_col)
    # A key's days are neighbours in one partition; their number is the calendar's.
    days = days.repartition("key").sortWithinPartitions("key", "day")
    return days.mapInArrow(run, f"key {key_type}, {_OUT}").withColumnRenamed("key", key_col)


def _runs(table: pa.Table) -> Iterator[pa.Table]:
    """Consecutive rows of one key; the last run may go on in the next batch."""
    codes = table.column("key").combine_chunks().dictionary_encode("encode")
    codes = (codes.combine_chunks() if isinstance(codes, pa.ChunkedArray) else codes).indices.to_numpy()
    ends = np.append(np.flatnonzero(codes[1:] != codes[:-1]) + 1, len(codes))
    start = 0
    for end in ends.tolist():
        yield table.slice(start, end - start)
        start = end


def _dense(part: pa.Table) -> tuple:
    """Key, first day and the values of all days."""
    days = part.column("day").to_numpy()
    values = np.zeros(int(days[-1]) - int(days[0]) + 1, dtype=np.int64)
    values[days - days[0]] = part.column("total").to_numpy()
    return part.column("key")[0].as_py(), int(days[0]), values
