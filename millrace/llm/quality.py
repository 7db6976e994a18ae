r"""Quality rules learned as decision lists (DataFrame functions only).

``measure`` turns each text into a few counts.  ``learn`` runs sequential covering
over the labelled rows that the base rule leaves: it grows one conjunction of
thresholds at a time on two thirds of them by FOIL gain, prunes it on the other
third, keeps it if it is precise there, and goes on with the rows that no rule covers.
What a rule that is not precise covers is set aside, and the next one is grown on the
rest, until the rows left hold too few bad ones to tell.  Every such row takes part;
a step is one aggregation to (feature, bin) counts, so the driver sees some hundred
numbers at a time.  The result is an ordered list of rules that
``DecisionList.column`` renders as one Spark ``CASE WHEN`` expression.

Defined cases: a null text counts as empty and fails the base rule (fewer than 50
words); null labels and labels of unknown documents are ignored; of labels that repeat
an id the smallest counts; rows that repeat an id are judged one by one; without labels of both kinds the list is empty and
the base rule alone decides; extra columns are ignored by ``judge`` and kept by
``keep_good``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, cut, drop_cut, read_cut, text_or_empty, write_cut

#: What the learner may test: name -> Spark SQL over the counts of ``measure``.
FEATURES = {
    "n_words": "n_words",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "exclamations_per_word": "n_exclaim / greatest(n_words, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
}
BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"


def _removed(text: Column, pattern: str) -> Column:
    """How many characters ``pattern`` matches."""
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the counts, one row per row of ``docs``."""
    text = F.col("_text")
    step = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("_text"))
    step = step.select("*", F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("_words"))
    words = F.col("_words")
    window = F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    step = step.select(
        "doc_id",
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        _removed(text, r"[#*$%&|<>]+").alias("n_symbols"),
        _removed(text, r"[A-Z]+").alias("n_upper"),
        _removed(text, r"[0-9]+").alias("n_digits"),
        _removed(text, r"!+").alias("n_exclaim"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
        F.when(F.size(words) > 3, F.slice(window, F.lit(1), F.size(words) - 2)).alias("_windows"),
    )
    lines, windows = F.col("_lines"), F.col("_windows")
    # Few texts repeat a window; only theirs are sorted.
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    step = step.select(
        "*",
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct(windows)) < F.size(windows), placed).alias("_placed"),
    ).drop("_lines", "_windows")
    placed = F.col("_placed")
    same = lambda e, i: F.coalesce(F.get(placed, i - 1)["h"] == e["h"], F.lit(False)) | F.coalesce(
        F.get(placed, i + 1)["h"] == e["h"], F.lit(False)
    )
    starts = F.transform(F.filter(placed, same), lambda e: e["i"])
    covered = F.array_distinct(F.flatten(F.transform(starts, lambda p: F.array(p, p + 1, p + 2))))
    return step.withColumn("n_repeat_words", F.coalesce(F.size(covered).cast("long"), F.lit(0).cast("long"))).withColumn(
        "n_repeat_words", F.when(placed.isNull(), F.lit(0).cast("long")).otherwise(F.col("n_repeat_words"))
    ).drop("_placed")


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    threshold: float

    def sql(self) -> str:
        return f"({FEATURES[self.feature]}) {'>' if self.above else '<='} {self.threshold!r}D"


@dataclass(frozen=True)
class Rule:
    tests: tuple[Test, ...]
    precision: float
    covered: int

    def sql(self) -> str:
        return " AND ".join(t.sql() for t in self.tests)


@dataclass(frozen=True)
class DecisionList:
    rules: tuple[Rule, ...]

    def sql(self) -> str:
        """The number of the first rule that fires, null if none does."""
        if not self.rules:
            return "CAST(NULL AS INT)"
        return "CASE " + " ".join(f"WHEN {r.sql()} THEN {i}" for i, r in enumerate(self.rules)) + " END"

    def column(self) -> Column:
        return F.expr(self.sql())


def _gain(p0: int, n0: int, p1: int, n1: int) -> float:
    """FOIL's information gain of going from (p0, n0) to (p1, n1) covered rows."""
    if not p1:
        return 0.0
    return p1 * (math.log2(p1 / (p1 + n1)) - math.log2(p0 / (p0 + n0)))


def _thresholds(rows: DataFrame, bins: int) -> dict[str, list[float]]:
    """At most ``bins`` - 1 distinct quantiles of each feature among bad and among good rows."""
    at = [i / bins for i in range(1, bins)]
    aggs = [
        F.percentile_approx(F.when(F.col("bad") == bad, F.expr(sql).cast("double")), at, 10_000).alias(f"{name}_{int(bad)}")
        for name, sql in FEATURES.items()
        for bad in (True, False)
    ]
    found = rows.agg(*aggs).collect()[0].asDict()
    return {name: sorted({*(found[f"{name}_1"] or []), *(found[f"{name}_0"] or [])}) for name in FEATURES}


def _histogram(rows: DataFrame, cuts: dict[str, list[float]]) -> dict[str, list[list[int]]]:
    """Counts [bad, good] for each bin of each feature; bin b holds values in (cut b-1, cut b]."""

    def bin_of(name: str) -> Column:
        limits = F.array(*[F.lit(float(x)) for x in cuts[name]]) if cuts[name] else F.array().cast("array<double>")
        return F.size(F.filter(limits, lambda x: F.expr(FEATURES[name]) > x))

    cells = rows.select(
        "bad", F.explode(F.array(*[F.struct(F.lit(n).alias("f"), bin_of(n).alias("b")) for n in FEATURES])).alias("c")
    )
    out = {n: [[0, 0] for _ in range(len(cuts[n]) + 1)] for n in FEATURES}
    for row in cells.groupBy("c.f", "c.b").agg(
        F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n")
    ).collect():
        out[row["f"]][row["b"]] = [row["p"], row["n"]]
    return out


def _best_test(hist: dict[str, list[list[int]]], cuts: dict[str, list[float]]) -> tuple[float, Test, int, int] | None:
    best = None
    for name, cells in hist.items():
        total_p, total_n = (sum(c[k] for c in cells) for k in (0, 1))
        if not total_p or not total_n:
            continue
        below_p = below_n = 0
        for threshold, (p, n) in zip(cuts[name], cells):
            below_p, below_n = below_p + p, below_n + n
            for above, p1, n1 in ((False, below_p, below_n), (True, total_p - below_p, total_n - below_n)):
                gain = _gain(total_p, total_n, p1, n1)
                if gain > 0 and (best is None or gain > best[0] + 1e-9):
                    best = (gain, Test(name, above, threshold), p1, n1)
    return best


def _centred(rows: DataFrame, tests: list[Test]) -> list[Test]:
    """The same splits of ``rows`` one after another, with thresholds midway between the values on their two sides."""
    sides = []
    for i, test in enumerate(tests):
        value = F.expr(" AND ".join(["true", *(t.sql() for t in tests[:i])]))
        value = F.when(value, F.expr(FEATURES[test.feature]).cast("double"))
        sides += [F.max(F.when(value <= test.threshold, value)).alias(f"low{i}"), F.min(F.when(value > test.threshold, value)).alias(f"high{i}")]
    found = rows.agg(*sides).collect()[0].asDict()
    out = []
    for i, test in enumerate(tests):
        low, high = found[f"low{i}"], found[f"high{i}"]
        if low is not None and high is not None:
            middle = low + (high - low) / 2
            test = Test(test.feature, test.above, middle if low <= middle < high else low)
        out.append(test)
    return out


def _tightest(tests: list[Test]) -> tuple[Test, ...]:
    """Without tests that a later one on the same feature and side implies."""
    last: dict[tuple[str, bool], Test] = {}
    for t in tests:
        key = (t.feature, t.above)
        if key not in last or (t.threshold > last[key].threshold) == t.above:
            last[key] = t
    return tuple(last.values())


def learn(
    measured: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    max_rules: int = 16,
    max_aside: int = 8,
    max_tests: int = 4,
    bins: int = 24,
    min_precision: float = 0.9,
    min_covered: int = 5,
) -> DecisionList:
    """Decision list whose rules find rows that ``labels`` marks 0; all other rows are good."""
    known = labels.filter(F.col(label_col).isNotNull()).groupBy("doc_id").agg((F.min(label_col) == 0).alias("bad"))
    keep = ["doc_id", "n_words", "word_chars", "n_symbols", "n_upper", "n_digits", "n_exclaim", "n_lines", "n_dup_lines", "n_repeat_words"]
    # The generated number keeps the filter above the counts: pushed below, each of its tests
    # would compute them anew, and a frame that is not written yet would never end.
    rows = measured.select(*keep, F.monotonically_increasing_id().alias("_number"))
    rows = rows.filter(f"NOT ({BASE_FAILED}) AND _number >= 0").drop("_number")
    rows = rows.join(known, "doc_id").withColumn("_prune", F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0)
    rows = cut(rows, "labelled")
    cuts = _thresholds(rows, bins)
    rules: list[Rule] = []
    aside: list[str] = []
    while len(rules) < max_rules and len(aside) < max_aside:
        left = rows.filter(DecisionList(tuple(rules)).column().isNull())
        start = grow = left.filter(" AND ".join(["NOT _prune", *(f"NOT ({c})" for c in aside)]))
        tests: list[Test] = []
        while len(tests) < max_tests:
            best = _best_test(_histogram(grow, cuts), cuts)
            if best is None:
                break
            tests.append(best[1])
            grow = grow.filter(tests[-1].sql())
            if not best[3]:
                break
        if not tests:
            break
        tests = _centred(start, tests)
        prefixes = [" AND ".join(t.sql() for t in tests[: k + 1]) for k in range(len(tests))]
        sums = [F.count_if(F.expr(f"({c}) AND {'bad' if bad else 'NOT bad'}")).alias(f"{k}_{int(bad)}") for k, c in enumerate(prefixes) for bad in (True, False)]
        held = left.filter("_prune").agg(F.count_if("bad").alias("bad"), *sums).collect()[0].asDict()
        if held["bad"] < min_covered:
            break
        worth = [((held[f"{k}_1"] - held[f"{k}_0"]) / max(held[f"{k}_1"] + held[f"{k}_0"], 1), held[f"{k}_1"]) for k in range(len(tests))]
        k = max(range(len(tests)), key=lambda i: (worth[i], -i))
        p, n = held[f"{k}_1"], held[f"{k}_0"]
        if p + n < min_covered or p / (p + n) < min_precision:
            aside.append(prefixes[-1])
        else:
            rules.append(Rule(_tightest(tests[: k + 1]), p / (p + n), p + n))
    return DecisionList(tuple(rules))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **named) -> DataFrame:
    """Counts, ``base_failed``, ``rule`` (number of the rule that fired) and ``kept`` for every row."""
    measured = cut(measure(docs, id_col, text_col), "measured")
    rules = learn(measured, labels, **named)
    return (
        measured.withColumn("base_failed", F.expr(BASE_FAILED))
        .withColumn("rule", rules.column())
        .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
    )


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **named) -> DataFrame:
    """The filtering form: the rows of ``docs`` that base rule and decision list keep.

    The rules are learned from all rows and then applied to each row's own counts, so
    no join and no shuffle of texts is needed.
    """
    measured = measure(docs, id_col, text_col)
    path = write_cut(measured, "measured")
    rules = learn(read_cut(docs.sparkSession, path, measured), labels, **named)
    drop_cut(docs.sparkSession, path)
    marked = docs.withColumn("_row", F.struct(*docs.columns))
    counts = measure(marked.select("_row", F.col(text_col).alias("_body")), "_row", "_body")
    # The generated number keeps the optimiser from pushing the filter below the counts,
    # where each test would compute them anew.
    counts = counts.withColumn("_number", F.monotonically_increasing_id())
    good = ~F.expr(BASE_FAILED) & rules.column().isNull() & (F.col("_number") >= 0)
    return counts.filter(good).select("doc_id.*")
