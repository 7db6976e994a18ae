import re
from collections import Counter

from pyspark.sql import functions as F

from millrace.llm import quality as Q

W = r"[^\x20\x09-\x0D]+"


def brute(text):
    t = text or ""
    w = re.findall(W, t)
    grams = list(zip(w, w[1:], w[2:]))
    n = Counter(grams)
    covered = {j for i, g in enumerate(grams) if n[g] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if re.search(W, x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def test_counts_against_brute_force(docs, texts):
    out = Q.measure(docs).collect()
    got = sorted((str(r["doc_id"]), r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in out)
    assert got == sorted((str(i), *brute(t)) for i, t in texts)


def planted(spark):
    """Texts the base rule keeps: some with many symbols and some of short words are bad, as are a few that nothing tells."""
    rows, labels = [], []
    for i in range(600):
        kind = i % 6
        words = [f"{'w' if kind == 1 else 'word'}{i % 7}{'x' if kind == 1 else 'xxxx'}{j}" for j in range(80 + i % 9)]
        rows.append((i, " ".join(words) + " ###########" * (30 if kind == 0 else 0)))
        labels.append((i, 0 if kind == 0 or kind == 1 or i % 41 == 0 else 1))
        if i % 50 == 0:
            rows.append((1000 + i, "bad " * 70))  # the base rule rejects it
            labels.append((1000 + i, 0))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_learns_planted_rules(spark):
    docs, labels = planted(spark)
    m = Q.measure(docs).cache()
    rules = Q.learn(m, labels)
    assert len(rules.rules) >= 2 and all(r.precision >= 0.9 for r in rules.rules)
    fired = {r["doc_id"] for r in m.filter(rules.column().isNotNull()).collect() if r["doc_id"] < 1000}
    assert fired == {i for i in range(600) if i % 6 < 2}
    assert "CASE WHEN" in rules.sql()


def brute_learn(measured, labels, bins=24, max_tests=4, min_precision=0.9, min_covered=5):
    """Sequential covering over plain rows."""
    import math

    bad = {}
    for d, q in labels:
        if q is not None:
            bad[d] = bad.get(d, False) or q == 0
    features = {n: compile(sql.replace("greatest", "max"), n, "eval") for n, sql in Q.FEATURES.items()}
    rows = []
    for r in measured:
        if r["doc_id"] in bad and not (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]):
            rows.append((dict(zip(features, map(lambda f: float(eval(f, {"max": max}, r)), features.values()))), bad[r["doc_id"]], r["prune"]))
    cuts = {}
    for n in features:
        found = set()
        for kind in (True, False):
            values = sorted(x[n] for x, b, _ in rows if b == kind)
            found |= {values[max(math.ceil(len(values) * i / bins) - 1, 0)] for i in range(1, bins)} if values else set()
        cuts[n] = sorted(found)
    holds = lambda x, t: (x[t[0]] > t[2]) == t[1]
    all_hold = lambda x, tests: all(holds(x, t) for t in tests)
    rules, aside = [], []
    while len(rules) < 16 and len(aside) < 8:
        left = [r for r in rows if not any(all_hold(r[0], t) for t in rules)]
        grow = [r for r in left if not r[2] and not any(all_hold(r[0], t) for t in aside)]
        tests = []
        while len(tests) < max_tests:
            p0 = sum(b for _, b, _ in grow)
            n0 = len(grow) - p0
            best = None
            for n in features if p0 and n0 else ():
                for c in cuts[n]:
                    for above in (False, True):
                        inside = [b for x, b, _ in grow if (x[n] > c) == above]
                        p1 = sum(inside)
                        gain = p1 * (math.log2(p1 / len(inside)) - math.log2(p0 / (p0 + n0))) if p1 else 0
                        if gain > 0 and (best is None or gain > best[0] + 1e-9):
                            best = (gain, n, above, c, len(inside) - p1)
            if best is None:
                break
            _, n, above, c, wrong = best
            low, high = max((x[n] for x, _, _ in grow if x[n] <= c), default=None), min((x[n] for x, _, _ in grow if x[n] > c), default=None)
            if low is not None and high is not None:
                c = low + (high - low) / 2
            tests.append((n, above, c))
            grow = [r for r in grow if holds(r[0], tests[-1])]
            if not wrong:
                break
        held = [r for r in left if r[2]]
        if not tests or sum(b for _, b, _ in held) < min_covered:
            return rules
        worth = []
        for k in range(len(tests)):
            inside = [b for x, b, _ in held if all_hold(x, tests[: k + 1])]
            worth.append(((2 * sum(inside) - len(inside)) / max(len(inside), 1), sum(inside), -k, len(inside)))
        _, p, k, n = max(worth)
        if n < min_covered or p / n < min_precision:
            aside.append(tests)
        else:
            rules.append(tests[: 1 - k])
    return rules


def test_learner_against_brute_force(spark):
    docs, labels = planted(spark)
    real = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    for docs, labels in ((docs, labels), real):
        m = Q.measure(docs).withColumn("prune", F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).cache()
        expected = brute_learn([r.asDict() for r in m.collect()], [(r["doc_id"], r["quality"]) for r in labels.collect()])
        found = Q.learn(m, labels).rules
        tight = [{(n, above): c for n, above, c in tests} for tests in expected]  # a later test on one side is the tighter one
        assert found and [{(t.feature, t.above): t.threshold for t in r.tests} for r in found] == tight


def test_judge_and_filter_agree(docs, labels):
    judged = Q.judge(docs, labels)
    n = judged.filter("kept").count()
    assert judged.count() == docs.count()
    assert judged.filter("base_failed and kept").count() == 0
    assert judged.filter("base_failed != (n_words < 50 or 100 * n_repeat_words > 50 * n_words)").count() == 0
    kept = Q.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == n


def test_without_labels(docs, labels, nothing):
    assert Q.learn(Q.measure(docs), labels.filter("false")).rules == ()
    assert Q.learn(Q.measure(docs), labels.withColumn("quality", F.lit(1))).rules == ()
    assert Q.judge(nothing, labels).count() == 0


def test_learning_on_counts_that_are_not_written(spark):
    """The filter on the base rule stays above the counts, so they are computed once."""
    docs, labels = planted(spark)
    assert Q.learn(Q.measure(docs), labels).rules == Q.learn(Q.measure(docs).cache(), labels).rules
