import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from millrace.llm import katz as K


def words(text):
    low = re.sub(b"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    return [*re.findall(rb"[^\x20\x09-\x0D]+", low), None]


class Brute:
    """The same model with dictionaries."""

    def __init__(self, texts):
        self.c1, self.c2 = Counter(), Counter()
        for t in texts:
            w = words(t)
            self.c1.update(w)
            self.c2.update(zip(["start", *w[:-1]], w))
        self.n, self.v = sum(self.c1.values()), len(self.c1)
        seen = lambda c: [sum(x == r for x in c.values()) for r in range(1, K.K + 2)]
        self.d1, self.d2 = ({r: x for r, x in enumerate(K.good_turing(seen(c)))} for c in (self.c1, self.c2))
        mass = {w: self.d1.get(c, 1) * c / self.n for w, c in self.c1.items()}
        kept = sum(mass.values())
        self.unknown = max(1 - kept, 1 / (self.n + 1))
        self.p1 = {w: m * (1 - self.unknown) / kept for w, m in mass.items()}
        self.cv, seen_mass, lower = Counter(), defaultdict(float), defaultdict(float)
        for (v, w), c in self.c2.items():
            self.cv[v] += c
            seen_mass[v] += self.d2.get(c, 1) * c
            lower[v] += self.p1[w]
        self.div = {v: n + 1 if seen_mass[v] >= n - 1e-9 else n for v, n in self.cv.items()}
        self.alpha = {v: (1 - seen_mass[v] / self.div[v]) / (1 - lower[v]) for v in self.cv}

    def p(self, w, v):
        c = self.c2.get((v, w))
        if c:
            return self.d2.get(c, 1) * c / self.div[v]
        return self.alpha.get(v, 1) * self.p1.get(w, self.unknown)

    def score(self, text):
        w = words(text)
        return sum(math.log10(self.p(x, v)) for v, x in zip(["start", *w[:-1]], w)), sum(math.log10((self.c1[x] + 1) / (self.n + self.v + 1)) for x in w), sum(self.c1[x] > 0 for x in w), len(w)


@pytest.fixture(params=["one bucket", "many buckets"])
def layout(request, monkeypatch):
    if request.param == "many buckets":
        for name, value in (("CACHED", 200), ("BUCKET_TOKENS", 20_000), ("HOT", 0.01), ("SAMPLE_ROWS", 60), ("BOOK", 40)):
            monkeypatch.setattr(K, name, value)


def test_against_brute_force(docs, texts, layout):
    held = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 7 == 2
    model = Brute([t for i, t in texts if not held(i)])
    out = defaultdict(list)
    for r in K.lm_score(docs).collect():
        out[r["doc_id"]].append(r)
    assert sum(map(len, out.values())) == len(texts)
    for i, t in texts:
        score, base, known, n = model.score(t)
        r = out[i][0]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held(i), n, known, model.n)
        assert r["score"] == pytest.approx(score, abs=1e-5, rel=1e-7) and r["base_score"] == pytest.approx(base, abs=1e-5, rel=1e-7)


def test_probabilities_sum_to_one(texts):
    model = Brute([t for _, t in texts[:60]])
    assert sum(model.p1.values()) + model.unknown == pytest.approx(1)
    for v in list(model.cv)[:40]:
        assert sum(model.p(w, v) for w in model.c1) + model.p("never seen", v) == pytest.approx(1, abs=1e-9)


def test_discounts():
    d = K.good_turing([int(1e6 * r**-1.5) for r in range(1, 7)])
    assert ((d[1:6] > 0) & (d[1:6] < 1)).all() and (np.diff(d[1:6]) > 0).all() and d[6] == 1
    odd = K.good_turing([10, 0, 3, 0, 1, 0])
    assert odd[1] == 0.5 and odd[5] == 0.9
    assert K.good_turing([0] * 6)[1] == 0.5


def test_small_tables(spark, nothing):
    assert K.lm_score(nothing).count() == 0
    held_only = spark.createDataFrame([(i, "a b") for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2], "doc_id long, text string")
    rows = K.lm_score(held_only).collect()
    assert rows and all((r["train_tokens"], r["n_known"], r["score"], r["base_score"]) == (0, 0, 0.0, 0.0) for r in rows)
    same = spark.createDataFrame([(i, "a a") for i in range(50)], "doc_id long, text string")
    assert all(-1 < r["score"] < 0 for r in K.lm_score(same).collect())


def test_word_buckets_ask_each_context_bucket_once(docs, monkeypatch):
    for name, value in (("CACHED", 200), ("BUCKET_TOKENS", 20_000), ("SAMPLE_ROWS", 60)):
        monkeypatch.setattr(K, name, value)
    rows = docs.selectExpr("doc_id", "false AS held_out", "text").repartition(6)
    layout = K.plan_layout(rows)
    model = K.train(rows, layout)
    asked = K._ask(rows, model, "bigint")
    questions = K._answer_words(asked, model, "bigint").filter(f"part = {K._QUESTION}").count()
    assert layout.buckets > 1 and asked.select("chunk").distinct().count() == 6
    assert 0 < questions <= layout.buckets**2
