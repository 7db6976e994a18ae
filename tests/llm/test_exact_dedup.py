import hashlib
import random
import re
from collections import defaultdict

import pytest

from millrace.llm import exact_dedup as E

norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def test_against_brute_force(docs, texts):
    groups = defaultdict(list)
    for i, t in texts:
        groups[norm(t)].append(i)
    want = sorted((str(i), str(min((x for x in groups[norm(t)] if x is not None), default=None)), len(groups[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest()) for i, t in texts)
    out = E.exact_dedup(docs).collect()
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["text_sha256"]) for r in out) == want
    kept = [r for r in out if r["kept"]]
    assert len(kept) == len(groups) and all(r["doc_id"] == r["keep_id"] for r in kept)


def test_filter_keeps_columns_and_one_row_each(docs, texts):
    out = E.keep_first(docs)
    assert out.columns == docs.columns and out.count() == len({norm(t) for _, t in texts})


def test_store_restores_texts(docs, texts):
    got = E.restore(E.recipes(docs.filter("doc_id is not null and doc_id != 10005")), E.chunk_store(docs))
    assert {r["doc_id"]: r["text"] for r in got.collect()} == {i: norm(t) for i, t in texts if i not in (None, 10_005)}


def test_chunks_follow_content(spark):
    rng = random.Random(1)
    base = " ".join("".join(rng.choice("etaoinshrdlu0123456789") for _ in range(rng.randrange(2, 9))) for _ in range(6000))
    a, b = (r["recipe"] for r in E.recipes(spark.createDataFrame([(1, base), (2, "prefix added in front " + base)], "doc_id long, text string")).orderBy("doc_id").collect())
    shared = {bytes(c["id"]) for c in a} & {bytes(c["id"]) for c in b}
    assert len(shared) > 0.9 * len(a)


def test_disagreeing_identifiers_stop_the_job(spark, monkeypatch):
    rows = spark.createDataFrame([(1, 0, "s", [(bytearray(b"x"), 1, 1)]), (2, 1, "s", [(bytearray(b"x"), 1, 2)])], "doc_id long, _row long, text_sha256 string, recipe array<struct<id:binary,n_chars:int,check:bigint>>")
    with pytest.raises(ValueError):
        E._decide(rows, "doc_id")


def test_empty(nothing):
    assert E.exact_dedup(nothing).count() == 0 and E.keep_first(nothing).count() == 0
