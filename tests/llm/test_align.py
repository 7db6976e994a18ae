import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from millrace.llm import align as A

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["日本語 テキスト 😀 ﬁ ß İ \x85\xa0", "<|endoftext|> <s> </s> <0x41> <unk>", "a▁b", "x\x00y", " ", "\n\n  a", "👩‍👩‍👧", "a" * 5000]


@pytest.fixture(scope="module")
def both():
    return A.sides(*PATHS)


def ends(side, ids):
    return np.cumsum([len(side.tokens[i]) for i in ids]).tolist()


def brute(text, both):
    """Ids, the groups between common ends, and all pairs of occurrences that end together."""
    a, b = both
    if not text:
        return None
    ids_a, ids_b = a.encode(text), b.encode(text)
    if a.joined(ids_a) != b" " + text.encode() or b.joined(ids_b) != b" " + text.encode():
        return None
    ends_a, ends_b = ends(a, ids_a), ends(b, ids_b)
    groups, before = [], 0
    for end in sorted({*ends_a} & {*ends_b}):
        part = [[i for i, e in zip(ids, at) if before < e <= end] for ids, at in ((ids_a, ends_a), (ids_b, ends_b))]
        groups.append(part)
        before = end
    at = {e: i for i, e in zip(ids_b, ends_b)}
    return ids_a, ids_b, groups, [(i, at[e]) for i, e in zip(ids_a, ends_a) if e in at]


def test_rank_encoder_equals_the_library(both):
    """On every code point between letters, digits, blanks and marks: the character classes of both agree."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(PATHS[0])
    library.encode_special_tokens = True
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [f"{c} x{c}1{c}{c}. {c}" for c in points]
    for at in range(0, len(texts), 20_000):
        part = texts[at : at + 20_000]
        for text, want in zip(part, library.encode_batch_fast([" " + t for t in part], add_special_tokens=False)):
            assert both[0].encode(text) == want.ids, repr(text)
    for text in [*ODD, "it's we'LL they've  \n \t x", " " * 3_000 + "x" + "\n" * 3_000]:
        assert both[0].encode(text) == library.encode(" " + text, add_special_tokens=False).ids


def test_very_long_blank_runs(both):
    a, b = both
    for text in (" " * 400_000, "x" + "\n" * 400_000 + "y"):
        ids_a, ids_b = A.encode(text, a, b)
        assert len(A.groups(a.ends(ids_a), b.ends(ids_b))[0]) > 0


def test_overlaps(both):
    a, b = both
    for text in ["unbelievable misalignments, 1234567 words", *ODD]:
        ids_a, ids_b = A.encode(text, a, b)
        ends_a, ends_b = ends(a, ids_a), ends(b, ids_b)
        first, after = A.overlaps(np.array(ends_a, dtype=np.int64), np.array(ends_b, dtype=np.int64))
        for i, (lo, hi) in enumerate(zip(first, after)):
            start = ends_a[i - 1] if i else 0
            touched = [j for j in range(len(ends_b)) if (ends_b[j - 1] if j else 0) < ends_a[i] and ends_b[j] > start]
            assert touched == list(range(lo, hi))


def test_query_equals_brute_force(spark, docs, both):
    rows = {}
    for r in docs.select("doc_id", "text").collect():
        if r["text"] is None or len(r["text"]) < 20_000:
            rows.setdefault(r["doc_id"], []).append(r["text"])
    small = docs.filter("text IS NULL OR length(text) < 20000")
    more = spark.createDataFrame([(90_000 + i, t) for i, t in enumerate(ODD)], "doc_id bigint, text string")
    for i, t in enumerate(ODD):
        rows[90_000 + i] = [t]
    found = A.alignment(small.unionByName(more, allowMissingColumns=True), *PATHS).collect()
    known = {key: [brute(t, both) for t in texts] for key, texts in rows.items()}
    counts = Counter(pair for many in known.values() for k in many if k for pair in k[3])
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    want = []
    for key, many in known.items():
        for k in many:
            if k is None:
                want.append((key, 0, 0, 0, 0, 0, 0, ""))
                continue
            ids_a, ids_b, groups, links = k
            text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
            best = sum(counts[p] == most[p[1]] for p in links)
            want.append((key, len(ids_a), len(ids_b), len(groups), len(links), best, sum(counts[p] for p in links), hashlib.sha256(text.encode()).hexdigest()))
    order = lambda t: (t[0] is None, t)
    assert sorted(map(tuple, found), key=order) == sorted(want, key=order)
    assert len(counts) <= A.most_pairs(*both)


def test_bound_of_pairs_by_hand():
    side = lambda *tokens: A.Side(None, list(tokens))
    # (ab, b), (ab, ab), (b, b), (b, ab), (cb, b)
    assert A.most_pairs(side(b"ab", b"b", b"cb"), side(b"b", b"ab")) == 5


def test_long_text_and_joins_by_sorting(spark, docs):
    long = docs.filter("doc_id IN (10007, 10008)")
    one = A.alignment(long, *PATHS).collect()
    assert one[0][1:] == one[1][1:] and one[0]["n_links"] > 30_000
    assert sorted(A.alignment(docs, *PATHS, broadcast_pairs=0).collect(), key=str) == sorted(A.alignment(docs, *PATHS).collect(), key=str)


def test_groups_of_a_table(spark, docs):
    for r in A.aligned(docs.filter("doc_id < 40"), *PATHS).collect():
        assert len(r["a_cuts"]) == len(r["b_cuts"])
        assert r["a_cuts"][-1:] == [len(r["a_ids"])] or not r["a_ids"]


def test_empty(nothing):
    assert A.alignment(nothing, *PATHS).count() == 0
