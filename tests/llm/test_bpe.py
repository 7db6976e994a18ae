import base64
import hashlib
import random
import struct

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import bpe as B

PATH = P.path("byte_bpe_50k.tiktoken")
DATA = open(PATH, "rb").read()
RANKS = {base64.b64decode(a): int(b) for a, b in (x.split() for x in DATA.splitlines())}
REAL = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
CODEC = B.Codec(B.read_ranks(DATA), P.PATTERN)


def test_query_against_the_library(docs, texts):
    out = {}
    for r in B.digest(docs, PATH, P.PATTERN, with_ids=True).collect():
        out.setdefault(r["doc_id"], []).append(r)
    for i, t in texts:
        ids = REAL.encode_ordinary(t or "")
        want = (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest(), ids)
        assert any((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], list(r["token_ids"])) == want for r in out[i])


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("abehinotr 'sS\n\t12.é中😀 _-"), max_size=60))
def test_any_text(text):
    ids = CODEC.encode(text)
    assert ids == REAL.encode_ordinary(text) and CODEC.decode_bytes(CODEC.packed(text)) == text.encode()


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 2000, " " * 3000, "x\x85 y", "<|endoftext|>", "İstanbul ß ﬁ"])
def test_odd_texts(text):
    assert CODEC.encode(text) == REAL.encode_ordinary(text)


def test_prefixes_appends_and_edits():
    rng, v = random.Random(7), CODEC.vocabulary
    text = "".join(rng.choice("theinrsaou") for _ in range(600)).encode()
    grown = B.PrefixTable(v)
    for at in range(0, len(text), 37):
        grown.append(text[at : at + 37])
    whole = B.PrefixTable(v, text)
    assert grown.last == whole.last and all(whole.tokens(n) == v.merge(text[:n], len(v.tokens)) for n in range(0, 600, 13))
    for _ in range(50):
        table, start = B.PrefixTable(v, text), rng.randrange(600)
        stop, new = min(600, start + rng.randrange(9)), bytes(rng.choice(b"etaoin") for _ in range(rng.randrange(9)))
        computed = table.replace(start, stop, new)
        assert table.last == B.PrefixTable(v, text[:start] + new + text[stop:]).last
        assert computed <= len(new) + 4 * v.longest


def test_columns(spark, docs, nothing):
    coded = B.encode_column(docs, PATH, P.PATTERN)
    assert coded.columns == [*docs.columns, "token_ids"]
    back = B.decode_column(coded, PATH, P.PATTERN)
    assert back.filter("decoded != coalesce(text, '')").count() == 0
    assert B.digest(nothing, PATH, P.PATTERN).count() == 0
