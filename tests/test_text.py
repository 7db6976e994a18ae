"""Text functions against hand-made cases."""

import pytest
from pyspark.sql import functions as F

from millrace.functions import text as X


def one(spark, f, value):
    return spark.createDataFrame([(value,)], "c string").select(f(F.col("c"))).collect()[0][0]


@pytest.mark.parametrize(
    ("f", "value", "expected"),
    [
        (X.strip_html, "<p>Hello <b>World</b></p>", " Hello  World  "),
        (X.normalize_whitespace, "Hello    World\n\n\n\nBye", "Hello World\n\nBye"),
        (X.normalize_whitespace, "  a　", "a"),
        (X.remove_control_chars, "a\x00b\x0bc\x0cd\x1fe\x7f\tf\ng\r", "abcde\tf\ng\r"),
        (X.strip_dateline, "WASHINGTON (Reuters) - text", "text"),
        (X.strip_dateline, "NEW YORK/LONDON (Reuters) - text", "NEW YORK/LONDON (Reuters) - text"),
        (X.strip_dateline, "Washington (Reuters) - text", "Washington (Reuters) - text"),
        (X.strip_dateline, "WASHINGTON (Reuters) — text", "WASHINGTON (Reuters) — text"),
        (X.strip_dateline, "x WASHINGTON (Reuters) - text", "x WASHINGTON (Reuters) - text"),
        (X.dedup_key, "Hello World!", "helloworld"),
        (X.dedup_key, "日本語", ""),
        (X.dedup_key, None, ""),
        (X.clean_text, None, ""),
        (X.clean_text, "PARIS (Reuters) - <b>Big</b> news at https://x.org/a?b  now ", "Big news at now"),
        (X.fix_encoding, "caf\u00c3\u00a9 \u00e2\u20ac\u201c d\u00c3\u00a9j\u00c3\u00a0 vu", "caf\u00e9 \u2013 d\u00e9j\u00e0 vu"),
        (X.fix_encoding, "plain Ã text", "plain Ã text"),
        (X.word_count, " a b  c ", 3),
        (X.char_length, "a😀", 2),
        (X.label_key, "  FaKe ", "fake"),
        (X.has_image_suffix, "x/Y.JPEG", True),
        (X.has_image_suffix, "x/y.gif", False),
    ],
)
def test_functions(spark, f, value, expected):
    assert one(spark, f, value) == expected


def test_urls(spark):
    out = one(spark, X.strip_urls, "see https://a.b/c and www.d.org now")
    assert "http" not in out and "www" not in out


def test_tokens_and_bigrams(spark):
    assert one(spark, lambda c: X.alpha_tokens(c, X.STOP_WORDS), "The Cat sat, on 3 mats été") == ["cat", "mats", "été"]
    assert one(spark, lambda c: X.bigrams(X.alpha_tokens(c)), "a b, c d") == ["a c", "c d"]
    assert one(spark, lambda c: X.bigrams(X.alpha_tokens(c)), "a") == []


def test_row_id_and_json(spark):
    row = spark.range(7, 8).select(X.row_id("liar", F.col("id")), X.json_of([]), X.json_of(["id"])).collect()[0]
    assert tuple(row) == ("liar_0000007", "{}", '{"id":7}')
