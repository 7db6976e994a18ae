import random
import re
import unicodedata

from pyspark.sql import functions as F

from millrace.functions import encoding as E
from millrace.functions import text as X


def mojibake(text, layers=1):
    for _ in range(layers):
        text = "".join(bytes([b]).decode("cp1252") if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else chr(b) for b in text.encode())
    return text


def brute_repair(text):
    """Layer by layer, run by run, with Python's codecs."""
    back = {c: c.encode("cp1252") for c in E._CP1252}

    def run(m):
        if not re.search(E._MOJIBAKE, m[0]):
            return m[0]
        try:
            return b"".join(back.get(c) or c.encode("latin-1") for c in m[0]).decode("utf-8")
        except UnicodeDecodeError:
            return m[0]

    for _ in range(E.LAYERS):
        text = re.sub(f"[{E._ONE_BYTE}]+", run, text)
    return text


def applied(spark, f, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, c string").select("i", f(F.col("c")).alias("c")).collect()
    return [r.c for r in sorted(rows)]


def test_repair_equals_codecs(spark):
    pick = random.Random(5)
    letters = "abc é ß ñ Ã â€ Â ™ „ “ € 日本 я ü œ ðŸ \n".replace(" ", "") + " "
    texts = ["".join(pick.choice(letters) for _ in range(pick.randrange(12))) for _ in range(150)]
    texts += [mojibake(t, pick.randrange(1, 4)) for t in texts] + ["„Spaß“", "日本 " + mojibake("déjà 😀"), None, ""]
    assert applied(spark, E.repair_mojibake, texts) == [t if t is None else brute_repair(t) for t in texts]
    assert applied(spark, E.repair_mojibake, [mojibake("Œuvre – déjà “vu” 😀", n) for n in range(1, 5)]) == ["Œuvre – déjà “vu” 😀"] * 4


def test_nfc_equals_unicodedata(spark):
    pick = random.Random(6)
    letters = "aeiouUOAsnεωи éêậǖ q1\n😀ÅΩ" + "̧̨̛̣́̀̂̃̈̊̕ͅ"
    texts = ["".join(pick.choice(letters) for _ in range(pick.randrange(14))) for _ in range(400)]
    texts += [unicodedata.normalize("NFD", chr(i)) for i in range(0xC0, 0x600)] + ["́a", None, ""]
    assert applied(spark, E.nfc, texts) == [t if t is None else unicodedata.normalize("NFC", t) for t in texts]


def test_typography(spark):
    assert applied(spark, X.fix_encoding, ["“a” ‘b’\r\nc\rd e", "ﬁne ﬀ", "ＡＢ！　x", "é", None]) == ["\"a\" 'b'\nc\nd\ne", "fine ff", "AB! x", "é", None]


def test_repair_of_whole_texts_and_of_runs(spark):
    """Texts of marked runs alone are repaired at once, others run by run, with the same result; a run without marks stays."""
    texts = ["Ã© x Ä€ y", "Ã© x ÃŸ", "Ã© 日 Ã©", "é Ã©", mojibake("é ü “x” ñ", 3) + " é"]
    assert applied(spark, E.repair_mojibake, texts) == [brute_repair(t) for t in texts]


def test_many_clusters_of_one_text(spark):
    """Different clusters beyond ``FEW`` are composed where they stand; a cluster that begins another is not replaced inside it."""
    pick = random.Random(7)
    texts = ["e\u0301 e\u0301\u0323 q\u0323 q\u0301\u0323 e\u0323\u0301"]
    texts += ["".join(pick.choice("aeiouq") + "".join(chr(pick.randrange(0x300, 0x320)) for _ in range(pick.randrange(4))) for _ in range(n)) for n in (E.FEW // 2, 4 * E.FEW)]
    assert applied(spark, E.nfc, texts) == [unicodedata.normalize("NFC", t) for t in texts]


def test_columns_of_once_are_computed_once(spark):
    """A filter on them is not put below them, where it would compute them anew."""
    rows = X.once(spark.range(3).withColumn("c", F.lit(" a ")), t=X.clean_text(F.concat("c", F.col("id").cast("string"))))
    kept = rows.filter("t != 'a 1'").filter(F.length("t") > 0)
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Reuters") == 1
    assert sorted(r.t for r in kept.collect()) == ["a 0", "a 2"]


def test_white_space_is_as_before(spark):
    texts = [" a \t b\t\tc  d\n\n\n\ne \u3000", "\n\n\n", "", "a b", "\u3000a", None]
    assert applied(spark, X.normalize_whitespace, texts) == [t if t is None else re.sub(r"\n{3,}", "\n\n", re.sub("[ \t]+", " ", t)).strip() for t in texts]
