r"""Encoding repair as Column expressions: mojibake, typography and Unicode composition; no Python runs per row.

Tables come from the Unicode data of the Python that builds the plan, by rule.  Texts without the
characters in question pay one pattern search each.  Null stays null.
"""

from __future__ import annotations

import unicodedata
from collections import defaultdict
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The characters that Windows-1252 has where ISO 8859-1 has controls, and these.
_CP1252 = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
_LATIN1 = _CP1252.encode("cp1252").decode("latin-1")
#: What UTF-8 read as Windows-1252 looks like where repair is worth a try.
_MOJIBAKE = "(?=[ÂÃÅâð])(?:Ã[\u0080-¿ƒ‚-™ŒœŠšŸŽžˆ˜]|â€|Â[\u0080-¿]|Å[’“¡¾½¸]|ðŸ)"
_ONE_BYTE = f"\u0080-ÿ{_CP1252}"
#: The same as a class that parts ASCII off first, as a class of many ranges is slow.
_ANY_ONE_BYTE = f"[[^\\x00-\\x7f]&&[{_ONE_BYTE}]]"
#: Combining marks that composition looks at (U+034F joins and is none).
_MARK = r"\u0300-\u034e\u0350-\u036f"
LAYERS = 4
#: Different clusters of a text up to which each is replaced over the whole text.
FEW = 100


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once, however often ``f`` names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def repair_mojibake(c: Column, layers: int = LAYERS) -> Column:
    """Undo UTF-8 that was read as Windows-1252 or ISO 8859-1, up to ``layers`` times over.

    Each run of such characters is repaired for itself, so other scripts beside it do no harm; a run stays where
    its bytes are not UTF-8 as a whole.  A step makes a run shorter and is taken only where its marks show.
    A text of such runs and ASCII alone, each run marked, is UTF-8 as a whole if each run is, and is repaired at once.
    """
    runs = lambda t: F.regexp_extract_all(t, F.lit(f"(?s){_ANY_ONE_BYTE}+|(?:(?!{_ANY_ONE_BYTE}).)++"), F.lit(0))
    one_byte = lambda t: F.when(t.rlike(f"[[^\\x00-ÿ]&&[{_CP1252}]]"), F.translate(t, _CP1252, _LATIN1)).otherwise(t)
    fixed = lambda run: F.try_validate_utf8(F.encode(one_byte(run), "iso-8859-1").cast("string"))
    each = lambda t: F.array_join(F.transform(runs(t), lambda run: F.when(run.rlike(_MOJIBAKE), F.coalesce(fixed(run), run)).otherwise(run)), "")
    unmarked = f"(?=[^\\x00-\\x7f])(?<!{_ANY_ONE_BYTE})(?:(?!{_MOJIBAKE}){_ANY_ONE_BYTE})++(?!{_ANY_ONE_BYTE})"
    mixed = f"[[^\\x00-ÿ]&&[^{_CP1252}]]|{unmarked}"
    once = lambda t: F.coalesce(F.when(~t.rlike(mixed), fixed(t)), each(t))

    def step(t: Column, left: int) -> Column:
        again = lambda u: F.when(u == t, u).otherwise(step(u, left - 1))
        return F.when(t.rlike(_MOJIBAKE), bound(once(t), again)).otherwise(t) if left else t

    return bound(c, lambda t: step(t, layers))


def plain_typography(c: Column) -> Column:
    """Straight quotes, one kind of line break, letters for ligatures and full-width forms."""
    wide = "".join(map(chr, range(0xFF01, 0xFF5F))) + "\u3000"

    def ligatures(t: Column) -> Column:
        joined = t
        for ligature in map(chr, range(0xFB00, 0xFB07)):
            joined = F.replace(joined, F.lit(ligature), F.lit(unicodedata.normalize("NFKC", ligature)))
        return F.when(t.rlike("[\ufb00-\ufb06]"), joined).otherwise(t)

    steps = (
        lambda t: F.regexp_replace(F.regexp_replace(t, "[ʼ‘-‛]", "'"), "[“-‟]", '"'),
        lambda t: F.regexp_replace(t, "\r\n?|[\u0085\u2028\u2029]", "\n"),
        lambda t: F.when(t.rlike("[\uff01-\uff5e\u3000]"), F.translate(t, wide, unicodedata.normalize("NFKC", wide))).otherwise(t),
        ligatures,
    )

    def plain(t: Column) -> Column:
        for f in steps:
            t = bound(t, f)
        return t

    return bound(c, lambda t: F.when(t.rlike("\r|[[^\\x00-\\x7f]&&[\u0085ʼ‘-‟\u2028\u2029\uff01-\uff5e\u3000\ufb00-\ufb06]]"), plain(t)).otherwise(t))


@cache
def _tables() -> tuple[dict[str, dict[str, str]], dict[str, str], dict[str, str], dict[int, str]]:
    """By mark the pairs (base: composed); whole decompositions; other forms of one character; marks by class."""
    pairs, whole, single = defaultdict(dict), {}, {}
    for char in map(chr, range(0xC0, 0x3000)):
        parts = unicodedata.decomposition(char).split()
        if not parts or parts[0].startswith("<"):
            continue
        parts = [chr(int(p, 16)) for p in parts]
        whole[char] = unicodedata.normalize("NFD", char)
        if len(parts) == 1:
            single[char] = unicodedata.normalize("NFC", char)
        elif unicodedata.normalize("NFC", char) == char and 0x300 <= ord(parts[1]) <= 0x36F:
            pairs[parts[1]][parts[0]] = char
    classes = defaultdict(str)
    for mark in map(chr, range(0x300, 0x370)):
        if unicodedata.combining(mark):
            classes[unicodedata.combining(mark)] += mark
    single = {a: b for a, b in single.items() if len(b) == 1}
    return dict(pairs), whole, single, dict(sorted(classes.items()))


def _class(mark: Column) -> Column:
    classes = _tables()[3]
    return F.ascii(F.translate(mark, "".join(classes.values()), "".join(chr(n) * len(marks) for n, marks in classes.items())))


def _joined(base: Column, mark: Column) -> Column:
    """The character that is another with one mark; null where there is none."""
    # Marks stand in the second place of three only, so a pair is found nowhere else.
    table = F.lit("".join(a + m + whole for m, pairs in _tables()[0].items() for a, whole in pairs.items()))
    return bound(F.instr(table, F.concat(base, mark)), lambda i: F.when(i > 0, F.substring(table, i + 2, F.lit(1))))


def _composed(cluster: Column) -> Column:
    """A character with marks behind it, composed: marks are ordered by class and joined where none of their class stands before."""
    whole = _tables()[1]
    known = F.str_to_map(F.lit(";".join(f"{a}={b}" for a, b in whole.items())), F.lit(";"), F.lit("="))
    head = F.substring(cluster, 1, 1)
    plain = F.when(head.rlike("[^\\x00-\\x7f]"), F.concat(F.coalesce(F.try_element_at(known, head), head), F.substring(cluster, F.lit(2), F.length(cluster)))).otherwise(cluster)
    chars = F.regexp_extract_all(plain, F.lit("(?s)."), F.lit(0))
    behind = F.slice(chars, F.lit(2), F.size(chars))
    ordered = F.sort_array(F.transform(behind, lambda m, i: F.struct(_class(m).alias("n"), i.alias("i"), m.alias("m"))))
    start = F.struct(F.get(chars, F.lit(0)).alias("base"), F.lit("").alias("rest"), F.lit(0).alias("last"))

    def join(acc: Column, placed: Column) -> Column:
        mark, n = placed["m"], placed["n"]
        both = _joined(acc["base"], mark)
        ok = (acc["last"] < n) & both.isNotNull()
        return F.struct(
            F.when(ok, both).otherwise(acc["base"]).alias("base"), F.when(ok, acc["rest"]).otherwise(F.concat(acc["rest"], mark)).alias("rest"), F.when(ok, acc["last"]).otherwise(n).alias("last")
        )

    return F.aggregate(ordered, start, join, lambda acc: F.concat(acc["base"], acc["rest"]))


def nfc(c: Column) -> Column:
    """Composed form of letters with the marks U+0300 to U+036F, and of characters that are another's other form.

    Marks of other blocks and conjoining Hangul stay as they are.  Each different cluster of a text is composed once
    and replaced, longer ones first; what is composed holds no cluster that composition changes.  Of a text with
    more than ``FEW`` different ones each is composed where it stands, so that no text is read once per cluster.
    """
    single = _tables()[2]
    plain = lambda t: F.when(t.rlike(f"[[^\\x00-\u033f]&&[{''.join(single)}]]"), F.translate(t, "".join(single), "".join(single.values()))).otherwise(t)

    def each(t: Column) -> Column:
        clusters = F.regexp_extract_all(t, F.lit(f"(?s)[^{_MARK}][{_MARK}]+|[^{_MARK}]+(?![{_MARK}])"), F.lit(0))
        return F.array_join(F.transform(clusters, lambda x: F.when(x.rlike(f"^[^{_MARK}][{_MARK}]"), _composed(x)).otherwise(x)), "")

    paired = lambda x: F.when(F.length(x) == 2, _joined(F.substring(x, 1, 1), F.substring(x, 2, 1)))

    def replaced(t: Column, found: Column) -> Column:
        pairs = F.sort_array(F.transform(found, lambda x: F.struct(F.length(x).alias("n"), x.alias("apart"), F.coalesce(paired(x), _composed(x)).alias("whole"))), asc=False)
        return F.aggregate(pairs, t, lambda u, p: F.replace(u, p["apart"], p["whole"]))

    def composed(t: Column) -> Column:
        found = F.array_distinct(F.regexp_extract_all(t, F.lit(f"(?s)[^{_MARK}][{_MARK}]+"), F.lit(0)))
        return bound(found, lambda x: F.when(F.size(x) <= FEW, replaced(t, x)).otherwise(each(t)))

    # A line break before the text, which no mark joins, makes marks at its start those of a character.
    headed = lambda t: bound(F.concat(F.lit("\n"), F.replace(t, F.lit("\u0344"), F.lit("\u0308\u0301"))), composed)
    whole = lambda t: bound(headed(t), lambda u: F.substring(u, F.lit(2), F.length(u)))
    marked = lambda t: bound(plain(t), lambda u: F.when(u.rlike(f"[{_MARK}]"), whole(u)).otherwise(u))
    return bound(c, lambda t: F.when(t.rlike(f"[[^\\x00-ÿ]&&[{_MARK}{''.join(single)}]]"), marked(t)).otherwise(t))
