r"""Text functions as Column expressions: no Python runs per row.

Patterns use Java's ``(?U)`` where the semantics ask for Unicode white space.
Every function maps null to null unless its docstring says otherwise.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import encoding

#: Patterns that define the cleaning chain.
HTML_TAG = r"<[^>]+>"
URL = r"(?U)https?://\S+|www\.\S+"
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
DATELINE = r"^[A-Z .,'-]{3,40}\(Reuters\)\s*-\s*"
EDGES = r"(?U)^\s+|\s+\z"
NOT_KEY = r"[^a-z0-9]+"

#: Words without weight in vocabulary statistics.
STOP_WORDS = (
    "the a an and or of to in is are was were be been being this that these those it its for on with as at by from but not no so if then than"
).split()


def strip(c: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(c, EDGES, "")


def fix_encoding(c: Column) -> Column:
    """Mojibake undone layer by layer, then straight quotes, plain line breaks and letters, then composed characters.

    What repair libraries do besides (entities, terminal escapes, lost bytes) is not done here.
    """
    all_of = lambda t: encoding.nfc(encoding.plain_typography(encoding.repair_mojibake(t)))
    # ASCII needs line breaks only.
    return encoding.bound(c, lambda t: F.when(F.octet_length(t) == F.length(t), F.regexp_replace(t, r"\r\n?", "\n")).otherwise(all_of(t)))


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns that are computed once per row, whatever filters and selections follow.

    A generator of one row: optimisers put no filter below it, which would compute its columns anew.
    """
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.stack(F.lit(1), *columns.values()).alias(*columns))


def strip_html(c: Column) -> Column:
    """Each tag becomes one space; not a parser."""
    return encoding.bound(c, lambda t: F.when(F.contains(t, F.lit("<")), F.regexp_replace(t, HTML_TAG, " ")).otherwise(t))


def strip_urls(c: Column) -> Column:
    return encoding.bound(c, lambda t: F.when(F.contains(t, F.lit("http")) | F.contains(t, F.lit("www.")), F.regexp_replace(t, URL, " ")).otherwise(t))


def remove_control_chars(c: Column) -> Column:
    """Without control characters; tab, line feed and carriage return stay."""
    return F.regexp_replace(c, CONTROL, "")


def normalize_whitespace(c: Column) -> Column:
    """Runs of blanks and tabs to one blank, three or more line feeds to two, ends stripped."""
    lines = lambda t: F.when(F.contains(t, F.lit("\n\n\n")), F.regexp_replace(t, r"\n{3,}", "\n\n")).otherwise(t)
    ends = lambda t: F.when(F.concat(F.substring(t, 1, 1), F.substring(t, -1, 1)).rlike(r"(?U)\s"), strip(t)).otherwise(t)
    return encoding.bound(encoding.bound(F.regexp_replace(c, r"\t[ \t]*| [ \t]+", " "), lines), ends)


def strip_dateline(c: Column) -> Column:
    """Without a news agency's dateline at the start."""
    return F.regexp_replace(c, DATELINE, "")


def clean_text(c: Column, repair: bool = True, urls: bool = True) -> Column:
    """The whole chain; null becomes the empty text."""
    c = F.coalesce(c, F.lit(""))
    c = strip_html(fix_encoding(c) if repair else c)
    c = strip_urls(c) if urls else c
    return normalize_whitespace(remove_control_chars(strip_dateline(c)))


def dedup_key(c: Column) -> Column:
    """Lower-case ASCII letters and digits only; null becomes the empty key."""
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), NOT_KEY, "")


def words(c: Column) -> Column:
    """Runs without Unicode white space."""
    return F.filter(F.split(c, r"(?U)\s+"), lambda w: w != "")


def char_length(c: Column) -> Column:
    """Code points."""
    return F.length(c)


def word_count(c: Column) -> Column:
    return F.size(words(c))


def alpha_tokens(c: Column, without: Iterable[str] = ()) -> Column:
    """Lower-case words of letters only, less the given ones."""
    # The pattern keeps no empty piece either, so the split is filtered once.
    low = F.transform(F.filter(F.split(c, r"(?U)\s+"), lambda w: w.rlike(r"^\p{L}+\z")), F.lower)
    without = list(without)
    return F.filter(low, lambda w: ~w.isin(without)) if without else low


def bigrams(tokens: Column) -> Column:
    """Adjacent pairs, joined by a blank."""
    n = F.size(tokens)
    pair = F.zip_with(F.slice(tokens, F.lit(1), n - 1), F.slice(tokens, F.lit(2), n - 1), lambda a, b: F.concat_ws(" ", a, b))
    return F.when(n > 1, pair).otherwise(F.array().cast("array<string>"))


def json_of(columns: Iterable[str]) -> Column:
    """The columns as one JSON object, nulls kept as null; '{}' for none."""
    columns = list(columns)
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}) if columns else F.lit("{}")


def row_id(dataset: str, ordinal: Column) -> Column:
    """``<dataset>_<ordinal, seven digits>``."""
    return F.format_string(f"{dataset}_%07d", ordinal)


def has_image_suffix(path: Column) -> Column:
    return F.lower(path).rlike(r"\.(jpe?g|png)$")


def label_key(c: Column) -> Column:
    """What two label spellings have in common: ends stripped, lower case."""
    return F.lower(strip(c))
