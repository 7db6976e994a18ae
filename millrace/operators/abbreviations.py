"""Names and their abbreviations, by an index of initials: no name is compared with all others.

A name of two or more words is abbreviated by

* an ``acronym``: one token of the initials of all words, or of all but the small ones ("WHO", "W.H.O.");
* an ``abbreviation``: as many tokens, each the beginning of its word and not all whole ("J. Smith", "Int. Bus. Mach.").

Words are lower case, parted by white space or hyphens, without dots and commas.  A name stands in the
index under its initials and, for tokens of more letters, under initials and the first two letters of
its first or last word.  A mention looks up one key, the most selective that it has; pairs are verified.
Spellings that repeat are compared once, and what they mean is joined to the mentions.  Mentions and results are
dealt into parts of some ``PART_ROWS`` rows, so no task's memory grows with the input.

Defined cases: null or empty names and types match nothing; one-letter mentions and names of one word neither;
a name is no abbreviation of itself; a mention may abbreviate several names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import once
from ..storage import Table

#: Words that acronyms leave out.
SMALL = ("of", "the", "and", "for", "in", "on", "to", "a", "an")
#: Mentions or results of one task, some 100 bytes each.
PART_ROWS = 500_000


def name_words(c: Column) -> Column:
    tokens = F.transform(F.split(F.lower(c), r"(?U)[\s-]+"), lambda t: F.regexp_replace(t, "[.,]", ""))
    return F.filter(tokens, lambda t: t != "")


def _initials(words: Column) -> Column:
    return F.array_join(F.transform(words, lambda w: F.substring(w, 1, 1)), "")


def _two(word: Column) -> Column:
    return F.substring(word, 1, 2)


def _key(kind: str, *parts: Column) -> Column:
    return F.concat_ws("\x1f", F.lit(kind), *parts)


def _parts(df: DataFrame, rows: int) -> int:
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // PART_ROWS))


def matches(mentions: DataFrame, names: DataFrame) -> DataFrame:
    """``mention_id, node_id, how`` of ``mention_id, type, surface`` and ``node_id, type, name``."""
    said = once(mentions.select("mention_id", "type", "surface"), tokens=name_words(F.col("surface"))).filter("size(tokens) > 1 OR length(get(tokens, 0)) > 1")
    said = Table(said.select("mention_id", "type", "tokens"), "said").df
    named = once(names.select("node_id", "type", "name"), words=name_words(F.col("name"))).filter("size(words) > 1").select("node_id", "type", "words")
    t, w = F.col("tokens"), F.col("words")
    first, last = F.get(t, F.lit(0)), F.get(t, F.size(t) - 1)
    asked = (
        F.when(F.size(t) == 1, _key("acronym", first))
        .when(F.length(first) > 1, _key("first", _initials(t), _two(first)))
        .when(F.length(last) > 1, _key("last", _initials(t), _two(last)))
        .otherwise(_key("initials", _initials(t)))
    )
    full = _initials(w)
    held = F.array(
        _key("acronym", full), _key("acronym", _initials(F.filter(w, lambda x: ~x.isin(*SMALL)))), _key("first", full, _two(F.get(w, F.lit(0)))), _key("last", full, _two(F.get(w, F.size(w) - 1))), _key("initials", full)
    )
    questions = said.groupBy("type", "tokens").agg(F.count(F.lit(1)).alias("times")).select("type", "tokens", "times", asked.alias("key"))
    index = named.select("type", "words").distinct().select("type", "words", F.explode(F.array_distinct(held)).alias("key"))
    acronym = F.size(t) == 1
    begins = F.forall(F.zip_with(t, w, lambda a, b: F.coalesce(b.startswith(a), F.lit(False))), lambda ok: ok)
    pairs = questions.join(index, ["type", "key"]).filter(acronym | ((F.size(t) == F.size(w)) & (t != w) & begins))
    pairs = pairs.select("type", "tokens", "times", "words", F.when(acronym, "acronym").otherwise("abbreviation").alias("how"))
    meant = Table(pairs.join(named, ["type", "words"]).select("type", "tokens", "times", "node_id", "how").distinct(), "meant").df
    results = meant.agg(F.sum("times").alias("n")).collect()[0]["n"] or 0
    dealt = said.repartition(_parts(said, said.count()), "type", "tokens")
    found = dealt.join(meant.drop("times"), ["type", "tokens"]).select("mention_id", "node_id", "how")
    return found.repartition(_parts(said, results), "mention_id", "node_id").distinct()
