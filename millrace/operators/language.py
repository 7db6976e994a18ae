r"""Language of texts by rank-order profiles of letter n-grams.

A profile lists the ``SIZE`` most frequent n-grams (one to three characters) of a language's words; a word is
a run of letters in lower case with ``_`` at both ends, and ``_`` alone is no n-gram.  Ties in count go by code
point.  A text is ranked the same way, and its distance to a language is the sum, over its own n-grams, of how
far each is from its rank in the profile, or ``SIZE`` where the profile lacks it.  The nearest language wins.

Profiles are learned from all labelled rows: words are counted per language first, with map-side sums, so only
distinct words are cut into n-grams.  Detection moves no row: each text is ranked where it is read (the words of an Arrow batch are cut once), against
profiles of at most ``MAX_LANGUAGES`` times ``SIZE`` entries, which is checked before they are handed to the tasks.

Defined cases: a null text and one of fewer than ``min_chars`` code points have no language (null), a text
without an n-gram of any profile is ``unknown``; equal distances go to the first name; rows without a
language are not learned from; with no labelled row every text is ``unknown``.
"""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import profile, split

#: Entries of a profile, as usual for this method.
SIZE = 300
#: More languages than this are taken for a wrong column.
MAX_LANGUAGES = 256


def _words(text: str):
    return F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"\p{L}+"), F.lit(0))


def learn(df: DataFrame, lang: str = "lang", text: str = "text", size: int = SIZE) -> DataFrame:
    """``lang, gram, n, rank`` (from 1) of the ``size`` most frequent n-grams of each language."""
    words = df.filter(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.explode(_words(text)).alias("word"))
    counted = words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    edged = F.concat(F.lit("_"), "word", F.lit("_"))
    cuts = lambda k: F.transform(F.sequence(F.lit(1), F.length("word") + 3 - k), lambda i: F.substring(edged, i, F.lit(k)))
    grams = counted.select("lang", "n", F.explode(F.concat(cuts(1), cuts(2), cuts(3))).alias("gram")).filter("gram != '_'")
    sums = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # The rank limit is applied in each task before the rows meet, so a language sends few rows.
    place = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    return sums.withColumn("rank", place).filter(F.col("rank") <= size)


class _Ids(dict):
    """Numbers for n-grams in order of appearance."""

    def __missing__(self, gram: str) -> int:
        self[gram] = len(self)
        return self[gram]


def _cut_words(words: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct n-grams of words by code point, the places of each word's n-grams in that list, one after the other, and where each word's begin."""
    ids, found, starts = _Ids(), array("i"), [0]
    for word in words:
        edged = f"_{word}_"
        n = len(edged)
        found.extend(ids[edged[i]] for i in range(1, n - 1))
        found.extend(ids[edged[i : i + 2]] for i in range(n - 1))
        found.extend(ids[edged[i : i + 3]] for i in range(n - 2))
        starts.append(len(found))
    grams = sorted(ids)
    place = np.empty(len(grams), np.int64)
    place[[ids[g] for g in grams]] = np.arange(len(grams))
    return grams, place[np.frombuffer(found, np.int32)] if found else np.empty(0, np.int64), np.array(starts)


def _top(words: np.ndarray, cut: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams of one text (numbers of its words) in order."""
    word, times = np.unique(words, return_counts=True)
    many = starts[word + 1] - starts[word]
    at = np.repeat(starts[word] - np.cumsum(many) + many, many) + np.arange(many.sum())
    gram, which = np.unique(cut[at], return_inverse=True)
    n = np.bincount(which, np.repeat(times, many))
    return gram[np.argsort(-n, kind="stable")[:size]]


def detect(df: DataFrame, profiles: DataFrame, text: str = "text", into: str = "detected", size: int = SIZE, min_chars: int = 10) -> DataFrame:
    """``df`` with a struct ``lang, distance, next_distance`` (of the second language that shares an n-gram) in ``into``."""
    rows = profiles.select("gram", "lang", "rank").limit(MAX_LANGUAGES * size + 1).collect()
    langs = sorted({r["lang"] for r in rows})
    if len(langs) > MAX_LANGUAGES or len(rows) > MAX_LANGUAGES * size:
        raise ValueError(f"profiles of more than {MAX_LANGUAGES} languages")
    line = {g: i for i, g in enumerate(sorted({r["gram"] for r in rows}), 1)}
    # Rank of each n-gram in each language, 0 where the profile lacks it; line 0 is of n-grams that all lack.
    ranks = np.zeros((len(line) + 1, len(langs)), np.int32)
    for r in rows:
        ranks[line[r["gram"]], langs.index(r["lang"])] = r["rank"]

    def nearest(top: np.ndarray) -> tuple[str, int | None, int | None]:
        theirs = ranks[top]
        shared = theirs > 0
        near = np.where(shared, size - np.abs(theirs - np.arange(1, len(top) + 1)[:, None]), 0).sum(axis=0)
        best = sorted((size * len(top) - int(near[i]), langs[i]) for i in np.flatnonzero(shared.any(axis=0)))[:2]
        if not best:
            return "unknown", None, None
        return best[0][1], best[0][0], best[1][0] if len(best) > 1 else None

    @F.arrow_udf("lang string, distance bigint, next_distance bigint")
    def found(texts: pa.Array) -> pa.Array:
        words = texts.flatten().dictionary_encode()
        grams, cut, starts = _cut_words(words.dictionary.to_pylist())
        known = np.array([line.get(g, 0) for g in grams], np.int64)
        numbers = words.indices.to_numpy()
        ends = np.cumsum(pc.fill_null(pc.list_value_length(texts), 0).to_numpy())
        out = []
        for present, end, begin in zip(texts.is_valid().to_pylist(), ends, np.r_[0, ends[:-1]]):
            out.append(nearest(known[_top(numbers[begin:end], cut, starts, size)]) if present else (None, None, None))
        lang, distance, second = zip(*out) if out else ((), (), ())
        columns = [pa.array(lang, pa.string()), pa.array(distance, pa.int64()), pa.array(second, pa.int64())]
        return pa.StructArray.from_arrays(columns, ["lang", "distance", "next_distance"])

    return df.withColumn(into, found(F.when(F.length(text) >= min_chars, _words(text))))


def sampled_distribution(df: DataFrame, profiles: DataFrame, text: str = "text", id_col: str = "doc_id", sample_n: int = 500, seed: int = 42, k: int = 5) -> DataFrame:
    """``lang, n, pct, shown``: the ``k`` most frequent languages of a seeded sample of rows that have a text.

    The sample is drawn over ids (unique); texts are read for its rows only.  Texts too short to judge count nowhere.
    """
    ids = split.sample_k(df.filter(F.col(text).isNotNull()).select(id_col), sample_n, seed, id_col)
    rows = df.select(id_col, text).join(F.broadcast(ids), id_col, "left_semi")
    found = detect(rows, profiles, text).select(F.col("detected.lang").alias("lang"), text)
    top = profile.language_distribution(found, "lang", text, k)
    return top.withColumn("shown", F.format_string("%d (%.1f%%)", "n", "pct"))
