"""Registered queries of language detection, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import language
from .catalogue import _q, _t


def _ranked(name: str, keys: str, words: str) -> str:
    """Tables ``name`` with the most frequent n-grams per ``keys``."""
    return f"""{name}_w AS (SELECT {keys}, word, count(*) AS n FROM ({words}) GROUP BY ALL),
    {name}_c AS (SELECT {keys}, n, word, k, unnest(range(1, length(word) + 4 - k)) AS i FROM {name}_w, range(1, 4) r(k)),
    {name}_g AS (SELECT {keys}, substr('_' || word || '_', i, k) AS gram, sum(n)::BIGINT AS n FROM {name}_c GROUP BY ALL),
    {name} AS (SELECT {keys}, gram, n, row_number() OVER (PARTITION BY {keys} ORDER BY n DESC, gram)::INT AS rank FROM {name}_g WHERE gram <> '_' QUALIFY rank <= {language.SIZE})"""


_LETTERS = r"unnest(regexp_extract_all(lower(text), '\pL+')) AS word"
_PROFILES = _ranked("p", "lang", f"SELECT lang, {_LETTERS} FROM documents WHERE lang IS NOT NULL")


def _found(table: str, key: str) -> str:
    """Tables ``best`` with the languages of each text, nearest first."""
    texts = _ranked("t", "id", f"SELECT {key} AS id, {_LETTERS} FROM {table} WHERE length(text) >= 10")
    return f"""WITH {_PROFILES}, {texts}, m AS (SELECT id, count(*) AS m FROM t GROUP BY id),
    s AS (SELECT t.id, p.lang, sum({language.SIZE} - abs(t.rank - p.rank)) AS near FROM t JOIN p USING (gram) GROUP BY ALL),
    best AS (SELECT id, lang, ({language.SIZE} * m - near)::BIGINT AS distance, row_number() OVER (PARTITION BY id ORDER BY {language.SIZE} * m - near, lang) AS r FROM s JOIN m USING (id)),
    found AS (SELECT {key} AS id, text, CASE WHEN length(text) >= 10 THEN coalesce(a.lang, 'unknown') END AS lang, a.distance, b.distance AS next_distance
      FROM {table} LEFT JOIN best a ON a.id = {key} AND a.r = 1 LEFT JOIN best b ON b.id = {key} AND b.r = 2)"""


def _profiles(spark, sf_dir):
    return language.learn(_t(spark, sf_dir, "documents"))


@_q(f"WITH {_PROFILES} SELECT lang, gram, n, rank FROM p")
def language_profiles(spark, sf_dir):
    return _profiles(spark, sf_dir)


@_q(f"{_found('documents', 'doc_id')} SELECT id AS doc_id, lang, distance, next_distance FROM found")
def language_detected(spark, sf_dir):
    """The language of every document by the profiles of all."""
    return language.detect(_t(spark, sf_dir, "documents"), _profiles(spark, sf_dir)).select("doc_id", "detected.*")


@_q(f"{_found('conversations', 'conv_id * 1000 + turn')} SELECT lang, count(*) AS n FROM found GROUP BY lang")
def language_of_turns(spark, sf_dir):
    """Turns by language: the profiles of one table read another that carries no language."""
    found = language.detect(_t(spark, sf_dir, "conversations"), _profiles(spark, sf_dir))
    return found.groupBy(F.col("detected.lang").alias("lang")).agg(F.count(F.lit(1)).alias("n"))


@_q(
    f"{_found('documents', 'doc_id')}, drawn AS (SELECT * FROM found WHERE text IS NOT NULL ORDER BY md5('42:' || id), id LIMIT 500), "
    "c AS (SELECT lang, count(*) AS n FROM drawn WHERE length(text) >= 10 GROUP BY lang), d AS (SELECT lang, n, round(100.0 * n / sum(n) OVER (), 1)::DOUBLE AS pct FROM c) "
    "SELECT lang, n, pct, format('{} ({:.1f}%)', n, pct) AS shown FROM d ORDER BY n DESC, lang LIMIT 5"
)
def language_sampled(spark, sf_dir):
    return language.sampled_distribution(_t(spark, sf_dir, "documents"), _profiles(spark, sf_dir))
