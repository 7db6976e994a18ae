"""The contract queries: each applies its operator to the whole intended table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import table


def op1_katz_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .katz import lm_score

    return lm_score(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import score_toxicity

    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import license_scan

    return license_scan(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import judge

    out = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix_report

    return mix_report(table(spark, sf_dir, "documents"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html import extract

    return extract(table(spark, sf_dir, "pages"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .bpe import digest

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return digest(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import language_id

    return language_id(table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import exact_dedup

    out = exact_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_dedup

    return near_dedup(table(spark, sf_dir, "documents"))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fingerprints import fingerprint_report

    return fingerprint_report(table(spark, sf_dir, "documents"))


def op12_change_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .changepoints import segments

    return segments(table(spark, sf_dir, "sale_lines"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .align import alignment

    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment(table(spark, sf_dir, "documents"), a, b)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}


_OP5 = r"""
WITH d AS (
  SELECT doc_id, coalesce('=' || source, '') AS s,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents
), p AS (
  SELECT s, sum(size)::BIGINT AS source_size FROM d GROUP BY s
), w AS (
  SELECT *, ((row_number() OVER (ORDER BY s = '', s) - 1) % 3 + 1)::DOUBLE AS weight,
         source_size * 3.0::DOUBLE AS most, (sum(source_size) OVER ())::DOUBLE AS total
  FROM p
), c AS (
  SELECT *, most / weight <= (total - coalesce(sum(most) OVER b, 0)) / ((sum(weight) OVER ()) - coalesce(sum(weight) OVER b, 0)) AS capped
  FROM w WINDOW b AS (ORDER BY most / weight, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), l AS (
  SELECT *, total - sum(CASE WHEN capped THEN most ELSE 0 END) OVER () AS rest,
         sum(CASE WHEN capped THEN 0 ELSE weight END) OVER () AS open_weight
  FROM c
), t AS (
  SELECT *, CASE WHEN capped THEN most ELSE weight * rest / nullif(open_weight, 0) END AS target FROM l
), r AS (
  SELECT *, coalesce(least(target / nullif(source_size, 0)::DOUBLE, 3.0), 0.0)::DOUBLE AS rate,
         ('0x' || substr(md5('mix:20:' || s), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM t
), k AS (
  SELECT d.doc_id, d.size, r.source_size, r.target, floor(r.rate) AS whole, r.rate - floor(r.rate) AS part, u,
         (row_number() OVER (PARTITION BY d.s ORDER BY d.size, d.doc_id))::DOUBLE AS n
  FROM d JOIN r ON d.s = r.s
)
SELECT doc_id, size, source_size, target,
       ((whole + floor(u + part * n) - floor(u + part * (n - 1))) * size)::BIGINT AS taken
FROM k
"""

_OP9 = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM t WINDOW w AS (PARTITION BY t)
"""

#: The same optimum by dynamic programming over all segments of at least 14 days, without pruning.
_OP12 = r"""
WITH RECURSIVE taken AS (
  SELECT vendor_id AS v, datediff('day', DATE '1970-01-01', CAST(shipped_at AS DATE)) AS day, sum(quantity)::BIGINT AS x
  FROM sale_lines WHERE quantity IS NOT NULL AND shipped_at IS NOT NULL GROUP BY ALL
), span AS (
  SELECT v, min(day) AS first, max(day) - min(day) + 1 AS n FROM taken GROUP BY v
), dense AS (
  SELECT s.v, s.n, g.i AS i, coalesce(t.x, 0)::HUGEINT AS x
  FROM span s, LATERAL (SELECT unnest(range(1, s.n + 1)) AS i) g LEFT JOIN taken t ON t.v IS NOT DISTINCT FROM s.v AND t.day = s.first + g.i - 1
), sums AS (
  SELECT v, n, i, sum(x) OVER w AS s, sum(x * x) OVER w AS q FROM dense WINDOW w AS (PARTITION BY v ORDER BY i)
  UNION ALL SELECT v, n, 0, 0, 0 FROM span
), parts AS (
  SELECT a.v, a.n AS days, a.i AS s, b.i AS e, b.i - a.i AS n, b.s - a.s AS total, 1 + ((b.i - a.i) * (b.q - a.q) - (b.s - a.s) * (b.s - a.s)) // ((b.i - a.i) * (b.i - a.i)) AS spread
  FROM sums a JOIN sums b ON a.v IS NOT DISTINCT FROM b.v AND b.i > a.i
  WHERE (a.n < 28 AND a.i = 0 AND b.i = a.n) OR (a.n >= 28 AND b.i - a.i >= 14 AND (a.i = 0 OR a.i >= 14))
), costs AS (
  SELECT *, n * floor(1000 * ln(spread::DOUBLE))::BIGINT AS cost FROM parts
), best(v, e, state) AS (
  SELECT v, 0::BIGINT, [{'c': -40000::BIGINT, 'k': 0::BIGINT, 's': 0::BIGINT}] FROM span
  UNION ALL
  SELECT b.v, b.e + 1, list_append(any_value(b.state), min({'c': b.state[c.s + 1].c + c.cost + 40000, 'k': b.state[c.s + 1].k + 1, 's': c.s}))
  FROM best b JOIN span p ON p.v IS NOT DISTINCT FROM b.v AND b.e < p.n
  LEFT JOIN costs c ON c.v IS NOT DISTINCT FROM b.v AND c.e = b.e + 1 AND b.state[c.s + 1] IS NOT NULL
  GROUP BY b.v, b.e
), whole AS (
  SELECT b.v, b.state, p.n, p.first FROM best b JOIN span p ON p.v IS NOT DISTINCT FROM b.v AND b.e = p.n
), back AS (
  SELECT v, state, first, n AS e, state[n + 1].s AS s, state[n + 1].k AS k, state[n + 1].k AS n_segments, state[n + 1].c AS best_cost FROM whole
  UNION ALL
  SELECT v, state, first, s, state[s + 1].s, k - 1, n_segments, best_cost FROM back WHERE s > 0
)
SELECT k.v AS vendor_id, k.k::INT AS segment_no, (k.first + k.s)::BIGINT AS first_day, c.n::BIGINT AS n_days, c.total::BIGINT AS total, c.spread::BIGINT AS spread,
       c.cost::BIGINT AS cost, k.n_segments::BIGINT AS n_segments, k.best_cost::BIGINT AS best_cost
FROM back k JOIN costs c ON c.v IS NOT DISTINCT FROM k.v AND c.s = k.s AND c.e = k.e
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_source_mixing": _OP5, "op9_exact_dedup": _OP9, "op12_change_points": _OP12}
