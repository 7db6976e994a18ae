r"""SimHash fingerprints of documents and the search for near ones (DataFrame functions only).

Terms are the distinct lower-case words of a text and its distinct pairs of neighbouring
words.  A term's 64-bit hashes (one for every 64 bits of the fingerprint) vote with the
term's weight on each bit, for it where the hash has a one and against it otherwise; words of
one or two characters weigh half.  A bit is set if more than half of all weight is for it.
Votes are sums: four bits of a hash are added per 64-bit sum, 16 bits apart, so 256 bits take
64 sums in one hash aggregation.  ``likeness`` of two fingerprints is the cosine that their
differing bits estimate, cos(pi * d / bits), zero from a right angle on.

``within`` finds all fingerprints within a radius of given ones by permuted block tables.
Cut into more blocks than the radius has bits, two such fingerprints agree in some
``blocks - radius`` blocks, so one table for each choice of these blocks, keyed by their bits,
holds every match under an equal key.  A match is reported by the first table that has it.

Scale: equal fingerprints are one row of the tables, with their number.  Rows of one key are
dealt into blocks of bounded size, and a query meets a block, not its rows: neither a frequent
key nor a large group of near copies becomes one task or one row per pair.  Only keys that
some query has are gathered.  ``with_next`` orders documents in ranges of ids from approximate
quantiles: the text moves once, and each range carries the first row of the next one.

Defined cases: null text counts as empty; texts without a word have the fingerprint zero;
a last row's next document is the first, a single row's is itself; rows with equal ids follow in
the order of a hash of their texts, null ids come last; repeated rows stay rows of their own;
extra columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, cut, partitions, text_or_empty

BITS = 256
RADIUS = 7
BLOCKS = 8
#: Fingerprints of one key that stand in one row.
BLOCK_ROWS = 2048
#: Ranges of the hash in which rows without id stand.
_UNNAMED = 16
#: Every 16th bit, the lower 16 bits of every 32, and 32 bits.
_LANES = 0x0001000100010001
_PAIR = 0x0000FFFF0000FFFF
_LANE = 0xFFFFFFFF


def names(bits: int, prefix: str = "w") -> list[str]:
    return [f"{prefix}{j}" for j in range(bits // 64)]


# ---- fingerprints ---------------------------------------------------------------------


def terms(text: Column) -> Column:
    """Hashes of the distinct words and pairs; the lowest bit is one for words of full weight and for pairs."""
    words = F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
    full = lambda h, yes: h.bitwiseAND(F.lit(-2)).bitwiseOR(yes)
    single = lambda w: full(F.xxhash64(w), (F.length(w) > 2).cast("bigint"))
    return F.transform(
        F.array(words),
        lambda ws: F.array_distinct(
            F.concat(
                F.transform(ws, single),
                F.transform(F.slice(ws, F.lit(1), F.greatest(F.size(ws) - 1, F.lit(0))), lambda w, i: full(F.xxhash64(w, F.get(ws, i + 1)), F.lit(1).cast("bigint"))),
            )
        ),
    )[0]


def votes(rows: DataFrame, keys: list[str], term: str, bits: int = BITS, place: str | None = None, side: str | None = None, outputs: dict[str, Column | None] | None = None) -> DataFrame:
    """``keys`` and the fingerprint's words of each group of ``keys``; ``term`` is null for a group without terms.

    ``place`` is a term's position in its text.  ``outputs`` names several fingerprints of a group by
    the prefix of their words, each with a condition on ``side``; terms that several share vote once.
    Four bits are added per sum, 16 bits apart, over runs of terms that cannot overflow them.
    """
    outputs = outputs or {"w": None}
    run = F.shiftright(F.col(place), 14) if place else F.lit(0)
    limit = F.lit(1).cast("bigint")
    hashed = rows.select(
        *keys,
        (F.col(side) if side else F.lit(0)).alias("_side"),
        run.alias("_run"),
        F.when(F.col(term).isNull(), 0).otherwise(F.col(term).bitwiseAND(limit) + 1).cast("bigint").alias("_weight"),
        *[F.xxhash64(term, F.lit(j)).alias(f"_h{j}") for j in range(bits // 64)],
    )
    sums = [
        F.sum(F.col("_weight") * F.shiftrightunsigned(F.col(f"_h{j}"), i).bitwiseAND(F.lit(_LANES))).alias(f"_s{j}_{i}")
        for j in range(bits // 64)
        for i in range(16)
    ]
    partial = hashed.groupBy(*keys, "_side", "_run").agg(F.sum("_weight").alias("_all"), *sums)
    # Sums of runs have room for 2^31 of weight: two bits each, 32 bits apart.
    wide = []
    for prefix, where in outputs.items():
        here = (lambda c, where=where: c) if where is None else (lambda c, where=where: F.when(where, c))
        wide.append(F.coalesce(F.sum(here(F.col("_all"))), F.lit(0)).alias(f"_{prefix}all"))
        for j in range(bits // 64):
            for i in range(16):
                s = F.col(f"_s{j}_{i}")
                for k, part in ((0, s), (16, F.shiftrightunsigned(s, 16))):
                    wide.append(F.coalesce(F.sum(here(part.bitwiseAND(F.lit(_PAIR)))), F.lit(0)).alias(f"_{prefix}{j}_{i + k}"))
    summed = partial.withColumnRenamed("_side", side or "_side").groupBy(*keys).agg(*wide)

    def word(prefix: str, j: int) -> Column:
        parts = []
        for i in range(32):
            s = F.col(f"_{prefix}{j}_{i}")
            for at, lane in ((i, s.bitwiseAND(F.lit(_LANE))), (i + 32, F.shiftrightunsigned(s, 32))):
                parts.append(F.shiftleft((2 * lane > F.col(f"_{prefix}all")).cast("bigint"), at))
        return reduce(lambda a, b: a.bitwiseOR(b), parts)

    return summed.select(*keys, *[word(p, j).alias(n) for p in outputs for j, n in enumerate(names(bits, p))])


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """``row, doc_id`` and the words ``w0, w1, ...`` of the fingerprint of every row."""
    numbered = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"), text_or_empty(text_col).alias("_text"))
    exploded = numbered.select("row", "doc_id", F.posexplode_outer(terms(F.col("_text"))).alias("_place", "_term"))
    return votes(exploded, ["row", "doc_id"], "_term", bits, "_place")


def differing(a: list[Column], b: list[Column]) -> Column:
    return reduce(lambda x, y: x + y, [F.bit_count(x.bitwiseXOR(y)) for x, y in zip(a, b)])


def likeness(a: list[Column], b: list[Column]) -> Column:
    """Estimated cosine of the two texts' weighted terms, 0 to 1; equal fingerprints have 1."""
    return F.greatest(F.cos(differing(a, b) * F.lit(3.141592653589793 / (64 * len(a)))), F.lit(0.0))


def as_hex(words: list[Column]) -> Column:
    return F.lower(F.concat(*[F.lpad(F.hex(w), 16, "0") for w in words]))


# ---- search ---------------------------------------------------------------------------


def _block(words: list[Column], index: int, blocks: int) -> Column:
    """The bits of one block; blocks of 64 * len(words) / blocks bits do not cross words."""
    width = 64 * len(words) // blocks
    per_word = 64 // width
    mask = F.lit((1 << width) - 1 if width < 64 else -1).cast("bigint")
    return F.shiftrightunsigned(words[index // per_word], width * (index % per_word)).bitwiseAND(mask)


def _tables(blocks: int, radius: int) -> list[tuple[int, ...]]:
    if blocks <= radius:
        raise ValueError("there must be more blocks than differing bits")
    return list(combinations(range(blocks), blocks - radius))


def within(queries: DataFrame, rows: DataFrame, bits: int = BITS, radius: int = RADIUS, blocks: int = BLOCKS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """All matches of the distinct fingerprints of ``queries`` among ``rows``, both with the columns ``w0, w1, ...``.

    Returns ``q0, q1, ..., found``, several rows per query; ``found`` lists the matching
    fingerprints' words, their ``distance`` and ``n``, the number of rows that have them.
    """
    if 64 % (bits // blocks):
        raise ValueError("blocks must not cross 64-bit words")
    w, q, tables = names(bits), names(bits, "q"), _tables(blocks, radius)

    def keyed(frame: DataFrame, columns: list[str]) -> DataFrame:
        words = [F.col(c) for c in columns]
        keys = [F.struct(F.lit(t).alias("t"), F.xxhash64(F.lit(t), *[_block(words, i, blocks) for i in chosen]).alias("key")) for t, chosen in enumerate(tables)]
        return frame.select("*", F.explode(F.array(*keys)).alias("_k")).select("*", "_k.t", "_k.key").drop("_k")

    asked = keyed(queries.select(*[F.col(a).alias(b) for a, b in zip(w, q)]).distinct(), q)
    entries = keyed(rows.groupBy(*w).agg(F.count(F.lit(1)).alias("n")), w)
    # How many rows a key has is known before any of them are gathered.
    wanted = entries.join(asked.select("t", "key").distinct().hint("merge"), ["t", "key"], "left_semi")
    wanted = cut(wanted, "entries")
    dealt = wanted.groupBy("t", "key").agg(F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).cast("bigint").alias("parts"))
    members = (
        wanted.join(dealt.hint("merge"), ["t", "key"])
        .groupBy("t", "key", F.pmod(F.xxhash64(*w), F.col("parts")).alias("part"))
        .agg(F.collect_list(F.struct(*w, "n")).alias("members"))
    )
    met = asked.join(members.hint("merge"), ["t", "key"])
    query = [F.col(c) for c in q]

    def first(m: Column) -> Column:
        """Whether no earlier table has this match."""
        same = F.array(*[_block(query, i, blocks) == _block([m[c] for c in w], i, blocks) for i in range(blocks)])
        earlier = [F.lit(t) >= F.col("t") for t in range(len(tables))]
        clear = [later | ~reduce(lambda a, b: a & b, [same[i] for i in chosen]) for later, chosen in zip(earlier, tables)]
        return reduce(lambda a, b: a & b, clear)

    near = F.filter("members", lambda m: differing(query, [m[c] for c in w]) <= radius)
    found = met.select(*q, "t", near.alias("found")).filter(F.size("found") > 0)
    found = found.select(*q, F.filter("found", first).alias("found")).filter(F.size("found") > 0)
    return found.select(
        *q, F.transform("found", lambda m: F.struct(*[m[c].alias(c) for c in w], differing(query, [m[c] for c in w]).alias("distance"), m["n"].alias("n"))).alias("found")
    )


# ---- a document and the next one ------------------------------------------------------


def _range_of(value: Column, limits: list[int]) -> Column:
    """How many of the ordered ``limits`` are smaller, by bisection."""
    if not limits:
        return F.lit(0)
    array = F.split(F.lit(",".join(map(str, limits))), ",").cast("array<bigint>")
    steps = [1 << k for k in reversed(range(len(limits).bit_length()))]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, step: F.when(F.get(array, at + step - 1) < value, at + step).otherwise(at),
    )


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, part, place, guest, text, next``: rows in ranges of ids, each with the next row's text.

    The last row of a range is a guest: a copy of the row that follows the range, without a next.
    """
    spark = docs.sparkSession
    ranges = partitions(spark)
    at = [i / ranges for i in range(1, ranges)] or [0.5]
    named = F.col(id_col).cast("bigint")
    limits = sorted(set(docs.agg(F.percentile_approx(named, at, max(10_000, 20 * ranges)).alias("p")).collect()[0]["p"] or []))
    digest = F.col("h")
    unnamed = F.shiftrightunsigned(digest.bitwiseXOR(F.lit(-(1 << 63))), 60) + len(limits) + 1
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")).withColumn("h", F.xxhash64("text"))
    key = F.col("doc_id").cast("bigint")
    rows = rows.withColumn("part", F.when(key.isNull(), unnamed).otherwise(_range_of(key, limits)).cast("int"))
    # One row per range: as many as there are shuffle partitions, whatever the size of the table.
    firsts = sorted(rows.groupBy("part").agg(F.min(F.struct("doc_id", "h")).alias("least")).collect(), key=lambda r: r["part"])
    follows = [(r["least"]["doc_id"], r["least"]["h"], firsts[i - 1]["part"]) for i, r in enumerate(firsts)]
    kind = docs.schema[id_col].dataType.simpleString()
    follows = spark.createDataFrame(follows, f"doc_id_ {kind}, h_ bigint, part int")
    guests = (
        rows.drop("part")
        .join(F.broadcast(follows), F.col("doc_id").eqNullSafe(F.col("doc_id_")) & (F.col("h") == F.col("h_")))
        .dropDuplicates(["part"])
        .select("doc_id", "text", "h", "part", F.lit(True).alias("guest"))
    )
    ordered = W.partitionBy("part").orderBy("guest", F.col("doc_id").asc_nulls_last(), "h")
    everything = rows.withColumn("guest", F.lit(False)).unionByName(guests)
    return everything.select("doc_id", "part", F.row_number().over(ordered).alias("place"), "guest", "text", F.lead("text").over(ordered).alias("next"))


def edited(text: Column, following: Column) -> Column:
    """The last quarter of the code points replaced by as many of the start of the next text."""
    n = F.length(text)
    cut_off = F.floor(n / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - cut_off), F.substring(following, F.lit(1), cut_off))


def fingerprint_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS, radius: int = RADIUS, blocks: int = BLOCKS, every: int = 100) -> DataFrame:
    """Fingerprints of every text and of its edited form, and how near they are.

    ``n_within`` counts the rows within the radius of a row's own fingerprint, itself included; it is
    asked for the rows whose id is divisible by ``every`` and null for the others.
    """
    w = names(bits)
    old, new, following = (names(bits, p) for p in ("o", "e", "f"))
    rows = with_next(docs, id_col, text_col)
    keys = ["part", "place", "guest", "doc_id", "n_chars", "sha"]
    rows = rows.select("part", "place", "guest", "doc_id", "text", F.length("text").cast("bigint").alias("n_chars"), F.when(~F.col("guest"), edited(F.col("text"), F.col("next"))).alias("edited"))
    rows = rows.select(*keys[:5], F.unhex(F.sha2(F.col("edited").cast("binary"), 256)).alias("sha"), terms(F.col("text")).alias("own"), terms(F.coalesce("edited", F.lit(""))).alias("now"))
    # Most terms of a text are also those of its edited form.
    shares = [F.array_intersect("own", "now"), F.array_except("own", "now"), F.array_except("now", "own")]
    rows = rows.select(*keys, F.explode(F.array(*[F.struct(F.lit(i).alias("side"), t.alias("terms")) for i, t in enumerate(shares)])).alias("s"))
    rows = rows.select(*keys, F.col("s.side").alias("side"), F.posexplode_outer("s.terms").alias("at", "term"))
    both = votes(rows, keys, "term", bits, "at", "side", {"o": F.col("side") != 2, "e": F.col("side") != 1})
    ordered = W.partitionBy("part").orderBy("place")
    both = both.select("*", *[F.lead(o).over(ordered).alias(f) for o, f in zip(old, following)]).filter("NOT guest").drop("guest")
    both = cut(both, "fingerprints")
    own = both.select("part", "place", "doc_id", *[F.col(o).alias(c) for o, c in zip(old, w)])
    matches = within(own.filter(F.col("doc_id") % every == 0), own, bits, radius, blocks)
    counts = matches.groupBy(*names(bits, "q")).agg(F.sum(F.aggregate("found", F.lit(0).cast("bigint"), lambda s, m: s + m["n"])).alias("n_within"))
    asked = F.col("doc_id") % every == 0
    counted = both.filter(asked).join(counts.hint("merge"), [F.col(o) == F.col(q) for o, q in zip(old, names(bits, "q"))], "left").drop(*names(bits, "q"))
    rest = both.filter(~F.coalesce(asked, F.lit(False))).withColumn("n_within", F.lit(None).cast("bigint"))
    columns = lambda many: [F.col(c) for c in many]
    return counted.unionByName(rest).select(
        "doc_id",
        "n_chars",
        F.lower(F.hex("sha")).alias("edited_sha256"),
        as_hex(columns(old)).alias("fingerprint"),
        as_hex(columns(new)).alias("edited_fingerprint"),
        likeness(columns(old), columns(new)).alias("near_edited"),
        likeness(columns(old), columns(following)).alias("near_next"),
        "n_within",
    )
