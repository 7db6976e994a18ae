"""Top-k evidence by BM25, exact, without joining out frequent terms.

A score is a sum of impacts, one for each term that claim and text share.  No term adds more to any
text than its largest impact, so with the k-th best score known to be at least ``floor``:

* terms are put in order of their largest impact; the first ones, whose largest impacts add up to less
  than ``floor``, cannot lift a text into the top k by themselves.  A text must hold one of the others,
  the *essential* terms.  The frequent terms have small impacts and are the inessential ones.
* texts are numbered into blocks, and each term has its largest impact in each block.  A candidate that the
  essential terms found is dropped when its partial score and the block's largest impacts of the
  inessential terms stay below ``floor``.
* what is left is scored in full by looking up the pairs of text and term, never a term alone.

Where claims are so many, or their words so frequent, that even the candidates would be far more than claims and
texts (``PAIR_ROWS``), they are not written down: postings are dealt into groups of texts and claims into chunks,
both of bounded rows, and each task scores one chunk over one group in full and gives its k best.  The work
is that of all postings that claims meet; what is moved is postings times chunks and claims times groups.  Where no index
is kept (``ranked``), many claims are met with whole texts in the same way, and postings are not moved to their terms at all.

``floor`` comes from a first pass over each claim's strongest terms: the texts that are best by these
alone are scored in full, and the k-th best of any texts cannot be above the k-th best of all.

Scale: postings of frequent terms are dealt into parts of bounded size by the text, and a claim's term
meets each part, so no task holds a frequent term.  ``index`` is written once and read by all
requests; its tables hold one row per different (term, text), per (term, block) and per term.

Defined cases: scores within 1e-9 tie and the smaller id wins; only texts that share a term with a claim are ranked; claims with
fewer than k such texts give fewer rows; null and empty texts share nothing; repeated words of a claim count
once; ids are taken to be unique.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import alpha_tokens, once
from ..storage import Table, free_shuffles

#: Texts of a block share one bound per term.
BLOCK_TEXTS = 128
#: Postings of one part of a frequent term.
PART_ROWS = 100_000
#: Terms, strongest first, and postings of them, that give the first bound; and how many times k texts are scored for it.
SEED_TERMS, SEED_ROWS, SEED_TEXTS = 16, 50_000, 4
SLACK = 1e-9
#: Different terms or texts up to which they are sent to every task (some 100 bytes each) to filter postings where they are read.
SENT_ROWS = 200_000
#: Postings met by claims beyond which pairs are scored in cells, and rows of a cell's claims (claim, term) and texts (term, text).
PAIR_ROWS, CHUNK_ROWS, GROUP_ROWS = 20_000_000, 4_000_000, 4_000_000
#: Different words of claims from which whole texts are dealt into cells, and words of a cell's claims and texts (some 8 and 40 bytes each).
ASKED_ROWS, CLAIM_ROWS, TEXT_ROWS = 100_000, 16_000_000, 12_000_000
#: Within a cell: bytes of the frequent terms' matrix and of one block of sums, the part of the texts that makes a term frequent, texts of a peak, postings scored at once.
MATRIX_BYTES, BLOCK_BYTES, FREQUENT, PEAK, SCORED_ROWS = 100 << 20, 16 << 20, 8, 16, 1 << 20


@dataclass(frozen=True)
class Index:
    """``postings`` term, evidence_id, block, part, impact; ``terms`` term, df, parts, most; ``blocks`` term, block, most."""

    postings: DataFrame
    terms: DataFrame
    blocks: DataFrame


def tokens(text: Column) -> Column:
    return F.coalesce(alpha_tokens(text), F.array().cast("array<string>"))


def counts(words: Column) -> Column:
    """``term, tf, n`` of each different word of an array of ``n`` words, by the ends of equal stretches of the sorted words."""
    ends = lambda s: F.filter(F.sequence(F.lit(1), F.size(s)), lambda i: ~F.coalesce(F.get(s, i) == F.get(s, i - 1), F.lit(False)))
    one = lambda s, e: F.transform(
        e, lambda end, j: F.struct(F.get(s, end - 1).alias("term"), (end - F.coalesce(F.get(e, j - 1), F.lit(0))).alias("tf"), F.size(s).alias("n"))
    )
    # Arrays of one element bind a value to a name, so that nothing is computed once per word and no words twice.
    return F.transform(F.array(F.sort_array(words)), lambda s: F.when(F.size(s) > 0, F.transform(F.array(ends(s)), lambda e: one(s, e))[0]))[0]


def counts_and_size(words: Column) -> Column:
    """``counts``, after one entry of no word (the empty ``term``, which is no word) that gives the size of every text."""
    size = lambda w: F.array(F.struct(F.lit("").alias("term"), F.lit(0).alias("tf"), F.size(w).alias("n")))
    none = F.array().cast("array<struct<term:string,tf:int,n:int>>")
    return F.transform(F.array(words), lambda w: F.concat(size(w), F.coalesce(counts(w), none)))[0]


def index(evidence: DataFrame, k1: float = 1.2, b: float = 0.75, block_texts: int = BLOCK_TEXTS, part_rows: int = PART_ROWS, only: DataFrame | None = None, write_blocks: bool = True) -> Index:
    """Impacts of every (term, text) by BM25 over lower-case letter words (our choice), with their maxima.

    An index for given claims alone needs their terms only: the column ``term`` of ``only``; the maxima of
    blocks, which are then read once or not at all, need not be written.
    """
    # Words are counted inside their row and written, so texts are split once and only different words are moved, once, to their term.
    texts = once(evidence.select("evidence_id", "text"), c=counts_and_size(tokens(F.col("text"))))
    counted = texts.select("evidence_id", F.explode("c").alias("c")).select("evidence_id", "c.*")
    if only is not None:
        counted = _only(counted, "term", only.select("term").unionByName(evidence.sparkSession.createDataFrame([("",)], "term string")))
    written = Table(counted, "counted")
    sizes = written.df.filter("term = ''").agg(F.count(F.lit(1)).alias("docs"), F.avg("n").alias("mean")).collect()[0]
    docs, mean = sizes["docs"], max(sizes["mean"] or 0.0, 1.0)
    counted = written.df.filter("term != ''")
    df = counted.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    tf = counted.withColumn("n", F.col("n").cast("int"))
    idf = F.log(1 + (docs - F.col("df") + 0.5) / (F.col("df") + 0.5))
    impact = idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("n") / mean))
    blocks = max(1, -(-docs // block_texts))
    of_text = F.xxhash64("evidence_id")
    postings = tf.join(df, "term").select(
        "term", "evidence_id", F.pmod(of_text, F.lit(blocks)).alias("block"), F.pmod(F.shiftright(of_text, 7), F.ceil(F.col("df") / part_rows)).alias("part"), impact.alias("impact"), "df"
    )
    postings = Table(postings, "postings").df
    written.drop()
    terms = postings.groupBy("term").agg(F.max("df").alias("df"), F.max("impact").alias("most")).withColumn("parts", F.ceil(F.col("df") / part_rows))
    by_block = postings.groupBy("term", "block").agg(F.max("impact").alias("most"))
    return Index(postings.drop("df"), Table(terms, "index").df, Table(by_block, "index").df if write_blocks else by_block)


def _only(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """``rows`` of the wanted values if these are few enough to be sent, else all: what follows is a join on them anyway."""
    wanted = wanted.distinct()
    return rows.join(F.broadcast(wanted), column, "left_semi") if wanted.limit(SENT_ROWS + 1).count() <= SENT_ROWS else rows


def claim_terms(claims: DataFrame) -> DataFrame:
    """``claim_id, term``: the different words of each claim."""
    return claims.select("claim_id", F.explode(F.array_distinct(tokens(F.col("text")))).alias("term"))


def _meet(asked: DataFrame, postings: DataFrame) -> DataFrame:
    """Asked terms (``claim_id, term, parts``) with their postings; a term meets each of its parts."""
    dealt = asked.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    return dealt.join(postings, ["term", "part"])


def scores(pairs: DataFrame, asked: DataFrame, postings: DataFrame) -> DataFrame:
    """``claim_id, evidence_id, score``: whole scores of the given pairs, by the keys (term, text)."""
    pairs = Table(pairs, "pairs").df
    some = _only(postings.select("term", "evidence_id", "impact"), "evidence_id", pairs.select("evidence_id"))
    terms = pairs.join(asked.select("claim_id", "term"), "claim_id")
    return terms.join(some, ["term", "evidence_id"]).groupBy("claim_id", "evidence_id").agg(F.sum("impact").alias("score"))


def floors(asked: DataFrame, postings: DataFrame, k: int, seed_terms: int = SEED_TERMS, seed_rows: int = SEED_ROWS, seed_texts: int = SEED_TEXTS) -> DataFrame:
    """``claim_id, floor``: a score that the k-th best text of the claim has at least; no row where none is known."""
    strongest = W.partitionBy("claim_id").orderBy(F.desc("most"), "df", "term")
    some = asked.withColumns({"nth": F.row_number().over(strongest), "rows": F.sum("df").over(strongest.rowsBetween(W.unboundedPreceding, 0))})
    some = some.filter((F.col("nth") == 1) | ((F.col("nth") <= seed_terms) & (F.col("rows") <= seed_rows)))
    partial = _meet(some.select("claim_id", "term", "parts"), postings).groupBy("claim_id", "evidence_id").agg(F.sum("impact").alias("score"))
    best = W.partitionBy("claim_id").orderBy(F.desc("score"), "evidence_id")
    first = partial.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= k * seed_texts).select("claim_id", "evidence_id")
    ranked = scores(first, asked, postings).withColumn("nth", F.row_number().over(best)).filter(F.col("nth") == k)
    return ranked.select("claim_id", (F.col("score") - SLACK).alias("floor"))


def candidates(asked: DataFrame, known: Index, k: int, **named) -> DataFrame:
    """``claim_id, evidence_id``: every text that can be among the k best of a claim."""
    asked = asked.join(floors(asked, known.postings, k, **named), "claim_id", "left").withColumn("floor", F.coalesce("floor", F.lit(0.0)))
    weakest = W.partitionBy("claim_id").orderBy("most", "term").rowsBetween(W.unboundedPreceding, 0)
    asked = asked.withColumn("essential", F.sum("most").over(weakest) >= F.col("floor"))
    asked = Table(asked, "asked").df
    partial = _meet(asked.filter("essential").select("claim_id", "term", "parts", "floor"), known.postings).groupBy("claim_id", "evidence_id", "block")
    partial = Table(partial.agg(F.sum("impact").alias("score"), F.max("floor").alias("floor")), "partial").df
    # Bounds of the blocks that hold candidates only.
    met = partial.select("claim_id", "block").distinct().join(asked.filter("NOT essential").select("claim_id", "term"), "claim_id")
    bounds = met.join(known.blocks, ["term", "block"]).groupBy("claim_id", "block").agg(F.sum("most").alias("rest"))
    bounded = partial.join(bounds, ["claim_id", "block"], "left")
    return bounded.filter(F.col("score") + F.coalesce("rest", F.lit(0.0)) + SLACK >= F.col("floor")).select("claim_id", "evidence_id")


def _kth(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of all scores that can be among the k best; places are in the order of the ids.

    Scores within the rounding of the k-th best stay, of equal ones the k first.
    """
    if len(scores) <= k:
        return np.arange(len(scores))
    low = np.partition(scores, len(scores) - k)[len(scores) - k] - 2 * SLACK
    found = np.flatnonzero(scores >= low)
    if len(found) <= k:
        return found
    order = np.lexsort((found, scores[found]))
    values = scores[found][order]
    starts = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    nth = np.arange(len(values)) - np.repeat(starts, np.diff(np.r_[starts, len(values)]))
    return found[order[nth < k]]


def _ranges(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All places of the ranges, one range after the other."""
    return np.arange(lengths.sum()) + np.repeat(begins - np.r_[0, np.cumsum(lengths)[:-1]], lengths)


def _best(claim_at: np.ndarray, claim_terms: np.ndarray, text_at: np.ndarray, text_terms: np.ndarray, impacts: np.ndarray, n_terms: int, order: np.ndarray, k: int):
    """Claims, texts (their places) and scores: what can be among the k best texts of each claim within one cell.

    Terms are numbers below ``n_terms``; those of claim ``i`` lie in ``claim_terms[claim_at[i]:claim_at[i + 1]]``, texts likewise,
    and ``order`` is the place of each text by its id.  Sums in single precision only find the texts worth
    scoring: frequent terms by one matrix product, the others by their postings.  Such a sum of m positive terms is wrong by less than
    (m + 3) / 2^23 of itself, and texts within that of the k-th best are scored exactly, from their own postings.
    """
    n, lengths = len(text_at) - 1, np.diff(text_at)
    held = np.bincount(text_terms, minlength=n_terms)
    begins = np.r_[0, np.cumsum(held)]
    by_term = np.argsort(text_terms, kind="stable")
    which, small = np.repeat(np.arange(n), lengths)[by_term], impacts[by_term].astype(np.float32)
    del by_term
    width = -(-max(n, 1) // PEAK) * PEAK
    frequent = np.argsort(-held, kind="stable")[: MATRIX_BYTES // (4 * width)]
    frequent = frequent[held[frequent] * FREQUENT >= max(n, 1)]
    column = np.full(n_terms, -1, np.int32)
    column[frequent] = np.arange(len(frequent))
    matrix = np.zeros((len(frequent), width), np.float32)
    for row, t in zip(matrix, frequent.tolist()):
        row[which[begins[t] : begins[t + 1]]] = small[begins[t] : begins[t + 1]]
    claims = len(claim_at) - 1
    rows = max(1, min(claims, 128, BLOCK_BYTES // (4 * width)))
    local = np.full(n_terms, -1, np.int32)
    for at in range(0, claims, rows):
        to = min(at + rows, claims)
        counts, terms = np.diff(claim_at[at : to + 1]), claim_terms[claim_at[at] : claim_at[to]]
        who = np.repeat(np.arange(to - at), counts)
        place = column[terms]
        weights = np.zeros((to - at, len(frequent)), np.float32)
        weights[who[place >= 0], place[place >= 0]] = 1
        sums = weights @ matrix
        rest = np.flatnonzero((place < 0) & (held[terms] > 0))
        for c, i, j in zip(who[rest].tolist(), begins[terms[rest]].tolist(), begins[terms[rest] + 1].tolist()):
            sums[c][which[i:j]] += small[i:j]
        # As many texts as there are peaks reach the k-th peak at least.
        peaks = sums.reshape(to - at, PEAK, -1).max(axis=1)
        low = np.partition(peaks, -k, axis=1)[:, -k] if peaks.shape[1] >= k else np.zeros(to - at, np.float32)
        low = low * (1 - 4 * (counts + 3) / 2.0**23) - 4 * SLACK
        low = np.maximum(low, np.finfo(np.float32).tiny).astype(np.float32)
        c, text = np.nonzero(peaks >= low[:, None])
        c, text = np.repeat(c, PEAK), (text[:, None] + np.arange(PEAK) * peaks.shape[1]).ravel()
        high = sums[c, text] >= low[c]
        c, text = c[high], text[high]
        by_id = np.lexsort((order[text], c))
        c, text = c[by_id], text[by_id]
        # The block's terms by small numbers; the last column stands for all others.
        own, place = np.unique(terms, return_inverse=True)
        local[own] = np.arange(len(own))
        asked = np.zeros((to - at, len(own) + 1), bool)
        asked[who, place] = True
        # A claim's texts are scored together; no more of them at once than the cell has postings, or some blocks of them.
        ends, score = np.cumsum(lengths[text]), np.empty(len(text))
        cuts = np.r_[0, np.flatnonzero(np.diff(ends // SCORED_ROWS)) + 1, len(text)]
        for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if i < j:
                sizes = lengths[text[i:j]]
                place = _ranges(text_at[text[i:j]], sizes)
                score[i:j] = np.add.reduceat(np.where(asked[np.repeat(c[i:j], sizes), local[text_terms[place]]], impacts[place], 0.0), np.r_[0, np.cumsum(sizes)[:-1]])
        local[own] = -1
        firsts = np.searchsorted(c, np.arange(to - at + 1))
        for i in range(to - at):
            best = firsts[i] + _kth(score[firsts[i] : firsts[i + 1]], k)
            if len(best):
                yield np.full(len(best), at + i), text[best], score[best]


def _found(best, claim_ids: pa.Array, text_ids: pa.Array) -> pa.Table:
    """``claim_id, evidence_id, score`` of what ``_best`` gives."""
    who, which, score = (np.concatenate(parts) for parts in zip((np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)), *best))
    return pa.table({"claim_id": claim_ids.take(pa.array(who)), "evidence_id": text_ids.take(pa.array(which)), "score": score})


def _places(ids: pa.Array) -> np.ndarray:
    """The place of each id in their order."""
    places = np.empty(len(ids), np.int64)
    places[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))
    return places


def _score_cell(asked: pa.Table, postings: pa.Table, k: int) -> pa.Table:
    """``claim_id, evidence_id, score``: what can be among the k best texts of each claim within one cell."""
    asked, postings = asked.sort_by([("claim_id", "ascending"), ("t", "ascending")]), postings.sort_by([("evidence_id", "ascending"), ("t", "ascending")])
    claims, texts = (pc.dictionary_encode(t.column(c).combine_chunks()) for t, c in ((asked, "claim_id"), (postings, "evidence_id")))
    known = np.unique(asked.column("t").to_numpy())
    held = np.searchsorted(known, postings.column("t").to_numpy())
    mine = np.flatnonzero(known[np.minimum(held, len(known) - 1)] == postings.column("t").to_numpy()) if len(known) else np.empty(0, np.int64)
    firsts = lambda places, n: np.searchsorted(places, np.arange(n + 1))
    text_at = firsts(texts.indices.to_numpy()[mine], len(texts.dictionary))
    claim_at = firsts(claims.indices.to_numpy(), len(claims.dictionary))
    own = np.searchsorted(known, asked.column("t").to_numpy())
    return _found(_best(claim_at, own, text_at, held[mine], postings.column("impact").to_numpy()[mine], len(known), _places(texts.dictionary), k), claims.dictionary, texts.dictionary)


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Where the lists of a column begin, and their values one after the other."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy()
    values = pc.list_flatten(column)
    return np.r_[0, np.cumsum(sizes, dtype=np.int64)], values.to_numpy()


def _score_texts(asked: pa.Table, texts: pa.Table, k: int, docs: int, mean: float, k1: float, b: float) -> pa.Table:
    """As ``_score_cell``, of whole claims and texts; rows of ``asked`` with ``df`` are terms, not claims."""
    words, claims = asked.filter(pc.is_valid(asked.column("df"))), asked.filter(pc.is_valid(asked.column("claim_id")))
    known, df = _lists(words.column("terms"))[1], _lists(words.column("df"))[1]
    by_term = np.argsort(known)
    known, df = known[by_term], df[by_term]
    idf = np.log(1 + (docs - df + 0.5) / (df + 0.5))

    def numbered(table):
        """The table's lists as numbers of known terms, and which of their places these are."""
        at, terms = _lists(table.column("terms"))
        places = np.empty(len(terms), np.int32)
        for i in range(0, len(terms), SCORED_ROWS):
            part = terms[i : i + SCORED_ROWS]
            found = np.searchsorted(known, part)
            places[i : i + SCORED_ROWS] = np.where(known[np.minimum(found, len(known) - 1)] == part, found, -1) if len(known) else -1
        mine = places >= 0
        return np.r_[0, np.cumsum(mine)][at], places[mine], mine

    claim_at, claim_terms, _ = numbered(claims)
    claim_ids, text_ids = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (claims.column("claim_id"), texts.column("evidence_id")))
    text_at, text_terms, mine = numbered(texts)
    tf = _lists(texts.column("tf"))[1][mine].astype(np.float64)
    norm = np.repeat(k1 * (1 - b + b * texts.column("n").to_numpy() / mean), np.diff(text_at))
    del asked, claims, texts, mine
    impacts = idf[text_terms] * tf * (k1 + 1) / (tf + norm)
    del tf, norm
    return _found(_best(claim_at, claim_terms, text_at, text_terms, impacts, len(known), _places(text_ids), k), claim_ids, text_ids)


def scored_in_cells(asked: DataFrame, postings: DataFrame, k: int, chunk_rows: int = CHUNK_ROWS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``claim_id, evidence_id, score``: whole scores of all texts that can be among the k best of a claim."""
    # Small numbers stand for terms; where these are few, their table is sent to every task.
    numbers = Table(asked.select("term").distinct().withColumn("t", F.monotonically_increasing_id()), "numbers").df
    numbers = F.broadcast(numbers) if numbers.count() <= SENT_ROWS else numbers
    chunks, groups = max(1, -(-asked.count() // chunk_rows)), max(1, -(-postings.count() // group_rows))
    # Claims are fewer than postings, so for as many cells as there are cores they are the ones to repeat.
    groups = max(groups, -(-asked.sparkSession.sparkContext.defaultParallelism // chunks))
    deal = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.filter("claim_id IS NOT NULL").join(numbers, "term").select("claim_id", F.col("t").alias("t"), deal("claim_id", chunks).alias("x"), every(groups).alias("y"))
    right = postings.join(numbers, "term").select("evidence_id", F.col("t").alias("t"), "impact", deal("evidence_id", groups).alias("y"), every(chunks).alias("x"))
    types = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c, df in (("claim_id", asked), ("evidence_id", postings)))
    return left.groupBy("x", "y").cogroup(right.groupBy("x", "y")).applyInArrow(lambda a, b: _score_cell(a, b, k), f"{types}, score double")


def ranked(claims: DataFrame, evidence: DataFrame, k: int = 5, k1: float = 1.2, b: float = 0.75, asked_rows: int = ASKED_ROWS, claim_rows: int = CLAIM_ROWS, text_rows: int = TEXT_ROWS) -> DataFrame:
    """``claim_id, evidence_id, score, rank``: as ``rank``, of claims and texts of which no index is kept.

    Many claims meet nearly all postings, so these are not moved to their terms: whole texts and whole claims are
    dealt into cells, words as 64-bit hashes that differ for all words there are, with the counts of the claims' words.
    """
    if claim_terms(claims).limit(asked_rows + 1).count() <= asked_rows:
        return rank(claims, index(evidence, k1, b, only=claim_terms(claims), write_blocks=False), k)
    split = once(evidence.select("evidence_id", "text"), words=tokens(F.col("text"))).select("evidence_id", F.size("words").alias("n"), counts(F.col("words")).alias("words"))
    none = F.array().cast("array<struct<term:string,tf:int>>")
    texts = Table(split.withColumn("words", F.coalesce(F.transform("words", lambda w: F.struct(w["term"], w["tf"])), none)), "texts", "zstd").df
    sizes = texts.agg(F.count(F.lit(1)).alias("docs"), F.avg("n").alias("mean")).collect()[0]
    docs, mean = sizes["docs"], max(sizes["mean"] or 0.0, 1.0)
    df = texts.select(F.explode("words.term").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    by_claims = claim_terms(claims).groupBy("term").agg(F.count(F.lit(1)).alias("claims"))
    words = Table(df.join(by_claims, "term", "full"), "words").df
    seed = 0
    while not words.groupBy(_hash(F.col("term"), seed)).count().filter("count > 1").isEmpty():
        seed += 1
    rows = words.agg(F.sum("claims").alias("claims"), F.sum("df").alias("texts")).collect()[0]
    free_shuffles(claims.sparkSession)
    chunks, groups = max(1, -(-(rows["claims"] or 0) // claim_rows)), max(1, -(-(rows["texts"] or 0) // text_rows))
    groups = max(groups, -(-claims.sparkSession.sparkContext.defaultParallelism // chunks))
    numbers = lambda n: F.sequence(F.lit(0), F.lit(n - 1))
    deal = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    hashes = lambda c: F.transform(c, lambda w: _hash(w, seed))
    left = claims.filter("claim_id IS NOT NULL").select("claim_id", hashes(F.array_distinct(tokens(F.col("text")))).alias("terms"), F.lit(None).cast("array<bigint>").alias("df"))
    left = left.withColumn("x", deal("claim_id", chunks))
    # Terms go along to every cell, some in a row.
    both = words.filter("df IS NOT NULL AND claims IS NOT NULL").select(_hash(F.col("term"), seed).alias("t"), "df").groupBy(F.pmod("t", F.lit(-(-words.count() // 1000) or 1)))
    both = both.agg(F.collect_list(F.struct("t", "df")).alias("w")).select(F.lit(None).cast(claims.schema["claim_id"].dataType).alias("claim_id"), F.col("w.t").alias("terms"), F.col("w.df").alias("df"))
    left = left.unionByName(both.withColumn("x", F.explode(numbers(chunks)))).withColumn("y", F.explode(numbers(groups)))
    right = texts.select("evidence_id", "n", hashes(F.col("words.term")).alias("terms"), F.col("words.tf").alias("tf"), deal("evidence_id", groups).alias("y")).withColumn("x", F.explode(numbers(chunks)))
    types = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c, df in (("claim_id", claims), ("evidence_id", evidence)))
    scored = left.groupBy("x", "y").cogroup(right.groupBy("x", "y")).applyInArrow(lambda c, t: _score_texts(c, t, k, docs, mean, k1, b), f"{types}, score double")
    return _first(scored, k)


def _hash(term: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), term)


def _first(scored: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("claim_id").orderBy(F.desc(F.round("score", 9)), "evidence_id")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def rank(claims: DataFrame, known: Index, k: int = 5, pair_rows: int = PAIR_ROWS, **named) -> DataFrame:
    """``claim_id, evidence_id, score, rank``: the k best texts of every claim (``claim_id, text``)."""
    asked = Table(claim_terms(claims).join(known.terms, "term"), "asked").df
    known = Index(_only(known.postings, "term", asked.select("term")), known.terms, known.blocks)
    if (asked.agg(F.sum("df").alias("met")).collect()[0]["met"] or 0) > pair_rows:
        scored = scored_in_cells(asked, known.postings, k)
    else:
        scored = scores(candidates(asked, known, k, **named), asked, known.postings)
    return _first(scored, k)
