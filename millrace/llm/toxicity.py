r"""Toxicity by votes of the nearest labelled examples, exact TF-IDF cosine.

1. A bounded sample of the labelled training rows (at most about ``max_examples``,
   half of each label, chosen by a hash of the id) becomes the set of examples.
2. The vocabulary is every word that ``min_examples`` examples hold.  A word's weight is its
   inverse document frequency, counted over all documents, times its relevance
   ``floor + (g / (g + half)) ** 2``, where g is the likelihood ratio of the word's presence and
   the label among the examples.  No word has weight 0: words that go with a label lead,
   all others tell texts apart.
3. The examples are put into an inverted index in blocks of ``BLOCK`` examples.  For
   a query the largest weight of each term in each block bounds the cosine of a
   whole block; the blocks with the highest bounds are scored first and only
   blocks whose bound reaches the k-th best cosine are scored after them, so the
   result is exact.
4. Neighbours vote with weight 1 / (1 - cosine + 0.05).  The vote is calibrated by
   logistic regression on leave-one-out votes of the examples, which are weighted
   back to the labels' frequencies among all training rows.

Examples, vocabulary (``max_terms`` words at most, the most relevant) and index are bounded by
parameters, so they can be broadcast; document vectors stay in a table.

Defined cases: null, empty and term-less texts have no neighbour and get the
calibrated frequency of such examples; without examples of both labels every score
is the labels' mean (0 if there is none); rows of ``labels`` that repeat an id
count once with the largest label; null labels are ignored; of rows that repeat a
labelled id with several texts the smallest text is the example; equal cosines go to
the example with the smaller id; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_size, cut, fold, pieces

BLOCK = 64
MAX_EXAMPLES = 8192
MAX_TERMS = 1 << 20
#: Queries whose frequent terms are multiplied at once.
_TOGETHER = 128
#: ASCII letters in lower case and all other characters above ASCII stay, anything else parts words.
_LETTERS = bytes(i + 32 if 65 <= i <= 90 else i if 97 <= i <= 122 or i > 127 else 32 for i in range(256))


def words_of(text: str | bytes | None) -> list[bytes]:
    raw = text if isinstance(text, bytes) else (text or "").encode("utf-8", "surrogatepass")
    return raw.translate(_LETTERS).split()


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The numbers of all the ranges, one after another."""
    sizes = ends - starts
    ends_here = np.cumsum(sizes)
    return np.arange(int(ends_here[-1]) if len(sizes) else 0) + np.repeat(starts - ends_here + sizes, sizes)


class BlockMaxIndex:
    """Inverted index over unit vectors; ``search`` gives the exact k nearest by cosine.

    Postings are sorted by term and example; a segment is a term's postings in one block.
    Terms that more than a thirty-second of the examples hold bound little; their weights are a
    matrix, and what they add to all cosines of many queries is one product (``base``).
    Only the vectors are pickled; whoever loads an index builds the rest anew.
    """

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]]):
        sizes = np.array([len(ids) for ids, _ in vectors], dtype=np.int64)
        terms = np.concatenate([np.empty(0, np.int32), *(ids for ids, _ in vectors)]).astype(np.int32)
        self.__setstate__((sizes, terms, np.concatenate([np.empty(0), *(w for _, w in vectors)])))

    def __getstate__(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.given

    def __setstate__(self, given: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
        self.given = given
        sizes, terms, weights = given
        self.size = len(sizes)
        self.blocks = -(-self.size // BLOCK)
        owner = np.repeat(np.arange(self.size), sizes)
        terms = terms.astype(np.int64)
        found, place, df = np.unique(terms, return_inverse=True, return_counts=True)
        often = 32 * df > max(self.size, BLOCK)
        self.frequent = found[often]
        dense = often[place]
        self.dense = np.zeros((len(self.frequent), self.size))
        self.dense[np.searchsorted(self.frequent, terms[dense]), owner[dense]] = weights[dense]
        owner, terms, weights = owner[~dense], terms[~dense], weights[~dense]
        order = np.lexsort((owner, terms))
        self.owner, terms, self.weights = owner[order], terms[order], weights[order]
        self.block_of = np.arange(self.size) // BLOCK
        self.block_starts = np.arange(0, self.size, BLOCK)
        block = self.owner // BLOCK
        self.start = np.flatnonzero(np.r_[True, (terms[1:] != terms[:-1]) | (block[1:] != block[:-1])][: len(terms)])
        self.end = np.r_[self.start[1:], len(terms)].astype(np.int64)[: len(self.start)]
        self.block = block[self.start]
        self.top = np.maximum.reduceat(self.weights, self.start) if len(self.start) else np.empty(0)
        self.terms, first = np.unique(terms[self.start], return_index=True)
        self.first = np.r_[first, len(self.start)]

    def _score(self, segments: np.ndarray, q: np.ndarray) -> np.ndarray:
        """What the segments add to the cosine of each example."""
        at = _ranges(self.start[segments], self.end[segments])
        return np.bincount(self.owner[at], np.repeat(q, self.end[segments] - self.start[segments]) * self.weights[at], minlength=self.size)

    def base(self, queries: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """What the frequent terms add to the cosine of each query and example."""
        rows = np.zeros((len(queries), len(self.frequent)))
        for row, (ids, weights) in zip(rows, queries):
            place, here = self._find(self.frequent, ids)
            row[place] = weights[here]
        return rows @ self.dense

    @staticmethod
    def _find(terms: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.searchsorted(terms, ids)
        here = terms[np.minimum(place, len(terms) - 1)] == ids if len(terms) else np.zeros(len(ids), dtype=bool)
        return place[here], here

    def search(self, ids: np.ndarray, weights: np.ndarray, k: int, without: int = -1, base: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Example numbers and cosines above 0, best first, equal ones by number."""
        if not self.size:
            return np.empty(0, np.int64), np.empty(0)
        base = self.base([(ids, weights)])[0] if base is None else base
        place, here = self._find(self.terms, ids)
        segments = _ranges(self.first[place], self.first[place + 1])
        q = np.repeat(weights[here], self.first[place + 1] - self.first[place])
        block = self.block[segments]
        bound = np.bincount(block, q * self.top[segments], minlength=self.blocks) + np.maximum.reduceat(base, self.block_starts)
        few = min(self.blocks, 2 + k // BLOCK)
        wanted = np.zeros(self.blocks, dtype=bool)
        wanted[np.argpartition(-bound, few - 1)[:few]] = True
        first = wanted[block]
        total = np.where(wanted[self.block_of], base, 0.0) + self._score(segments[first], q[first])
        if without >= 0:
            total[without] = 0.0
        seen = total[wanted[self.block_of]]
        kth = np.partition(seen, -k)[-k] if len(seen) > k else 0.0
        more = ~wanted & (bound >= kth - 1e-12) & (bound > 0)
        if more.any():
            rest = more[block]
            total += np.where(more[self.block_of], base, 0.0) + self._score(segments[rest], q[rest])
            if without >= 0:
                total[without] = 0.0
        found = np.flatnonzero(total >= max(kth, 1e-12))
        if len(found) > k:
            least = np.partition(total[found], -k)[-k]
            found = found[total[found] >= least]
        best = found[np.lexsort((found, -total[found]))][:k]
        return best, total[best]


def _weigh(counts: np.ndarray, weight: np.ndarray) -> np.ndarray:
    x = (1.0 + np.log(counts)) * weight
    norm = np.sqrt((x * x).sum())
    return x / norm if norm else x


def _vote(labels: np.ndarray, cosines: np.ndarray) -> float:
    w = 1.0 / (1.05 - np.minimum(cosines, 1.0))
    return float((w * labels).sum() / w.sum())


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Weighted logistic regression of one variable with a slight penalty, by Newton steps."""
    design, beta = np.stack([x, np.ones_like(x)], axis=1), np.zeros(2)
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (w * (p - y)) + 1e-3 * beta
        hessian = (design * (w * p * (1 - p) + 1e-9)[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


class Model:
    """Index, labels and calibration; ``score`` works on one document's term counts."""

    def __init__(self, example_ids, labels: np.ndarray, weights: np.ndarray, counts: list[tuple[np.ndarray, np.ndarray]], weight: np.ndarray, k: int, fallback: float):
        self.example_ids, self.labels, self.weight, self.k, self.fallback = example_ids, labels, weight, k, fallback
        self.usable = bool(len(labels)) and 0 < labels.mean() < 1
        self._known: dict[bytes, tuple[float, list]] = {}  # copies are frequent
        if not self.usable:
            return
        vectors = [(ids, _weigh(n, weight[ids])) for ids, n in counts]
        self.index = BlockMaxIndex(vectors)
        votes = np.full(len(labels), np.nan)
        for at in range(0, len(vectors), _TOGETHER):
            part = vectors[at : at + _TOGETHER]
            for i, ((ids, w), base) in enumerate(zip(part, self.index.base(part)), at):
                best, cosines = self.index.search(ids, w, k, i, base)
                if len(best):
                    votes[i] = _vote(labels[best], cosines)
        has = ~np.isnan(votes)
        self.slope, self.offset = _logistic(votes[has], labels[has], weights[has])
        self.fallback = float(((weights * labels)[~has].sum() + fallback) / (weights[~has].sum() + 1.0))

    def scores(self, texts: list[tuple[np.ndarray, np.ndarray]], n_evidence: int = 5) -> list[tuple[float, list]]:
        """Score and evidence of each text, given the numbers and counts of its words; copies are looked up once."""
        if not self.usable:
            return [(self.fallback, [])] * len(texts)
        keys = [blake2b(ids.tobytes() + counts.tobytes(), digest_size=16).digest() for ids, counts in texts]
        if len(self._known) > 50_000:
            self._known.clear()
        fresh = {key: text for key, text in zip(keys, texts) if key not in self._known}
        queries = [(ids, _weigh(counts, self.weight[ids])) for ids, counts in fresh.values()]
        order = list(fresh)
        for at in range(0, len(order), _TOGETHER):
            part = queries[at : at + _TOGETHER]
            for key, (ids, w), base in zip(order[at : at + _TOGETHER], part, self.index.base(part)):
                best, cosines = self.index.search(ids, w, self.k, base=base)
                if len(best):
                    z = self.slope * _vote(self.labels[best], cosines) + self.offset
                    self._known[key] = float(1.0 / (1.0 + np.exp(-z))), [self.example_ids[i] for i in best[:n_evidence]]
                else:
                    self._known[key] = self.fallback, []
        return [self._known[key] for key in keys]


def vectors(docs: DataFrame, terms: list[bytes], keys: list[str]) -> DataFrame:
    """``keys``, ``ids, counts``: the vocabulary words of the ``text`` of every row, ids ascending."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)
    n = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: i for i, t in enumerate(shared.value)}
        size = max(len(number), 1)
        for batch in (part for whole in batches for part in by_size(whole, n, 4 << 20)):
            texts = batch.column(n).cast(pa.large_binary())
            found = [np.fromiter(map(number.get, words, repeat(-1)), np.int64, len(words)) for words in (words_of(t.as_py()) for t in texts)]
            # One sort of (row, word) counts the words of all texts of the batch.
            rows = np.repeat(np.arange(len(found)), [len(f) for f in found])
            ids = np.concatenate([np.empty(0, np.int64), *found])
            cells, counts = np.unique((rows * size + ids)[ids >= 0], return_counts=True)
            ends = np.searchsorted(cells, np.arange(len(found) + 1) * size)
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (cells % size, counts)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], *lists], names=[*keys, "ids", "counts"])

    kinds = ", ".join(f"{k} {docs.schema[k].dataType.simpleString()}" for k in keys)
    return docs.select(*keys, "text").mapInArrow(run, f"{kinds}, ids array<int>, counts array<int>")


def _vocabulary(examples: DataFrame, n_pos: int, n_neg: int, max_terms: int, min_examples: int, floor: float, half: float) -> tuple[list[bytes], np.ndarray]:
    """The words of at least ``min_examples`` examples in byte order, and the relevance of each."""

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pos: Counter[bytes] = Counter()
        neg: Counter[bytes] = Counter()
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1)):
                (pos if label.as_py() else neg).update(set(words_of(text.as_py())))
        terms = sorted(pos.keys() | neg.keys())
        for at in range(0, len(terms), 20_000):
            part = terms[at : at + 20_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.binary()), pa.array([pos[t] for t in part], pa.int64()), pa.array([neg[t] for t in part], pa.int64())],
                names=["term", "p", "n"],
            )

    seen = examples.select("text", "label").mapInArrow(present, "term binary, p bigint, n bigint").groupBy("term").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
    p, n = F.col("p").cast("double"), F.col("n").cast("double")
    total = n_pos + n_neg

    def part(seen_in, of_all, of_term):
        return F.when(seen_in > 0, seen_in * F.log(seen_in * total / (of_all * of_term))).otherwise(0.0)

    with_term, without = p + n, total - (p + n)
    g2 = 2 * (part(p, F.lit(n_pos), with_term) + part(n, F.lit(n_neg), with_term) + part(n_pos - p, F.lit(n_pos), without) + part(n_neg - n, F.lit(n_neg), without))
    kept = seen.filter(with_term >= min_examples).select("term", F.greatest(g2, F.lit(0.0)).alias("g2"))
    rows = sorted((bytes(r["term"]), r["g2"]) for r in kept.orderBy(F.desc("g2"), "term").limit(max_terms).collect())
    g = np.array([r[1] for r in rows])
    return [r[0] for r in rows], floor + (g / (g + half)) ** 2


def _frequencies(counted: DataFrame, size: int) -> DataFrame:
    """``id, n``: how many rows hold each term; a task sends one row per term, not per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(size, dtype=np.int64)
        for batch in batches:
            n += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        ids = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int32)), pa.array(n[ids])], names=["id", "n"])

    return counted.select("ids").mapInArrow(run, "id int, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    modulus: int = 5,
    k: int = 15,
    max_examples: int = MAX_EXAMPLES,
    max_terms: int = MAX_TERMS,
    min_examples: int = 2,
    floor: float = 0.05,
    half: float = 40.0,
) -> DataFrame:
    """``doc_id, held_out, score, predicted, evidence`` for every row of ``docs``."""
    spark = docs.sparkSession
    known = labels.filter(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull() & (fold("doc_id", modulus) != 0))
    known = known.groupBy("doc_id").agg(F.max(F.when(F.col(label_col) == 1, 1).otherwise(0)).alias("label"))
    per_label = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_all = sum(per_label.values())
    share = {c: min(1.0, max_examples / 2 / n) for c, n in per_label.items()}
    chance = F.when(F.col("label") == 1, share.get(1, 0.0)).otherwise(share.get(0, 0.0))
    drawn = known.filter(F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1 << 20)) < chance * (1 << 20))
    # Bounded by max_examples, so its ids can go to every task.
    drawn = cut(drawn, "drawn")
    keyed = docs.select(F.col(id_col).alias("doc_id"), (fold(id_col, modulus) == 0).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    examples = keyed.join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    examples = cut(examples, "examples")
    sampled = {r["label"]: r["n"] for r in examples.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    terms, relevance = [], np.zeros(0)
    if len(sampled) == 2:
        terms, relevance = _vocabulary(examples, sampled[1], sampled[0], max_terms, min_examples, floor, half)
    counted = cut(vectors(keyed, terms, ["doc_id", "held_out"]), "vectors")
    df = np.zeros(len(terms))
    seen_in = _frequencies(counted, len(df)).toArrow()
    df[seen_in["id"].to_numpy()] = seen_in["n"].to_numpy()
    idf = np.log((1.0 + counted.count()) / (1.0 + df)) + 1.0
    rows = vectors(examples, terms, ["doc_id", "label"]).toArrow().sort_by("doc_id").combine_chunks()
    label_of = np.array(rows["label"].to_pylist(), dtype=int)
    ids, counts = ([x.values.to_numpy().astype(kind) for x in rows[c]] for c, kind in (("ids", np.int64), ("counts", float)))
    weight = {c: per_label[c] / sampled[c] for c in sampled}
    model = Model(
        rows["doc_id"].to_pylist(),
        label_of.astype(float),
        np.array([weight[label] for label in label_of.tolist()]),
        list(zip(ids, counts)),
        idf * relevance,
        k,
        per_label.get(1, 0) / n_all if n_all else 0.0,
    )
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in pieces(whole)):
            ends = batch.column(2).offsets.to_numpy()
            ends = ends - ends[:1]
            ids, counts = batch.column(2).flatten().to_numpy().astype(np.int64), batch.column(3).flatten().to_numpy().astype(float)
            found = shared.value.scores([(ids[a:b], counts[a:b]) for a, b in zip(ends[:-1], ends[1:])])
            score = [f[0] for f in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(score, pa.float64()),
                    pa.array([int(s >= 0.5) for s in score], pa.int32()),
                    pa.array([f[1] for f in found], pa.list_(batch.schema.field(0).type)),
                ],
                names=["doc_id", "held_out", "score", "predicted", "evidence"],
            )

    id_type = docs.schema[id_col].dataType.simpleString()
    return counted.mapInArrow(run, f"doc_id {id_type}, held_out boolean, score double, predicted int, evidence array<{id_type}>")
