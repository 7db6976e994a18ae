r"""Language-model scores: Katz backoff over word bigrams.

Model.  ``c`` counts words (and one end per text, which also follows a start mark).

* Unigrams: P(w) = d(c) c / N with Good-Turing discounts d for c <= K; what the
  discounts free is the probability of the one unknown word, so P sums to 1.
* Bigrams: P(w | v) = d(c(vw)) c(vw) / c(v) if vw was seen, else alpha(v) P(w), with
  alpha(v) = (1 - sum of seen P(. | v)) / (1 - sum of P over the seen words), which makes
  P(. | v) sum to 1 exactly.  All sums behind alpha are sums of integers (counts,
  and numbers of words with a count of 1..K), so no order of summation matters.
* A token is evaluated recursively: bigram, else backoff weight and unigram, else
  the unknown word.

Tables.  Words are 64-bit hashes (two of V words collide with probability
V^2 / 2^65).  Pairs (v, w) are routed to the bucket of ``w``, so a bucket knows c(vw),
c(w) and with them both levels of a token's evaluation; contexts v are routed to
buckets of their own, which hold c(v) and alpha(v).  Both tables are Parquet,
partitioned by bucket, with packed columns.  Texts are scored by sending their pairs
to the word buckets and what remains of the context to the context buckets; only
packed hashes travel, never texts.  A word bucket asks each context bucket once, for all texts together,
so there are buckets^2 such rows and not as many for every chunk of texts.

Scale.  The number of buckets follows the corpus, so a bucket holds some
``BUCKET_TOKENS`` tokens.  A bounded sample of texts yields a code book of frequent
words (shorter codes in the pair table), the hot words (their pairs are spread over
all buckets by v) and the hot pairs (answered where the text is).  The sample changes
the layout only: every count and every score covers all rows, whatever it holds.
After counting, at most ``CACHED`` of the most frequent words go to every task with
c(w), c(v) and alpha(v); all other words are asked for in the tables.  Scores are
summed as integers in units of 2^-32, so sums do not depend on their order.

Defined cases: null text counts as empty and is one end token; a table without
training rows has N = 0 and gives every token probability 1 (score 0); rows that
repeat an id are texts of their own; null ids are hashed as empty text for the
fold; extra columns are ignored.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, fold, free_shuffles, read_cut, shared_dir

K = 5
BUCKET_TOKENS = 2_000_000
#: Tokens of texts that are packed together.
CHUNK_TOKENS = 1_000_000
SAMPLE_ROWS = 2_000
BOOK = 65_000
#: Most words that every task knows; the number of the others is not bounded.
CACHED = 1_000_000
UNIT = 2.0**32
#: Share of the sample's tokens from which a word or a pair is hot; bounds their number.
HOT = 0.001
END, START = np.uint64(xxhash.xxh64_intdigest(b" end")), np.uint64(xxhash.xxh64_intdigest(b" start"))
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(w: np.ndarray, v: np.ndarray | None = None) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = w * _A if v is None else w * _A + (v ^ (v >> np.uint64(31))) * _B
        return (x ^ (x >> np.uint64(29))) * _B


def _small(a: np.ndarray) -> np.ndarray:
    top = int(a.max()) if len(a) else 0
    return a.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def _pack(*arrays: np.ndarray) -> bytes:
    raw = pickle.dumps(arrays, protocol=5)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(data: bytes) -> tuple[np.ndarray, ...]:
    return pickle.loads(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True))


def _runs(a: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values, and the length of ``a``."""
    return np.r_[np.flatnonzero(np.r_[True, a[1:] != a[:-1]]), len(a)] if len(a) else np.zeros(1, np.int64)


def _find(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Positions of ``keys`` in the sorted ``table``, -1 where absent."""
    if not len(table):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All lower-case words of the texts, one after the other, and each text's number of them."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat = lists.values
    full = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    sums = np.r_[0, np.cumsum(full)]
    ends = lists.offsets.to_numpy()
    return flat.filter(pa.array(full)), sums[ends[1:]] - sums[ends[:-1]]


@dataclass(frozen=True)
class Layout:
    """What is fixed before counting; bounded by BOOK and 1 / HOT."""

    buckets: int
    book: np.ndarray
    hot_words: np.ndarray
    hot_pairs: np.ndarray


@dataclass(frozen=True)
class Tokens:
    """The tokens of a chunk as numbers of its distinct words; the last two are end and start."""

    kinds: np.ndarray
    w: np.ndarray
    v: np.ndarray
    owner: np.ndarray
    lengths: np.ndarray


def tokens(texts: pa.Array) -> Tokens:
    flat, n = words(texts)
    coded = flat.dictionary_encode()
    kinds = coded.dictionary.cast(pa.binary()).to_pylist()
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, kinds), dtype=np.uint64, count=len(kinds))
    lengths = n + 1
    ends = np.cumsum(lengths)
    w = np.full(int(ends[-1]) if len(ends) else 0, len(kinds), dtype=np.int64)
    inner = np.ones(len(w), dtype=bool)
    inner[ends - 1] = False
    w[inner] = coded.indices.to_numpy(zero_copy_only=False)
    v = np.r_[np.int64(len(kinds) + 1), w[:-1]] if len(w) else w
    v[ends - lengths] = len(kinds) + 1
    return Tokens(np.r_[hashes, END, START], w, v, np.repeat(np.arange(len(n)), lengths), lengths)


def _slices(batch: pa.RecordBatch, column: int, chunk: int = CHUNK_TOKENS) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``chunk`` tokens (six bytes each)."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 6)
    at, done = 0, 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(size, done + 6 * chunk, side="right")))
        yield batch.slice(at, to - at)
        at, done = to, int(size[to - 1])


def _bucket(layout: Layout, w: np.ndarray, v: np.ndarray, hot: np.ndarray) -> np.ndarray:
    bucket = _mix(w) % np.uint64(layout.buckets)
    bucket[hot] = _mix(w[hot], v[hot]) % np.uint64(layout.buckets)
    return bucket.astype(np.uint16 if layout.buckets < 1 << 16 else np.int64)


def _code(book: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """1 + the place in the book, 0 for a word that is not in it."""
    return (_find(book, hashes) + 1).astype(np.uint32)


def _coded(hashes: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words as codes, with the hashes of those without one."""
    return _small(code), hashes[code == 0]


def _decoded(code: np.ndarray, raw: np.ndarray, book: np.ndarray) -> np.ndarray:
    out = np.empty(len(code), dtype=np.uint64)
    has = code > 0
    out[has] = book[code[has].astype(np.int64) - 1]
    out[~has] = raw
    return out


def _pack_pairs(w: np.ndarray, w_code: np.ndarray, v: np.ndarray, v_code: np.ndarray, *more: np.ndarray) -> bytes:
    """Pairs grouped by w: w once per run, words by their codes where they have one."""
    runs = _runs(w)
    at = runs[:-1]
    return _pack(*_coded(w[at], w_code[at]), _small(np.diff(runs)), *_coded(v, v_code), *map(_small, more))


def _unpack_pairs(data: bytes, book: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct w with their codes, run lengths, v with their codes, and what else was packed."""
    w_code, w_raw, lengths, v_code, v_raw, *more = _unpack(data)
    return _decoded(w_code, w_raw, book), w_code, lengths.astype(np.int64), _decoded(v_code, v_raw, book), v_code, *more


def _fixed(x: np.ndarray) -> np.ndarray:
    return np.rint(x * UNIT).astype(np.int64)


def good_turing(n: list[int]) -> np.ndarray:
    """Discounts for counts 0..K+1 from n[r-1], the number of types seen r times (r = 1..K+1).

    Katz's formula; where the raw numbers give no discount between 0 and 1 for every r,
    they are smoothed by a line through log n over log r first, and where that does
    not fall steeply enough either, 1/2 is taken off each count instead.
    """
    r = np.arange(1, K + 2, dtype=float)
    counts = np.array(n, dtype=float)
    d = np.ones(K + 2)
    if (counts > 0).all():
        slope = np.polyfit(np.log(r), np.log(counts), 1)[0]
        for numbers in (counts, r**slope):
            common = (K + 1) * numbers[K] / numbers[0]
            if common < 1:
                d[1 : K + 1] = (r[1:] * numbers[1:] / (r[:-1] * numbers[:-1]) - common) / (1 - common)
                if ((d[1 : K + 1] > 0) & (d[1 : K + 1] < 1)).all():
                    return d
    d[1 : K + 1] = (r[:K] - 0.5) / r[:K]
    return d


@dataclass(frozen=True)
class Model:
    """Global figures and the bounded parts that every task gets; the tables stay on disk."""

    layout: Layout
    n_tokens: int
    n_types: int
    d1: np.ndarray
    d2: np.ndarray
    unknown: float
    scale: float
    hot_counts: np.ndarray
    pair_counts: np.ndarray
    pairs_path: str = ""
    contexts_path: str = ""
    cached: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    cached_count: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    cached_log_n: np.ndarray = field(default_factory=lambda: np.zeros(0))
    cached_log_alpha: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def log_unigram(self, c: np.ndarray) -> np.ndarray:
        p = self.scale * self.d1[np.minimum(c, K + 1)] * c / max(self.n_tokens, 1)
        return np.log10(np.where(c > 0, p, self.unknown))

    def log_base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 1.0) / (self.n_tokens + self.n_types + 1.0))

    def log_seen(self, c: np.ndarray) -> np.ndarray:
        return np.log10(self.d2[np.minimum(c, K + 1)] * np.maximum(c, 1))

    def context(self, n: np.ndarray, ones: np.ndarray, more: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 of c(v) (as a divisor) and of alpha(v), from the integer sums of contexts.

        ``n``: c(v).  ``ones[r]``: words that follow r + 1 times.  ``more``: sum of c(w) > K
        over the words that follow; ``kinds[r]``: how many of these have c(w) = r + 1.
        """
        r = np.arange(1, K + 1)
        mass = n - (ones * (r * (1 - self.d2[1 : K + 1]))).sum(axis=1)
        # A context without discounted words gives the share 1 / (n + 1) to the others.
        divisor = np.where(mass >= n, n + 1.0, n)
        lower = self.scale * (more + (kinds * (r * self.d1[1 : K + 1])).sum(axis=1)) / max(self.n_tokens, 1)
        return np.log10(divisor), np.log10((1.0 - mass / divisor) / (1.0 - lower))


# ---- training -------------------------------------------------------------------------


def _sample(docs: DataFrame, per_row: float) -> DataFrame:
    return docs.filter(F.pmod(F.xxhash64("doc_id", F.lit("katz")), F.lit(1 << 30)) < int(per_row * (1 << 30)))


def plan_layout(rows: DataFrame) -> Layout:
    """Buckets for the estimated number of tokens; code book and hot lists from the sample."""
    n_rows = rows.count()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, 1):
                t = tokens(part.column(1))
                ids, n1 = np.unique(t.w, return_counts=True)
                one = t.kinds[ids]
                two, n2 = np.unique(_mix(t.kinds[t.w], t.kinds[t.v]), return_counts=True)
                often = n2 > max(2, HOT / 20 * len(t.w))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.r_[np.zeros(len(one), np.int32), np.ones(int(often.sum()), np.int32)]),
                        pa.array(np.r_[one, two[often]].view(np.int64)),
                        pa.array(np.r_[n1, n2[often]].astype(np.int64)),
                    ],
                    names=["kind", "h", "n"],
                )

    seen = _sample(rows, min(1.0, SAMPLE_ROWS / max(n_rows, 1))).select("doc_id", "text").mapInArrow(count, "kind int, h bigint, n bigint")
    seen = cut(seen.groupBy("kind", "h").agg(F.sum("n").alias("n")), "sample")
    total = seen.filter("kind = 0").agg(F.sum("n")).collect()[0][0] or 1
    top = seen.filter("kind = 0").orderBy(F.desc("n"), "h").limit(BOOK).collect()
    pairs = seen.filter((F.col("kind") == 1) & (F.col("n") >= HOT * total)).collect()
    hashed = lambda xs: np.unique(np.array(xs, dtype=np.int64).view(np.uint64))
    # In the sample, tokens per row are as in all rows; a sampled table has min(n, SAMPLE_ROWS) of them.
    tokens_all = total * max(1.0, n_rows / SAMPLE_ROWS)
    return Layout(
        max(1, int(-(-tokens_all // BUCKET_TOKENS))),
        hashed([r["h"] for r in top] + np.array([START, END]).view(np.int64).tolist()),
        hashed([r["h"] for r in top if r["n"] >= HOT * total]),
        hashed([r["h"] for r in pairs]),
    )


def _count_pairs(rows: DataFrame, layout: Layout) -> DataFrame:
    """``bucket, pairs``: the pairs of chunks of texts, counted before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, 0, 2 * CHUNK_TOKENS):
                t = tokens(part.column(0))
                code, hot = _code(layout.book, t.kinds), _find(layout.hot_words, t.kinds) >= 0
                both = np.sort(t.w * len(t.kinds) + t.v)  # by w, then v
                runs = _runs(both)
                w, v = np.divmod(both[runs[:-1]], len(t.kinds))
                n = np.diff(runs)
                bucket = _bucket(layout, t.kinds[w], t.kinds[v], hot[w])
                order = np.argsort(bucket, kind="stable")
                ends = _runs(bucket[order])
                ids, blocks = [], []
                for s, e in zip(ends[:-1], ends[1:]):
                    x = order[s:e]
                    ids.append(int(bucket[x[0]]))
                    blocks.append(_pack_pairs(t.kinds[w[x]], code[w[x]], t.kinds[v[x]], code[v[x]], n[x]))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(blocks, pa.binary())], names=["bucket", "pairs"])

    return rows.select("text").mapInArrow(run, "bucket int, pairs binary")


_STATS = [*(f"one_{r}" for r in range(1, K + 2)), *(f"two_{r}" for r in range(1, K + 2)), "tokens", "types"]
#: Words with a count of 2^j or more, for the choice of the cached ones.
_LEVELS = 48


def _merge_pairs(blocks: DataFrame, layout: Layout) -> DataFrame:
    """``bucket, pairs`` sorted by (w, v), with the bucket's counts of counts and its shares of hot words and pairs."""

    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        w, v, n = [], [], []
        for b in group.column("pairs").to_pylist():
            kinds, _, lengths, seconds, _, counts = _unpack_pairs(b, layout.book)
            w.append(np.repeat(kinds, lengths))
            v.append(seconds)
            n.append(counts.astype(np.int64))
        w, v, n = np.concatenate(w), np.concatenate(v), np.concatenate(n)
        mixed = _mix(w, v)
        order = np.argsort(mixed)
        starts = _runs(mixed[order])
        del mixed
        changes = np.flatnonzero((np.diff(w[order]) != 0) | (np.diff(v[order]) != 0))
        if len(changes) != len(starts) - 2:
            # Two pairs share a mixed key; sorted by their words they part.
            order = np.lexsort((v, w))
            changes = np.flatnonzero((np.diff(w[order]) != 0) | (np.diff(v[order]) != 0))
            starts = np.r_[0, changes + 1, len(order)]
        n = np.add.reduceat(n[order], starts[:-1])
        w, v = w[order[starts[:-1]]], v[order[starts[:-1]]]
        order = np.argsort(w, kind="stable")
        w, v, n = w[order], v[order], n[order]
        runs = _runs(w)
        totals = np.add.reduceat(n, runs[:-1])
        kinds = w[runs[:-1]]
        hot = _find(layout.hot_words, kinds)
        pair = _find(layout.hot_pairs, _mix(w, v))
        stats = [int(((totals == r) & (hot < 0)).sum()) for r in range(1, K + 2)] + [int((n == r).sum()) for r in range(1, K + 2)]
        stats += [int(n.sum()), int((hot < 0).sum())]
        levels = [int(((totals >= 1 << j) & (hot < 0)).sum()) for j in range(_LEVELS)]
        shares = lambda at, x: pa.array([[{"i": int(i), "n": int(c)} for i, c in zip(at[at >= 0], x[at >= 0])]], pa.list_(pa.struct([("i", pa.int32()), ("n", pa.int64())])))
        return pa.table(
            {
                "bucket": pa.array([key[0].as_py()], pa.int32()),
                "pairs": pa.array([_pack_pairs(w, _code(layout.book, w), v, _code(layout.book, v), n)], pa.binary()),
                "levels": pa.array([levels], pa.list_(pa.int64())),
                **{name: pa.array([x], pa.int64()) for name, x in zip(_STATS, stats)},
                "hot_words": shares(hot, totals),
                "hot_pairs": shares(pair, n),
            }
        )

    stats = ", ".join(f"{s} bigint" for s in _STATS)
    shares = "array<struct<i:int,n:bigint>>"
    return blocks.groupBy("bucket").applyInArrow(run, f"bucket int, pairs binary, levels array<bigint>, {stats}, hot_words {shares}, hot_pairs {shares}")


def _write_partitioned(df: DataFrame, name: str) -> tuple[str, DataFrame]:
    path = f"{shared_dir(df.sparkSession)}/millrace-{name}-{uuid.uuid4().hex}"
    df.write.partitionBy("bucket").option("compression", "uncompressed").parquet(path)
    return path, read_cut(df.sparkSession, path, df)


def _figures(table: DataFrame, layout: Layout) -> Model:
    sums = table.agg(*[F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in _STATS]).collect()[0].asDict()

    def shares(column: str, size: int) -> np.ndarray:
        out = np.zeros(size, dtype=np.int64)
        for r in table.select(F.explode(column).alias("x")).groupBy("x.i").agg(F.sum("x.n").alias("n")).collect():
            out[r["i"]] = r["n"]
        return out

    hot, pairs = shares("hot_words", len(layout.hot_words)), shares("hot_pairs", len(layout.hot_pairs))
    one = [sums[f"one_{r}"] + int((hot == r).sum()) for r in range(1, K + 2)]
    n_tokens, n_types = sums["tokens"], sums["types"] + int((hot > 0).sum())
    d1, d2 = good_turing(one), good_turing([sums[f"two_{r}"] for r in range(1, K + 2)])
    if n_tokens:
        kept = 1.0 - sum(n * r * (1 - d1[r]) for r, n in enumerate(one[:K], 1)) / n_tokens
        unknown = max(1.0 - kept, 1.0 / (n_tokens + 1.0))
        scale = (1.0 - unknown) / kept
    else:
        unknown, scale = 1.0, 1.0
    return Model(layout, n_tokens, n_types, d1, d2, unknown, scale, hot, pairs)


def _word_counts(model: Model, kinds: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """c(w) of the words of a bucket: its own sum, or the global one of a hot word."""
    hot = _find(model.layout.hot_words, kinds)
    return np.where(hot >= 0, model.hot_counts[hot], totals) if len(model.hot_counts) else totals


def _cached_words(pairs: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """At most CACHED of the most frequent words (those over a power of two), sorted, with their counts."""
    sums = pairs.select(F.posexplode("levels").alias("j", "n")).groupBy("j").agg(F.sum("n").alias("n")).collect()
    least = min((1 << r["j"] for r in sums if r["n"] + len(model.hot_counts) <= CACHED), default=1 << _LEVELS)
    layout = model.layout

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for data in batch.column(0):
                kinds, _, lengths, _, _, n = _unpack_pairs(data.as_py(), layout.book)
                totals = np.add.reduceat(n.astype(np.int64), np.cumsum(lengths) - lengths)
                often = (totals >= least) & (_find(layout.hot_words, kinds) < 0)
                found.append(_pack(kinds[often], _small(totals[often])))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["words"])

    parts = [_unpack(bytes(r["words"])) for r in pairs.select("pairs").mapInArrow(run, "words binary").collect()]
    there = model.hot_counts > 0
    words_ = np.concatenate([model.layout.hot_words[there], *(p[0] for p in parts)])
    counts = np.concatenate([model.hot_counts[there], *(p[1].astype(np.int64) for p in parts)])
    # The start mark is a context of every text, though no word.
    words_, counts = np.r_[words_, START], np.r_[counts, 0]
    order = np.argsort(words_)
    return words_[order], counts[order]


def _context_parts(pairs: DataFrame, model: Model) -> DataFrame:
    """``bucket, sums``: each word bucket's integer sums for the contexts it has seen."""
    slim = replace(model, cached=np.zeros(0, np.uint64), cached_count=np.zeros(0, np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                kinds, _, lengths, v, _, n = _unpack_pairs(data.as_py(), slim.layout.book)
                n = n.astype(np.int64)
                cw = np.repeat(_word_counts(slim, kinds, np.add.reduceat(n, np.cumsum(lengths) - lengths)), lengths)
                order = np.argsort(v)
                v, n, cw = v[order], n[order], cw[order]
                starts = _runs(v)[:-1]
                total = lambda x: np.add.reduceat(x.astype(np.int64), starts)
                columns = [v[starts], total(n), total(np.where(cw > K, cw, 0))]
                columns += [total(n == r) for r in range(1, K + 1)] + [total(cw == r) for r in range(1, K + 1)]
                bucket = (_mix(columns[0]) % np.uint64(slim.layout.buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                ends = _runs(bucket[order])
                ids, blocks = [], []
                for s, e in zip(ends[:-1], ends[1:]):
                    x = order[s:e]
                    ids.append(int(bucket[x[0]]))
                    blocks.append(_pack(columns[0][x], *(_small(c[x]) for c in columns[1:])))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(blocks, pa.binary())], names=["bucket", "sums"])

    return pairs.select("pairs").mapInArrow(run, "bucket int, sums binary")


def _merge_contexts(parts: DataFrame, model: Model) -> DataFrame:
    """``bucket, contexts`` and ``cached``: sorted v, log10 c(v), log10 alpha(v) of the other and of the cached words."""
    shared = parts.sparkSession.sparkContext.broadcast(model.cached)
    slim = replace(model, cached=np.zeros(0, np.uint64), cached_count=np.zeros(0, np.int64))

    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        blocks = [_unpack(b) for b in group.column("sums").to_pylist()]
        v, *sums = (np.concatenate([b[i] for b in blocks]) for i in range(3 + 2 * K))
        order = np.argsort(v, kind="stable")
        starts = _runs(v[order])[:-1]
        n, more, *rest = (np.add.reduceat(s[order].astype(np.int64), starts) for s in sums)
        v = v[order][starts]
        log_n, log_alpha = slim.context(n, np.stack(rest[:K], axis=1), more, np.stack(rest[K:], axis=1))
        at = _find(shared.value, v)
        rare, known = at < 0, at >= 0
        return pa.table(
            {
                "bucket": pa.array([key[0].as_py()], pa.int32()),
                "contexts": pa.array([_pack(v[rare], log_n[rare], log_alpha[rare])], pa.binary()),
                "cached": pa.array([_pack(_small(at[known]), log_n[known], log_alpha[known])], pa.binary()),
            }
        )

    return parts.groupBy("bucket").applyInArrow(run, "bucket int, contexts binary, cached binary")


def train(rows: DataFrame, layout: Layout) -> Model:
    """Counts ``rows`` (with a column ``text``) and writes the two tables of the model."""
    spark = rows.sparkSession
    pairs_path, pairs = _write_partitioned(_merge_pairs(_count_pairs(rows, layout), layout), "pairs")
    free_shuffles(spark)
    model = _figures(pairs, layout)
    cached, counts = _cached_words(pairs, model)
    model = replace(model, cached=cached, cached_count=counts)
    contexts_path, contexts = _write_partitioned(_merge_contexts(_context_parts(pairs, model), model), "contexts")
    free_shuffles(spark)
    log_n, log_alpha = np.zeros(len(cached)), np.zeros(len(cached))
    for r in contexts.select("cached").collect():
        at, n, alpha = _unpack(bytes(r["cached"]))
        log_n[at], log_alpha[at] = n, alpha
    return replace(model, pairs_path=pairs_path, contexts_path=contexts_path, cached_log_n=log_n, cached_log_alpha=log_alpha)


# ---- scoring --------------------------------------------------------------------------

_ROW = "bucket int, chunk bigint, part int, data binary, ids array<{id}>, held array<boolean>"
_HEADER, _ANSWER, _QUESTION = 0, 1, 2


def _table(rows: list[tuple], id_type: pa.DataType) -> dict:
    """Rows (bucket, chunk, kind, data, ids, held) as columns; ``part`` is the kind, and orders the sums."""
    types = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.list_(id_type), pa.list_(pa.bool_())]
    names = ["bucket", "chunk", "part", "data", "ids", "held"]
    return {n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(zip(names, types))}


def _by_owner(owner: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Owners and the sums of their integer values (in two halves, so that float sums are exact)."""
    there = np.flatnonzero(np.bincount(owner)) if len(owner) else np.zeros(0, np.int64)
    add = lambda x: np.bincount(owner, weights=x)[there].astype(np.int64) if len(owner) else there
    return there, *((add(v >> 20) << 20) + add(v & 0xFFFFF) for v in values)


def _answer(owner: np.ndarray, score: np.ndarray, base_owner: np.ndarray, base: np.ndarray, known: np.ndarray) -> bytes:
    """Packed sums of scores, and of base scores and known tokens, by text (both without sign)."""
    o, s = _by_owner(owner, -_fixed(score))
    b, *rest = _by_owner(base_owner, -_fixed(base), known.astype(np.int64))
    # Backoff weights may exceed 1, so a sum of scores can be above 0.
    return _pack(_small(o), s if len(s) and s.min() < 0 else _small(s), _small(b), *map(_small, rest))


def _ask(docs: DataFrame, model: Model, id_type: str) -> DataFrame:
    """The texts' pairs by word bucket; hot pairs and the base scores of cached words are answered here, in the chunk's header."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        layout = model.layout
        # The same in every attempt, so a task that is run again fits the answers to the first.
        name, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in _slices(batch, 2):
                t, chunk = tokens(part.column(2)), (name << 32) + number
                number += 1
                code, hot = _code(model.cached, t.kinds), _find(layout.hot_words, t.kinds) >= 0
                counts = np.where(code > 0, model.cached_count[code.astype(np.int64) - 1], 0)
                base = model.log_base(counts)
                in_cache = code[t.w] > 0
                # A hot pair's word is hot, and hot words that were seen are cached.
                maybe = np.flatnonzero(hot[t.w]) if len(layout.hot_pairs) else np.zeros(0, np.int64)
                pair = _find(layout.hot_pairs, _mix(t.kinds[t.w[maybe]], t.kinds[t.v[maybe]]))
                maybe, pair = maybe[(pair >= 0) & (code[t.v[maybe]] > 0)], pair[(pair >= 0) & (code[t.v[maybe]] > 0)]
                c, v = model.pair_counts[pair], code[t.v[maybe]].astype(np.int64) - 1
                score = np.where(c > 0, model.log_seen(c) - model.cached_log_n[v], model.log_unigram(counts[t.w[maybe]]) + model.cached_log_alpha[v])
                answer = _answer(t.owner[maybe], score, t.owner[in_cache], base[t.w[in_cache]], counts[t.w[in_cache]] > 0)
                header = _pack(_small(t.lengths), np.frombuffer(answer, dtype=np.uint8))
                rows = [(number % layout.buckets, chunk, _HEADER, header, part.column(0).to_pylist(), part.column(1).to_pylist())]
                rest = np.ones(len(t.w), dtype=bool)
                rest[maybe] = False
                w, v, owner = t.w[rest], t.v[rest], t.owner[rest]
                bucket = _bucket(layout, t.kinds, t.kinds, np.zeros(len(t.kinds), dtype=bool)).astype(np.int64)[w]
                spread = hot[w]
                bucket[spread] = _bucket(layout, t.kinds[w[spread]], t.kinds[v[spread]], np.ones(int(spread.sum()), dtype=bool))
                # Owners ascend within a word, which packs better.
                order = np.argsort((bucket * len(t.kinds) + w) * len(t.lengths) + owner)
                ends = _runs(bucket[order])
                for s, e in zip(ends[:-1], ends[1:]):
                    x = order[s:e]
                    rows.append((int(bucket[x[0]]), chunk, _QUESTION, _pack_pairs(t.kinds[w[x]], code[w[x]], t.kinds[v[x]], code[v[x]], owner[x]), None, None))
                yield pa.RecordBatch.from_pydict(_table(rows, part.schema.field(0).type))

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, _ROW.format(id=id_type))


def _pack_contexts(unsettled: list[tuple[np.ndarray, ...]], buckets: int) -> Iterator[tuple[int, bytes]]:
    """One packed question for each context bucket: v once per run, then chunk, owner and whether the pair was seen."""
    if not unsettled:
        return
    v, chunk, owner, seen = (np.concatenate(x) for x in zip(*unsettled))
    to = (_mix(v) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((v, to))
    ends = _runs(to[order])
    for s, e in zip(ends[:-1], ends[1:]):
        y = order[s:e]
        runs = _runs(v[y])
        chunks, number = np.unique(chunk[y], return_inverse=True)
        yield int(to[y[0]]), _pack(v[y][runs[:-1]], _small(np.diff(runs)), chunks, _small(number), _small(owner[y]), seen[y])


def _answer_words(asked: DataFrame, model: Model, id_type: str) -> DataFrame:
    """Word buckets: unigram and pair counts are looked up; contexts that are not cached stay a question."""
    pairs = asked.sparkSession.read.schema("pairs binary, bucket int").parquet(model.pairs_path).select("bucket", "pairs")
    shared = asked.sparkSession.sparkContext.broadcast(model)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        model = shared.value
        layout = model.layout
        kinds = key = np.zeros(0, np.uint64)
        totals = n = np.zeros(0, np.int64)
        if right.num_rows:
            kinds, _, lengths, v, _, n = _unpack_pairs(right.column("pairs")[0].as_py(), layout.book)
            n = n.astype(np.int64)
            totals = np.add.reduceat(n, np.cumsum(lengths) - lengths)
            key = _mix(np.repeat(kinds, lengths), v)
            del v
            order = np.argsort(key)
            key, n = key[order], n[order]
        rows, unsettled = [], []
        columns = [left.column(c) for c in ("bucket", "chunk", "part", "data", "ids", "held")]
        for i in range(left.num_rows):
            bucket, chunk, part, data, ids, held = (c[i].as_py() for c in columns)
            if part != _QUESTION:
                rows.append((bucket, chunk, part, data, ids, held))
                continue
            w, w_code, lengths, v, v_code, owner = _unpack_pairs(data, model.cached)
            owner = owner.astype(np.int64)
            at = _find(kinds, w)
            cw = np.where(at >= 0, totals[at], 0) if len(totals) else np.zeros(len(w), np.int64)
            # A cached word's count is global, also where this bucket has only some of its pairs.
            cw = np.where(w_code > 0, model.cached_count[w_code.astype(np.int64) - 1], cw)
            at = _find(key, _mix(np.repeat(w, lengths), v))
            c = np.where(at >= 0, n[at], 0) if len(n) else np.zeros(len(v), np.int64)
            seen = c > 0
            score = np.where(seen, model.log_seen(c), np.repeat(model.log_unigram(cw), lengths))
            coded = v_code > 0
            x = v_code[coded].astype(np.int64) - 1
            score[coded] += np.where(seen[coded], -model.cached_log_n[x], model.cached_log_alpha[x])
            rare = np.repeat(w_code == 0, lengths)
            answer = _answer(owner, score, owner[rare], np.repeat(model.log_base(cw), lengths)[rare], np.repeat(cw > 0, lengths)[rare])
            rows.append((bucket, chunk, _ANSWER, answer, None, None))
            rare = ~coded
            unsettled.append((v[rare], np.full(int(rare.sum()), chunk), owner[rare], seen[rare]))
        rows.extend((to, None, _QUESTION, data, None, None) for to, data in _pack_contexts(unsettled, layout.buckets))
        return pa.table(_table(rows, left.schema.field("ids").type.value_type))

    return asked.groupBy("bucket").cogroup(pairs.groupBy("bucket")).applyInArrow(run, _ROW.format(id=id_type))


def _answer_contexts(asked: DataFrame, model: Model, id_type: str) -> DataFrame:
    """Context buckets: c(v) for seen pairs, alpha(v) for the others (1 for an unknown context)."""
    contexts = asked.sparkSession.read.schema("contexts binary, bucket int").parquet(model.contexts_path).select("bucket", "contexts")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        known, log_n, log_alpha = _unpack(right.column("contexts")[0].as_py()) if right.num_rows else (np.zeros(0, np.uint64), np.zeros(0), np.zeros(0))
        rows, settled = [], []
        columns = [left.column(c) for c in ("bucket", "chunk", "part", "data", "ids", "held")]
        for i in range(left.num_rows):
            bucket, chunk, part, data, ids, held = (c[i].as_py() for c in columns)
            if part != _QUESTION:
                rows.append((bucket, chunk, part, data, ids, held))
                continue
            v, lengths, chunks, number, owner, seen = _unpack(data)
            at = np.repeat(_find(known, v), lengths.astype(np.int64))
            there = at >= 0
            settled.append((chunks[number][there], owner[there].astype(np.int64), np.where(seen[there], -log_n[at[there]], log_alpha[at[there]])))
        if settled:
            bucket = left.column("bucket")[0].as_py()
            chunk, owner, score = (np.concatenate(x) for x in zip(*settled))
            order = np.argsort(chunk, kind="stable")
            ends = _runs(chunk[order])
            for s, e in zip(ends[:-1], ends[1:]):
                y = order[s:e]
                rows.append((bucket, int(chunk[y[0]]), _ANSWER, _answer(owner[y], score[y], np.zeros(0, np.int64), np.zeros(0), np.zeros(0, bool)), None, None))
        return pa.table(_table(rows, left.schema.field("ids").type.value_type))

    return asked.groupBy("bucket").cogroup(contexts.groupBy("bucket")).applyInArrow(run, _ROW.format(id=id_type))


def _gather(answers: DataFrame, model: Model, id_type: str) -> DataFrame:
    """The answers of a chunk are added up for each text."""
    n_tokens = model.n_tokens

    def run(group: pa.Table) -> pa.Table:
        parts = group.column("part").to_pylist()
        data = group.column("data").to_pylist()
        at = parts.index(_HEADER)
        lengths, own = _unpack(data[at])
        score, base, known = (np.zeros(len(lengths), np.int64) for _ in range(3))
        for packed in [own.tobytes(), *(d for d, p in zip(data, parts) if p == _ANSWER)]:
            ids, s, base_ids, *rest = _unpack(packed)
            score[ids] -= s.astype(np.int64)
            if len(base_ids):
                base[base_ids] -= rest[0].astype(np.int64)
                known[base_ids] += rest[1].astype(np.int64)
        ids = group.column("ids")[at]
        return pa.table(
            {
                "doc_id": ids.values,
                "held_out": group.column("held")[at].values,
                "n_tokens": pa.array(lengths.astype(np.int64)),
                "n_known": pa.array(known),
                "train_tokens": pa.array(np.full(len(lengths), n_tokens, dtype=np.int64)),
                "base_score": pa.array(base / UNIT),
                "score": pa.array(score / UNIT),
            }
        )

    return answers.groupBy("chunk").applyInArrow(
        run, f"doc_id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    )


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Scores of ``docs`` (``doc_id, held_out, text``) under ``model``."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    asked = _ask(docs, model, id_type)
    return _gather(_answer_contexts(_answer_words(asked, model, id_type), model, id_type), model, id_type)


def lm_score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 7, held_out: int = 2) -> DataFrame:
    """Trains on the rows outside the held-out fold and scores all rows."""
    rows = docs.select(F.col(id_col).alias("doc_id"), (fold(id_col, modulus) == held_out).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    training = rows.filter(~F.col("held_out"))
    return score(rows, train(training, plan_layout(training)))
