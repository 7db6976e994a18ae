r"""Token alignment of two tokenisers over the same bytes.

Both encodings of a text are turned into byte ranges.  The ranges of B are a static
interval index: they are ordered and do not overlap, so the B tokens that an A token touches
lie between two bisections, one of its start among B's ends and one of its end among B's
starts.  A gap between two A tokens that no B token spans is a boundary; between two
boundaries stands a group, the smallest stretch that both tokenisers cut alike.  The last A
and the last B token of a group end together: they are linked.

``aligned`` gives ids and the groups' ends of every text, ``alignment`` counts how often the
corpus links each pair of ids and returns the digest per text.

Scale: texts are encoded where they are read.  What leaves a text are its distinct linked
pairs with their numbers, summed map-side.  Two linked tokens end together, so the bytes
of the shorter are a suffix of the other's: ``most_pairs`` counts these pairs of ids from the
vocabularies alone, some hundred thousand, however large the corpus.  The table of
counts is therefore broadcast where that bound is small, and joined by sorting otherwise.

Defined cases: null and empty texts, and texts that either encoding does not give back byte
by byte (the text after one space), have no tokens: zeros and an empty digest.  Names of
special tokens inside texts are plain text.  Rows that repeat an id are rows of their own;
extra columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, pieces

#: Pairs up to which the counts are broadcast: some 50 MB of rows.
BROADCAST_PAIRS = 2_000_000


#: Fixed value: the pattern of the plain byte-level pre-tokeniser.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_characters() -> dict[str, int]:
    """Byte-level vocabularies write a byte as itself where it prints and as U+0100 and up otherwise."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(rest)}


class Side:
    """A tokeniser with the bytes of its tokens."""

    def __init__(self, encode, tokens: list[bytes]):
        self.encode, self.tokens = encode, tokens
        self.sizes = np.array([len(t) for t in tokens], dtype=np.int64)

    def ends(self, ids: np.ndarray) -> np.ndarray:
        return np.cumsum(self.sizes[ids])

    def joined(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def _merges_in_order(model: dict) -> bool:
    """Whether the ids after the single bytes follow the order of the merges, so that an id is its token's rank."""
    merges = (m if isinstance(m, str) else " ".join(m) for m in model["merges"])
    return all(model["vocab"].get(m.replace(" ", "")) == 256 + i for i, m in enumerate(merges))


def byte_side(path: str) -> Side:
    """A byte-level BPE file of the tokenizers library.

    Where ids are ranks and the pre-tokeniser is the plain byte-level one, a rank encoder with the
    same pattern gives the same ids in a fifth of the time; other files go through the library.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    of, tokens = _byte_characters(), [b""] * library.get_vocab_size()
    added = {t["content"] for t in whole["added_tokens"]}
    for token, i in whole["model"]["vocab"].items():
        tokens[i] = token.encode() if token in added else bytes(of[c] for c in token)
    plain = lambda text: library.encode(" " + text, add_special_tokens=False).ids
    before = whole["pre_tokenizer"] or {}
    simple = before.get("type") == "ByteLevel" and not before["add_prefix_space"] and before.get("use_regex", True) and not whole["normalizer"]
    if not simple or not _merges_in_order(whole["model"]):
        return Side(plain, tokens)
    from tiktoken import Encoding

    ranks = {t: i for i, t in enumerate(tokens) if t and t.decode("latin-1") not in added}
    fast = Encoding("byte_side", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        try:
            return fast.encode_ordinary(" " + text)
        except BaseException as error:  # the pattern engine gives up on some very long runs of white space
            if isinstance(error, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            return plain(text)

    return Side(encode, tokens)


def piece_side(path: str) -> Side:
    """A sentencepiece model that adds a space before the text."""
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=path)
    tokens = []
    for i in range(library.get_piece_size()):
        piece = library.id_to_piece(i)
        tokens.append(bytes([int(piece[3:5], 16)]) if library.is_byte(i) else piece.replace("▁", " ").encode())
    return Side(lambda text: library.encode(text, num_threads=1), tokens)


@lru_cache(maxsize=2)
def sides(path_a: str, path_b: str) -> tuple[Side, Side]:
    """Both tokenisers, once per worker."""
    return byte_side(path_a), piece_side(path_b)


def most_pairs(a: Side, b: Side) -> int:
    """How many pairs of ids can ever be linked: those of which one is a suffix of the other."""
    of_a, of_b = (Counter(t for t in side.tokens if t) for side in (a, b))
    into = lambda long, short: sum(n * short[t[i:]] for t, n in long.items() for i in range(len(t)))
    both = sum(n * of_b[t] for t, n in of_a.items())
    return into(of_a, of_b) + into(of_b, of_a) - both


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each A token the first B token that it overlaps, and the one after the last."""
    starts_a, starts_b = (np.concatenate([[0], ends[:-1]]) for ends in (ends_a, ends_b))
    return np.searchsorted(ends_b, starts_a, side="right"), np.searchsorted(starts_b, ends_a, side="left")


def groups(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many A and how many B tokens stand before the end of each group."""
    if not len(ends_a):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    first, after = overlaps(ends_a, ends_b)
    open_ = np.append(first[1:] >= after[:-1], True)
    at = np.flatnonzero(open_)
    return at + 1, after[at]


def encode(text: str | None, a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """Ids of both sides, none where either does not give the text back."""
    none = np.zeros(0, dtype=np.int64)
    if not text:
        return none, none
    whole = b" " + text.encode("utf-8", "surrogatepass")
    ids_a, ids_b = a.encode(text), b.encode(text)
    if a.joined(ids_a) != whole or b.joined(ids_b) != whole:
        return none, none
    return np.array(ids_a, dtype=np.int64), np.array(ids_b, dtype=np.int64)


class Writer:
    """Digest of ``a1,a2|b1;a3|b2,b3``: the ids with their separators are taken from one pool of strings."""

    def __init__(self, a: Side, b: Side):
        numbers = [str(i) for i in range(len(a.tokens))], [str(i) for i in range(len(b.tokens))]
        self.at = np.cumsum([0, *(len(n) for n in numbers for _ in range(2))])
        self.pool = pa.array([n + s for many, separators in zip(numbers, (",|", ",;")) for s in separators for n in many])

    def text(self, ids_a: np.ndarray, ids_b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray) -> memoryview:
        order = np.empty(len(ids_a) + len(ids_b), dtype=np.int64)
        last_a, last_b = np.zeros(len(ids_a), dtype=np.int64), np.zeros(len(ids_b), dtype=np.int64)
        last_a[cuts_a - 1] = last_b[cuts_b - 1] = 1
        # Before a group's A tokens stand the B tokens of earlier groups, before its B tokens all A tokens so far.
        before_a = np.repeat(np.concatenate([[0], cuts_b[:-1]]), np.diff(cuts_a, prepend=0))
        before_b = np.repeat(cuts_a, np.diff(cuts_b, prepend=0))
        order[np.arange(len(ids_a)) + before_a] = ids_a + self.at[last_a]
        order[np.arange(len(ids_b)) + before_b] = ids_b + self.at[2 + last_b]
        taken = self.pool.take(pa.array(order))
        ends = np.frombuffer(taken.buffers()[1], dtype=np.int32, count=len(taken) + 1)
        return memoryview(taken.buffers()[2])[: int(ends[-1]) - 1]  # without the last separator


@lru_cache(maxsize=2)
def _writer(path_a: str, path_b: str) -> Writer:
    return Writer(*sides(path_a, path_b))


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, a_ids, b_ids, a_cuts, b_cuts``: ids, and how many of them each group's end leaves behind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = sides(path_a, path_b)
        for batch in (part for whole in batches for part in pieces(whole, 128)):
            found = []
            for text in batch.column(1):
                ids_a, ids_b = encode(text.as_py(), a, b)
                found.append((ids_a, ids_b, *groups(a.ends(ids_a), b.ends(ids_b))))
            out = [pa.array([f[i] for f in found], pa.list_(pa.int32())) for i in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *out], names=["doc_id", "a_ids", "b_ids", "a_cuts", "b_cuts"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, a_ids array<int>, b_ids array<int>, a_cuts array<int>, b_cuts array<int>")


def linked(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, groups_sha256, pairs, times``: the text's distinct linked pairs and how often it has them.

    A pair is ``a * 2^32 + b``; pairs are in order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = sides(path_a, path_b)
        writer = _writer(path_a, path_b)
        for batch in (part for whole in batches for part in pieces(whole, 256)):
            rows = []
            for text in batch.column(1):
                ids_a, ids_b = encode(text.as_py(), a, b)
                cuts_a, cuts_b = groups(a.ends(ids_a), b.ends(ids_b))
                digest = hashlib.sha256(writer.text(ids_a, ids_b, cuts_a, cuts_b)).hexdigest() if len(ids_a) else ""
                pairs, times = np.unique(ids_a[cuts_a - 1] << 32 | ids_b[cuts_b - 1], return_counts=True)
                rows.append((len(ids_a), len(ids_b), len(cuts_a), digest, pairs, times))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32())]
            out = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *out], names=["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, pairs array<bigint>, times array<int>")


def pair_counts(links: DataFrame) -> DataFrame:
    """``pair, count, best``: how many links hold each pair, and if no other pair of its B id has more."""
    one = F.explode(F.arrays_zip("pairs", "times")).alias("p")
    counts = links.select(one).groupBy(F.col("p.pairs").alias("pair")).agg(F.sum(F.col("p.times").cast("bigint")).alias("count"))
    b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    most = counts.groupBy(b.alias("b")).agg(F.max("count").alias("most"))
    return counts.withColumn("b", b).join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def alignment(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row."""
    # The number of a row is written with it, so it is the same for all later readers.
    rows = cut(linked(docs, path_a, path_b, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "links")
    counts = cut(pair_counts(rows), "pairs")
    counts = F.broadcast(counts) if most_pairs(*sides(path_a, path_b)) <= broadcast_pairs else counts.hint("merge")
    one = F.explode_outer(F.arrays_zip("pairs", "times")).alias("p")
    each = rows.select("doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "row", one)
    each = each.withColumns({"pair": F.col("p.pairs"), "n": F.coalesce(F.col("p.times"), F.lit(0)).cast("bigint")}).drop("p")
    zero = F.lit(0).cast("bigint")
    return (
        each.join(counts, "pair", "left")
        .groupBy("row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256")
        .agg(
            F.sum("n").alias("n_links"),
            F.sum(F.when(F.col("best"), F.col("n")).otherwise(zero)).alias("n_best"),
            F.sum(F.coalesce(F.col("n") * F.col("count"), zero)).alias("count_sum"),
        )
        .select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    )
