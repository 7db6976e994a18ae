r"""Byte-level BPE by prefix dynamic programming.

For every prefix of a piece exactly one token can end its BPE encoding: the token
``t`` that is a suffix of the prefix and *compatible* with the last token of what
precedes it (two tokens are compatible if the encoding of their joined bytes is
just these two).  ``PrefixTable`` stores this last token for every prefix, so

* the encoding of any prefix is read off by walking back from its end,
* appended bytes only add entries, and
* after an edit only the entries near it are computed again, until the table is
  in step with the old one (one longest token's worth of equal entries).

Texts are split by the pre-tokeniser's pattern and each piece is encoded by itself;
workers remember pieces (bounded), which changes nothing but the time.

Defined cases: null text counts as empty and gives no token; special tokens' names
are ordinary text; rows that repeat an id are rows of their own; extra columns
are ignored by ``digest`` and kept by ``encode_column``.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pieces

#: Pieces in each of the two generations that a worker remembers.
REMEMBERED = 200_000


def read_ranks(data: bytes) -> list[bytes]:
    """Token bytes by id from the lines ``base64 rank`` of a rank file."""
    pairs = [line.split() for line in data.splitlines() if line]
    table = [b""] * (1 + max(int(rank) for _, rank in pairs))
    for token, rank in pairs:
        table[int(rank)] = base64.b64decode(token)
    return table


class Vocabulary:
    """Tokens with the relation of compatible neighbours."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.ids = {t: i for i, t in enumerate(tokens) if t}
        self.longest = max(map(len, tokens))
        self.lengths = (*_LIKELY, *(n for n in range(1, self.longest + 1) if n not in _LIKELY))
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._fits: dict[int, bool] = {}

    def merge(self, data: bytes, below: int) -> list[int]:
        """Plain merging by rank, using ranks smaller than ``below`` only."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, at = below, -1
            for i in range(len(parts) - 1):
                rank = self.ids.get(parts[i] + parts[i + 1], below)
                if rank < best:
                    best, at = rank, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ids[p] for p in parts]

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; None for one that no merge makes."""
        if token not in self._halves:
            parts = self.merge(self.tokens[token], token) if len(self.tokens[token]) > 1 else []
            self._halves[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self._halves[token]

    def fits(self, left: int, right: int) -> bool:
        """Whether the encoding of the joined bytes of both is ``[left, right]``.

        It is not if, while undoing the merges that made them (latest first), the two
        parts that face each other could themselves have merged earlier.
        """
        key = left << 20 | right
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) > 400_000:
                self._fits.clear()
            known = self._fits[key] = self._check(left, right)
        return known

    def _check(self, left: int, right: int) -> bool:
        ids, tokens = self.ids, self.tokens
        before = len(tokens) + 1  # merges of this rank and later ones have been undone
        while True:
            joined = ids.get(tokens[left] + tokens[right])
            if joined is not None and joined < before:
                return False
            a, b = self.halves(left), self.halves(right)
            if a is None and b is None:
                return True
            # Equal ranks merge from the left, so the right one was made later.
            if b is None or (a is not None and left > right):
                before, left = left, a[1]
            else:
                before, right = right + 1, b[0]


#: Token lengths in the order in which they are tried; since only one token fits, any order gives it.
_LIKELY = (3, 2, 4, 5, 1)


def extend(v: Vocabulary, data: bytes, last: list[int], stop: int) -> None:
    """Adds the entries of the prefixes of ``data`` up to ``stop`` to ``last``."""
    ids, known, lengths = v.ids, v._fits, v.lengths
    for end in range(len(last) + 1, stop + 1):
        for n in lengths:
            start = end - n
            if start < 0:
                continue
            token = ids.get(data[start:end])
            if token is None:
                continue
            if start:
                fits = known.get(last[start - 1] << 20 | token)
                if not (v.fits(last[start - 1], token) if fits is None else fits):
                    continue
            last.append(token)
            break
        else:
            raise ValueError("the vocabulary lacks a single byte")


class PrefixTable:
    """The unique last token of every prefix of ``data``."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        extend(self.vocabulary, self.data, self.last, len(self.data))

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Puts ``new`` in place of ``data[start:stop]``; returns how many entries were computed."""
        old, shift = self.last, len(new) - (stop - start)
        self.data = self.data[:start] + new + self.data[stop:]
        self.last = old[:start]
        equal = computed = 0
        for end in range(start + 1, len(self.data) + 1):
            extend(self.vocabulary, self.data, self.last, end)
            computed += 1
            then = end - 1 - shift
            equal = equal + 1 if then >= stop and old[then] == self.last[-1] else 0
            if equal >= self.vocabulary.longest:
                self.last.extend(old[then + 1 :])
                break
        return computed

    def tokens(self, end: int | None = None) -> list[int]:
        """The encoding of the prefix that ends at ``end``."""
        at = len(self.data) if end is None else end
        out = []
        while at:
            out.append(self.last[at - 1])
            at -= len(self.vocabulary.tokens[out[-1]])
        return out[::-1]


def _ascii_pattern(pattern: str) -> re.Pattern | None:
    """The same splits for texts of ASCII characters only, for the faster engine; None if unsure.

    There letters are A-Z and a-z, numbers 0-9, and both engines agree on white space.
    """
    out, inside, i = [], False, 0
    while i < len(pattern):
        c = pattern[i]
        part = {r"\p{L}": "A-Za-z", r"\p{N}": "0-9"}.get(pattern[i : i + 5])
        if part:
            out.append(part if inside else f"[{part}]")
            i += 5
            continue
        if c == "\\":
            if pattern[i + 1 : i + 2] not in ("s", "S"):
                return None
            out.append(pattern[i : i + 2])
            i += 2
            continue
        inside = (inside or c == "[") and c != "]"
        out.append(c)
        i += 1
    return re.compile("".join(out), re.ASCII)


class Codec:
    def __init__(self, tokens: list[bytes], pattern: str):
        self.vocabulary = Vocabulary(tokens)
        self.pattern = regex.compile(pattern)
        self.ascii_pattern = _ascii_pattern(pattern) or self.pattern
        self._packed = [i.to_bytes(4, "little") for i in range(len(tokens))]
        self._pieces: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def _encode_piece(self, piece: str) -> bytes:
        data, v, packed = piece.encode("utf-8", "surrogatepass"), self.vocabulary, self._packed
        whole = v.ids.get(data)
        if whole is not None:
            return packed[whole]
        last: list[int] = []
        extend(v, data, last, len(data))
        at, out = len(data), []
        while at:
            token = last[at - 1]
            out.append(packed[token])
            at -= len(v.tokens[token])
        return b"".join(out[::-1])

    def _recall(self, piece: str) -> bytes:
        """A piece that is not among the recent ones: from the older ones, else encoded."""
        ids = self._older.get(piece)
        if ids is None:
            ids = self._encode_piece(piece)
        if len(piece) <= 64:
            if len(self._pieces) >= REMEMBERED:
                self._older, self._pieces = self._pieces, {}
            self._pieces[piece] = ids
        return ids

    def packed(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        out = []
        for piece in (self.ascii_pattern if text.isascii() else self.pattern).findall(text):
            out.append(self._pieces.get(piece) or self._recall(piece))
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), dtype="<u4").tolist()

    def decode_bytes(self, packed: bytes) -> bytes:
        return b"".join(map(self.vocabulary.tokens.__getitem__, np.frombuffer(packed, dtype="<u4").tolist()))


_codecs: dict[str, Codec] = {}


def _codec(data: bytes, pattern: str) -> Codec:
    """One codec for each worker and vocabulary."""
    key = hashlib.sha256(data + pattern.encode()).hexdigest()
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(read_ranks(data), pattern)
    return _codecs[key]


def _rank_data(path: str):
    """The rank file, read where the job starts; its size is that of the vocabulary."""
    with open(path, "rb") as f:
        return f.read()


def digest(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` (and ``token_ids``) for every row."""
    data = docs.sparkSession.sparkContext.broadcast(_rank_data(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(data.value, pattern)
        for batch in (part for whole in batches for part in pieces(whole)):
            n, ids, back, lists = [], [], [], []
            for text in batch.column(1):
                packed = codec.packed(text.as_py() or "")
                n.append(len(packed) // 4)
                ids.append(hashlib.sha256(packed).hexdigest())
                back.append(hashlib.sha256(codec.decode_bytes(packed)).hexdigest())
                if with_ids:
                    lists.append(packed)
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, *([_id_lists(lists)] if with_ids else [])], names=names)

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *(["token_ids"] if with_ids else [])]
    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string")).mapInArrow(
        run, f"doc_id {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", token_ids array<int>" * with_ids
    )


def _id_lists(packed: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(p) // 4 for p in packed)], dtype=np.int64)
    flat = np.frombuffer(b"".join(packed), dtype="<u4").astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def encode_column(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", out_col: str = "token_ids") -> DataFrame:
    """``docs`` with the ids of each text in a further column (it replaces one of that name)."""
    data = docs.sparkSession.sparkContext.broadcast(_rank_data(ranks_path))
    kept = [c for c in docs.columns if c != out_col]
    at = kept.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(data.value, pattern)
        for batch in (part for whole in batches for part in pieces(whole)):
            column = _id_lists([codec.packed(t.as_py() or "") for t in batch.column(at)])
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*kept, out_col])

    fields = [docs.schema[c] for c in kept]
    schema = T.StructType([*fields, T.StructField(out_col, T.ArrayType(T.IntegerType()))])
    return docs.select(*kept).mapInArrow(run, schema)


def decode_column(encoded: DataFrame, ranks_path: str, pattern: str, ids_col: str = "token_ids", out_col: str = "decoded") -> DataFrame:
    """The inverse: a column with the text of each id list."""
    data = encoded.sparkSession.sparkContext.broadcast(_rank_data(ranks_path))

    @F.pandas_udf("string")
    def back(ids):
        codec = _codec(data.value, pattern)
        return ids.map(lambda x: b"".join(codec.vocabulary.tokens[i] for i in x).decode("utf-8", "replace") if x is not None else None)

    return encoded.withColumn(out_col, back(ids_col))
