r"""HTML extraction with a suffix array over the pages of a host.

A page is parsed into blocks of text, and its token stream (the words of all blocks,
each block closed by a boundary token) joins those of its host.  Runs of ``DEPTH``
tokens that stand on at least ``MIN_PAGES`` pages of the host, of at least two different
contents, are repeats; pages of equal content are copies of one article and say nothing
about boilerplate.  The repeats are found for every block, and decide as follows.

* Blocks that no element explains: what repeats cover is boilerplate, unique runs stay;
  fewer than ``DEPTH // 2`` covered tokens within a block that has others stay too.  Of a block shorter than ``DEPTH`` outside paragraphs the whole text is one run.
* Blocks in an ``article`` or ``main`` element: a box (a block that is no paragraph,
  heading, list item or table cell) covered as a whole is boilerplate, unless repeats cover
  more than half of the page's article, which then is a near copy and stays.  Paragraphs
  stay: articles of a host share passages, and these belong to each of them.
* Navigation, page header and footer, sidebars, forms, scripts, styles, adverts, notices
  and comments that elements or class names state are boilerplate whether repeated or
  not, as is what stands outside the article of a page that has one.

How the repeats of a host are found, whatever its size: no task holds a host.

1. Each page sends the hashes of its anchors, the 4-grams that are smallest among the seven of
   some ``DEPTH`` window (one token in four).  Every window holds one, so only windows
   whose anchor is on enough pages can be repeats; that is exact.
2. Those pages get their repeated anchors back.  The suffixes of a batch of pages are ranked by
   prefix doubling to ``DEPTH`` tokens; equal ranks are equal runs, counted once per page.
   Runs that hold a repeated anchor are summed over all batches by a 64-bit hash.
3. Those pages get their repeated runs back, which are covered and joined.

Keys are hashes that contain the host, so a hot host is as many keys as any other text;
counts are combined before each shuffle.  Pages move by a hash of their own.

Defined cases: null and empty html give an empty text; a null url is the host ''; cut-off
pages are read as far as they go (an unfinished tag is dropped, open elements end with the
page); an article inside an element that only its class marks counts where the page has no
other; rows that repeat a page_id are pages of their own, and rows equal in url and html
are copies; extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from functools import cache, lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_size, cut, drop_cut, free_shuffles, read_cut, write_cut

DEPTH = 10
MIN_PAGES = 3
GRAM = 4
BOILERPLATE, UNKNOWN, CONTENT, MARKED_CONTENT = 0, 1, 2, 3

#: Elements by what they hold.
_DROPPED = frozenset("nav footer aside form script style noscript template iframe object svg select button menu dialog canvas audio video".split())
_RAW = frozenset("script style noscript template textarea title iframe svg select".split())
_CONTENT = frozenset("article main".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var br wbr img input".split()
)
_FLOW = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th caption figcaption article main".split())
#: Words of class, id or role that mark boilerplate; the second set only outside content.
_MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner cookie cookies consent sidebar menu nav navbar navigation breadcrumb breadcrumbs"
    " footer comment comments disqus share sharing social promo promoted sponsor sponsored newsletter subscribe signup popup modal notice"
    " notices alert pagination complementary contentinfo search login toolbar responses replies respond".split()
)
_OUTER_MARKS = frozenset("header masthead widget".split())
#: Marks of reader comments, which decide whatever else a name says ("comment-thread") unless it
#: also has a word that speaks of comments without holding them ("no-comments", "comments-open", "category-comment").
_COMMENTS = frozenset("comment comments commentlist commenter commenters disqus".split())
_ABOUT = frozenset("no not non without with has have hide hides hidden open closed enabled disabled allow allows allowed on off category tag topic type format story opinion code".split())
#: Words that may stand beside a mark in one name ("site-footer", "ad-slot-2"); any
#: other word ("with-sidebar", "no-comments", "search-results") makes it a name of something else.
_BESIDE = frozenset(
    "site page main global top bottom left right inner outer primary secondary post entry user reader wrapper wrap container box block area"
    " section list item items bar link links slot unit row col column panel group holder text title heading icon button form field fixed sticky"
    " thread tool count network".split()
)
#: Marks of links to other articles, and words that may stand beside these alone ("related-stories").
_ELSEWHERE = frozenset("related recommended recommendation recommendations".split())
_PIECES = frozenset("article articles story stories news reading read more".split())
_PLAIN_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>"']*)([^>"']*)>""")
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""")
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORDS = re.compile(r"[a-z]+")
#: What a stream holds where a block ends; no word contains a line break.
BOUNDARY = "\n"


class Block(NamedTuple):
    text: str
    kind: int
    flow: bool


@cache
def _end_of(name: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I)


@lru_cache(4096)
def _marks(name: str) -> frozenset:
    """The marks of one class, id or role name; none if it says other things too."""
    words = set(_WORDS.findall(re.sub(r"([a-z])([A-Z])", r"\1-\2", name).lower()))
    if words & _COMMENTS and not words & _ABOUT:
        return frozenset(("comments",))
    found = words & (_MARKS | _OUTER_MARKS | _ELSEWHERE)
    rest = words - found - (_PIECES if words & _ELSEWHERE else frozenset())
    beside = all(w in _BESIDE or w.removesuffix("s") in _BESIDE for w in rest)
    return frozenset(found) if beside else frozenset()


@lru_cache(4096)
def _marks_of(attributes: str) -> frozenset:
    return frozenset().union(*map(_marks, " ".join(map("".join, _NAMES.findall(attributes))).split()))


def parse(page: str | None) -> list[Block]:
    """The blocks of a page in order: their text, what the elements around say, and if it is running text."""
    page = page or ""
    out: list[Block] = []
    held: list[str] = []
    stack: list[tuple[str, int, bool]] = []  # open elements that can hold blocks, their kind, if only a name marks it
    kind, at, n = UNKNOWN, 0, len(page)

    def flush() -> None:
        if held:
            text = "".join(held)
            held.clear()
            text = " ".join((entities.unescape(text) if "&" in text else text).split())
            if text:
                out.append(Block(text, kind, bool(stack) and stack[-1][0] in _FLOW))

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            held.append(page[at:])
            break
        if lt > at:
            held.append(page[at:lt])
        following = page[lt + 1 : lt + 2]
        if following in ("!", "?"):
            comment = page.startswith("<!--", lt)
            end = page.find("-->", lt + 4) if comment else page.find(">", lt)
            at = n if end < 0 else end + (3 if comment else 1)
            continue
        tag = _PLAIN_TAG.match(page, lt) or _TAG.match(page, lt) or _LOOSE_TAG.match(page, lt)
        if tag is None:
            if following == "/" or following.isalpha():  # an unfinished tag
                break
            held.append("<")
            at = lt + 1
            continue
        at = tag.end()
        closing, name, attributes = tag.groups()
        name = name.lower()
        if name in _RAW and not closing:
            held.append(" ")
            end = _end_of(name).search(page, at)
            if attributes.endswith("/") and (end is None or name not in ("script", "style", "textarea")):
                continue  # closes itself
            at = end.end() if end else n
            continue
        if name in _INLINE:
            if name in ("br", "img", "input"):
                held.append(" ")
            continue
        flush()
        if name in _VOID or attributes.endswith("/"):
            continue
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
            kind = stack[-1][1] if stack else UNKNOWN
            continue
        if name in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and stack and stack[-1][0] == name:
            stack.pop()  # these end where the next one begins
            kind = stack[-1][1] if stack else UNKNOWN
        within, named = kind, bool(stack) and stack[-1][2]
        if within == BOILERPLATE:
            if named and name in _CONTENT:
                within = MARKED_CONTENT
        elif name not in ("html", "body"):
            marks = _marks_of(attributes) if "=" in attributes else frozenset()
            outside = within == UNKNOWN
            if name in _DROPPED or outside and name in ("header", "head"):
                within, named = BOILERPLATE, False
            elif marks - _OUTER_MARKS or outside and marks:
                within, named = BOILERPLATE, outside
            elif name in _CONTENT and within != MARKED_CONTENT:
                within = CONTENT
        stack.append((name, within, named))
        kind = within
    flush()
    return out


# ---- token streams ------------------------------------------------------------------

_FACTOR, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_BOUNDARY_ID = np.uint64(0x165667B19E3779F9)


def _mixed(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(32))) * _MIX
        return h ^ (h >> np.uint64(29))


def token_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of ``data`` and the places where they end; a space or line break follows each.

    A token's bytes are the digits of a number to an odd base, modulo 2 ** 64.
    """
    raw = np.frombuffer(data, dtype=np.uint8)
    ends = np.flatnonzero((raw == 32) | (raw == 10))
    if not len(ends):
        return np.zeros(0, dtype=np.uint64), ends
    starts = np.r_[0, ends[:-1] + 1]
    with np.errstate(over="ignore"):
        powers = np.full(int((ends - starts).max()) + 1, _FACTOR, dtype=np.uint64)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        digits = raw.astype(np.uint64) + np.uint64(1)
        digits[ends] = 0
        digits *= powers[np.arange(len(raw)) - np.repeat(starts, ends - starts + 1)]
        return _mixed(np.add.reduceat(digits, starts)), ends


def _seed(host: str | None) -> int:
    return xxhash.xxh64_intdigest((host or "").encode("utf-8", "surrogatepass"))


class Streams:
    """Token streams of some pages, one after another: hashes, with page and host of each token."""

    def __init__(self, pages: list[list[Block]], seeds: list[int]):
        texts = ["".join([f"{block[0]}{BOUNDARY}" for block in blocks]).encode("utf-8", "surrogatepass") for blocks in pages]
        data = b"".join(texts)
        words, ends = token_hashes(data)
        closes = np.frombuffer(data, dtype=np.uint8)[ends] == 10
        last = np.cumsum(1 + closes)  # tokens up to and with each word and the boundary after it
        self.ids = np.repeat(words, 1 + closes)
        self.ids[last[closes] - 1] = _BOUNDARY_ID
        upto = np.searchsorted(ends, np.cumsum([len(t) for t in texts]) if texts else np.zeros(0, np.int64))
        stops = np.r_[0, last][upto]
        self.starts = np.r_[0, stops[:-1]].astype(np.int64)[: len(pages)]
        self.page = np.repeat(np.arange(len(pages)), stops - self.starts)
        self.seed = np.repeat(np.array(seeds, dtype=np.uint64), stops - self.starts)

    def grams(self, width: int) -> np.ndarray:
        """A hash of the ``width`` tokens from each place on and of the host."""
        n = max(len(self.ids) - width + 1, 0)
        with np.errstate(over="ignore"):
            out = self.seed[:n].copy()
            for i in range(width):
                out = out * _FACTOR + self.ids[i : i + n]
            return _mixed(out)

    def windows(self, depth: int = DEPTH) -> np.ndarray:
        """The places from which ``depth`` tokens belong to one page."""
        return np.flatnonzero(self.page[: max(len(self.ids) - depth + 1, 0)] == self.page[depth - 1 :])

    def anchors(self, depth: int = DEPTH) -> np.ndarray:
        """For each of ``windows`` its anchor: the smallest hash of its GRAM-grams."""
        at, least = self.windows(depth), self.grams(GRAM)
        out = least[at] if len(at) else least[:0]
        for i in range(1, depth - GRAM + 1):
            out = np.minimum(out, least[at + i])
        return out


def _distinct(page: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each page's keys once, by page."""
    change = np.r_[True, (key[1:] != key[:-1]) | (page[1:] != page[:-1])][: len(key)]
    page, key = page[change], key[change]
    order = np.lexsort((key, page))
    page, key = page[order], key[order]
    change = np.r_[True, (key[1:] != key[:-1]) | (page[1:] != page[:-1])][: len(key)]
    return page[change], key[change]


def short_blocks(blocks: list[Block], seed: int, depth: int = DEPTH) -> dict[int, int]:
    """Blocks too short for a window that no paragraph holds: number of the block -> hash of its text."""
    return {
        i: xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), seed=seed)
        for i, (text, kind, flow) in enumerate(blocks)
        if kind == UNKNOWN and not flow and text.count(" ") + 1 < depth
    }


def content_hash(blocks: list[Block]) -> int:
    """31 bits of the text that makes the page: its article, or else all that no element explains, or all."""
    chosen = _article(blocks) or [b for b in blocks if b.kind == UNKNOWN] or blocks
    return xxhash.xxh64_intdigest(BOUNDARY.join([b[0] for b in chosen]).encode("utf-8", "surrogatepass")) >> 33


def suffix_ranks(ids: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Ranks of the suffixes to ``depth`` tokens by prefix doubling; nothing follows the end."""
    rank, width = np.unique(ids, return_inverse=True)[1], 1
    while width < depth and len(rank):
        step = min(width, depth - width)
        after = np.zeros(len(rank), dtype=np.int64)
        after[: max(len(rank) - step, 0)] = rank[step:] + 1
        rank = np.unique(rank * (int(rank.max()) + 2) + after, return_inverse=True)[1]
        width += step
    return rank


def runs(streams: Streams, at: np.ndarray, content: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, ...]:
    """Of the windows at the places ``at``: hash, pages, least and greatest content of their runs.

    Pages and contents of a run stand at its first window, 0 at the others.
    """
    inside = np.zeros(len(streams.ids) + 1, dtype=np.int64)
    inside[at] += 1
    inside[at + depth] -= 1
    inside = np.cumsum(inside)[:-1] > 0
    # Only what the windows cover is concatenated; each window's tokens stay neighbours.
    with np.errstate(over="ignore"):
        ids = streams.ids[inside] * _FACTOR + streams.seed[inside]
    page = streams.page[at]
    rank = suffix_ranks(ids, depth)[(np.cumsum(inside) - 1)[at]]
    order = np.lexsort((page, rank))  # the suffix array of these places, equal runs by page
    r, p = rank[order], page[order]
    new = np.flatnonzero(np.r_[True, r[1:] != r[:-1]][: len(r)])
    n, low, high = (np.zeros(len(at), dtype=np.int64) for _ in range(3))
    if len(new):
        first = np.r_[True, (r[1:] != r[:-1]) | (p[1:] != p[:-1])].astype(np.int64)
        c = content[p]
        leader = order[new]
        n[leader] = np.add.reduceat(first, new)
        everyone = np.diff(np.r_[new, len(r)])
        # All windows of a run carry its contents, so that min and max need no leader.
        low[order] = np.repeat(np.minimum.reduceat(c, new), everyone)
        high[order] = np.repeat(np.maximum.reduceat(c, new), everyone)
    return streams.grams(depth)[at], n, low, high


def _stretches(mask: np.ndarray, least: int = DEPTH // 2) -> np.ndarray:
    """Without covered stretches of fewer than ``least`` tokens: a run that ends a word or two into a block."""
    edges = np.flatnonzero(np.diff(np.r_[False, mask, False].astype(np.int8)))
    out = mask.copy()
    for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
        if end - start < least:
            out[start:end] = False
    return out


def _article(blocks: list[Block]) -> list[Block]:
    return [b for b in blocks if b.kind == CONTENT] or [b for b in blocks if b.kind == MARKED_CONTENT]


def assemble(blocks: list[Block], places: np.ndarray, short: list[int]) -> tuple[str, int, int]:
    """Text of a page, its tokens in repeats, and its tokens that go because of them.

    Repeats start at ``places`` of the stream; the blocks numbered in ``short`` are repeats as a whole.
    """
    mask = None
    if len(places) or short:
        total = sum(b[0].count(" ") + 2 for b in blocks)
        edge = np.zeros(total + 1, dtype=np.int64)
        np.add.at(edge, places, 1)
        np.add.at(edge, places + DEPTH, -1)
        mask = np.cumsum(edge)[:total] > 0
    whole = set(short)
    article = _article(blocks)
    kind = article[0].kind if article else UNKNOWN
    chosen: list[tuple[Block, np.ndarray | None]] = []
    at = n_repeated = 0
    for i, block in enumerate(blocks):
        own = None
        if mask is not None:
            n = block.text.count(" ") + 1
            own = mask[at : at + n]
            at += n + 1
            if i in whole:
                own = np.ones(n, dtype=bool)
            n_repeated += int(own.sum())
        if block.kind == kind:
            chosen.append((block, own))
    out: list[str] = []
    n_cut = 0
    copy = bool(article) and mask is not None and 2 * sum(int(own.sum()) for _, own in chosen) > sum(len(own) for _, own in chosen)
    for block, own in chosen:
        if own is None or not own.any() or article and (copy or block.flow or not own.all()):
            out.append(block.text)
            continue
        if not own.all():
            own = _stretches(own)
        n_cut += int(own.sum())
        if not own.all():
            out.append(" ".join(t for t, m in zip(block.text.split(), own) if not m))
    return "\n\n".join(out), n_repeated, n_cut


# ---- tables -------------------------------------------------------------------------


def _pack(blocks: list[Block]) -> bytes:
    """Blocks as compressed lines (their text holds no line break), since pages are shuffled."""
    raw = "\n".join([f"{2 * kind + flow}{text}" for text, kind, flow in blocks]).encode("utf-8", "surrogatepass")
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(data: bytes) -> list[Block]:
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    return [Block(line[1:], int(line[0]) >> 1, int(line[0]) & 1 == 1) for line in raw.decode("utf-8", "surrogatepass").split("\n")] if raw else []


def _host(url_col: str) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(F.col(url_col).cast("string"), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values, dtype=np.uint64).view(np.int64))


def _keyed(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """``row`` names a page by url and html; equal pages share it, and pages that a collision joins only share keys of runs."""
    url, body = F.col(url_col).cast("string"), F.col(html_col).cast("string")
    return pages.select(F.xxhash64(url, body).alias("row"), _host(url_col).alias("host"), body.alias("html"), F.col(id_col).alias("page_id"), url.alias("url"))


def page_anchors(keyed: DataFrame) -> DataFrame:
    """``key, row, content``: each page's anchors and short blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in by_size(whole, 2, 4 << 20)):
            parsed = [parse(html.as_py()) for html in batch.column(2)]
            seeds = list(map(_seed, batch.column(1).to_pylist()))
            streams = Streams(parsed, seeds)
            short = [(i, key) for i, (blocks, seed) in enumerate(zip(parsed, seeds)) for key in short_blocks(blocks, seed).values()]
            page = np.concatenate([streams.page[streams.windows()], np.array([s[0] for s in short], dtype=np.int64)])
            page, key = _distinct(page, np.concatenate([streams.anchors(), np.array([s[1] for s in short], dtype=np.uint64)]))
            content = np.array(list(map(content_hash, parsed)), dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [_signed(key), pa.array(batch.column(0).to_numpy()[page]), pa.array(content[page])], names=["key", "row", "content"]
            )

    return keyed.select("row", "host", "html").mapInArrow(run, "key bigint, row bigint, content int")


def _often(counted: DataFrame, n: Column, least: str, greatest: str) -> DataFrame:
    """Keys on enough pages of different contents, combined before the shuffle."""
    sums = counted.groupBy("key").agg(F.sum(n).alias("n"), F.min(least).alias("low"), F.max(greatest).alias("high"))
    return sums.filter((F.col("n") >= MIN_PAGES) & (F.col("low") != F.col("high"))).select("key")


def page_runs(placed: DataFrame) -> DataFrame:
    """``key, row, at, n, low, high`` for the windows of ``placed`` (``row, host, blocks, keys``) that hold a repeated anchor.

    ``at`` is the place in the page's stream, or -1 less the number of a short block; ``n`` is
    counted once for each run and page of a batch and 0 elsewhere.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in by_size(whole, 2, 4 << 20)):
            parsed = [_unpack(b.as_py()) for b in batch.column(2)]
            seeds = list(map(_seed, batch.column(1).to_pylist()))
            streams, content = Streams(parsed, seeds), np.array(list(map(content_hash, parsed)), dtype=np.int64)
            keys = batch.column(3)
            known = np.unique(keys.flatten().to_numpy().view(np.uint64))
            anchors = streams.anchors()
            # Keys hold the host: one that is repeated for a page is so for all pages of its host.
            near = np.searchsorted(known, anchors)
            at = streams.windows()[known[np.minimum(near, len(known) - 1)] == anchors] if len(known) else np.zeros(0, np.int64)
            key, n, low, high = runs(streams, at, content)
            page = streams.page[at]
            also = set(known.tolist())
            short = [(i, k, h) for i, (blocks, seed) in enumerate(zip(parsed, seeds)) for k, h in short_blocks(blocks, seed).items() if h in also]
            owner = np.array([s[0] for s in short], dtype=np.int64)
            hashes = np.array([s[2] for s in short], dtype=np.uint64)
            once = np.zeros(len(short), dtype=np.int64)
            once[list({(s[0], s[2]): i for i, s in enumerate(short)}.values())] = 1
            yield pa.RecordBatch.from_arrays(
                [
                    _signed(np.concatenate([key, hashes])),
                    pa.array(batch.column(0).to_numpy()[np.concatenate([page, owner])]),
                    pa.array(np.concatenate([at - streams.starts[page], -1 - np.array([s[1] for s in short], dtype=np.int64)]).astype(np.int32)),
                    pa.array(np.concatenate([n, once]).astype(np.int32)),
                    pa.array(np.concatenate([low, content[owner]]).astype(np.int32)),
                    pa.array(np.concatenate([high, content[owner]]).astype(np.int32)),
                ],
                names=["key", "row", "at", "n", "low", "high"],
            )

    return placed.select("row", "host", "blocks", "keys").mapInArrow(run, "key bigint, row bigint, at int, n int, low int, high int")


def blocks(keyed: DataFrame, id_type: str) -> DataFrame:
    """The parsed pages, packed: ``row, host, page_id, url, blocks``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in by_size(whole, 4, 4 << 20)):
            packed = pa.array([_pack(parse(h.as_py())) for h in batch.column(4)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], packed], names=["row", "host", "page_id", "url", "blocks"])

    return keyed.select("row", "host", "page_id", "url", "html").mapInArrow(run, f"row bigint, host string, page_id {id_type}, url string, blocks binary")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars, n_repeated`` (tokens in repeats), ``n_cut`` (tokens that repeats remove) for every row."""
    spark, id_type = pages.sparkSession, pages.schema[id_col].dataType.simpleString()
    keyed = _keyed(pages, id_col, url_col, html_col)
    anchors = page_anchors(keyed)
    # The first counts are written and their shuffle is freed before the next one is made.
    often = cut(_often(anchors.withColumn("n", F.lit(1)), F.col("n"), "content", "content"), "anchors")
    free_shuffles(spark)
    known = anchors.select("key", "row").join(often.hint("merge"), "key", "left_semi").groupBy("row").agg(F.collect_set("key").alias("keys"))
    path = write_cut(known, "known")
    free_shuffles(spark)
    found = page_runs(blocks(keyed, id_type).select("row", "host", "blocks").join(read_cut(spark, path, known).hint("merge"), "row"))
    runs_path = write_cut(found, "runs")
    drop_cut(spark, path)
    free_shuffles(spark)
    found = read_cut(spark, runs_path, found)
    repeats = found.select("key", "row", "at").join(_often(found, F.col("n"), "low", "high").hint("merge"), "key", "left_semi")
    # Rows that share a name by equal url and html have found the same places.
    repeats = cut(repeats.groupBy("row").agg(F.collect_set("at").alias("places")), "repeats")
    drop_cut(spark, runs_path)
    free_shuffles(spark)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = []
            for packed, found in zip(batch.column(2), batch.column(3)):
                places = np.array(found.as_py() or [], dtype=np.int64)
                done.append(assemble(_unpack(packed.as_py()), places[places >= 0], (-1 - places[places < 0]).tolist()))
            text = [d[0] for d in done]
            numbers = [pa.array(x, pa.int64()) for x in (list(map(len, text)), [d[1] for d in done], [d[2] for d in done])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(text, pa.string()), *numbers], names=["page_id", "url", "text", "n_chars", "n_repeated", "n_cut"]
            )

    placed = blocks(keyed, id_type).join(repeats.hint("merge"), "row", "left").select("page_id", "url", "blocks", "places")
    return placed.mapInArrow(decide, f"page_id {id_type}, url string, text string, n_chars bigint, n_repeated bigint, n_cut bigint")
