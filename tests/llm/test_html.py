import pytest

from millrace.llm import html as H


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>t</title>{head}</head><body>{body}</body></html>"


@pytest.mark.parametrize(
    ("body", "text"),
    [
        ("<nav><a>menu</a></nav><article><h1>T</h1><p>a <b>b</b>\n c<p>d</article><footer>f</footer>", "T\n\na b c\n\nd"),
        ("<article><p>x &amp; y &lt;z&gt; &eacute;&#233;&nbsp;&copy</p></article>", "x & y <z> éé ©"),
        ("<article><script>var a='</p>';</script><style>p{}</style><!-- no --><p>yes</p><form><p>no</p></form></article>", "yes"),
        ('<article><p>a</p><div class="ad">no</div><aside>no</aside><section id="comments"><p>no</p></section><p>b</p></article>', "a\n\nb"),
        ('<article><div class="x"><div class="share">no</div><p>in</p></div><p>out</p></article>', "in\n\nout"),
        ("<article><p>1 < 2 and a <b", "1 < 2 and a"),
        ("<article><ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table><blockquote>q</blockquote></article>", "one\n\ntwo\n\nc1\n\nc2\n\nq"),
        ("<article><p>a<br>b<br/>c</p></article>", "a b c"),
        ('<article><header><h1>title</h1></header><p data-x="a>b">t</p></article>', "title\n\nt"),
        ("<main><p>m</p></main><p>loose</p>", "m"),
        ('<svg class="i"/><article><p>a</p><iframe src=a/><svg/><p>b</p></article>', "a\n\nb"),
        ('<div class="with-sidebar"><article class="post no-comments"><p>a</p></article></div>', "a"),
        ('<main><div id="search-results"><p>r</p></div><div class="site-footer">no</div><div class="cookieBanner ad-slot-2">no</div></main>', "r"),
        ('<div class="sidebar"><article><p>only here</p></article></div>', "only here"),
        ('<article><p>x</p></article><div class="sidebar"><article><p>teaser</p></article></div>', "x"),
        ("<nav><article><p>teaser</p></article></nav><p>loose</p>", "loose"),
        ("", ""),
        (None, ""),
    ],
)
def test_structure(spark, body, text):
    html = page(body) if body is not None else None
    out = H.extract(spark.createDataFrame([(1, "http://a.b/c", html)], "page_id long, url string, html string")).collect()[0]
    assert (out["text"], out["n_chars"]) == (text, len(text))


@pytest.mark.parametrize(
    ("names", "goes"),
    [
        ("comments reader-comments-list comment-thread commentThread comment-form-wrapper article-comments comment_12 commentlist disqus_thread responses", True),
        ("share-buttons social-links sharing-tools related-posts related-stories more-related related recommended-articles newsletter-signup-box ads-slot-3 toolbar", True),
        ("no-comments has-comments comments-open category-comment code-comment with-sidebar search-results market-share share-price news-alert related-work", False),
        ("content-sidebar-wrap headline lead adventure address commentary response story body post entry-content readmore", False),
    ],
)
def test_names_of_boxes_inside_an_article(names, goes):
    for name in names.split():
        for attribute in (f'class="x1 {name}"', f"id='{name}'"):
            blocks = H.parse(page(f"<article><p>a</p><div {attribute}><p>b</p></div></article>"))
            assert [b.text for b in blocks if b.kind == H.CONTENT] == (["a"] if goes else ["a", "b"]), name


def brute(pages):
    """Extraction by comparing all windows of all pages of a host: page number -> masks, for (host, html) pages."""
    where, whole, content = {}, {}, {}
    parsed = [(host, H.parse(html)) for host, html in pages]
    for p, (host, blocks) in enumerate(parsed):
        tokens = [t for b in blocks for t in [*b.text.split(), None]]
        for i in range(len(tokens) - H.DEPTH + 1):
            where.setdefault((host, *tokens[i : i + H.DEPTH]), set()).add(p)
        for b in blocks:
            if b.kind == H.UNKNOWN and not b.flow and len(b.text.split()) < H.DEPTH:
                whole.setdefault((host, b.text), set()).add(p)
        article = [b for b in blocks if b.kind == H.CONTENT] or [b for b in blocks if b.kind == H.MARKED_CONTENT]
        content[p] = tuple(b.text for b in article or [b for b in blocks if b.kind == H.UNKNOWN] or blocks)

    def often(found):
        return len(found) >= H.MIN_PAGES and len({content[p] for p in found}) > 1

    texts = []
    for p, (host, blocks) in enumerate(parsed):
        tokens = [t for b in blocks for t in [*b.text.split(), None]]
        mask = [False] * len(tokens)
        for i in range(len(tokens) - H.DEPTH + 1):
            if often(where[(host, *tokens[i : i + H.DEPTH])]):
                mask[i : i + H.DEPTH] = [True] * H.DEPTH
        at, own = 0, []
        for b in blocks:
            n = len(b.text.split())
            m = mask[at : at + n]
            at += n + 1
            if (host, b.text) in whole and b.kind == H.UNKNOWN and not b.flow and often(whole[(host, b.text)]):
                m = [True] * n
            own.append(m)
        kinds = [b.kind for b in blocks]
        kind = H.CONTENT if H.CONTENT in kinds else H.MARKED_CONTENT if H.MARKED_CONTENT in kinds else H.UNKNOWN
        chosen = [(b, m) for b, m in zip(blocks, own) if b.kind == kind]
        near = kind != H.UNKNOWN and sum(map(sum, (m for _, m in chosen))) * 2 > sum(len(m) for _, m in chosen)
        out = []
        for b, m in chosen:
            if kind != H.UNKNOWN:
                if near or b.flow or not all(m):
                    out.append(b.text)
            elif not all(m):
                for start in range(len(m)):
                    if m[start] and not (start and m[start - 1]):
                        end = (m + [False]).index(False, start)
                        if end - start < H.DEPTH // 2:
                            m[start:end] = [False] * (end - start)
                out.append(" ".join(t for t, x in zip(b.text.split(), m) if not x))
        texts.append("\n\n".join(out))
    return texts


def host_pages(seed, n):
    """Pages of a few hosts, one hot, with notices, menus, boxes inside articles, shared passages and copies."""
    import random

    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    text = lambda k: " ".join(rng.choice(words) for _ in range(k))
    pool = {h: [text(rng.randrange(3, 25)) for _ in range(6)] for h in "abc"}
    rows, bodies = [], []
    for i in range(n):
        host = rng.choice("aaaab" if i % 3 else "abc")
        menu = "".join(f"<li>{w}</li>" for w in pool[host][0].split())
        box = f'<div class="x">{rng.choice(pool[host])}</div>'
        story = "".join(f"<p>{text(rng.randrange(1, 30))}</p>" for _ in range(rng.randrange(4))) + (f"<p>{pool[host][1]}</p>" if rng.random() < 0.3 else "")
        body = rng.choice(
            [
                f"<ul>{menu}</ul><div>{text(9)} {rng.choice(pool[host])} {text(5)}</div><div>Home</div>{box}",
                f"<nav>{menu}</nav><article><h1>{text(4)}</h1>{box}{story}</article><footer>{pool[host][2]}</footer>",
                f"<main>{box}{box}</main>{story}",
                rng.choice(bodies) if bodies else "<p>first</p>",
            ]
        )
        bodies.append(body)
        rows.append((i, host, page(body)))
    return rows


def test_against_brute_force_on_generated_hosts(spark):
    rows = host_pages(7, 240)
    rows.append((240, "a", page("<div>" + rows[0][2] + " ".join(f"long{i % 5000}" for i in range(60_000)) + "</div>")))
    frame = spark.createDataFrame([(i, f"http://{h}/{i}", html, "x", 1) for i, h, html in rows], "page_id long, url string, html string, row string, keys int")
    expected = brute([(h, html) for _, h, html in rows])
    plain = ["\n\n".join(b.text for b in (H._article(H.parse(x)) or [b for b in H.parse(x) if b.kind == H.UNKNOWN])) for _, _, x in rows]
    assert sum(a != b for a, b in zip(plain, expected)) > 60  # repeats decide
    for parts in (1, 5):
        out = H.extract(frame.repartition(parts)).collect()
        assert len(out) == len(rows)
        assert {r["page_id"]: r["text"] for r in out} == dict(enumerate(expected))
        assert all(r["n_chars"] == len(r["text"]) for r in out) and sum(r["n_cut"] for r in out) > 500


def test_anchor_of_every_window():
    import random

    rng = random.Random(3)
    pages = [[H.Block(" ".join(rng.choice("abc") for _ in range(rng.randrange(1, 40))), H.UNKNOWN, True) for _ in range(3)] for _ in range(9)] + [[]]
    streams = H.Streams(pages, [rng.randrange(1 << 64) for _ in pages])
    single, places = streams.grams(H.GRAM), streams.windows()
    expected = [i for i in range(len(streams.ids) - H.DEPTH + 1) if len(set(streams.page[i : i + H.DEPTH].tolist())) == 1]
    assert places.tolist() == expected
    assert streams.anchors().tolist() == [min(single[i : i + H.DEPTH - H.GRAM + 1].tolist()) for i in expected]
    assert len(H.Streams([], []).anchors()) == 0


def test_suffix_ranks_against_brute_force():
    import numpy as np

    rng = np.random.default_rng(5)
    for n in (0, 1, 9, 60):
        ids = rng.integers(0, 3, n).astype(np.uint64)
        for depth in (1, 3, 8, 10):
            rank, seen = H.suffix_ranks(ids, depth), {}
            for i in range(n):
                seen.setdefault(int(rank[i]), set()).add(tuple(ids[i : i + depth].tolist()))
            assert all(len(v) == 1 for v in seen.values()) and len(seen) == len(set().union(*seen.values()))
            assert [x[1] for x in sorted((k, min(v)) for k, v in seen.items())] == sorted(min(v) for v in seen.values())


def test_streams():
    pages = [[H.Block("ab c", 1, True), H.Block("é", 1, True)], [], [H.Block("c ab", 1, True)]]
    streams = H.Streams(pages, [1, 2, 3])
    a, b = streams.ids.tolist(), H._BOUNDARY_ID
    assert len(a) == 8 and a[2] == a[4] == a[7] == b and (a[0], a[1]) == (a[6], a[5]) and len(set(a)) == 4
    assert streams.page.tolist() == [0] * 5 + [2] * 3 and streams.starts.tolist() == [0, 5, 5]


def test_host_boilerplate_of_unmarked_pages(spark):
    common = " ".join(f"welcome{i}" for i in range(12))
    rows = [(i, "http://h.org/x", page(f"<div>Home</div><div>{common}</div><div>story {i} " + " ".join(f"u{i}v{j}" for j in range(10)) + "</div>")) for i in range(5)]
    rows += [(9, "http://other.org/", page(f"<div>{common}</div>")), (10, None, page("<div>alone</div>"))]
    out = {r["page_id"]: r["text"] for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(out[i].startswith(f"story {i}") and "welcome" not in out[i] for i in range(5))
    assert out[9] == common and out[10] == "alone"


def test_boxes_inside_articles(spark):
    """A notice repeated inside articles goes; passages that articles share, and copies, stay."""
    notice = " ".join(f"notice{i}" for i in range(12))
    passage = " ".join(f"passage{i}" for i in range(30))
    own = lambda i: " ".join(f"p{i}w{k}" for k in range(60))
    rows = [(i, "http://h.org/", page(f"<main><div>{notice}</div><p>{own(i)}</p><p>{passage}</p></main>")) for i in range(4)]
    out = {r["page_id"]: r for r in H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(out[i]["text"] == f"{own(i)}\n\n{passage}" and out[i]["n_cut"] == 12 for i in range(4))


def test_repeated_articles_stay(spark):
    text = " ".join(f"w{i}" for i in range(100))
    rows = [(i, "http://h.org/", page(f"<nav>menu {i}</nav><article><div>{text}</div></article>")) for i in range(6)]
    rows.append(rows[0])
    out = H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(out) == 7 and {r["text"] for r in out} == {text}


def test_real_pages_and_empty(spark):
    """Where every page has an article, the text is what a plain reading of the article's elements gives."""
    import html as entities
    import re

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    out = {r["page_id"]: r for r in H.extract(pages).collect()}
    rows = pages.collect()
    assert len(out) == len(rows)
    for r in rows:
        inside = re.search(r"<article>(.*?)(</article>|$)", r["html"], re.S)[1]
        inside = re.sub(r"<!--.*?(-->|$)|<(script|style|form|aside|nav)\b.*?</\2>", "", inside, flags=re.S)
        parts = re.split(r"</?(?:p|h1|h2|div|ul|li|section|blockquote|table|tr|td)\b[^>]*>", inside)
        parts = [" ".join(entities.unescape(re.sub(r"<br>", " ", x) if "<br>" in x else x).split()) for x in (re.sub(r"</?(?:b|a|i|em|strong)\b[^>]*>", "", y) for y in parts)]
        assert out[r["page_id"]]["text"] == "\n\n".join(x for x in parts if x), r["page_id"]
    assert H.extract(pages.limit(0)).count() == 0
