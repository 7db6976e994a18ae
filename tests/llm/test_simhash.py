import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from millrace.llm import simhash as S


def brute_fp(text, k=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = ([" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)]) if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if h and 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps, radius):
    parent = list(range(len(ids)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= radius):
            a, b = root(i), root(int(j))
            parent[max(a, b)] = min(a, b)
    groups = {}
    for i, d in enumerate(ids):
        groups.setdefault(root(i), []).append(d)
    return {i: min((x for x in groups[root(k)] if x is not None), default=None) for k, i in enumerate(ids)}


def test_fingerprints(docs, texts):
    got = sorted((str(r["doc_id"]), r["fp"] & (2**64 - 1)) for r in S.fingerprints(docs).collect())
    assert got == sorted((str(i), brute_fp(t)) for i, t in texts)


def test_components_against_brute_force(docs, texts):
    out = S.near_dedup(docs).collect()
    ids = [i for i, _ in texts]
    want = brute_components(ids, np.array([brute_fp(t) for _, t in texts], dtype=np.uint64), 2)
    assert len(out) == len(texts) and all(r["component_id"] == want[r["doc_id"]] for r in out)


def test_tiles_lose_no_link(spark):
    """Chains and dense clusters, in every layout, against all pairs."""
    rng = random.Random(5)
    fps = [rng.getrandbits(64) for _ in range(300)]
    for f in list(fps[:60]):
        for _ in range(rng.randint(1, 6)):
            f ^= (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))
            fps.append(f)
    fps = np.unique(np.array(fps, dtype=np.uint64))
    rows = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    want = brute_components([int(x) for x in fps.view(np.int64)], fps, 2)
    for segments, tile_rows in ((4, 2048), (8, 2048), (2, 7)):
        roots = {r["node"]: r["root"] for r in S.components(S.links(rows, 2, segments, tile_rows)).collect()}
        assert {int(x): roots.get(int(x), int(x)) for x in fps.view(np.int64)} == want


def test_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(500, 400), (500, 450)], "a long, b long")
    got = {r["node"]: r["root"] for r in S.components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 101)}, 500: 400, 450: 400}


def test_near_copies(spark):
    rng = random.Random(3)
    base = [[f"w{rng.randrange(10**6)}" for _ in range(200)] for _ in range(40)]
    rows = []
    for i, words in enumerate(base):
        rows.append((i, " ".join(words)))
        for k, n in enumerate((1, 2, 60)):
            copy = list(words)
            for _ in range(n):
                copy[rng.randrange(len(copy))] = f"z{rng.randrange(10**6)}"
            rows.append((100 * (k + 1) + i, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")

    def shingles(t):
        w = t.split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    sets = {i: shingles(t) for i, t in rows}
    want = {}
    for i in sorted(sets):
        want[i] = min([i, *(want[j] for j in sorted(sets) if j < i and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]))])
    got = {r["node"]: r["root"] for r in S.near_copies(docs).collect()}
    assert {i: got.get(i, i) for i in sets} == want
    split = {r["node"]: r["root"] for r in S.near_copies(docs, tile_rows=2).collect()}
    assert split == got
    assert S.keep_one(docs).count() == len(set(want.values()))


def test_edges_of_the_table(spark, docs, nothing):
    assert S.near_dedup(nothing).count() == 0 and S.keep_one(nothing).count() == 0
    out = S.keep_one(docs)
    assert out.columns == docs.columns and out.filter("doc_id is null").count() == 1


def near_pair(rng, first):
    words = [f"w{rng.randrange(10**6)}" for _ in range(80)]
    copy = list(words)
    copy[30] = copy[31] = copy[32] = f"z{rng.randrange(10**6)}"
    return [(first, " ".join(words)), (first + 1, " ".join(copy))]


def test_no_link_is_lost(spark):
    """Pairs just over the similarity that share no anchor, or lie beyond the radius."""
    rng, apart = random.Random(8), []
    while len(apart) < 4:
        pair = near_pair(rng, len(apart))
        if not set(S.anchors(pair[0][1], 5).tolist()) & set(S.anchors(pair[1][1], 5).tolist()):
            apart += pair
    rows = apart + [row for i in range(100, 140, 2) for row in near_pair(rng, i)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {i + 1: i for i, _ in rows[::2]}
    assert {r["node"]: r["root"] for r in S.near_copies(docs).collect()} == want
    assert {r["node"]: r["root"] for r in S.near_copies(docs, radius=0, tile_rows=2).collect()} == want


def test_prefixes_of_similar_sets_meet():
    rng = np.random.default_rng(4)
    for _ in range(2000):
        n, gone = int(rng.integers(1, 60)), int(rng.integers(0, 8))
        h = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        other = np.unique(np.r_[h[gone:], rng.integers(0, 2**64, int(rng.integers(0, 8)), dtype=np.uint64)])
        shared = len(np.intersect1d(h, other))
        common = np.sort(h[rng.random(len(h)) < 0.3])
        if len(other) and shared >= 0.8 * (len(h) + len(other) - shared):
            assert len(np.intersect1d(S.prefix(h, 0.8, common), S.prefix(other, 0.8, common)))


def test_rows_that_repeat_an_id(spark):
    rng = random.Random(6)
    (_, text), (_, copy) = near_pair(rng, 0)
    (_, clean), (_, last) = near_pair(rng, 0)
    rows = [(-3, text), (7, copy), (7, clean), (7, last), (None, copy + " x"), (None, clean + " y"), (None, "alone")]
    for kind, as_id in (("long", lambda i: i), ("string", lambda i: None if i is None else f"id{i + 3:02}")):
        docs = spark.createDataFrame([(as_id(i), t) for i, t in rows], f"doc_id {kind}, text string")
        kept = [(r["doc_id"], r["text"]) for r in S.keep_one(docs).collect()]
        assert len(kept) == 3 and (as_id(-3), text) in kept and (None, "alone") in kept
        assert [i for i, t in kept if t in (clean, last)] == [as_id(7)]


def test_sketches_hold_the_radius():
    """A sketch differs in no more bits than the sets in elements, at any width; tiles lose no link."""
    rng = np.random.default_rng(9)
    sets = []
    for n in (1, 3, 40, 63, 64, 65, 200, 900):
        for _ in range(4):
            h = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
            sets.append(h)
            for share in (0.95, 0.8, 0.5):
                kept = h[rng.random(len(h)) < share]
                sets.append(np.unique(np.r_[kept, rng.integers(0, 2**64, (len(h) - len(kept)) // 3 + 1, dtype=np.uint64)]))
    sketches = [S.parity_sketch(h) for h in sets]
    links = set()
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            apart = len(np.setxor1d(a, b))
            width = min(len(sketches[i]), len(sketches[j]))
            differ = np.bitwise_count(S.folded(sketches[i], width) ^ S.folded(sketches[j], width)).sum()
            assert differ <= apart and (apart - differ) % 2 == 0
            both = len(np.intersect1d(a, b))
            if both >= 0.8 * (len(a) + len(b) - both):
                links.add((j, i))
    rows, sizes = np.arange(len(sets)), np.array(list(map(len, sets)))
    half = rows % 2 == 0
    for roots in (rows, rows // 2):
        sides = [(rows[half], rows[half]), (rows[half], rows[~half]), (rows[~half], rows[~half])]
        found = set().union(*(S.within(rows, roots, sizes, sketches, x, y, 0.8) for x, y in sides))
        assert {(a, b) for a, b in links if roots[a] != roots[b]} <= found
        assert len(found) < 2 * len(links) and all(roots[a] != roots[b] for a, b in found)


def test_near_copies_against_all_pairs_of_the_documents(spark):
    """Every link at 0.8 of the real table, by bands of similarity, and no group that links do not make."""
    from collections import defaultdict

    sets = {}
    for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or ""))
        sets[r["doc_id"]] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    holders, shared = defaultdict(list), defaultdict(int)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    for ids in holders.values():
        for k, a in enumerate(ids):
            for b in ids[k + 1 :]:
                shared[a, b] += 1
    links = {p: n / (len(sets[p[0]]) + len(sets[p[1]]) - n) for p, n in shared.items()}
    links = {p: x for p, x in links.items() if x >= 0.8}
    empty = [i for i, s in sets.items() if not s]
    links.update({(empty[0], i): 1.0 for i in empty[1:]})
    got = {r["node"]: r["root"] for r in S.near_copies(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()}
    bands = defaultdict(lambda: [0, 0])
    for (a, b), x in links.items():
        found = bands[min(int(x * 20), 19) / 20]
        found[0] += got.get(a, a) == got.get(b, b)
        found[1] += 1
    print({k: tuple(v) for k, v in sorted(bands.items())})
    assert len(links) > 20 and all(n == of for n, of in bands.values())
    root = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            if root[a] != low or root[b] != low:
                root[a] = root[b] = low
                changed = True
    assert {i: got.get(i, i) for i in sets} == root


def test_near_copies_start_from_fingerprints_in_tiles(spark, monkeypatch):
    """Groups come from SimHash tiles too: without any shared anchor, and with no exact pass, copies of near fingerprints are found."""
    rng = np.random.default_rng(5)
    fps = np.unique(rng.integers(0, 2**64, 60, dtype=np.uint64))
    fps = np.unique(np.r_[fps, fps[:30] ^ np.uint64(5), fps[:10] ^ np.uint64(1 << 63)])
    table = spark.createDataFrame([(i, int(f)) for i, f in enumerate(np.r_[fps, fps[:5]].view(np.int64))], "doc_id long, fp long")
    want = brute_components(list(range(len(fps) + 5)), np.r_[fps, fps[:5]], 2)
    got = {r["doc_id"]: r["fp"] for r in S.tile_groups(table, 2, tile_rows=4).collect()}
    assert len(set(got.values())) == len(set(want.values()))
    assert all(got[i] == got[j] for i, j in want.items())

    words = [f"w{rng.integers(10**6)}" for _ in range(300)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join([*words[:-1], "other"]))], "doc_id long, text string")
    by_text = S._by_text

    def without_anchors(rows, columns, types, of):
        out = by_text(rows, columns, types, of)
        return out.withColumn("anchors", F.array().cast("array<bigint>")) if "anchors" in columns else out

    monkeypatch.setattr(S, "_by_text", without_anchors)
    monkeypatch.setattr(S, "_open_pairs", lambda table, *_: spark.createDataFrame([], "a long, b long"))
    assert np.bitwise_count(np.uint64(S.fingerprint(" ".join(words), 5)) ^ np.uint64(S.fingerprint(" ".join([*words[:-1], "other"]), 5))) <= 2
    assert {r["node"]: r["root"] for r in S.near_copies(docs).collect()} == {2: 1}
