"""Evidence classes and growing components against plain union-find."""

import numpy as np
import pytest

from millrace.operators import evidence as E
from millrace.operators import graph


def find(links):
    """Smallest connected node of every node."""
    root = {}
    for a, b in links:
        x, y = (root.setdefault(n, n) for n in (a, b))
        for n in [n for n, r in root.items() if r in (x, y)]:
            root[n] = min(x, y)
    return root


@pytest.mark.parametrize("seed", range(3))
def test_components_grow_to_the_same(spark, seed):
    rng = np.random.default_rng(seed)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 60, (40, 2))] + [(100 + i, 101 + i) for i in range(20)]
    rng.shuffle(links)
    links = [tuple(map(int, x)) for x in links]
    frame = lambda x: spark.createDataFrame(x, "a bigint, b bigint")
    parts = [links[:20], links[10:35], links[35:], links[:5]]  # some come twice
    known = graph.connected_components(frame(parts[0]), "a", "b")
    for part in parts[1:]:
        known = graph.extend_components(known, frame(part))
    assert {r["node"]: r["root"] for r in known.collect()} == find(links)
    assert {r["node"]: r["root"] for r in graph.connected_components(frame(links), "a", "b").collect()} == find(links)


def test_components_of_nothing(spark):
    none = spark.createDataFrame([], "a bigint, b bigint")
    known = graph.connected_components(none, "a", "b")
    assert known.count() == 0
    one = graph.extend_components(known, spark.createDataFrame([(2, 1), (None, 4), (3, 3)], "a bigint, b bigint"))
    assert sorted(map(tuple, one.collect())) == [(1, 1), (2, 1), (3, 3)]


def test_depths(spark):
    steps = [("b", "a"), ("c", "b"), ("c", "a"), ("d", "c"), ("x", "y"), ("y", "x"), ("z", "y")]
    got = dict(map(tuple, graph.depths(spark.createDataFrame(steps, "c string, p string"), "c", "p").collect()))
    assert got == {"a": 0, "b": 1, "c": 2, "d": 3}  # the cycle and what hangs on it have no depth


ITEMS = [
    (1, "Storm hits coast.", "wire", "w/1", 1),
    (2, "Storm hits coast.", "wire", "w/1", 2),  # retrieved twice
    (3, "storm  hits coast", "wire", "w/1", 3),  # other marks
    (4, "Storm hits coast.", "daily", "d/1", 4),  # another outlet
    (5, "Storm hits coast.", "wire", "w/2", 5),  # another address
    (6, "Storm missed the coast.", "wire", "w/1", 6),  # changed at its address
    (7, "!!!", "wire", "w/3", 7),
    (8, "???", "wire", "w/4", 8),
    (9, None, "wire", "w/5", 9),
    (10, "Tormenta", "diario", "x/1", 10),
    (11, "Storm hits coast.", None, None, 11),
]
SCHEMA = "evidence_id int, content string, outlet string, url string, captured_at int"


def test_types_from_content(spark):
    links = {(r["a"], r["b"], r["kind"], r["changed"]) for r in E.derive_links(spark.createDataFrame(ITEMS, SCHEMA)).collect()}
    assert links == {
        (2, 1, "exact_copy", False), (3, 1, "near_copy", False), (4, 1, "syndicated_copy_of", False), (5, 1, "mirrored_at", False),
        (11, 1, "exact_copy", False), (6, 3, "updated_version_of", True),
    }


def test_classes(spark):
    items = spark.createDataFrame(ITEMS, SCHEMA)
    more = spark.createDataFrame([(10, 4, "translation_of", False), (7, 8, "near_copy", True), (8, 6, "retraction_of", True), (1, 9, "archived_copy_of", None)], "a int, b int, kind string, changed boolean")
    links = E.derive_links(items).unionByName(more)
    got = {r["evidence_id"]: r for r in E.classes(items, links).collect()}
    assert {k: r["class"] for k, r in got.items()} == {
        1: "archived_copy_of", 2: "exact_copy", 3: "near_copy", 4: "syndicated_copy_of", 5: "mirrored_at", 6: "version", 7: "version", 8: "version", 9: "original", 10: "translation_of", 11: "exact_copy",
    }
    assert {k for k, r in got.items() if r["collection"] == 1} == {1, 2, 3, 11}
    assert {k for k, r in got.items() if r["root"] == 1} == {1, 2, 3, 4, 5, 9, 10, 11}
    assert {r["origin"] for r in got.values() if r["root"] == 1} == {9}  # all others are copies of something
    assert (got[6]["root"], got[7]["root"], got[6]["retracted"], got[8]["retracted"]) == (6, 7, True, False)
    chains = {r["evidence_id"]: (r["chain"], r["version"]) for r in E.versions(links).collect()}
    assert chains == {3: (3, 1), 6: (3, 2), 8: (3, 3), 7: (3, 4)}


def test_copies_are_one_source(spark):
    items = E.classes(spark.createDataFrame(ITEMS, SCHEMA), E.derive_links(spark.createDataFrame(ITEMS, SCHEMA)))
    stances = spark.createDataFrame([(1, i, "supports") for i in (1, 2, 4, 5, 6)] + [(2, 7, "refutes"), (2, 7, "refutes")], "claim_id int, evidence_id int, stance string")
    got = {r["claim_id"]: (r["n_items"], r["n_independent"]) for r in E.independent_support(stances, items).collect()}
    assert got == {1: (5, 2), 2: (1, 1)}


def test_content_is_read_once(spark):
    """Components read their links many times; the content behind them is hashed once for each row."""
    seen = spark.sparkContext.accumulator(0)

    def look(rows):
        for batch in rows:
            seen.add(batch.num_rows)
            yield batch

    items = spark.createDataFrame(ITEMS, SCHEMA)
    counted = items.mapInArrow(look, SCHEMA)
    links = E.derive_links(counted)
    first = links.filter("a % 2 = 0")
    known = E.extend(E.components(first), links.filter("a % 2 = 1"))
    assert {r["root"] for r in E.classes(items, links, known).collect()} == {1, 6, 7, 8, 9, 10}
    assert seen.value == len(ITEMS)


def test_depths_of_long_chains_take_few_rounds(spark, monkeypatch):
    """One parent each: rounds grow with the logarithm; cycles and what is below them are left out."""
    written = []
    real = graph.Table
    monkeypatch.setattr(graph, "Table", lambda *a: written.append(1) or real(*a))
    steps = [(i + 1, i) for i in range(40)] + [(100, 102), (101, 100), (102, 101), (103, 102), (201, 200), (202, 200)]
    got = dict(map(tuple, graph.depths(spark.createDataFrame(steps, "c long, p long"), "c", "p").collect()))
    assert got == {i: i for i in range(41)} | {200: 0, 201: 1, 202: 1}
    assert len(written) < 12
