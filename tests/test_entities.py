import itertools

from pyspark.sql import functions as F

from millrace.operators import abbreviations as A
from millrace.operators import provenance as P

NAMES = ["World Health Organisation", "Bank of the North", "International Business Machines", "John Smith", "Jane  Smith", "Jean-Luc Petit", "Acme", "", None, "Émile Zola", "A B"]
SAID = ["WHO", "W.H.O.", "bn", "BOTN", "Int. Bus. Mach.", "J. Smith", "Jo. S.", "John Smith", "J. S.", "JS", "J-L. Petit", "A", "", None, "É. Z.", "é zola", "World Health", "a b", "Business Machines"]


def brute(said, name):
    words = lambda s: [w for w in (t.replace(".", "").replace(",", "") for t in (s or "").lower().replace("-", " ").split()) if w]
    m, a = words(said), words(name)
    if len(a) < 2 or not m or len(m) == 1 and len(m[0]) < 2:
        return None
    if len(m) == 1:
        return "acronym" if m[0] in ("".join(w[0] for w in a), "".join(w[0] for w in a if w not in A.SMALL)) else None
    return "abbreviation" if len(m) == len(a) and m != a and all(y.startswith(x) for x, y in zip(m, a)) else None


def test_abbreviations(spark):
    mentions = [(i, t, s) for i, (s, t) in enumerate(itertools.product(SAID, ["org", None]))]
    nodes = [(i, "org", n, "x") for i, n in enumerate(NAMES)] + [(90, "place", "World Health Organisation", "y")]
    got = A.matches(spark.createDataFrame(mentions * 2, "mention_id int, type string, surface string"), spark.createDataFrame(nodes, "node_id int, type string, name string, surface string"))
    want = {(m, n, brute(s, name)) for m, t, s in mentions if t for n, u, name, _ in nodes if u == t and brute(s, name)}
    assert {tuple(r) for r in got.collect()} == want
    assert {w[2] for w in want} == {"acronym", "abbreviation"} and got.count() == len(want)


def test_parts_follow_the_results(spark, monkeypatch):
    """One spelling may mean many names: results of a task are bounded, also where mentions are few."""
    monkeypatch.setattr(A, "PART_ROWS", 100)
    mentions = spark.createDataFrame([(i, "org", "JS") for i in range(60)], "mention_id int, type string, surface string")
    names = spark.createDataFrame([(i, "org", "John Smith" if i % 2 else "Jane Smith") for i in range(50)], "node_id int, type string, name string")
    got = A.matches(mentions, names)
    assert got.count() == 3000 and got.rdd.getNumPartitions() >= 30
    assert max(r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()) < 400


def test_provenance_paths(spark):
    link = lambda *rows: spark.createDataFrame(list(rows), "a string, b string")
    facts = spark.createDataFrame([("f1",), ("f2",), ("f2",), (None,)], "fact string")
    graph = [link(("f1", "e1"), ("f1", "e2"), ("f1", "e1")), link(("e1", "r1"), ("e2", None)), link(("r1", "n1"), ("r1", "n2")), link(("n1", "c1"), ("n2", "c1")), link(("c1", "d1"))]
    evidence = [link(("f1", "v1"), ("f2", "v2")), link(("v1", "d1"))]
    got = P.fact_provenance(facts, graph, evidence).select("fact_id", "branch", P.shown(F.col("path")), "missing")
    assert {tuple(r) for r in got.collect()} == {
        ("f1", "graph", "fact:f1 > edge:e1 > relation:r1 > entity:n1 > claim:c1 > article:d1", None),
        ("f1", "graph", "fact:f1 > edge:e1 > relation:r1 > entity:n2 > claim:c1 > article:d1", None),
        ("f1", "graph", "fact:f1 > edge:e2", "relation"),
        ("f2", "graph", "fact:f2", "edge"),
        ("f1", "evidence", "fact:f1 > evidence:v1 > article:d1", None),
        ("f2", "evidence", "fact:f2 > evidence:v2", "article"),
    }
    assert got.count() == 6
    assert P.fact_provenance(facts.limit(0), graph, evidence).count() == 0


def test_walks_move_ids_only(spark):
    """Kinds and missing links follow from the place in the path: no join carries them."""
    from millrace.operators import provenance

    links = spark.createDataFrame([("1", "a"), ("a", "x")], "f string, t string")
    out = provenance.walk(spark.createDataFrame([("1",), ("2",)], "id string"), [("edge", links), ("claim", links), ("article", links)])
    assert out._jdf.queryExecution().analyzed().toString().count(" AS missing#") == 1
    assert {(r.start, tuple(map(tuple, r.path)), r.missing) for r in out.collect()} == {("1", (("fact", "1"), ("edge", "a"), ("claim", "x")), "article"), ("2", (("fact", "2"),), "edge")}
