import random

from pyspark.sql import functions as F

from millrace.operators import history as H

SCHEMA = "event_id string, kind string, mention_id long, node long, survivor long, target string, needs_review boolean, valid_at int, recorded_at int, extra int"


def brute(events, recorded, valid):
    """Replay one event after the other over a dictionary."""
    rows = [e for e in dict.fromkeys(e[:9] for e in events) if recorded is None or e[8] is None or e[8] <= recorded]
    low = lambda v: (v is not None, v if v is not None else 0)
    order = lambda e: (low(e[8]), e[0])
    by_id = {e[0]: e for e in rows}

    def stands(e):
        return not any(r[1] == "rollback" and r[5] == e[0] and order(r) > order(e) and stands(r) for r in rows)

    rows = [e for e in rows if stands(e)]
    reviewed = {e[5] for e in rows if e[1] == "review"}
    held = {e[0] for e in rows if (e[1] == "split" or e[1] == "merge" and e[6]) and e[0] not in reviewed}
    state, named = {}, {}
    for e in sorted(rows, key=lambda e: (low(e[7]), low(e[8]), e[0])):
        if e[0] in held or e[3] is None or valid is not None and e[7] is not None and e[7] > valid:
            continue
        if e[1] in ("assign", "split") and e[2] is not None:
            state[e[2]] = named[e[2]] = e[3]
        elif e[1] == "merge" and e[4] is not None:
            state = {m: e[4] if n == e[3] else n for m, n in state.items()}
    assert len(by_id) == len({e[0] for e in events if e[0] in by_id})
    return {(m, named[m], n) for m, n in state.items()}, held


def planted(seed, n=160):
    pick = random.Random(seed)
    maybe = lambda v: None if pick.random() < 0.04 else v
    out = []
    for i in range(n):
        kind = pick.choice(["assign", "assign", "assign", "merge", "merge", "split", "review", "rollback"])
        node, survivor, target = pick.randrange(12), pick.randrange(12), f"e{pick.randrange(n)}"
        out.append((f"e{i}", kind, maybe(pick.randrange(40)), maybe(node), maybe(survivor), target, pick.random() < 0.3, maybe(pick.randrange(50)), maybe(pick.randrange(50)), pick.randrange(2)))
    return out + out[:20]


def test_replay_equals_one_event_after_the_other(spark):
    for seed, recorded, valid in ((1, None, None), (2, 30, 25)):
        rows = planted(seed)
        events = spark.createDataFrame(rows, SCHEMA)
        at = lambda v: None if v is None else F.lit(v)
        want, held = brute(rows, recorded, valid)
        assert {tuple(r) for r in H.replay(events, at(recorded), at(valid)).collect()} == want
        assert {r.event_id for r in H.waiting(events, at(recorded)).collect()} == held


def test_no_events(spark):
    events = spark.createDataFrame([], SCHEMA)
    assert H.nodes(H.replay(events)).count() == 0


def test_one_node_over_many_parts(spark):
    """Almost all events name one node, and no parts are put together again."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(f"a{i:03}", "assign", i, 1, None, None, False, i, i, 0) for i in range(90)]
        rows += [(f"m{i:03}", "merge", None, 1, 2 + i, None, False, i, i, 0) for i in (40, 41, 80)] + [("n", "merge", None, 42, 7, None, False, 85, 85, 0)]
        got = H.replay(spark.createDataFrame(rows, SCHEMA))
        assert {tuple(r) for r in got.collect()} == brute(rows, None, None)[0]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
