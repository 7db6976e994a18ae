"""Batches in any order give what one batch of all events gives."""

import random

import pytest

from millrace.streaming.ingest import Ingest

SCHEMA = "key string, version int, requires array<string>, payload string"


def fixpoint(events):
    """State and waiting events, by plain rounds over all events."""
    events = {(k, v, tuple(r) if r is not None else None, p) for k, v, r, p in events if k is not None}
    applied, keys = set(), set()
    while True:
        more = {e for e in events - applied if all(n in keys for n in e[2] or () if n is not None)}
        if not more:
            break
        applied |= more
        keys |= {e[0] for e in more}
    state = {}
    for k, v, r, p in applied:
        # Of equal versions the larger row; null comes before everything.
        size = (v, r is not None, tuple((n is not None, n or "") for n in r or ()), p)
        state[k] = max(state.get(k, size), size)
    return {(k, size[0], size[3]) for k, size in state.items()}, {(e[0], e[1], e[3]) for e in events - applied}


def made(seed, n=70):
    rng = random.Random(seed)
    events = []
    for i in range(n):
        needs = [f"k{rng.randrange(28)}" for _ in range(rng.choice([0, 0, 1, 1, 2]))]
        events.append((f"k{rng.randrange(24)}", rng.randrange(6), rng.choice([needs, needs, None, [*needs, None]]), f"p{i % 5}"))
    return [*events, *[(f"c{i}", 1, [f"c{i + 1}"], "chain") for i in range(3)], ("c3", 1, [], "end"), ("a", 1, ["b"], "x"), ("b", 1, ["a"], "x"), (None, 1, [], "x")]


def read(table):
    state = {(r["key"], r["version"], r["payload"]) for r in table.state().collect()}
    return state, {(r["key"], r["version"], r["payload"]) for r in table.waiting().collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order(spark, tmp_path, seed):
    events = made(seed)
    order = list(events)
    random.Random(seed + 9).shuffle(order)
    batches = [order[:30], order[30:31], order[31:], order[10:40]]  # the last comes again
    table = Ingest(spark, str(tmp_path / "t"), buckets=5)
    for i, batch in enumerate(batches):
        table.merge(spark.createDataFrame(batch, SCHEMA), i)
    assert read(table) == fixpoint(events)
    once = Ingest(spark, str(tmp_path / "once"), buckets=3)
    once.merge(spark.createDataFrame(events, SCHEMA))
    assert read(once) == fixpoint(events)


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    table = Ingest(spark, str(tmp_path / "t"), buckets=16)
    table.merge(spark.createDataFrame([(f"k{i}", 1, None, "x") for i in range(200)], SCHEMA))
    before = table._manifest()
    table.merge(spark.createDataFrame([("k7", 2, None, "y"), ("late", 1, ["absent"], "z")], SCHEMA))
    after = table._manifest()
    assert len(before["state"]) == 16 and sum(before["state"][b] != after["state"][b] for b in before["state"]) == 1
    assert len(after["waiting"]) == 1 and after["number"] == 1
    assert table.state().filter("key = 'k7'").collect()[0]["payload"] == "y" and table.state().count() == 200
    table.merge(spark.createDataFrame([("absent", 1, None, "here")], SCHEMA))
    assert table.waiting().count() == 0 and table.state().count() == 202


def test_a_batch_that_failed_before_its_manifest(spark, tmp_path, monkeypatch):
    table = Ingest(spark, str(tmp_path / "t"), buckets=4)
    table.merge(spark.createDataFrame([("a", 1, None, "x")], SCHEMA))
    batch = spark.createDataFrame([("a", 2, None, "y"), ("b", 1, ["a"], "y")], SCHEMA)
    with monkeypatch.context() as m:
        m.setattr(table, "_publish", lambda manifest: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            table.merge(batch, 1)
    assert read(table)[0] == {("a", 1, "x")}
    table.merge(batch, 1)
    table.merge(batch, 1)
    assert read(table)[0] == {("a", 2, "y"), ("b", 1, "y")}


def test_nothing(spark, tmp_path):
    table = Ingest(spark, str(tmp_path / "t"))
    table.merge(spark.createDataFrame([], SCHEMA))
    assert table._manifest() is None
    with pytest.raises(ValueError):
        table.state()
    table.merge(spark.createDataFrame([("a", 1, None, "x")], SCHEMA))
    with pytest.raises(ValueError):
        Ingest(spark, str(tmp_path / "t"), buckets=7)


def test_as_a_stream(spark, tmp_path):
    """Files arrive one by one through Structured Streaming."""
    events = made(3, 40)
    for i in range(3):
        spark.createDataFrame(events[i::3], SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    table = Ingest(spark, str(tmp_path / "t"), buckets=4)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = stream.writeStream.foreachBatch(table.merge).option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert query.exception() is None
    assert read(table) == fixpoint(events)
