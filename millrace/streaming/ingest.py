"""Streaming ingestion: a keyed table that takes batches in any order and rewrites only what they touch.

Events are ``key, version`` with other columns, and may name keys that must be in the table before they
count (``requires``, an array).  ``Ingest.merge`` is a ``foreachBatch`` function.

* The table is dealt into buckets by the key's hash.  A batch reads and rewrites the buckets that it has
  keys of; the others keep their files.  A manifest lists each bucket's folder, and one rename publishes
  the manifest of a batch, so a reader sees a batch as a whole or not at all.
* An event whose required keys are not all there waits under one that is missing, in buckets by that
  key's hash.  When a key comes in, only its bucket is looked at, and what waited for it is judged again:
  it is applied, or waits under the next missing key.  A chain of requirements is followed within the batch.
* The latest version of a key wins, of equal versions the larger row.  So the table depends on the set of all
  events and not on their order: late, repeated and reordered batches, and batches repeated after a
  failure, give the same table as one batch of everything.

Defined cases: null ``requires`` and null elements ask for nothing; events without a key are dropped; a deletion is an event like
others (its key is there); events that require each other wait for ever; an empty batch changes nothing;
equal events that wait are kept once.  One stream writes a table at a time.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import Table, delete

#: Manifests whose files stay, so that a reader of the last but one is not cut off.
KEPT = 2


class Ingest:
    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, key: str = "key", version: str = "version", requires: str = "requires"):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.key, self.version, self.requires = key, version, requires
        known = self._manifest()
        if known and known["buckets"] != buckets:
            raise ValueError(f"the table has {known['buckets']} buckets")

    # ---- manifests ----

    def _fs(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), self.spark._jvm.org.apache.hadoop.fs.Path

    def _numbers(self) -> list[int]:
        fs, path = self._fs()
        found = fs.globStatus(path(f"{self.path}/_commits/*.json")) or []
        return sorted(int(f.getPath().getName().split(".")[0]) for f in found)

    def _manifest(self, number: int | None = None) -> dict | None:
        """The newest manifest, or that of a number: number, buckets, schemas, and the folder of each bucket of both parts."""
        numbers = self._numbers() if number is None else [number]
        if not numbers:
            return None
        fs, path = self._fs()
        stream = fs.open(path(f"{self.path}/_commits/{numbers[-1]:012d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, manifest: dict) -> None:
        fs, path = self._fs()
        fs.mkdirs(path(f"{self.path}/_commits"))
        draft, final = path(f"{self.path}/_draft-{uuid.uuid4().hex}"), path(f"{self.path}/_commits/{manifest['number']:012d}.json")
        stream = fs.create(draft, True)
        try:
            stream.write(bytearray(json.dumps(manifest).encode()))
        finally:
            stream.close()
        if fs.exists(final) or not fs.rename(draft, final):
            raise RuntimeError(f"another writer published {final}")
        self._forget()

    def _forget(self) -> None:
        """Delete what none of the newest manifests lists."""
        numbers = self._numbers()
        folders = lambda n: {f for part in ("state", "waiting") for f in self._manifest(n)[part].values()}
        kept = set().union(*(folders(n) for n in numbers[-KEPT:]))
        for n in numbers[:-KEPT]:
            for folder in folders(n) - kept:
                delete(self.spark, f"{self.path}/{folder}")
            delete(self.spark, f"{self.path}/_commits/{n:012d}.json")

    # ---- reading ----

    def _bucket(self, column: str):
        return F.pmod(F.xxhash64(F.col(column)), F.lit(self.buckets)).cast("int")

    def _read(self, manifest: dict | None, part: str, buckets: list[int] | None, like: DataFrame) -> DataFrame:
        folders = (manifest or {part: {}})[part]
        paths = [f"{self.path}/{f}" for b, f in sorted(folders.items()) if buckets is None or int(b) in buckets]
        if not paths:
            return self.spark.createDataFrame([], like.schema)
        return self.spark.read.schema(like.schema).parquet(*paths)

    def state(self) -> DataFrame:
        """The newest version of every key whose requirements are met."""
        return self._whole("state")

    def waiting(self) -> DataFrame:
        """Events that wait, with the missing key each waits under (``waits_for``)."""
        return self._whole("waiting")

    def _whole(self, part: str) -> DataFrame:
        manifest = self._manifest()
        if manifest is None:
            raise ValueError("nothing was ingested yet")
        from pyspark.sql.types import StructType

        return self._read(manifest, part, None, self.spark.createDataFrame([], StructType.fromJson(manifest["schemas"][part])))

    def _touched(self, rows: DataFrame, column: str) -> list[int]:
        """Buckets of a column's values: at most as many as there are buckets."""
        return [r["b"] for r in rows.select(self._bucket(column).alias("b")).distinct().collect()]

    # ---- merging ----

    def merge(self, batch: DataFrame, batch_id: int = 0) -> None:
        """Apply a batch; the same batch again changes nothing."""
        key = self.key
        manifest = self._manifest()
        shape = batch.limit(0)
        held_shape = shape.withColumn("waits_for", F.lit(None).cast(batch.schema[key].dataType))
        done: list[Table] = []

        def keep(rows: DataFrame, name: str) -> DataFrame:
            done.append(Table(rows, name))
            return done[-1].df

        open_ = batch.filter(F.col(key).isNotNull()).distinct()
        applied, waits = shape, held_shape
        while True:
            numbered = keep(open_.withColumn("_id", F.monotonically_increasing_id()), "open")
            if numbered.isEmpty():
                break
            need = numbered.select("_id", F.explode(F.array_distinct(self.requires)).alias("need")).filter("need IS NOT NULL")
            there = self._read(manifest, "state", self._touched(need, "need"), shape).select(F.col(key).alias("need"))
            there = there.unionByName(applied.select(F.col(key).alias("need"))).distinct()
            missing = need.join(there, "need", "left_anti").groupBy("_id").agg(F.min("need").alias("waits_for"))
            judged = keep(numbered.join(missing, "_id", "left").drop("_id"), "judged")
            ready = judged.filter("waits_for IS NULL").drop("waits_for")
            # A key that came in an earlier round has released its events then.
            came = ready.select(F.col(key).alias("waits_for")).distinct().join(applied.select(F.col(key).alias("waits_for")), "waits_for", "left_anti")
            applied, waits = applied.unionByName(ready), waits.unionByName(judged.filter("waits_for IS NOT NULL"))
            # What waits under a new key, here or in the table, is judged again.
            before = self._read(manifest, "waiting", self._touched(came, "waits_for"), held_shape)
            open_ = waits.unionByName(before).join(came, "waits_for", "left_semi").drop("waits_for").distinct()
        # Events under a key that came were judged again and stand further back.
        held = waits.join(applied.select(F.col(key).alias("waits_for")).distinct(), "waits_for", "left_anti").distinct()
        self._commit(manifest, applied, held, shape, held_shape)
        for table in done:
            table.drop()

    def _commit(self, manifest: dict | None, applied: DataFrame, held: DataFrame, shape: DataFrame, held_shape: DataFrame) -> None:
        key, rest = self.key, [c for c in shape.columns if c != self.key]
        came = applied.select(key).distinct()
        states = self._touched(applied, key)
        waits = sorted({*self._touched(came, key), *self._touched(held, "waits_for")})
        if not states and not waits:
            return
        rows = self._read(manifest, "state", states, shape).unionByName(applied)
        newest = rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(self.version, *[c for c in rest if c != self.version])).alias("r")).select(key, "r.*")
        waiting = self._read(manifest, "waiting", waits, held_shape).join(came.select(F.col(key).alias("waits_for")), "waits_for", "left_anti").unionByName(held).distinct()
        old = manifest or {"number": -1, "state": {}, "waiting": {}}
        after = {"number": old["number"] + 1, "buckets": self.buckets, "schemas": {"state": shape.schema.jsonValue(), "waiting": held_shape.schema.jsonValue()}}
        for part, frame, column, touched in (("state", newest, key, states), ("waiting", waiting, "waits_for", waits)):
            folder = f"{part}/{uuid.uuid4().hex}"
            if touched:
                frame.select(*(shape if part == "state" else held_shape).columns).withColumn("_bucket", self._bucket(column)).repartition("_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/{folder}")
            fs, path = self._fs()
            written = {int(s.getPath().getName().split("=")[1]) for s in (fs.globStatus(path(f"{self.path}/{folder}/_bucket=*")) or [])}
            kept = {b: f for b, f in old[part].items() if int(b) not in touched}
            after[part] = kept | {str(b): f"{folder}/_bucket={b}" for b in written}
        self._publish(after)
