"""The registered query of streaming ingestion, with its SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..storage import shared_dir
from ..streaming.ingest import Ingest
from .catalogue import _q, _t


@_q(
    """WITH s AS (SELECT DISTINCT 'sal_' || sale_id AS key, coalesce(epoch_us(arrived_at), 0) AS version, status AS payload, 'cli_' || client_id AS need FROM sales WHERE sale_id IS NOT NULL),
    c AS (SELECT 'cli_' || client_id AS key, max(coalesce(seq, 0)) AS version FROM client_changes WHERE client_id IS NOT NULL GROUP BY 1)
    SELECT key, version, 'applied' AS status, NULL::VARCHAR AS waits_for FROM c
    UNION ALL SELECT key, max(version), 'applied', NULL FROM s WHERE need IS NULL OR need IN (SELECT key FROM c) GROUP BY key
    UNION ALL SELECT key, version, 'waiting', need FROM s WHERE need NOT IN (SELECT key FROM c)"""
)
def ingest_state(spark, sf_dir):
    """Sales that count once their client is known, streamed before the clients' changes: what is applied and what still waits."""
    table = Ingest(spark, f"{shared_dir(spark)}/millrace-ingest-{uuid.uuid4().hex}", buckets=16)
    sales, changes = (spark.readStream.schema(_t(spark, sf_dir, n).schema).parquet(f"{sf_dir}/{n}.parquet*") for n in ("sales", "client_changes"))
    id_of = lambda prefix, c: F.concat(F.lit(prefix), F.col(c).cast("string"))
    arrived = F.coalesce(F.unix_micros(F.col("arrived_at").cast("timestamp")), F.lit(0).cast("bigint"))
    streams = [
        sales.select(id_of("sal_", "sale_id").alias("key"), arrived.alias("version"), F.array(id_of("cli_", "client_id")).alias("requires"), F.col("status").alias("payload")),
        changes.select(id_of("cli_", "client_id").alias("key"), F.coalesce("seq", F.lit(0).cast("bigint")).alias("version"), F.lit(None).cast("array<string>").alias("requires"), F.col("op").alias("payload")),
    ]
    for i, stream in enumerate(streams):
        query = stream.writeStream.foreachBatch(table.merge).option("checkpointLocation", f"{table.path}-checkpoint-{i}").trigger(availableNow=True).start()
        query.awaitTermination()
    none = F.lit(None).cast("string")
    applied = table.state().select("key", "version", F.lit("applied").alias("status"), none.alias("waits_for"))
    return applied.unionByName(table.waiting().select("key", "version", F.lit("waiting").alias("status"), "waits_for"))
