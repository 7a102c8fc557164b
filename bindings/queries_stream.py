"""Streams over the change log, run to the end of what there is and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.queries_ingest import LOG, LOG_SCHEMA, NET_SQL, landed_log
from bindings.registry import query
from starloom.functions.dates import window_start
from starloom.operators.cdc import net_rows
from starloom.session import fresh_dir
from starloom.sources.bronze import entity_path
from starloom.sources.tables import KeyedTable
from starloom.streaming import jobs

# Closed windows: those that end no later than the last event less the late buffer.
CLOSED = "w + INTERVAL 15 MINUTE <= (SELECT max(ingested_at) FROM b_log) - INTERVAL 15 MINUTE"
WINDOW = "time_bucket(INTERVAL 15 MINUTE, ingested_at) AS w"


def stream(b, max_files=None, root=None):
    return jobs.stream_bronze(b.spark, root or landed_log(b), "log", max_files, LOG_SCHEMA)


def finish(query_):
    query_.awaitTermination()


def to_files(b, frame):
    """Run a stream into Parquet and read the result."""
    out = fresh_dir(b.spark, "stream")
    finish(jobs.start_files(frame, out, out + "-checkpoint", every=None))
    return b.spark.read.schema(frame.schema).parquet(out)


@query("stream_microbatch_15m", "several events:i", "SELECT TRUE AS several, count(*) AS events FROM b_log")
def _(b):
    out = fresh_dir(b.spark, "batches")

    def handle(rows, batch_id):
        rows.agg(F.count("*").alias("events")).write.mode("overwrite").parquet(f"{out}/batch-{batch_id}")
    finish(jobs.start_batches(stream(b, max_files=10), handle, out + "-checkpoint", every=None))
    counts = b.spark.read.option("recursiveFileLookup", "true").parquet(out)
    return counts.agg((F.count("*") > 1).alias("several"), F.sum("events").alias("events"))


@query("stream_tumbling", "window_start:t event_type rows:i", f"""SELECT w AS window_start, event_type, count(*) AS rows
FROM (SELECT *, {WINDOW} FROM b_log) WHERE {CLOSED} GROUP BY ALL""")
def _(b):
    return to_files(b, jobs.tumbling(jobs.with_late_buffer(stream(b)), by=["event_type"]))


@query("stream_late_buffer", "window_start:t window_end:t rows:i", f"""SELECT w AS window_start,
  w + INTERVAL 15 MINUTE AS window_end, count(*) AS rows FROM (SELECT *, {WINDOW} FROM b_log) WHERE {CLOSED} GROUP BY ALL""")
def _(b):
    return to_files(b, jobs.tumbling(jobs.with_late_buffer(stream(b))))


@query("stream_net_changes", "window_epoch " + LOG, f"""SELECT *, slot AS window_epoch
FROM ({NET_SQL.format(slot='(epoch_us(ingested_at) // 900000000 * 900)')})""")
def _(b):
    # Ten files a microbatch: windows and keys go on from one to the next.
    table = KeyedTable(b.spark, fresh_dir(b.spark, "net"), ["window_epoch", "user_id"])
    rows = stream(b, max_files=10).withColumn("window_epoch", window_start(F.col("ingested_at")))
    finish(jobs.start_batches(rows, jobs.net_changes_to(table), table.path + "-checkpoint", None))
    return net_rows(table.read(), table.keys)


@query("stream_upsert_silver", LOG, "SELECT * FROM x_log")
def _(b):
    table = KeyedTable(b.spark, fresh_dir(b.spark, "table"), ["user_id"], order=["ingested_at", "seq"])
    finish(jobs.start_batches(stream(b, max_files=10), jobs.upsert_latest(table), table.path + "-checkpoint", None))
    return table.read()


@query("stream_ordered_latest", LOG, "SELECT * FROM x_log")
def _(b):
    table = KeyedTable(b.spark, fresh_dir(b.spark, "table"), ["user_id"])
    newest = jobs.ordered_latest(stream(b, max_files=10), ["user_id"])
    finish(jobs.start_batches(newest, jobs.upsert_rows(table), table.path + "-checkpoint", None, mode="update"))
    return table.read()


@query("stream_replay_dedup", LOG, "SELECT * FROM b_log")
def _(b):
    root = landed_log(b)
    b.log("log").write.mode("overwrite").parquet(entity_path(root, "log") + "/replayed")
    out = fresh_dir(b.spark, "once")
    finish(jobs.start_batches(stream(b, max_files=10, root=root), jobs.replay_ledger(out, ["seq"]), out + "-checkpoint", every=None))
    return b.spark.read.schema(LOG_SCHEMA).parquet(f"{out}/new").unionByName(b.spark.read.schema(LOG_SCHEMA).parquet(f"{out}/late")).select(*LOG_SCHEMA.names)


@query("stream_fact_enrich", "user_id seq event_type cliente_key", """SELECT l.user_id, l.seq, l.event_type,
  coalesce(c.cliente_key, -1) AS cliente_key FROM b_log l LEFT JOIN (SELECT * FROM d_cliente WHERE es_version_vigente) c
  ON c.cliente_id = 'CUST-' || l.user_id""")
def _(b):
    current = b.gold["cliente"].filter("es_version_vigente").select("cliente_id", "cliente_key")
    rows = stream(b, max_files=10).withColumn("cliente_id", F.concat(F.lit("CUST-"), F.col("user_id").cast("string")))
    out = fresh_dir(b.spark, "enriched")
    handle = jobs.enrich_to(out, lambda: [(current, "cliente_id", "cliente_key")])
    finish(jobs.start_batches(rows, handle, out + "-checkpoint", every=None))
    return b.spark.read.option("recursiveFileLookup", "true").parquet(out)


@query("stream_op_counts", "window_start:t eventos_totales:i inserts:i updates:i deletes:i",
       f"""SELECT w AS window_start, count(*) AS eventos_totales, count(*) FILTER (cdc_operation = 'I') AS inserts,
  count(*) FILTER (cdc_operation = 'U') AS updates, count(*) FILTER (cdc_operation = 'D') AS deletes
FROM (SELECT *, {WINDOW} FROM b_log) WHERE {CLOSED} GROUP BY ALL""")
def _(b):
    return to_files(b, jobs.op_counts(jobs.with_late_buffer(stream(b))))


@query("stream_to_bronze", "date:d events:i", "SELECT CAST(ingested_at AS DATE) AS date, count(*) AS events FROM b_log GROUP BY 1")
def _(b):
    out = fresh_dir(b.spark, "bronze")
    rows = stream(b, max_files=10).withColumn("date", F.to_date("ingested_at"))
    finish(jobs.start_files(rows, out, out + "-checkpoint", every=None, partition_by=["date"]))
    return b.spark.read.parquet(out).groupBy("date").agg(F.count("*").alias("events"))
