"""Streams give what the batch operators give, whatever the cut into microbatches."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from starloom.contracts import schema_of
from starloom.operators import cdc
from starloom.operators.cdc import latest_event
from starloom.session import fresh_dir
from starloom.sources.tables import KeyedTable
from starloom.streaming import jobs

START = datetime(2024, 1, 1)
SCHEMA = schema_of("k string, cdc_operation string, ingested_at timestamp_ntz, seq bigint")


def events(n=200, seed=1):
    rng = random.Random(seed)
    return [(f"k{rng.randrange(8)}", rng.choice("IUD"), START + timedelta(minutes=3 * i), i) for i in range(n)]


def landed(spark, rows, files=5):
    """The rows as several files, in the given order."""
    root = fresh_dir(spark, "log")
    step = len(rows) // files
    for i in range(files):
        part = rows[i * step:(i + 1) * step if i < files - 1 else len(rows)]
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/log")
    return root


def test_out_of_order_arrival_keeps_the_newest(spark):
    rows = events()
    shuffled = rows[:]
    random.Random(3).shuffle(shuffled)
    root = landed(spark, shuffled)
    want = sorted(map(tuple, latest_event(spark.createDataFrame(rows, SCHEMA), ["k"]).select(*SCHEMA.names).collect()))
    ordered = KeyedTable(spark, fresh_dir(spark, "t"), ["k"], order=["ingested_at", "seq"])
    stream = jobs.stream_bronze(spark, root, "log", 1, SCHEMA)
    jobs.start_batches(stream, jobs.upsert_latest(ordered), ordered.path + "-cp", None).awaitTermination()
    assert ordered.last_batch() == 4
    assert sorted(map(tuple, ordered.read().select(*SCHEMA.names).collect())) == want
    stateful = KeyedTable(spark, fresh_dir(spark, "t"), ["k"])
    newest = jobs.ordered_latest(jobs.stream_bronze(spark, root, "log", 1, SCHEMA), ["k"])
    jobs.start_batches(newest, jobs.upsert_rows(stateful), stateful.path + "-cp", None, "update").awaitTermination()
    assert sorted(map(tuple, stateful.read().select(*SCHEMA.names).collect())) == want


def test_restart_continues_after_the_checkpoint(spark):
    rows = events(100)
    root, out = landed(spark, rows[:50], 2), fresh_dir(spark, "out")

    def run():
        stream = jobs.stream_bronze(spark, root, "log", 1, SCHEMA)
        jobs.start_files(stream, out, out + "-cp", None).awaitTermination()
        return spark.read.schema(SCHEMA).parquet(out)
    assert run().count() == 50
    assert run().count() == 50
    spark.createDataFrame(rows[50:], SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/log")
    again = run()
    assert again.count() == 100 and again.select("seq").distinct().count() == 100


def test_rows_beyond_the_buffer_do_not_reopen_a_window(spark):
    on_time = [("a", "I", START + timedelta(minutes=m), m) for m in (1, 5, 20, 70)]
    late = [("a", "U", START + timedelta(minutes=2), 100), ("a", "D", START + timedelta(minutes=120), 101)]
    root, out = landed(spark, on_time, 1), fresh_dir(spark, "out")
    counts = jobs.op_counts(jobs.with_late_buffer(jobs.stream_bronze(spark, root, "log", 1, SCHEMA)))
    jobs.start_files(counts, out, out + "-cp", None).awaitTermination()
    spark.createDataFrame(late, SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/log")
    counts = jobs.op_counts(jobs.with_late_buffer(jobs.stream_bronze(spark, root, "log", 1, SCHEMA)))
    jobs.start_files(counts, out, out + "-cp", None).awaitTermination()
    got = {r.window_start: (r.eventos_totales, r.inserts, r.updates) for r in spark.read.parquet(out).collect()}
    assert got[START] == (2, 2, 0)
    assert got[START + timedelta(minutes=60)] == (1, 1, 0)


def test_redelivered_events_count_once(spark):
    rows = events(60)
    root = landed(spark, rows + rows[-20:], 4)
    out = fresh_dir(spark, "out")
    once = jobs.replay_dedup(jobs.stream_bronze(spark, root, "log", None, SCHEMA), ["seq"], minutes=600)
    jobs.start_files(once, out, out + "-cp", None).awaitTermination()
    assert sorted(r.seq for r in spark.read.parquet(out).select("seq").collect()) == list(range(60))


def test_late_and_redelivered_events_are_all_given_out_once(spark):
    """Five events in three files, one of them hours late, all delivered twice: five rows, the late one apart."""
    at = [(0, START), (1, START + timedelta(minutes=1)), (2, START + timedelta(hours=5)), (3, START + timedelta(hours=5)), (4, START + timedelta(minutes=2))]
    rows = [("a", "I", t, i) for i, t in at]
    root, out = fresh_dir(spark, "src"), fresh_dir(spark, "once")
    for part in (rows[:2], rows[2:4], rows[4:], rows):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/log")
        stream = jobs.stream_bronze(spark, root, "log", None, SCHEMA)
        jobs.start_batches(stream, jobs.replay_ledger(out, ["seq"]), out + "-cp", None).awaitTermination()
    assert sorted(r.seq for r in spark.read.parquet(f"{out}/new").collect()) == [0, 1, 2, 3]
    assert [r.seq for r in spark.read.parquet(f"{out}/late").collect()] == [4]


def test_net_changes_compose_over_microbatches(spark):
    """One row per key, whatever microbatches its events come in: the same as over the whole log."""
    ops = {"iu": "IU", "id": "ID", "di": "DI", "idu": "IDU", "uu": "UU", "ud": "UD", "idi": "IDI", "d": "D"}
    rows = [(k, op, START + timedelta(minutes=i), i) for k, word in ops.items() for i, op in enumerate(word)]
    whole = cdc.net_changes(spark.createDataFrame(rows, SCHEMA), ["k"], [])
    for order in (rows, rows[::-1]):  # and in whatever order
        table, root = KeyedTable(spark, fresh_dir(spark, "net"), ["k"]), fresh_dir(spark, "src")
        for i in range(3):
            spark.createDataFrame([r for r in order if r[3] == (i if order is rows else 2 - i)], SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/log")
            stream = jobs.stream_bronze(spark, root, "log", 1, SCHEMA)
            jobs.start_batches(stream, jobs.net_changes_to(table), table.path + "-cp", None).awaitTermination()
        got = cdc.net_rows(table.read(), ["k"])
        assert sorted(map(tuple, got.select(*whole.columns).collect())) == sorted(map(tuple, whole.collect()))


def test_enrich_gives_unknown_for_a_missing_master(spark):
    root, out = landed(spark, events(20), 1), fresh_dir(spark, "out")
    dim = spark.createDataFrame([("k1", 11), ("k2", 22)], "id string, dim_key bigint")
    stream = jobs.stream_bronze(spark, root, "log", None, SCHEMA)
    enriched = jobs.enrich(stream.withColumn("id", F.col("k")), [(dim, "id", "dim_key")])
    jobs.start_files(enriched, out, out + "-cp", None).awaitTermination()
    for r in spark.read.parquet(out).collect():
        assert r.dim_key == {"k1": 11, "k2": 22}.get(r.k, -1)


def test_enrich_sees_a_dimension_that_changes_between_microbatches(spark):
    root, out = landed(spark, events(20), 4), fresh_dir(spark, "out")
    table, calls = KeyedTable(spark, fresh_dir(spark, "dim"), ["id"]), []

    def read_dims():
        calls.append(len(calls))
        table.upsert(spark.createDataFrame([(f"k{i}", 100 + i) for i in range(8)][: 4 * len(calls)], "id string, dim_key bigint"), len(calls))
        return [(table.read(), "id", "dim_key")]

    stream = jobs.stream_bronze(spark, root, "log", 1, SCHEMA).withColumn("id", F.col("k"))
    jobs.start_batches(stream, jobs.enrich_to(out, read_dims), out + "-cp", None).awaitTermination()
    rows = spark.read.option("recursiveFileLookup", "true").parquet(out).collect()
    assert len(calls) == 4 and len(rows) == 20
    assert any(r.dim_key >= 104 for r in rows)  # members published after the first microbatch
    assert all(r.dim_key in (-1, 100 + int(r.k[1:])) for r in rows)
