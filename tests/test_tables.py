from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.contracts import CONTROL_SCHEMA, schema_of
from starloom.functions.keys import attribute_hash, surrogate_key
from starloom.operators import control
from starloom.session import fresh_dir
from starloom.sources import bronze
from starloom.sources.tables import KeyedTable

NOW = datetime(2024, 5, 1)


@pytest.fixture
def table(spark):
    return KeyedTable(spark, fresh_dir(spark, "table"), ["k"])


def batch(spark, *rows, schema="k int, v string"):
    return spark.createDataFrame(list(rows), schema)


def content(table, **kw):
    return {tuple(r) for r in table.read(**kw).collect()}


def test_upserts_removals_and_compaction(spark, table):
    table.upsert(batch(spark, (1, "a"), (2, "b"), (3, "c")), 1)
    table.upsert(batch(spark, (2, "B")), 2, removed=batch(spark, (2,), (3,), schema="k int"))
    want = {(1, "a"), (2, "B")}
    assert content(table) == want
    assert content(table, before=2) == {(1, "a"), (2, "b"), (3, "c")}
    table.compact()
    assert content(table) == want
    table.upsert(batch(spark, (3, "again"), (1, "z")), 3)
    assert content(table) == {(1, "z"), (2, "B"), (3, "again")}
    assert {tuple(r) for r in table.read_batch(3).collect()} == {(3, "again"), (1, "z")}


def test_replays_change_nothing(spark, table):
    for _ in range(2):
        table.upsert(batch(spark, (1, "a")), 1)
        table.upsert(batch(spark, (1, "b"), (2, "c")), 2)
    want = {(1, "b"), (2, "c")}
    assert content(table) == want
    table.compact()
    table.upsert(batch(spark, (1, "a")), 1)  # already folded
    assert content(table) == want


def test_unfinished_folder_does_not_count(spark, table):
    table.upsert(batch(spark, (1, "a")), 1)
    table.upsert(batch(spark, (1, "lost"), (9, "lost")), 2)
    (Path(table.path) / "batch-2" / "_SUCCESS").unlink()
    assert content(table) == {(1, "a")}
    assert table.last_batch() == 1


def test_new_columns_are_null_in_old_rows(spark, table):
    table.upsert(batch(spark, (1, "a"), (2, "b")), 1)
    table.compact()
    table.upsert(batch(spark, (2, "B", 5), schema="k int, v string, extra int"), 2)
    assert content(table) == {(1, "a", None), (2, "B", 5)}


def test_order_columns_win_over_batch_order(spark):
    schema = "k int, v string, seq int"
    table = KeyedTable(spark, fresh_dir(spark, "table"), ["k"], order=["seq"])
    table.upsert(batch(spark, (1, "new", 9), (2, "old", 1), schema=schema), 1)
    table.compact()
    table.upsert(batch(spark, (1, "late", 3), (2, "new", 2), schema=schema), 2)
    assert content(table) == {(1, "new", 9), (2, "new", 2)}


LOG = schema_of("k string, cdc_operation string, ingested_at timestamp_ntz, seq bigint")


def log_rows(spark, n, start=0):
    return spark.createDataFrame([(f"k{i}", "I", NOW + timedelta(hours=7 * i), i) for i in range(start, start + n)], LOG)


def test_landing_twice_with_a_batch_id_lands_once(spark):
    root = fresh_dir(spark, "bronze")
    for _ in range(2):
        bronze.land_changes(log_rows(spark, 10), root, "log", "b1")
    bronze.land_changes(log_rows(spark, 5, 10), root, "log", "b2")
    assert bronze.read_bronze(spark, root, "log", schema=LOG).count() == 15
    since = NOW + timedelta(hours=70)
    assert sorted(r.seq for r in bronze.read_bronze(spark, root, "log", since, LOG).collect()) == [11, 12, 13, 14]


def test_dated_log_prunes_folders(spark):
    root = fresh_dir(spark, "bronze")
    bronze.land_changes(log_rows(spark, 20), root, "log")
    df = bronze.read_bronze_dates(spark, root, "log", NOW + timedelta(days=3), LOG)
    assert sorted(r.seq for r in df.collect()) == list(range(11, 20))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "PushedFilters: [IsNotNull(ingested_at)" in plan


def test_extract_ranges_join_up(spark):
    log = log_rows(spark, 10)
    first, high = bronze.extract_range(log.filter("seq < 6"), None)
    second, top = bronze.extract_range(log, high)
    none, end = bronze.extract_range(log, top)
    assert (first.count(), high, second.count(), top, none.count(), end) == (6, 5, 4, 9, 0, None)


def test_sweep_runs_active_entities_only_and_commit_keeps_the_rest(spark):
    rows = [("a", "a", None, None, None, True, NOW), ("b", "b", 3, None, None, False, NOW), ("c", "c", 5, None, None, True, NOW)]
    table = spark.createDataFrame(rows, CONTROL_SCHEMA)
    seen = []

    def extract(entity, last):
        seen.append((entity, last))
        return (4, 9) if entity == "a" else (0, None)
    done = bronze.sweep(table, extract)
    assert sorted(seen, key=str) == [("a", None), ("c", 5)] and done["a"] == (4, 9)
    finished = spark.createDataFrame([("a", 4, 9)], "entity_name string, rows_copied bigint, new_seq bigint")
    after = {r.entity_name: r.last_seq for r in control.commit_batch(table, finished, NOW).collect()}
    assert after == {"a": 9, "b": 3, "c": 5}


def test_unparsable_values_become_null(spark):
    raw = spark.createDataFrame([("7", "x", 1.5)], "a string, b string, extra double")
    row = bronze.conform_schema(raw, schema_of("a int, b int, c date")).first()
    assert tuple(row) == (7, None, None)


def test_drift_is_rescued_and_logged(spark):
    raw = spark.createDataFrame([("1", "7", "x", None), ("2", "many", None, "n"), ("3", None, None, None)], "id string, b string, new string, c string")
    contract = schema_of("id string, b int, c date, d int")
    rows = bronze.conform_schema(raw, contract, "rescued")
    assert [tuple(r) for r in rows.collect()] == [("1", 7, None, None, {"new": "x"}), ("2", None, None, None, {"b": "many", "c": "n"}), ("3", None, None, None, None)]
    log = {(r.row_primary_key, r.column_name, r.issue_type, r.corrupted_value) for r in bronze.rescued_issues(rows, contract, "t", "id", "rescued").collect()}
    assert log == {("1", "new", "unknown column", "x"), ("2", "b", "unparsable", "many"), ("2", "c", "unparsable", "n")}


def test_types_widen_and_no_column_goes(spark):
    ddl = T.StructType.fromDDL
    stored, seen = ddl("a tinyint, b int, c float, d date, e decimal(10,2), f int, g int"), ddl("a int, b double, c double, d timestamp_ntz, e bigint, f string, h int")
    assert bronze.widen(stored, seen) == ddl("a int, b double, c double, d timestamp_ntz, e decimal(21,2), f string, g int, h int")
    assert bronze.widen(seen, stored).fieldNames() == ["a", "b", "c", "d", "e", "f", "h", "g"]
    assert all(bronze.wider(x, y) == bronze.wider(y, x) for x in (f.dataType for f in stored) for y in (f.dataType for f in seen))


def test_landing_with_and_without_a_batch_id_is_one_layout(spark):
    root = fresh_dir(spark, "bronze")
    bronze.land_changes(log_rows(spark, 10), root, "log", "b1")
    for _ in range(2):
        bronze.land_changes(log_rows(spark, 5, 10), root, "log")
    assert bronze.read_bronze_dates(spark, root, "log", datetime(1900, 1, 2), LOG).count() == 20


def test_watermark_leaves_the_buffer(spark):
    marks = control.update_watermark(control.empty_watermarks(spark), "silver", "t", log_rows(spark, 3), "r", NOW, "seq")
    assert control.get_watermark(marks, "silver", "t") == NOW + timedelta(hours=14) - timedelta(minutes=15)
    assert control.get_watermark_seq(marks, "silver", "t") == 2
    assert control.get_watermark(marks, "silver", "other") == datetime(1900, 1, 1)
    empty = log_rows(spark, 3).filter(F.lit(False))
    row = control.batch_watermark(marks, "silver", "t", empty, "r2", NOW).first()
    assert (row.last_loaded_at, row.rows_last_batch) == (NOW + timedelta(hours=14), 0)


def test_many_batches_are_one_scan_and_a_key_is_one_row(spark):
    table = KeyedTable(spark, fresh_dir(spark, "table"), ["k"])
    for n in range(1, 9):
        table.upsert(spark.createDataFrame([(n, "a"), (0, f"x{n}"), (0, f"y{n}")], "k int, v string").coalesce(1), n)
    read = table.read()
    assert {(r["k"], r["v"]) for r in read.collect()} == {*((n, "a") for n in range(1, 9)), (0, "y8")}
    assert read._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    single = KeyedTable(spark, fresh_dir(spark, "table"), ["k"])
    single.upsert(spark.createDataFrame([(0, "x"), (0, "y")], "k int, v string"), 1)
    assert single.read().count() == 1


def test_keys_of_long_parts_differ(spark):
    rows = spark.createDataFrame([("a" * 400 + x,) for x in "bc"], "t string")
    assert rows.select(surrogate_key(F.col("t"))).distinct().count() == 2
    assert rows.select(attribute_hash(F.col("t"))).distinct().count() == 2


def test_a_single_batch_is_read_and_written_without_ranking(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["k"])
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    table.upsert(rows, 1, unique=True)
    assert "Window" not in table.read()._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in table.lookup(rows.filter("k > 1").select("k")).collect()} == {(2, "b"), (3, "c")}
    table.upsert(rows.filter("k = 1").withColumn("v", F.lit("z")), 2, removed=rows.filter("k = 2").select("k"), unique=True)
    assert {tuple(r) for r in table.read().collect()} == {(1, "z"), (3, "c")}
    assert {tuple(r) for r in table.read(before=2).collect()} == {(1, "a"), (2, "b"), (3, "c")}
    table.upsert(rows.unionAll(rows), 3)  # rows that may repeat are still reduced to one for each key
    assert table.read_batch(3).count() == 3


def test_few_batches_are_laid_over_each_other_without_ranking(spark):
    table = KeyedTable(spark, fresh_dir(spark, "table"), ["k"])
    table.upsert(spark.createDataFrame([("a", 1), ("b", 1), ("c", 1), (None, 1)], "k string, v int"), 1)
    table.upsert(spark.createDataFrame([("b", 2), ("d", 2), (None, 2)], "k string, v int"), 2, removed=spark.createDataFrame([("c",), ("d",)], "k string"))
    assert "Window" not in table.read()._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in table.read().collect()} == {("a", 1), ("b", 2), ("d", 2), (None, 2)}
    table.upsert(spark.createDataFrame([("c", 3, "new")], "k string, v int, w string"), 3, removed=spark.createDataFrame([("b",)], "k string"))
    want = {("a", 1, None), ("c", 3, "new"), ("d", 2, None), (None, 2, None)}
    assert {tuple(r) for r in table.read().collect()} == want and table.read().count() == 4
    assert {tuple(r) for r in table.lookup(spark.createDataFrame([("b",), ("c",), ("d",)], "k string")).collect()} == {("c", 3, "new"), ("d", 2, None)}
    table.upsert(spark.createDataFrame([("e", 4, "new")], "k string, v int, w string"), 4)  # now they are ranked
    assert {tuple(r) for r in table.read().collect()} == want | {("e", 4, "new")}
    table.compact()
    table.upsert(spark.createDataFrame([("a", 5, "new")], "k string, v int, w string"), 5, removed=spark.createDataFrame([("e",)], "k string"))
    assert {tuple(r) for r in table.read().collect()} == {("a", 5, "new"), ("c", 3, "new"), ("d", 2, None), (None, 2, None)}


def test_a_batch_with_removed_keys_is_computed_once(spark):
    table, made = KeyedTable(spark, fresh_dir(spark, "table"), ["k"]), spark.sparkContext.accumulator(0)

    def row(k):
        made.add(1)
        return k, "a"

    rows = spark.sparkContext.parallelize([1, 2, 3], 1).map(row).toDF("k long, v string")
    table.upsert(rows, 1, removed=spark.createDataFrame([(2,), (4,)], "k long"))
    assert made.value == 3
    assert {tuple(r) for r in table.read().collect()} == {(1, "a"), (2, "a"), (3, "a")}
