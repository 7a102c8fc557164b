"""Assertions must fail on bad rows, not only pass on good ones."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from starloom.operators import monitor, quality
from starloom.operators.quality import ERROR, WARN, Rule
from starloom.plans.rules import BRONZE_RULES, GOLD_RULES, SILVER_RULES

NOW = datetime(2024, 1, 2, 12, 0)


@pytest.fixture
def parent(spark):
    return spark.createDataFrame([(1,), (2,)], "id int")


@pytest.fixture
def child(spark):
    return spark.createDataFrame([(1, 1, "a", 5.0), (2, 9, "b", -1.0), (2, None, None, 0.0), (3, 9, "zz", None)],
                                 "id int, parent int, code string, amount double")


def test_declared_rules_are_complete():
    assert [len(r) for r in (BRONZE_RULES, SILVER_RULES, GOLD_RULES)] == [16, 48, 44]


def test_suite_counts_failures(spark, parent, child):
    def rule(kind, column, severity=ERROR, **args):
        return Rule("silver", "child", kind, (column,), severity, args)
    rules = [rule("not_null", "code"), rule("unique", "id"), rule("accepted_values", "code", WARN, values=["a", "b"]),
             rule("not_accepted_values", "code", values=["zz"]), rule("range", "amount", low=0, inclusive=True),
             rule("relationship", "parent", WARN, to="parent", field="id")]
    got = {r.test_name: (r.failed_rows, r.sample_value, r.severity) for r in
           quality.run_suite({"child": child, "parent": parent}, rules).collect()}
    assert got == {
        "not_null_child_code": (1, None, ERROR), "unique_child_id": (1, "2", ERROR),
        "accepted_values_child_code": (1, "zz", WARN), "not_accepted_values_child_code": (1, "zz", ERROR),
        "range_child_amount": (1, "-1.0", ERROR), "relationship_child_parent": (2, "9", WARN)}


def test_combinations_count_null_as_a_value_and_self_references_work(spark):
    rows = [(1, None, 1), (1, None, 2), (1, "a|b", None), (2, "[null]", 9), (2, None, 2), (3, "a", 1), (3, "b", 1)]
    t = spark.createDataFrame(rows, "a int, b string, up int")
    rules = [Rule("silver", "t", "unique_combination", ("a", "b")), Rule("silver", "t", "relationship", ("up",), ERROR, {"to": "t", "field": "a"}),
             Rule("silver", "t", "unique", ("b",))]
    got = {r.test_name: (r.failed_rows, r.sample_value) for r in quality.run_suite({"t": t}, rules).collect()}
    assert got == {"unique_combination_t_a_b": (1, "1"), "relationship_t_up": (1, "9"), "unique_t_b": (0, None)}


def test_the_suite_scans_each_table_once(spark, tmp_path, parent, child):
    child.write.parquet(f"{tmp_path}/child")
    parent.write.parquet(f"{tmp_path}/parent")
    tables = {n: spark.read.parquet(f"{tmp_path}/{n}") for n in ("child", "parent")}
    rules = [Rule("silver", "child", "not_null", ("code",)), Rule("silver", "child", "unique", ("id",)), Rule("silver", "parent", "unique", ("id",)),
             Rule("silver", "child", "relationship", ("parent",), ERROR, {"to": "parent", "field": "id"}),
             Rule("silver", "child", "unique_combination", ("id", "code"))]
    text = quality.run_suite(tables, rules)._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan parquet") == 2
    assert "partial_sum" in text[text.index("Exchange hashpartitioning(rule"):]


def test_failing_rows_are_stored_with_counts_of_the_same_scan(spark, tmp_path, parent, child):
    rules = [Rule("silver", "child", "not_null", ("code",)), Rule("silver", "child", "range", ("amount",), WARN, {"low": 1, "inclusive": True}),
             Rule("silver", "child", "relationship", ("parent",), ERROR, {"to": "parent", "field": "id"}), Rule("silver", "child", "unique", ("id",))]
    tables = {"child": child, "parent": parent}
    for _ in range(2):  # a repeated run replaces what it wrote
        assert quality.store_failures(tables, rules, {"child": "id"}, str(tmp_path), "r1") == {"not_null_child_code": 1, "range_child_amount": 2}
    rows = {(r.row_key, tuple(r.rules), r.row) for r in spark.read.parquet(f"{tmp_path}/rows").collect()}
    assert rows == {("2", ("range_child_amount",), '{"id":2,"parent":9,"code":"b","amount":-1.0}'),
                    ("2", ("not_null_child_code", "range_child_amount"), '{"id":2,"parent":null,"code":null,"amount":0.0}')}
    values = {(r.entity_name, r.test_name, r.value, r.failed_rows) for r in spark.read.parquet(f"{tmp_path}/values").collect()}
    assert values == {("child", "relationship_child_parent", "9", 2), ("child", "unique_child_id", "2", 1)}


def test_exclusive_range_fails_on_the_limit(child):
    assert quality.in_range(child, "amount", low=0, inclusive=False).count() == 2
    assert quality.in_range(child, "amount", low=-1, high=5).count() == 0


def test_missing_table_is_an_error(child):
    rule = Rule("silver", "child", "relationship", ("parent",), ERROR, {"to": "parent", "field": "id"})
    with pytest.raises(KeyError):
        quality.run_suite({"child": child}, [rule])


def test_gate_stops_on_errors_only(spark):
    schema = "layer_name string, entity_name string, test_name string, severity string, failed_rows bigint, sample_value string"
    warned = [("silver", "t", "w", WARN, 5, None), ("silver", "t", "e", ERROR, 0, None)]
    assert quality.gate(spark.createDataFrame(warned, schema)) == (True, [])
    failed = warned + [("silver", "t", "bad", ERROR, 1, None)]
    assert quality.gate(spark.createDataFrame(failed, schema)) == (False, ["bad"])
    log = quality.consolidate(spark.createDataFrame(failed, schema), "r", NOW).collect()
    assert {(r.test_name, r.severity, r.failed_rows) for r in log} == {("w", WARN, 5), ("bad", ERROR, 1)}


def test_version_invariants_fail_on_bad_dimension(spark):
    end = datetime(9999, 12, 31)
    rows = [("a", NOW, NOW + timedelta(days=2), False), ("a", NOW + timedelta(days=1), end, True),
            ("b", NOW, end, True), ("b", NOW + timedelta(days=1), end, True), ("c", NOW, end, True),
            ("-1", NOW, end, True), ("-1", NOW + timedelta(days=1), end, True)]
    dim = spark.createDataFrame(rows, "id string, valido_desde timestamp_ntz, valido_hasta timestamp_ntz, "
                                      "es_version_vigente boolean")
    assert [r.clave for r in quality.one_current(dim, "id").collect()] == ["b"]
    assert sorted(r.clave_natural for r in quality.no_overlap(dim, "id").collect()) == ["a", "a", "b", "b"]


def test_freshness_limits(spark):
    rows = [("late", NOW - timedelta(minutes=31), "I"), ("ok", NOW - timedelta(minutes=30), "D"),
            ("old", NOW - timedelta(minutes=121), "U")]
    events = spark.createDataFrame(rows, "entidad string, ingested_at timestamp_ntz, cdc_operation string")
    assert {r.entidad: r.estado for r in monitor.freshness(events, NOW).collect()} == {
        "late": "REVISAR", "ok": "OK", "old": "REVISAR"}
    assert {r.entidad: r.status for r in monitor.source_freshness(events, NOW).collect()} == {
        "late": "warn", "ok": "pass", "old": "error"}


def test_health_counts_recent_errors_and_keeps_quiet_entities(spark):
    marks = spark.createDataFrame([("silver", "a", NOW - timedelta(minutes=40), 7), ("silver", "b", NOW, 1)],
                                  "layer_name string, entity_name string, last_loaded_at timestamp_ntz, rows_last_batch bigint")
    log = spark.createDataFrame(
        [("a", "error", NOW - timedelta(hours=1)), ("a", "warn", NOW), ("a", "error", NOW - timedelta(hours=25))],
        "entity_name string, severity string, detected_at timestamp_ntz")
    got = {r.entity_name: (r.minutos_de_retraso, r.estado_sla, r.fallos_calidad_24h)
           for r in monitor.pipeline_health(marks, log, NOW).collect()}
    assert got == {"a": (40, "RETRASADO", 1), "b": (0, "OK", 0)}


def test_lost_bronze_keys_are_reported(spark):
    log = spark.createDataFrame([("1", "I"), ("2", "U"), ("2", "U"), ("3", "D")], "k string, cdc_operation string")
    silver = spark.createDataFrame([("1",), ("3",)], "id string")
    row = monitor.recon_bronze_silver({"x": (log, "k", silver, "id")}).first()
    assert (row.claves_bronze, row.filas_silver, row.faltan) == (2, 2, 1)


def test_issue_log_lists_every_defect_of_a_row(spark):
    df = spark.createDataFrame([("r1", None, 4), ("r2", 1, -1), ("r3", 1, 1)], "id string, a int, b int")
    log = quality.issue_log(df, "t", "id", [
        quality.IssueRule("missing", "a", F.col("a").isNull(), "high", F.lit(0)),
        quality.IssueRule("negative", "b", F.col("b") < 0, "low"), quality.IssueRule("big", "b", F.col("b") > 3, "low")])
    got = {(r.row_primary_key, r.issue_type, r.corrupted_value, r.original_clean_value) for r in log.collect()}
    assert got == {("r1", "missing", None, "0"), ("r1", "big", "4", None), ("r2", "negative", "-1", None)}


def test_the_suite_hashes_its_counts_and_sorts_no_rows(spark, parent, child):
    rules = [Rule("silver", "child", "unique", ("id",)), Rule("silver", "child", "relationship", ("parent",), ERROR, {"to": "parent", "field": "id"}),
             Rule("silver", "child", "unique_combination", ("id",)), Rule("silver", "child", "not_null", ("code",))]
    text = quality._value_verdicts({"child": child, "parent": parent}, rules, {})._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in text and "Sort [" not in text and text.count("HashAggregate") == 2
    assert "lambda" not in text  # notes are made and spread by generated code


def test_a_combination_of_one_column_counts_null_as_a_value(spark):
    t = spark.createDataFrame([(None,), (None,), ("a",), ("b",), ("b",)], "a string")
    rules = [Rule("silver", "t", "unique_combination", ("a",)), Rule("silver", "t", "unique", ("a",))]
    got = {r.test_name: (r.failed_rows, r.sample_value) for r in quality.run_suite({"t": t}, rules).collect()}
    assert got == {"unique_combination_t_a": (2, ""), "unique_t_a": (1, "b")}
