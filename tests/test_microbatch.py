"""The whole job on a small warehouse: changes, removals, versions, the gate and replays."""

from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from starloom.contracts import ENTITIES
from starloom.operators.monitor import recon_silver_gold
from starloom.plans import silver
from starloom.plans.microbatch import HEADER_LOGS, MARK_OF, Warehouse, full_check, run_microbatch, total_verdicts
from starloom.session import fresh_dir
from starloom.streaming.warehouse import start_warehouse

T = datetime(2024, 3, 1, 8, 0)
LATER = T + timedelta(days=1)


def land(wh, entity, batch, rows):
    """Rows as dicts; columns left out are NULL."""
    schema = ENTITIES[entity].change_schema
    data = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
    wh.spark.createDataFrame(data, schema).coalesce(1).write.mode("overwrite").parquet(
        f"{wh.root}/bronze/{entity}/batch={batch}")


def event(op, ts, seq, **columns):
    return {"cdc_operation": op, "ingested_at": ts, "seq": seq, **columns}


def customer(op, ts, seq, city="Lima", email="a@b.com"):
    return event(op, ts, seq, customer_id="C1", company_name="Acme", country="UK", city=city, contact_email=email,
                 customer_since=date(2020, 1, 1))


def order(op, ts, seq, key, status="Completed", day=date(2024, 2, 20)):
    return event(op, ts, seq, sales_order_id=key, customer_id="C1", warehouse_id="W1", order_date=day,
                 order_status=status, sales_channel="Phone/Email")


def line(op, ts, seq, key, order_key, quantity=2):
    return event(op, ts, seq, sales_order_line_id=key, sales_order_id=order_key, line_number=1, product_id="P1",
                 quantity=quantity, unit_price=10.0, discount_rate=0.0, line_subtotal=10.0 * quantity,
                 discount_amount=0.0, line_total=10.0 * quantity)


@pytest.fixture
def warehouse(spark):
    wh = Warehouse(spark, fresh_dir(spark, "wh"))
    land(wh, "customers", 1, [customer("I", T, 1)])
    land(wh, "products", 1, [event("I", T, 1, product_id="P1", product_name="Bolt", category="Tools", unit_cost=4.0,
                                   list_price=10.0, is_discontinued=False, product_launch_date=date(2020, 1, 1))])
    land(wh, "warehouses", 1, [event("I", T, 1, warehouse_id="W1", warehouse_name="Main", country="Peru", city="Lima")])
    land(wh, "sales_orders", 1, [order("I", T, i, k) for i, k in enumerate(("O1", "O2", "O3"))])
    land(wh, "invoices", 1, [event("I", T, 1, invoice_id="I1", sales_order_id="O1", due_date=date(2024, 3, 20),
                                   payment_term_days=30)])
    land(wh, "shipments", 1, [event("I", T, 1, shipment_id="S1", sales_order_id="O1", ship_date=date(2024, 2, 25))])
    land(wh, "sales_order_lines", 1, [line("I", T, 1, "L1", "O1"), line("I", T, 2, "L2", "O2"), line("I", T, 3, "L3", "O3"),
                                      line("I", T, 4, "L4", "O3")])
    return wh


def fact(wh):
    return {r.venta_detalle_id: r for r in wh.read("fact_ventas").collect()}


def test_changes_flow_through_and_a_replay_changes_nothing(warehouse):
    wh = warehouse
    assert run_microbatch(wh, 1, T) == {"failed": []}
    first = fact(wh)
    assert set(first) == {"L1", "L2", "L3", "L4"}
    assert (float(first["L1"].costo), float(first["L1"].margen), first["L1"].fecha_key) == (8.0, 12.0, 20240220)

    land(wh, "customers", 2, [customer("U", LATER, 2, city="Cusco")])
    land(wh, "sales_orders", 2, [order("U", LATER, 9, "O2", status="Cancelled")])  # its line must leave the fact
    land(wh, "sales_order_lines", 2, [line("D", LATER, 8, "L3", "O3"), line("U", LATER, 9, "L4", "O3", quantity=5)])
    # An earlier shipment alone re-dates its unchanged order.
    land(wh, "shipments", 2, [event("I", LATER, 2, shipment_id="S2", sales_order_id="O1", ship_date=date(2024, 2, 10))])
    snapshots = []
    for _ in range(2):  # the second run repeats the finished batch
        assert run_microbatch(wh, 2, LATER) == {"failed": []}
        second = fact(wh)
        assert set(second) == {"L1", "L4"}
        assert second["L4"].cantidad == 5
        assert second["L1"].fecha_key == 20240219  # due date less term, as the order date is after the shipment
        versions = sorted(tuple(r) for r in wh.read("snp_clientes").select("ciudad", "valid_from").collect())
        assert versions == [("Cusco", LATER), ("Lima", datetime(1900, 1, 1))]
        marks = {r.entity_name: r.last_loaded_at for r in wh.read("etl_watermark").collect()}
        assert marks["slv_clientes"] == LATER and marks["slv_productos"] == T and marks["fact_ventas"] == LATER
        snapshots.append(sorted(map(str, second.values())))
    assert snapshots[0] == snapshots[1]
    assert {r.status for r in wh.read_log("pipeline_run_log").collect()} == {"SUCCEEDED"}


def test_error_rule_stops_before_gold_and_is_logged(warehouse):
    wh = warehouse
    land(wh, "customers", 1, [customer("I", T, 1, email="None")])
    assert run_microbatch(wh, 1, T)["failed"] == ["not_accepted_values_slv_clientes_email"]
    assert not wh.table("fact_ventas").exists() and not wh.table("snp_clientes").exists()
    assert not wh.table("etl_watermark").exists()
    log = [(r.entity_name, r.test_name, r.severity, r.failed_rows, r.sample_value)
           for r in wh.read_log("data_quality_log").collect()]
    assert log == [("slv_clientes", "not_accepted_values_slv_clientes_email", "error", 1, "none")]
    run = wh.read_log("pipeline_run_log").first()
    assert (run.status, run.error_message) == ("FAILED", "not_accepted_values_slv_clientes_email")


def test_rows_that_arrive_behind_other_entities_are_taken(warehouse):
    wh = warehouse
    land(wh, "shipments", 1, [event("I", T + timedelta(hours=2), 1, shipment_id="S1", sales_order_id="O1", ship_date=date(2024, 2, 25))])
    assert run_microbatch(wh, 1, T) == {"failed": []}
    between = T + timedelta(hours=1)  # behind the shipment of batch 1
    land(wh, "sales_order_lines", 2, [line("I", between, 20, "L9", "O2"), line("I", between, 21, "L10", "O9")])
    land(wh, "sales_orders", 2, [order("I", between, 20, "O9")])
    assert run_microbatch(wh, 2, LATER) == {"failed": []}
    assert {"L1", "L2", "L9", "L10"} <= set(fact(wh))
    assert wh.read_log("reconciliation_log").filter("not is_match").count() == 0


def test_a_batch_after_a_stop_at_the_gate_takes_both(warehouse):
    wh = warehouse
    assert run_microbatch(wh, 1, T) == {"failed": []}
    land(wh, "customers", 2, [customer("U", LATER, 2, email="None")])
    land(wh, "sales_order_lines", 2, [line("I", LATER, 20, "L9", "O2")])
    assert run_microbatch(wh, 2, LATER)["failed"] and "L9" not in fact(wh)
    land(wh, "customers", 3, [customer("U", LATER + timedelta(hours=1), 3)])
    for _ in range(2):
        assert run_microbatch(wh, 3, LATER + timedelta(hours=1)) == {"failed": []}
        assert "L9" in fact(wh)
    runs = sorted((r.run_id, r.status) for r in wh.read_log("pipeline_run_log").collect())
    assert runs == [("batch-1", "SUCCEEDED"), ("batch-2", "FAILED"), ("batch-3", "SUCCEEDED")]
    assert wh.read_log("data_quality_log").filter("severity = 'error'").count() == 1


def test_a_dimension_that_fans_out_stops_the_job(warehouse):
    wh = warehouse
    assert run_microbatch(wh, 1, T) == {"failed": []}
    versions = wh.read("snp_clientes")
    versions.withColumns({"valid_from": versions["valid_from"] + timedelta(days=1), "_removed": F.lit(False)}).coalesce(1).write.parquet(
        f"{wh.table('snp_clientes').path}/batch-2")  # a second version in force
    land(wh, "sales_order_lines", 3, [line("I", LATER, 20, "L9", "O2")])
    failed = run_microbatch(wh, 3, LATER)["failed"]
    assert "one_current_version_dim_cliente" in failed
    assert set(fact(wh)) == {"L1", "L2", "L3", "L4"}  # Gold is as it was: the batch's rows were never published
    assert wh.table("dim_cliente").last_batch() == 1 and wh.table("tot_diario").last_batch() == 1
    assert wh.table("fact_ventas").has_batch(3)


def test_state_and_totals_equal_full_models_after_changes(warehouse):
    """Headers by keyed state equal the model over whole logs; totals by deltas equal the full reconciliation."""
    wh = warehouse
    land(wh, "shipments", 1, [event("I", T, i, shipment_id=f"S{i}", sales_order_id="O1", ship_date=date(2024, 2, 10 + i)) for i in range(3)])
    assert run_microbatch(wh, 1, T) == {"failed": []}
    # The first shipment of O1 is deleted, another moves to O2, an invoice is deleted; a line leaves, one comes, one changes.
    land(wh, "shipments", 2, [event("D", LATER, 10, shipment_id="S0", sales_order_id="O1", ship_date=date(2024, 2, 10)),
                              event("U", LATER, 11, shipment_id="S1", sales_order_id="O2", ship_date=date(2024, 2, 1))])
    land(wh, "invoices", 2, [event("D", LATER, 9, invoice_id="I1", sales_order_id="O1", due_date=date(2024, 3, 20), payment_term_days=30)])
    land(wh, "sales_order_lines", 2, [line("D", LATER, 8, "L3", "O3"), line("U", LATER, 9, "L4", "O3", quantity=5), line("I", LATER, 10, "L5", "O1")])
    assert run_microbatch(wh, 2, LATER) == {"failed": []}
    full = silver.slv_orders(*(wh.bronze(e) for e in HEADER_LOGS))
    rows = lambda df: sorted(map(str, df.select(*sorted(full.columns)).collect()))
    assert rows(wh.read("slv_ventas")) == rows(full)
    day = {r.sales_order_id: r.ship_date for r in wh.read("ext_envios").collect()}
    assert day == {"O1": date(2024, 2, 12), "O2": date(2024, 2, 1)}
    verdicts = {tuple(r) for r in total_verdicts(wh.read("tot_diario")).filter("filas_silver + filas_gold > 0").collect()}
    whole = recon_silver_gold(wh.read("slv_venta_detalle"), wh.read("slv_ventas"), wh.read("fact_ventas"))
    assert verdicts == {tuple(r) for r in whole.select("fecha_key", "filas_silver", "filas_gold", "importe_silver", "importe_gold", "is_match").collect()}
    results, log = full_check(wh, "full-1", LATER)
    assert results.filter("failed_rows > 0 and severity = 'error'").count() == 0 and log.filter("not is_match").count() == 0


def test_a_second_batch_reads_recent_log_folders_only(warehouse):
    """No log is scanned whole once a watermark is there: each scan of a log is limited to the batch's own rows."""
    wh = warehouse
    for entity in HEADER_LOGS:
        text = wh.bronze(entity, T)._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThan(ingested_at" in text
    seen = []

    def changes(entity):
        seen.append(entity)
        return wh.bronze(entity)

    assert run_microbatch(wh, 1, T, changes) == {"failed": []}
    # The job gets at logs through ``changes`` only: with nothing new in them the fact and the totals stay as they are.
    before, wh_empty = fact(wh), lambda entity: wh.bronze(entity).limit(0)
    assert run_microbatch(wh, 2, LATER, wh_empty) == {"failed": []}
    assert fact(wh) == before and set(seen) == set(MARK_OF)


def test_a_stream_over_all_logs_resumes_after_a_stopped_batch(warehouse):
    wh = warehouse
    land(wh, "customers", 1, [customer("I", T, 1, email="None")])
    start = lambda: start_warehouse(wh, f"{wh.root}/checkpoint", lambda n: T + timedelta(days=n), every=None)
    with pytest.raises(StreamingQueryException):
        start().awaitTermination()
    assert not wh.table("fact_ventas").exists()
    tolerant = replace(wh, tolerated=("not_accepted_values_slv_clientes_email",))
    start_warehouse(tolerant, f"{wh.root}/checkpoint", lambda n: T + timedelta(days=n), every=None).awaitTermination()
    assert set(fact(wh)) == {"L1", "L2", "L3", "L4"} and wh.table("fact_ventas").last_batch() == 1
