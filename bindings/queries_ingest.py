"""Sources, sinks, filters, change resolution."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from bindings import sql as q
from bindings.binding import AS_OF, SPLIT
from bindings.registry import query
from starloom.contracts import CONTROL_SCHEMA, ENTITIES, schema_of
from starloom.functions.dates import window_start
from starloom.functions.repair import amount_gap, amount_mismatch
from starloom.functions.text import clean_email, effective_sale, is_active, upper_label, valid_email
from starloom.operators import cdc, merge
from starloom.operators.control import overlap_start, run_rows
from starloom.operators.fact import active, changed_lines, changed_orders
from starloom.plans.gold import dim_channel
from starloom.plans.silver import clean_customers
from starloom.session import fresh_dir
from starloom.sources import bronze
from starloom.sources.tables import KeyedTable, append_log
from starloom.streaming.jobs import start_files, stream_bronze

LOG_SCHEMA = schema_of("user_id bigint, event_type string, value double, operation int, cdc_operation string, "
                       "ingested_at timestamp_ntz, seq bigint")
MID_LOG = datetime(2024, 1, 16)
LOG = "user_id event_type value cdc_operation ingested_at:t seq"


def landed_log(b) -> str:
    """The native log in a new Bronze folder."""
    root = fresh_dir(b.spark, "bronze")
    bronze.land_changes(b.log("log"), root, "log")
    return root


# ---- sources and sinks --------------------------------------------------------------------

TICKET = "support_ticket_id customer_id created_at:d category priority status cdc_operation ingested_at:t seq"


@query("bronze_scan", TICKET, "SELECT * FROM b_support_tickets")
def _(b):
    root = fresh_dir(b.spark, "bronze")
    bronze.land_changes(b.log("support_tickets"), root, "support_tickets", "1")
    return bronze.read_bronze(b.spark, root, "support_tickets")


@query("bronze_stream", LOG, "SELECT * FROM b_log")
def _(b):
    root, out = landed_log(b), fresh_dir(b.spark, "copy")
    stream = stream_bronze(b.spark, root, "log", max_files=10, schema=LOG_SCHEMA)
    start_files(stream, out, out + "-checkpoint", every=None).awaitTermination()
    return b.spark.read.schema(LOG_SCHEMA).parquet(out)


@query("bronze_land", "date:d events:i last_seq", """SELECT CAST(ingested_at AS DATE) AS date, count(*) AS events,
  max(seq) AS last_seq FROM b_log GROUP BY 1""")
def _(b):
    landed = b.spark.read.parquet(bronze.entity_path(landed_log(b), "log"))
    return landed.groupBy("date").agg(F.count("*").alias("events"), F.max("seq").alias("last_seq"))


@query("initial_snapshot", "c_custkey c_name c_nationkey c_mktsegment cdc_operation ingested_at:t seq",
       f"SELECT *, 'I' AS cdc_operation, {q.AS_OF} AS ingested_at, CAST(0 AS BIGINT) AS seq FROM customer")
def _(b):
    return bronze.initial_snapshot(b.table("customer"), AS_OF)


@query("derive_cdc_columns", "event_id user_id cdc_operation ingested_at:t",
       """SELECT event_id, user_id, CASE WHEN event_type = 'error' THEN 'D' WHEN event_type = 'signup' THEN 'I'
  ELSE 'U' END AS cdc_operation, ts AS ingested_at FROM events""")
def _(b):
    kind = F.col("event_type")
    return bronze.with_cdc_columns(b.table("events"), kind == "error", kind != "signup", F.col("ts"))


@query("lsn_range_extract", LOG, """SELECT * FROM b_log WHERE seq > (SELECT max(seq) FROM b_log
  WHERE ingested_at < TIMESTAMP '2024-01-16') AND seq <= (SELECT max(seq) FROM b_log)""")
def _(b):
    log = b.log("log")
    checkpoint = log.filter(F.col("ingested_at") < F.lit(MID_LOG).cast("timestamp_ntz")).agg(F.max("seq")).first()[0]
    return bronze.extract_range(log, checkpoint)[0]


# A control table where one entity is switched off and some have a checkpoint.
CONTROL = [(e, None if i % 3 else 500, e != "returns") for i, e in enumerate(sorted(ENTITIES))]
SWEEP = "entity_name rows_copied:i first_seq new_seq"
SWEEP_SQL = " UNION ALL ".join(
    f"SELECT '{e}' AS entity_name, count(*) AS rows_copied, min(seq) AS first_seq, max(seq) AS new_seq FROM b_{e}"
    + ("" if last is None else f" WHERE seq > {last}") + " HAVING count(*) > 0" for e, last, on in CONTROL if on)


def control_frame(b):
    rows = [(e, f"dbo_{e}", last, None, None, on, AS_OF) for e, last, on in CONTROL]
    return b.spark.createDataFrame(rows, CONTROL_SCHEMA)


def swept(b):
    return bronze.sweep_frames(control_frame(b), {e: b.log(e) for e in ENTITIES})


@query("entity_sweep", SWEEP, SWEEP_SQL)
def _(b):
    return swept(b)


PRODUCT = "product_id list_price category cdc_operation ingested_at:t seq"


@query("upsert_write", PRODUCT, "SELECT * FROM x_products")
def _(b):
    log = b.log("products")
    table = KeyedTable(b.spark, fresh_dir(b.spark, "table"), ["product_id"])
    early = F.col("ingested_at") <= F.lit(SPLIT).cast("timestamp_ntz")
    table.upsert(cdc.latest_event(log.filter(early), ["product_id"]), 1)
    table.upsert(cdc.latest_event(log.filter(~early), ["product_id"]), 2)
    table.compact()
    table.upsert(cdc.latest_event(bronze.newer_than(log, SPLIT), ["product_id"]), 3)
    return table.read()


@query("replace_write", "canal_key canal_id canal_nombre canal_tipo es_borrado ingested_at:t", "SELECT * FROM d_canal")
def _(b):
    table = KeyedTable(b.spark, fresh_dir(b.spark, "table"), ["canal_key"])
    table.replace(dim_channel(b.silver["slv_canales"], datetime(2001, 1, 1)), 1)
    table.replace(dim_channel(b.silver["slv_canales"], AS_OF), 2)
    return table.read()


@query("schema_append_columns", "product_id list_price weight_kg",
       f"""SELECT product_id, list_price, CASE WHEN ingested_at > {q.SPLIT} THEN weight_kg END AS weight_kg
FROM x_products""")
def _(b):
    latest = cdc.latest_event(b.log("products"), ["product_id"])
    late = F.col("ingested_at") > F.lit(SPLIT).cast("timestamp_ntz")
    first_seen = cdc.latest_event(b.log("products").filter(~late), ["product_id"])
    return merge.upsert(first_seen.select("product_id", "list_price"),
                        latest.filter(late).select("product_id", "list_price", "weight_kg"), ["product_id"])


@query("widen_types", "purchase_order_line_id line_number quantity_ordered unit_cost line_total quantity_received",
       """SELECT purchase_order_line_id, line_number,
  CASE WHEN line_number = 7 THEN NULL ELSE quantity_ordered END AS quantity_ordered, unit_cost, line_total,
  CAST(NULL AS DOUBLE) AS quantity_received FROM b_purchase_order_lines""")
def _(b):
    log = b.log("purchase_order_lines")
    quantity = F.when(F.col("line_number") == 7, "many").otherwise(F.col("quantity_ordered").cast("string"))
    raw = log.select("purchase_order_line_id", F.col("line_number").cast("smallint"), quantity.alias("quantity_ordered"),
                     F.col("unit_cost").cast("string"), "line_total", F.lit(1).alias("not_in_contract"))
    return bronze.conform_schema(raw, ENTITIES["purchase_order_lines"].source_schema)


@query("schema_drift", "row_primary_key column_name issue_type corrupted_value", """SELECT purchase_order_line_id AS row_primary_key,
  'quantity_ordered' AS column_name, 'unparsable' AS issue_type, 'many' AS corrupted_value FROM b_purchase_order_lines WHERE line_number = 7
UNION ALL SELECT purchase_order_line_id, 'color', 'unknown column', 'c' || line_number FROM b_purchase_order_lines WHERE line_number > 4""")
def _(b):
    # The source sends text for a number and a column that the contract does not know: both are kept aside and logged.
    log, contract = b.log("purchase_order_lines"), ENTITIES["purchase_order_lines"].source_schema
    quantity = F.when(F.col("line_number") == 7, "many").otherwise(F.col("quantity_ordered").cast("string"))
    color = F.when(F.col("line_number") > 4, F.concat(F.lit("c"), F.col("line_number").cast("string")))
    rows = bronze.conform_schema(log.select(*contract.names).withColumns({"quantity_ordered": quantity, "color": color}), contract, "rescued")
    return bronze.rescued_issues(rows, contract, "purchase_order_lines", "purchase_order_line_id", "rescued")


RUN = "run_id pipeline_name layer_name entity_name status rows_affected:i logged_at:t"


@query("append_log", RUN, f"""SELECT 'run-' || r AS run_id, 'ingest' AS pipeline_name, 'bronze' AS layer_name,
  entity_name, 'SUCCEEDED' AS status, rows_copied AS rows_affected, {q.AS_OF} AS logged_at
FROM ({SWEEP_SQL}), range(2) t(r)""")
def _(b):
    path, done = fresh_dir(b.spark, "log"), swept(b)
    for r in (0, 1, 1):  # the second run is repeated
        append_log(run_rows(done, "ingest", "bronze", "SUCCEEDED", f"run-{r}", AS_OF), path, f"run-{r}")
    return b.spark.read.parquet(path).drop("run")


# ---- projections, filters, predicates -----------------------------------------------------

CUSTOMER = ("cliente_id nombre apellido nombre_completo email telefono pais ciudad email_valido creado_en:t "
            "actualizado_en:t es_borrado ingested_at:t")


@query("project_rename_cast", CUSTOMER + " seq", "SELECT * FROM e_clientes")
def _(b):
    return clean_customers(b.log("customers"))


@query("filter_not_deleted", "venta_detalle_id venta_id", """SELECT venta_detalle_id, venta_id FROM s_detalle
WHERE NOT es_borrado AND venta_id IN (SELECT venta_id FROM s_ventas WHERE NOT es_borrado)""")
def _(b):
    return active(b.silver["slv_venta_detalle"]).join(active(b.silver["slv_ventas"]).select("venta_id"), "venta_id",
                                                      "left_semi")


@query("filter_effective_sale", "sales_order_id order_status customer_id",
       "SELECT * FROM x_sales_orders WHERE upper(trim(order_status)) = 'COMPLETED'")
def _(b):
    return cdc.latest_event(b.log("sales_orders"), ["sales_order_id"]).filter(effective_sale(F.col("order_status")))


@query("filter_incremental", "sales_order_id cdc_operation ingested_at:t seq",
       f"SELECT * FROM b_sales_orders WHERE ingested_at > {q.SPLIT} - INTERVAL 15 MINUTE")
def _(b):
    return bronze.newer_than(b.log("sales_orders"), overlap_start(SPLIT))


@query("filter_detail_or_header_changed", "venta_detalle_id", f"""SELECT venta_detalle_id FROM s_detalle
WHERE ingested_at > {q.SPLIT} OR venta_id IN (SELECT venta_id FROM s_ventas WHERE ingested_at > {q.SPLIT})""")
def _(b):
    return changed_lines(b.silver["slv_venta_detalle"], b.silver["slv_ventas"], SPLIT)


@query("changed_orders", "sales_order_id", " UNION ".join(
    f"SELECT sales_order_id FROM b_{e} WHERE ingested_at > {q.SPLIT}" for e in ("sales_orders", "invoices", "shipments")))
def _(b):
    return changed_orders(b.log("sales_orders"), b.log("invoices"), b.log("shipments"), SPLIT)


@query("filter_non_null_key", "sales_order_id canal_id",
       f"SELECT sales_order_id, {q.label('sales_channel')} AS canal_id FROM x_sales_orders WHERE canal_id IS NOT NULL")
def _(b):
    latest = cdc.latest_event(b.log("sales_orders"), ["sales_order_id"])
    return latest.withColumn("canal_id", upper_label(F.col("sales_channel"))).filter(F.col("canal_id").isNotNull())


@query("flag_valid_email", "customer_id seq email email_valido", f"""SELECT customer_id, seq,
  lower({q.text('contact_email')}) AS email,
  CASE WHEN lower({q.text('contact_email')}) LIKE '%_@_%.__%' THEN TRUE ELSE FALSE END AS email_valido
FROM b_customers""")
def _(b):
    email = clean_email(F.col("contact_email"))
    return b.log("customers").select("customer_id", "seq", email.alias("email"), valid_email(email).alias("email_valido"))


@query("flag_amount_mismatch", "sales_order_line_id seq gap:m mismatch", """SELECT sales_order_line_id, seq,
  abs(a - b) AS gap, coalesce(abs(a - b) > 0.01, FALSE) AS mismatch
FROM (SELECT *, CAST(line_total AS DECIMAL(19,4)) AS a, CAST(line_subtotal - discount_amount AS DECIMAL(19,4)) AS b
  FROM b_sales_order_lines)""")
def _(b):
    lines = b.log("sales_order_lines").select(
        "sales_order_line_id", "seq", F.col("line_total").cast("decimal(19,4)").alias("a"),
        (F.col("line_subtotal") - F.col("discount_amount")).cast("decimal(19,4)").alias("b"))
    return lines.select("sales_order_line_id", "seq", amount_gap(F.col("a"), F.col("b")).alias("gap"),
                        amount_mismatch(F.col("a"), F.col("b")).alias("mismatch"))


@query("flag_active_product", "product_id seq activo",
       "SELECT product_id, seq, is_discontinued IS NOT TRUE AS activo FROM b_products")
def _(b):
    return b.log("products").select("product_id", "seq", is_active(F.col("is_discontinued")).alias("activo"))


# ---- change resolution and duplicates -------------------------------------------------------

LINE = ("sales_order_line_id sales_order_id product_id quantity unit_price discount_rate line_subtotal "
        "discount_amount line_total cdc_operation ingested_at:t seq")


@query("latest_event", LINE, "SELECT * FROM x_sales_order_lines")
def _(b):
    return cdc.latest_event(b.log("sales_order_lines"), ["sales_order_line_id"])


@query("drop_before_images", LOG + " operation", "SELECT * FROM b_log WHERE operation IN (1, 2, 4)")
def _(b):
    return cdc.after_images(b.log("log"))


@query("logical_delete", "user_id es_borrado ingested_at:t seq",
       "SELECT *, cdc_operation = 'D' AS es_borrado FROM x_log")
def _(b):
    return cdc.latest_event(b.log("log"), ["user_id"]).withColumn("es_borrado", cdc.mark_deleted(F.col("cdc_operation")))


NET_SQL = """SELECT l.* REPLACE (CASE WHEN f.op1 = 'I' THEN 'I' WHEN l.cdc_operation = 'D' THEN 'D' ELSE 'U' END
  AS cdc_operation) FROM
(SELECT *, {slot} AS slot FROM b_log QUALIFY row_number() OVER (PARTITION BY user_id, {slot} ORDER BY seq DESC) = 1) l
JOIN (SELECT user_id, {slot} AS slot, min_by(cdc_operation, seq) AS op1 FROM b_log GROUP BY ALL) f
  ON f.user_id = l.user_id AND f.slot = l.slot
WHERE NOT (f.op1 = 'I' AND l.cdc_operation = 'D')"""


@query("net_changes", "batch_date:d " + LOG, f"""SELECT *, slot AS batch_date
FROM ({NET_SQL.format(slot='CAST(ingested_at AS DATE)')})""")
def _(b):
    return cdc.net_changes(b.log("log").withColumn("batch_date", F.to_date("ingested_at")), ["user_id"], ["batch_date"])


@query("net_changes_15m", "window_epoch " + LOG, f"""SELECT *, slot AS window_epoch
FROM ({NET_SQL.format(slot='(epoch_us(ingested_at) // 900000000 * 900)')})""")
def _(b):
    log = b.log("log").withColumn("window_epoch", window_start(F.col("ingested_at")))
    return cdc.net_changes(log, ["user_id"], ["window_epoch"])


@query("all_changes", "user_id event_type value operation cdc_operation seq",
       """SELECT * REPLACE (['D', 'I', 'B', 'U'][operation] AS cdc_operation) FROM b_log
WHERE seq > (SELECT max(seq) FROM b_log WHERE ingested_at < TIMESTAMP '2024-01-16')""")
def _(b):
    log = b.log("log")
    before = F.col("ingested_at") < F.lit(MID_LOG).cast("timestamp_ntz")
    low, high = log.agg(F.max(F.when(before, F.col("seq"))), F.max("seq")).first()
    return cdc.all_changes(log, low, high)


@query("distinct_label_catalog", "kind label es_borrado ingested_at:t",
       """SELECT 'channel' AS kind, canal_id AS label, es_borrado, ingested_at FROM s_canales
UNION ALL SELECT 'category', categoria_id, es_borrado, ingested_at FROM s_categorias""")
def _(b):
    channels, categories = b.silver["slv_canales"], b.silver["slv_categorias"]
    return (channels.select(F.lit("channel").alias("kind"), F.col("canal_id").alias("label"), "es_borrado", "ingested_at")
            .unionByName(categories.select(F.lit("category").alias("kind"), F.col("categoria_id").alias("label"),
                                           "es_borrado", "ingested_at")))


@query("dedup_exact_payment", "payment_id invoice_id payment_date:d payment_amount",
       """SELECT * FROM x_payments p WHERE NOT EXISTS (SELECT 1 FROM x_payments o WHERE o.invoice_id = p.invoice_id
  AND o.payment_date = p.payment_date AND o.payment_amount = p.payment_amount AND o.payment_id < p.payment_id)""")
def _(b):
    payments = cdc.latest_event(b.log("payments"), ["payment_id"])
    return cdc.dedup_business(payments, ["invoice_id", "payment_date", "payment_amount"], "payment_id")


@query("dedup_supplier_payment", "duplicate_id original_id supplier_invoice_id payment_date:d payment_amount",
       """SELECT p.supplier_payment_id AS duplicate_id, o.first_id AS original_id, p.supplier_invoice_id,
  p.payment_date, p.payment_amount FROM x_supplier_payments p
JOIN (SELECT supplier_invoice_id, payment_date, payment_amount, min(supplier_payment_id) AS first_id
  FROM x_supplier_payments GROUP BY ALL) o ON o.supplier_invoice_id = p.supplier_invoice_id
  AND o.payment_date = p.payment_date AND o.payment_amount = p.payment_amount
WHERE p.supplier_payment_id <> o.first_id""")
def _(b):
    payments = cdc.latest_event(b.log("supplier_payments"), ["supplier_payment_id"])
    return cdc.duplicate_rows(payments, ["supplier_invoice_id", "payment_date", "payment_amount"], "supplier_payment_id")


@query("dedup_normalised_customer", "customer_id company_name customer_segment contact_email",
       """SELECT * FROM x_customers c WHERE customer_id IN (SELECT customer_id FROM b_sales_orders)
  OR NOT EXISTS (SELECT 1 FROM x_customers o WHERE upper(trim(o.company_name)) = upper(trim(c.company_name))
    AND o.customer_segment = c.customer_segment AND upper(trim(o.contact_email)) = upper(trim(c.contact_email))
    AND o.customer_id < c.customer_id)""")
def _(b):
    customers = cdc.latest_event(b.log("customers"), ["customer_id"])
    return cdc.dedup_normalised(customers, "customer_id", ["company_name", "customer_segment", "contact_email"],
                                [b.log("sales_orders").select("customer_id")])


@query("idempotent_replay", PRODUCT, "SELECT * FROM x_products")
def _(b):
    log = b.log("products")
    table = KeyedTable(b.spark, fresh_dir(b.spark, "table"), ["product_id"])
    late = F.col("ingested_at") > F.lit(SPLIT).cast("timestamp_ntz")
    for batch_id, rows in ((1, log.filter(~late)), (2, log.filter(late)), (2, log.filter(late))):
        table.upsert(cdc.latest_event(rows, ["product_id"]), batch_id)
    table.compact()
    table.upsert(cdc.latest_event(log.filter(~late), ["product_id"]), 1)
    return table.read()
