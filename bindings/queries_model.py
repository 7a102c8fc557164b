"""Silver models, dimensions, the fact, incremental control."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from bindings import sql as q
from bindings.binding import AS_OF, SPLIT
from bindings.queries_ingest import CONTROL, CUSTOMER, SWEEP_SQL, control_frame, swept
from bindings.registry import query
from starloom.contracts import CUSTOMER_CHECKED, ENTITIES
from starloom.operators import control, scd
from starloom.operators.fact import changed_lines, fact_incremental, fact_sales
from starloom.plans import silver
from starloom.plans.ingest import Ingest, run_ingest
from starloom.plans.microbatch import MARK_OF, Warehouse, run_microbatch
from starloom.session import fresh_dir
from starloom.sources.bronze import newer_than
from starloom.sources.tables import list_folders
from starloom.streaming.warehouse import start_warehouse


def until_split():
    return F.col("ingested_at") <= F.lit(SPLIT).cast("timestamp_ntz")


# ---- Silver ---------------------------------------------------------------------------------

query("slv_customers", CUSTOMER, "SELECT * FROM s_clientes")(lambda b: b.silver["slv_clientes"])
query("slv_categories", "categoria_id categoria_nombre categoria_padre_id categoria_padre_nombre actualizado_en:t "
      "es_borrado ingested_at:t", "SELECT * FROM s_categorias")(lambda b: b.silver["slv_categorias"])
PRODUCT = ("producto_id sku nombre_producto categoria_id categoria_nombre categoria_padre_id categoria_padre_nombre "
           "marca costo_unitario:m precio_unitario:m margen_unitario:m activo actualizado_en:t es_borrado ingested_at:t")
query("slv_products", PRODUCT, "SELECT * FROM s_productos")(lambda b: b.silver["slv_productos"])
query("slv_channels", "canal_id canal_nombre canal_tipo actualizado_en:t es_borrado ingested_at:t",
      "SELECT * FROM s_canales")(lambda b: b.silver["slv_canales"])
query("slv_branches", "sucursal_id sucursal_nombre ciudad region pais actualizado_en:t es_borrado ingested_at:t",
      "SELECT * FROM s_sucursales")(lambda b: b.silver["slv_sucursales"])
ORDER = ("venta_id cliente_id canal_id sucursal_id fecha_venta:t fecha_key estado es_venta_efectiva moneda "
         "actualizado_en:t es_borrado ingested_at:t")
query("slv_orders", ORDER, "SELECT * FROM s_ventas")(lambda b: b.silver["slv_ventas"])
query("slv_order_lines", "venta_detalle_id venta_id producto_id cantidad precio_unitario:m descuento:m importe_origen:m "
      "importe_calculado:m importe:m diferencia_importe:m tiene_descuadre actualizado_en:t es_borrado ingested_at:t",
      "SELECT * FROM s_detalle")(lambda b: b.silver["slv_venta_detalle"])

# ---- dimensions -----------------------------------------------------------------------------

DATE = ("fecha_key fecha:d anio trimestre mes dia dia_del_anio semana_anio dia_semana mes_nombre dia_semana_nombre "
        "anio_mes anio_trimestre primer_dia_mes:d ultimo_dia_mes:d es_fin_semana es_fin_de_mes es_pasado ingested_at:t")
query("dim_date", DATE, "SELECT * FROM d_fecha")(lambda b: b.dim_date)


@query("dim_scd1", "dimension clave clave_natural nombre es_borrado ingested_at:t",
       """SELECT 'canal' AS dimension, canal_key AS clave, canal_id AS clave_natural, canal_nombre AS nombre, es_borrado,
  ingested_at FROM d_canal
UNION ALL SELECT 'sucursal', sucursal_key, sucursal_id, sucursal_nombre, es_borrado, ingested_at FROM d_sucursal""")
def _(b):
    canal, sucursal = b.gold["canal"], b.gold["sucursal"]

    def shape(df, name, key, natural, label):
        return df.select(F.lit(name).alias("dimension"), F.col(key).alias("clave"), F.col(natural).alias("clave_natural"),
                         F.col(label).alias("nombre"), "es_borrado", "ingested_at")
    return shape(canal, "canal", "canal_key", "canal_id", "canal_nombre").unionByName(
        shape(sucursal, "sucursal", "sucursal_key", "sucursal_id", "sucursal_nombre"))


def customers_until(b, moment):
    """Customer state at a moment, as a microbatch job would have seen it."""
    log = b.log("customers").filter(F.col("ingested_at") <= F.lit(moment).cast("timestamp_ntz"))
    return silver.slv_customers(log)


T1, T2, T3 = datetime(1996, 1, 1), datetime(1997, 1, 1), datetime(1999, 1, 1)
SNAP = "cliente_id nombre_completo email telefono pais ciudad es_borrado ingested_at:t valid_from:t valid_to:t"


def state_sql(moment: datetime, gone: str = "FALSE") -> str:
    model = q.customer_model(f"({q.newest('customers', f'''(SELECT * FROM b_customers WHERE ingested_at <= TIMESTAMP '{moment}')''')})")
    return f"(SELECT * FROM ({model}) WHERE NOT ({gone}))"


STATE = " || ".join(f"coalesce(CAST({{a}}.{c} AS VARCHAR), '~') || '^'" for c in q.CUSTOMER_CHECK)


def fold_sql(moments, gone="FALSE") -> str:
    """Versions from the states at the given moments, as an interval computation rather than a fold."""
    states = " UNION ALL ".join(
        f"SELECT *, {i} AS i, TIMESTAMP '{m}' AS seen FROM {state_sql(m, gone if i == len(moments) - 1 else 'FALSE')}"
        for i, m in enumerate(moments))
    return f"""SELECT s.*, seen AS valid_from,
  coalesce(lead(seen) OVER (PARTITION BY cliente_id ORDER BY seen), CASE WHEN missing THEN TIMESTAMP '{moments[-1]}' END)
  AS valid_to FROM (SELECT *, lag(x) OVER (PARTITION BY cliente_id ORDER BY i) AS before,
    cliente_id NOT IN (SELECT cliente_id FROM {state_sql(moments[-1], gone)}) AS missing
  FROM (SELECT a.*, {STATE.format(a='a')} AS x FROM ({states}) a)) s WHERE before IS NULL OR before <> x"""


def folded(b, moments, last=lambda df: df, **options):
    history = None
    for m in moments:
        state = customers_until(b, m).drop("actualizado_en")
        state = last(state) if m == moments[-1] else state
        history = scd.snapshot_check(history, state, "cliente_id", CUSTOMER_CHECKED, m, **options)
    return history


@query("snapshot_check", SNAP, fold_sql([T1, T2, T3]))
def _(b):
    return folded(b, [T1, T2, T3])


@query("snapshot_hard_deletes", SNAP, fold_sql([T1, T2], "pais = 'UNITED KINGDOM'"))
def _(b):
    # In the last state one country's customers are missing.
    return folded(b, [T1, T2], lambda df: df.filter(~F.col("pais").eqNullSafe("UNITED KINGDOM")))


@query("snapshot_ignore_columns", "cliente_id versions:i phones:i",
       """SELECT h.cliente_id, count(*) AS versions, any_value(p.n) AS phones FROM hn_clientes h
JOIN (SELECT cliente_id, count(DISTINCT coalesce(telefono, '')) AS n FROM e_clientes GROUP BY 1) p USING (cliente_id)
GROUP BY 1""")
def _(b):
    events = silver.clean_customers(b.log("customers"))
    phones = events.groupBy("cliente_id").agg(F.countDistinct(F.coalesce("telefono", F.lit(""))).alias("phones"))
    versions = b.customer_history(False).groupBy("cliente_id").agg(F.count("*").alias("versions"))
    return versions.join(phones, "cliente_id")


DIM_CUSTOMER = ("cliente_key cliente_id nombre apellido nombre_completo email telefono pais ciudad email_valido creado_en:t "
                "es_borrado valido_desde:t valido_hasta:t es_version_vigente ingested_at:t")
DIM_PRODUCT = ("producto_key producto_id sku nombre_producto categoria_id categoria_nombre categoria_padre_id "
               "categoria_padre_nombre marca costo_unitario:m precio_unitario:m margen_unitario:m activo es_borrado "
               "valido_desde:t valido_hasta:t es_version_vigente ingested_at:t")
query("dim_scd2", DIM_CUSTOMER, "SELECT * FROM d_cliente")(lambda b: b.gold["cliente"])
query("dim_scd2_product", DIM_PRODUCT, "SELECT * FROM d_producto")(lambda b: b.gold["producto"])


@query("unknown_member", "dimension clave clave_natural desde:t hasta:t", """SELECT * FROM (
SELECT 'cliente' AS dimension, cliente_key AS clave, cliente_id AS clave_natural, valido_desde AS desde, valido_hasta AS hasta
FROM d_cliente UNION ALL SELECT 'producto', producto_key, producto_id, valido_desde, valido_hasta FROM d_producto)
WHERE clave_natural = '-1'""")
def _(b):
    def shape(df, name, key, natural):
        return df.filter(F.col(natural) == "-1").select(
            F.lit(name).alias("dimension"), F.col(key).alias("clave"), F.col(natural).alias("clave_natural"),
            F.col("valido_desde").alias("desde"), F.col("valido_hasta").alias("hasta"))
    return shape(b.gold["cliente"], "cliente", "cliente_key", "cliente_id").unionByName(
        shape(b.gold["producto"], "producto", "producto_key", "producto_id"))


HISTORY = "cliente_id nombre_completo email telefono pais ciudad email_valido es_borrado valid_from:t valid_to:t"
query("scd2_from_changelog", HISTORY, "SELECT * FROM hn_clientes")(lambda b: b.customer_history(False))


@query("scd2_from_changelog_product", "producto_id nombre_producto categoria_id marca costo_unitario:m precio_unitario:m "
       "activo es_borrado valid_from:t valid_to:t", "SELECT * FROM h_productos")
def _(b):
    return b.product_history(True)


@query("point_in_time", DIM_CUSTOMER, f"""SELECT * FROM d_cliente
WHERE valido_desde <= {q.SPLIT} AND valido_hasta > {q.SPLIT}""")
def _(b):
    return scd.point_in_time(b.gold["cliente"], SPLIT)


# ---- fact -----------------------------------------------------------------------------------

FACT = ("venta_detalle_id venta_id fecha_key cliente_key producto_key canal_key sucursal_key cliente_id producto_id "
        "canal_id sucursal_id fecha_venta:t cantidad precio_unitario:m descuento:m importe:m costo:m margen:m "
        "tiene_descuadre ingested_at:t")
query("fact_build", FACT, "SELECT * FROM f_ventas")(lambda b: b.fact())
query("fact_cost_margin", "venta_detalle_id cantidad importe:m costo:m margen:m", "SELECT * FROM fn_ventas")(
    lambda b: b.fact(b.dims(backdate_first=False)))


@query("fact_incremental", FACT, "SELECT * FROM f_ventas")
def _(b):
    # The fact as of the split, then one batch over everything that changed since: it must equal a
    # full build. The early fact sees only events up to the split.
    inputs = {"sales_order_lines": silver.LINE_INPUT, "sales_orders": silver.ORDER_INPUT, "invoices": silver.INVOICE_INPUT, "shipments": silver.SHIPMENT_INPUT}
    early_logs, logs = zip(*(silver.newest_as_of(b.log(e), ENTITIES[e].key, columns, SPLIT) for e, columns in inputs.items()))
    early = fact_sales(silver.slv_order_lines(early_logs[0]), silver.slv_orders(*early_logs[1:]), b.gold)
    lines, headers = silver.slv_order_lines(logs[0]), silver.slv_orders(*logs[1:])
    # A late invoice or shipment re-dates its order, so those orders count as changed headers.
    dated = (newer_than(b.log("invoices"), SPLIT).select("sales_order_id")
             .unionByName(newer_than(b.log("shipments"), SPLIT).select("sales_order_id")))
    changed = changed_lines(lines, headers, SPLIT, dated)
    rows = fact_sales(lines.join(changed, "venta_detalle_id", "left_semi"), headers, b.gold)
    return fact_incremental(early, changed, rows)


@query("late_dimension", "sucursal_id lineas:i sin_maestro:i",
       """SELECT sucursal_id, count(*) AS lineas, count(*) FILTER (sucursal_key = -1) AS sin_maestro
FROM f_ventas GROUP BY 1""")
def _(b):
    return b.fact().groupBy("sucursal_id").agg(
        F.count("*").alias("lineas"), F.count_if(F.col("sucursal_key") == -1).alias("sin_maestro"))


# ---- incremental control --------------------------------------------------------------------

WATERMARK = "layer_name entity_name last_seq:i last_loaded_at:t last_run_id rows_last_batch:i updated_at:t"


def watermarks(b):
    marks = control.empty_watermarks(b.spark)
    marks = control.update_watermark(marks, "bronze", "sales_orders", b.log("products"), "run-0", T1, seq="seq")
    marks = control.update_watermark(marks, "bronze", "sales_orders", b.log("sales_orders"), "run-1", AS_OF, seq="seq")
    return control.update_watermark(marks, "silver", "slv_venta_detalle", b.silver["slv_venta_detalle"], "run-1", AS_OF)


@query("watermark_update", WATERMARK, f"""SELECT 'bronze' AS layer_name, 'sales_orders' AS entity_name, max(seq) AS last_seq,
  max(ingested_at) AS last_loaded_at, 'run-1' AS last_run_id, count(*) AS rows_last_batch, {q.AS_OF} AS updated_at
FROM b_sales_orders UNION ALL SELECT 'silver', 'slv_venta_detalle', NULL, max(ingested_at), 'run-1', count(*), {q.AS_OF}
FROM s_detalle""")
def _(b):
    return watermarks(b)


@query("watermark_get", "entity watermark:t", """SELECT 'slv_venta_detalle' AS entity,
  max(ingested_at) - INTERVAL 15 MINUTE AS watermark FROM s_detalle UNION ALL SELECT 'new', TIMESTAMP '1900-01-01'""")
def _(b):
    marks = watermarks(b)
    known = control.watermark_frame(marks, "silver", "slv_venta_detalle")
    new = control.watermark_frame(marks, "silver", "slv_clientes")
    return known.select(F.lit("slv_venta_detalle").alias("entity"), "watermark").unionByName(
        new.select(F.lit("new").alias("entity"), "watermark"))


@query("watermark_get_seq", "entity watermark_seq:i",
       "SELECT 'sales_orders' AS entity, max(seq) AS watermark_seq FROM b_sales_orders UNION ALL SELECT 'new', 0")
def _(b):
    marks = watermarks(b)
    known = control.watermark_frame(marks, "bronze", "sales_orders")
    new = control.watermark_frame(marks, "bronze", "products")
    return known.select(F.lit("sales_orders").alias("entity"), "watermark_seq").unionByName(
        new.select(F.lit("new").alias("entity"), "watermark_seq"))


@query("checkpoint_commit", "entity_name last_seq last_extracted_at:t rows_last_batch active updated_at:t",
       "SELECT c.entity_name, coalesce(d.new_seq, c.last_seq) AS last_seq, "
       f"CASE WHEN d.new_seq IS NOT NULL THEN {q.AS_OF} END AS last_extracted_at, d.rows_copied AS rows_last_batch, "
       f"c.active, {q.AS_OF} AS updated_at FROM (VALUES "
       + ", ".join(f"('{e}', {'NULL' if s is None else s}, {str(a).upper()})" for e, s, a in CONTROL)
       + f") c(entity_name, last_seq, active) LEFT JOIN ({SWEEP_SQL}) d USING (entity_name)")
def _(b):
    return control.commit_batch(control_frame(b), swept(b), AS_OF)


@query("run_log", "run_id pipeline_name layer_name entity_name status rows_affected:i error_message logged_at:t",
       f"""SELECT 'run-7' AS run_id, 'ingest' AS pipeline_name, 'bronze' AS layer_name, entity_name,
  'SUCCEEDED' AS status, rows_copied AS rows_affected, CAST(NULL AS VARCHAR) AS error_message, {q.AS_OF} AS logged_at
FROM ({SWEEP_SQL})""")
def _(b):
    return control.run_rows(swept(b), "ingest", "bronze", "SUCCEEDED", "run-7", AS_OF)


# Two microbatches over folders on disk; the second starts from the watermarks of the first. Every line finds the first
# version of its customer and product, as later ones begin when the second batch runs, after all sales. A placeholder e-mail
# address is an error by the declared rules; this warehouse only warns of it.
FACT = ("venta_detalle_id venta_id fecha_key cliente_key producto_key canal_key sucursal_key cliente_id producto_id canal_id "
        "sucursal_id fecha_venta:t cantidad precio_unitario:m descuento:m importe:m costo:m margen:m tiene_descuadre ingested_at:t")
JOB_SQL = """SELECT l.venta_detalle_id, l.venta_id, coalesce(h.fecha_key, -1) AS fecha_key, coalesce(c.k, -1) AS cliente_key,
  coalesce(p.k, -1) AS producto_key, coalesce(n.canal_key, -1) AS canal_key, coalesce(s.sucursal_key, -1) AS sucursal_key,
  h.cliente_id, l.producto_id, h.canal_id, h.sucursal_id, h.fecha_venta, l.cantidad, l.precio_unitario, l.descuento, l.importe,
  CAST(l.cantidad * coalesce(p.costo_unitario, 0) AS DECIMAL(19,4)) AS costo,
  CAST(l.importe - l.cantidad * coalesce(p.costo_unitario, 0) AS DECIMAL(19,4)) AS margen, l.tiene_descuadre,
  greatest(l.ingested_at, h.ingested_at) AS ingested_at
FROM (SELECT * EXCLUDE (fecha_key) FROM eligible) l JOIN s_ventas h USING (venta_id)
LEFT JOIN (SELECT DISTINCT cliente_id, """ + q.key("cliente_id", "'1900-01-01 00:00:00.000'") + """ AS k FROM s_clientes) c
  ON c.cliente_id = h.cliente_id AND h.fecha_venta IS NOT NULL
LEFT JOIN (SELECT producto_id, """ + q.key("producto_id", "'1900-01-01 00:00:00.000'") + """ AS k, costo_unitario FROM s_productos) p
  ON p.producto_id = l.producto_id AND h.fecha_venta IS NOT NULL
LEFT JOIN d_canal n ON n.canal_id = h.canal_id LEFT JOIN d_sucursal s ON s.sucursal_id = h.sucursal_id"""
PLACEHOLDER_EMAIL = "not_accepted_values_slv_clientes_email"


def new_warehouse(b):
    return Warehouse(b.spark, fresh_dir(b.spark, "warehouse"), calendar=("1995-01-01", "2001-12-31"), tolerated=(PLACEHOLDER_EMAIL,))


@query("microbatch_job", FACT, JOB_SQL)
def _(b):
    wh = new_warehouse(b)
    for batch_id, (low, high, as_of) in enumerate([(None, SPLIT, AS_OF), (SPLIT, None, datetime(2002, 6, 1))], start=1):
        for entity in MARK_OF:
            rows = b.log(entity)
            if low is not None:
                rows = newer_than(rows, low)
            if high is not None:
                rows = rows.filter(until_split())
            # One folder per batch: the dates of this data go back years, one folder each is for daily loads.
            rows.write.mode("overwrite").parquet(f"{wh.root}/bronze/{entity}/batch={batch_id}")
        outcome = run_microbatch(wh, batch_id, as_of)
        if outcome["failed"]:
            raise RuntimeError(f"batch {batch_id} stopped: {outcome['failed']}")
    return wh.read("fact_ventas")


@query("stream_microbatch_job", FACT, JOB_SQL)
def _(b):
    # Three parts of the logs arrive one after another; the stream is started anew for each, from one checkpoint.
    wh = new_warehouse(b)
    bounds = [None, datetime(1996, 1, 1), SPLIT, None]
    for part, (low, high) in enumerate(zip(bounds, bounds[1:]), start=1):
        for entity in MARK_OF:
            rows = b.log(entity) if low is None else newer_than(b.log(entity), low)
            if high is not None:
                rows = rows.filter(F.col("ingested_at") <= F.lit(high).cast("timestamp_ntz"))
            rows.write.mode("overwrite").parquet(f"{wh.root}/bronze/{entity}/part={part}")
        start_warehouse(wh, f"{wh.root}/checkpoint", lambda n: datetime(2002, n, 1), every=None).awaitTermination()
    return wh.read("fact_ventas")


# Five entities in three sweeps: one fails in the first and is repeated over the same range though its log has grown, one is
# idle, one is inactive, one grows.
INGEST = {"customers": (None, True), "suppliers": (10**12, True), "returns": (None, False), "sales_orders": (40, True), "products": (None, True)}
GROWN = {"sales_orders": 5000, "products": 900}  # the log's end in the first sweep
INGEST_SQL = " UNION ALL ".join(f"""SELECT '{e}' AS entity_name, {str(on).upper()} AS active, {last} AS last_seq, {rows} AS rows_last_batch,
  {landed} AS landed_rows, {landed} AS landed_distinct, {folders} AS landed_ranges FROM {'b_' + e if folders else '(SELECT 1)'}""" for e, on, last, rows, landed, folders in [
    ("customers", True, "max(seq)", "count(*)", "count(*)", 1), ("suppliers", True, 10**12, "NULL", 0, 0), ("returns", False, "NULL", "NULL", 0, 0),
    ("sales_orders", True, "max(seq)", "count(*) FILTER (seq > (SELECT max(seq) FROM b_sales_orders WHERE seq <= 5000))", "count(*) FILTER (seq > 40)", 2),
    ("products", True, "max(seq)", "count(*) FILTER (seq > (SELECT max(seq) FROM b_products WHERE seq <= 900))", "count(*)", 2)])


@query("ingest_job", "entity_name active last_seq:i rows_last_batch:i landed_rows:i landed_distinct:i landed_ranges:i", INGEST_SQL)
def _(b):
    job = Ingest(b.spark, fresh_dir(b.spark, "ingest"), by_date=False)  # each range of this data spans years
    job.register([(e, f"dbo_{e}", last, on) for e, (last, on) in INGEST.items()], AS_OF)

    def source(entity, sweep):
        rows = b.log(entity)
        if sweep == 1 and entity in GROWN:
            rows = rows.filter(F.col("seq") <= GROWN[entity])
        if sweep == 1 and entity == "sales_orders":  # the copy breaks off after its range is known
            rows = rows.withColumn("customer_id", F.when(F.col("seq") == F.lit(50), F.raise_error(F.lit("source lost"))).otherwise(F.col("customer_id")))
        return lambda: rows

    for sweep in (1, 2, 3):
        run_ingest(job, {e: source(e, sweep) for e in INGEST}, sweep, AS_OF)
    landed = None
    for e in INGEST:
        path = f"{job.bronze}/{e}"
        if list_folders(b.spark, path):
            one = b.spark.read.parquet(path).select(F.lit(e).alias("entity_name"), "seq", F.to_json(F.struct(*ENTITIES[e].change_schema.names)).alias("row"), "batch")
            landed = one if landed is None else landed.unionByName(one)
    counts = landed.groupBy("entity_name").agg(F.count("*").alias("landed_rows"), F.count_distinct("seq", "row").alias("landed_distinct"), F.count_distinct("batch").alias("landed_ranges"))
    return job.control.read().join(counts, "entity_name", "left").fillna(0, ["landed_rows", "landed_distinct", "landed_ranges"])
