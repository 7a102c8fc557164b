"""Assertions, reconciliation, monitoring."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from bindings import sql as q
from bindings.binding import AS_OF, SPLIT
from bindings.queries_relational import (EVENTS, EVENTS_SQL, QUALITY_SQL, RECON, RECON_SQL, SOURCES, STAR, STAR_SQL,
                                         all_events, completeness_sql, quality_entries, source_counts, star_dims)
from bindings.registry import query
from starloom.contracts import DOMAINS, ENTITIES, SLA_MINUTES
from starloom.functions import repair
from starloom.functions.keys import month_of_key
from starloom.operators import joins, monitor, profile, quality
from starloom.operators.cdc import latest_event
from starloom.operators.control import table_watermark
from starloom.operators.fact import eligible_lines
from starloom.plans.rules import BRONZE_RULES, GOLD_RULES, SILVER_RULES
from starloom.session import fresh_dir


# ---- generic assertions: the failing rows ----------------------------------------------------


@query("dq_not_null", "venta_id fecha_venta:t canal_id", "SELECT * FROM s_ventas WHERE canal_id IS NULL")
def _(b):
    return quality.not_null(b.silver["slv_ventas"], "canal_id")


@query("dq_unique", "sales_order_line_id rows:i",
       "SELECT sales_order_line_id, count(*) AS rows FROM b_sales_order_lines GROUP BY 1 HAVING count(*) > 1")
def _(b):
    return quality.unique(b.log("sales_order_lines"), ["sales_order_line_id"])


@query("dq_unique_combination", "venta_id producto_id rows:i", """SELECT venta_id, producto_id, count(*) AS rows
FROM s_detalle GROUP BY 1, 2 HAVING count(*) > 1""")
def _(b):
    return quality.unique(b.silver["slv_venta_detalle"], ["venta_id", "producto_id"], ignore_null=False)


def _domain_sql(entity: str, column: str) -> str:
    values = ", ".join("'" + v + "'" for v in DOMAINS[(entity, column)])
    return (f"SELECT '{entity}.{column}' AS domain, {column} AS value, count(*) AS rows FROM b_{entity} "
            f"WHERE {column} NOT IN ({values}) GROUP BY {column}")


@query("dq_accepted_values", "domain value rows:i", " UNION ALL ".join(_domain_sql(*d) for d in DOMAINS))
def _(b):
    parts = None
    for (entity, column), values in DOMAINS.items():
        one = (quality.accepted(b.log(entity), column, values).groupBy(F.col(column).alias("value"))
               .agg(F.count("*").alias("rows")).select(F.lit(f"{entity}.{column}").alias("domain"), "value", "rows"))
        parts = one if parts is None else parts.unionByName(one)
    return parts


@query("dq_not_accepted_values", "cliente_id email", """SELECT cliente_id, email FROM s_clientes
WHERE email IN ('n/a', 'na', 'none', 'null')""")
def _(b):
    return quality.forbidden(b.silver["slv_clientes"], "email", ["n/a", "na", "none", "null"])


@query("dq_accepted_range", "producto_id margen_unitario:m", "SELECT * FROM s_productos WHERE margen_unitario > 0.5 OR margen_unitario < -5")
def _(b):
    return quality.in_range(b.silver["slv_productos"], "margen_unitario", -5, 0.5)


@query("dq_relationships", "venta_id sucursal_id", """SELECT venta_id, sucursal_id FROM s_ventas v
WHERE sucursal_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM s_sucursales s WHERE s.sucursal_id = v.sucursal_id)""")
def _(b):
    return quality.relationship(b.silver["slv_ventas"], "sucursal_id", b.silver["slv_sucursales"], "sucursal_id")


# ---- invariants of the star -------------------------------------------------------------------

def spoiled(dim, natural):
    """A dimension whose closed versions of some keys were left open, to see the invariants fail."""
    stuck = ~F.col("es_version_vigente") & F.col(natural).like("%5")
    return dim.withColumns({
        "valido_hasta": F.when(stuck, F.lit("9999-12-31").cast("timestamp_ntz")).otherwise(F.col("valido_hasta")),
        "es_version_vigente": F.col("es_version_vigente") | stuck})


SPOILED = """(SELECT * REPLACE (CASE WHEN NOT es_version_vigente AND {n} LIKE '%5' THEN TIMESTAMP '9999-12-31'
  ELSE valido_hasta END AS valido_hasta, es_version_vigente OR {n} LIKE '%5' AS es_version_vigente) FROM {d})"""
BOTH = (("cliente", "cliente_id", "d_cliente"), ("producto", "producto_id", "d_producto"))


@query("dq_one_current_version", "dimension clave versiones_vigentes:i", " UNION ALL ".join(
    f"""SELECT '{d}' AS dimension, {n} AS clave, count(*) AS versiones_vigentes FROM {SPOILED.format(n=n, d=t)}
WHERE es_version_vigente AND {n} <> '-1' GROUP BY 2 HAVING count(*) > 1""" for d, n, t in BOTH))
def _(b):
    parts = [quality.one_current(spoiled(b.gold[d], n), n).withColumn("dimension", F.lit(d)) for d, n, _ in BOTH]
    return parts[0].unionByName(parts[1])


@query("dq_no_overlap", "dimension clave_natural valido_desde:t valido_hasta:t", " UNION ALL ".join(
    f"""SELECT DISTINCT '{d}' AS dimension, a.{n} AS clave_natural, a.valido_desde, a.valido_hasta
FROM {SPOILED.format(n=n, d=t)} a JOIN {SPOILED.format(n=n, d=t)} b ON a.{n} = b.{n} AND a.valido_desde <> b.valido_desde
  AND a.valido_desde < b.valido_hasta AND b.valido_desde < a.valido_hasta WHERE a.{n} <> '-1'""" for d, n, t in BOTH))
def _(b):
    parts = [quality.no_overlap(spoiled(b.gold[d], n), n).withColumn("dimension", F.lit(d)) for d, n, _ in BOTH]
    return parts[0].unionByName(parts[1])


@query("dq_fact_not_duplicated", "filas_gold:i filas_silver:i fanned_out", f"""SELECT g.n AS filas_gold, s.n AS filas_silver,
  g.n > s.n AS fanned_out FROM (SELECT count(*) AS n FROM ({q.fact_model('dd_cliente')})) g,
  (SELECT count(*) AS n FROM eligible) s""".replace("dd_cliente", SPOILED.format(n="cliente_id", d="d_cliente")))
def _(b):
    # Looked up in a dimension with overlapping versions, the fact gains rows.
    dims = {**b.gold, "cliente": spoiled(b.gold["cliente"], "cliente_id")}
    lines, headers = b.silver["slv_venta_detalle"], b.silver["slv_ventas"]
    counts = joins.compare_counts(b.fact(dims), eligible_lines(lines, headers), "filas_gold", "filas_silver")
    return counts.withColumn("fanned_out", F.col("filas_gold") > F.col("filas_silver"))


# ---- reconciliation ---------------------------------------------------------------------------

PAIRS = {"clientes": ("customers", "slv_clientes", "s_clientes", "cliente_id"),
         "productos": ("products", "slv_productos", "s_productos", "producto_id"),
         "ventas": ("sales_orders", "slv_ventas", "s_ventas", "venta_id"),
         "detalle": ("sales_order_lines", "slv_venta_detalle", "s_detalle", "venta_detalle_id")}


@query("recon_bronze_silver", "entidad claves_bronze:i filas_silver:i faltan:i", " UNION ALL ".join(
    f"""SELECT '{n}' AS entidad, (SELECT count(DISTINCT {ENTITIES[e].key}) FROM b_{e} WHERE cdc_operation IN ('I', 'U'))
  AS claves_bronze, (SELECT count(*) FROM {t}) AS filas_silver,
  (SELECT count(*) FROM (SELECT DISTINCT {ENTITIES[e].key} AS k FROM b_{e} WHERE cdc_operation IN ('I', 'U'))
   WHERE k NOT IN (SELECT {k} FROM {t})) AS faltan""" for n, (e, _, t, k) in PAIRS.items()))
def _(b):
    return monitor.recon_bronze_silver({
        name: (b.log(entity), ENTITIES[entity].key, b.silver[table], key)
        for name, (entity, table, _, key) in PAIRS.items()})


DAILY_SQL = "SELECT * RENAME (p AS fecha_key) FROM (" + RECON_SQL.format(
    period="coalesce(s.k, g.k)", sk="coalesce(fecha_key, -1)", gk="fecha_key", gold="f_ventas") + ")"


@query("recon_silver_gold_daily", "fecha_key " + RECON, DAILY_SQL)
def _(b):
    return monitor.recon_silver_gold(b.silver["slv_venta_detalle"], b.silver["slv_ventas"], b.fact())


@query("recon_silver_gold_monthly", "anio_mes " + RECON + " veredicto",
       "SELECT * RENAME (p AS anio_mes), CASE WHEN is_match THEN 'OK' ELSE 'DESCUADRE' END AS veredicto FROM ("
       + RECON_SQL.format(period="coalesce(s.k, g.k)", sk="trunc(coalesce(fecha_key, -1) / 100)::INT",
                          gk="trunc(fecha_key / 100)::INT",
                          gold=f"(SELECT * FROM f_ventas WHERE ingested_at <= {q.SPLIT} + INTERVAL 365 DAY)") + ")")
def _(b):
    # Only what had arrived a year after the split is in this fact, so later months differ.
    arrived = b.fact().filter(F.col("ingested_at") <= F.lit(SPLIT + timedelta(days=365)).cast("timestamp_ntz"))
    recon = monitor.recon_silver_gold(b.silver["slv_venta_detalle"], b.silver["slv_ventas"], arrived,
                                      period=month_of_key, name="anio_mes")
    return recon.withColumn("veredicto", F.when(F.col("is_match"), "OK").otherwise("DESCUADRE"))


query("star_integrity", STAR, STAR_SQL.format(fact="f_ventas"))(
    lambda b: monitor.star_integrity(b.fact(), star_dims(b)))


@query("bronze_completeness", "entidad filas_oltp:i claves:i veredicto", completeness_sql())
def _(b):
    observed = profile.distinct_keys({e: (b.log(e), ENTITIES[e].key) for e in SOURCES})
    return joins.completeness(source_counts(b), observed, "entidad", "filas_oltp", "claves")


# ---- freshness and health -----------------------------------------------------------------------

TICK = "TIMESTAMP '2024-01-31 00:20:00'"


def tick():
    return F.lit("2024-01-31 00:20:00").cast("timestamp_ntz")


@query("bronze_freshness", EVENTS + " minutos_sin_datos:i estado", f"""SELECT *,
  {q.minutes('ultimo_microlote', TICK)} AS minutos_sin_datos,
  CASE WHEN {q.minutes('ultimo_microlote', TICK)} > 30 THEN 'REVISAR' ELSE 'OK' END AS estado FROM ({EVENTS_SQL})""")
def _(b):
    return monitor.freshness(all_events(b), tick())


@query("source_freshness", "entidad max_loaded_at:t age_minutes:i status", f"""SELECT entidad, m AS max_loaded_at, a AS age_minutes,
  CASE WHEN a > 120 THEN 'error' WHEN a > 30 THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT entidad, m, {q.minutes('m', TICK)} AS a FROM (
  SELECT 'type_' || event_type AS entidad, max(ingested_at) AS m FROM b_log GROUP BY 1
  UNION ALL SELECT 'orders', max(ingested_at) FROM b_sales_orders))""")
def _(b):
    log = b.log("log").select(F.concat(F.lit("type_"), F.col("event_type")).alias("entidad"), "ingested_at")
    orders = b.log("sales_orders").select(F.lit("orders").alias("entidad"), "ingested_at")
    return monitor.source_freshness(log.unionByName(orders), tick())


# Entities of the quality log appear as tables with a watermark each: their last entry's time.
MARKS_SQL = """(SELECT 'silver' AS layer_name, 'slv_' || event_type AS entity_name, max(ts) AS last_loaded_at,
  count(*) AS rows_last_batch FROM events GROUP BY 2)"""


def event_watermarks(b):
    return b.table("events").groupBy(F.concat(F.lit("slv_"), F.col("event_type")).alias("entity_name")).agg(
        F.max("ts").alias("last_loaded_at"), F.count("*").alias("rows_last_batch")).withColumn("layer_name", F.lit("silver"))


@query("pipeline_health", "layer_name entity_name last_loaded_at:t rows_last_batch:i minutos_de_retraso:i estado_sla "
       "fallos_calidad_24h:i", f"""SELECT w.*, {q.minutes('last_loaded_at', q.AS_OF)} AS minutos_de_retraso,
  CASE WHEN {q.minutes('last_loaded_at', q.AS_OF)} > 30 THEN 'RETRASADO' ELSE 'OK' END AS estado_sla,
  (SELECT count(*) FROM {QUALITY_SQL} d WHERE d.entity_name = w.entity_name AND d.severity = 'error'
    AND d.detected_at > {q.AS_OF} - INTERVAL 1 DAY) AS fallos_calidad_24h FROM {MARKS_SQL} w""")
def _(b):
    return monitor.pipeline_health(event_watermarks(b), quality_entries(b), AS_OF)


@query("entity_sla_status", "layer_name entity_name last_loaded_at:t sla_minutes age_minutes:i status",
       f"""SELECT *, CASE WHEN sla_minutes IS NULL THEN 'NO SLA' WHEN age_minutes > sla_minutes THEN 'LATE' ELSE 'OK' END AS status
FROM (SELECT 'silver' AS layer_name, t.entity_name, t.m AS last_loaded_at, s.sla_minutes,
  {q.minutes('t.m', q.AS_OF)} AS age_minutes FROM (
  SELECT 'slv_ventas' AS entity_name, max(ingested_at) AS m FROM s_ventas
  UNION ALL SELECT 'slv_canales', max(ingested_at) FROM s_canales
  UNION ALL SELECT 'slv_sin_promesa', max(ingested_at) FROM s_sucursales) t
LEFT JOIN (VALUES {", ".join(f"('{k}', {v})" for k, v in SLA_MINUTES.items())}) s(entity_name, sla_minutes) USING (entity_name))""")
def _(b):
    marks = [table_watermark(b.silver[t], "silver", n, "run-1", AS_OF) for t, n in (
        ("slv_ventas", "slv_ventas"), ("slv_canales", "slv_canales"), ("slv_sucursales", "slv_sin_promesa"))]
    return monitor.sla_status(marks[0].unionByName(marks[1]).unionByName(marks[2]), monitor.sla_frame(b.spark), AS_OF)


# ---- the suite ------------------------------------------------------------------------------------

SUITE_TABLES = {"slv_clientes": "s_clientes", "slv_categorias": "s_categorias", "slv_productos": "s_productos",
              "slv_canales": "s_canales", "slv_sucursales": "s_sucursales", "slv_ventas": "s_ventas",
              "slv_venta_detalle": "s_detalle",
              "dim_fecha": "d_fecha", "dim_cliente": "d_cliente", "dim_producto": "d_producto", "dim_canal": "d_canal",
              "dim_sucursal": "d_sucursal", "fact_ventas": "f_ventas", **{e: f"b_{e}" for e in ENTITIES}}


def _literal(v) -> str:
    return str(v).upper() if isinstance(v, bool) else str(v) if isinstance(v, (int, float)) else "'" + v + "'"


def _rule_sql(r: quality.Rule) -> str:
    """Failing rows of one rule, counted by a query of its own."""
    t, c = SUITE_TABLES[r.table], r.column
    values = ", ".join(_literal(v) for v in r.args.get("values", []))
    low, high, closed = r.args.get("low"), r.args.get("high"), r.args.get("inclusive", True)
    failing = {
        "not_null": lambda: f"SELECT CAST({c} AS VARCHAR) AS v FROM {t} WHERE {c} IS NULL",
        "unique": lambda: f"SELECT CAST({c} AS VARCHAR) AS v FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1",
        "unique_combination": lambda: f"SELECT CAST({c} AS VARCHAR) AS v FROM {t} GROUP BY {c} HAVING count(*) > 1",
        "accepted_values": lambda: f"SELECT CAST({c} AS VARCHAR) AS v FROM {t} WHERE {c} NOT IN ({values})",
        "not_accepted_values": lambda: f"SELECT CAST({c} AS VARCHAR) AS v FROM {t} WHERE {c} IN ({values})",
        "range": lambda: f"SELECT CAST({c} AS VARCHAR) AS v FROM {t} WHERE "
                         + " OR ".join(x for x in (None if low is None else f"{c} {'<' if closed else '<='} {low}",
                                                   None if high is None else f"{c} {'>' if closed else '>='} {high}") if x),
        "relationship": lambda: f"SELECT CAST({c} AS VARCHAR) AS v FROM {t} WHERE {c} IS NOT NULL AND {c} NOT IN "
                                f"(SELECT {r.args['field']} FROM {SUITE_TABLES[r.args['to']]})",
    }[r.kind]()
    return (f"SELECT '{r.layer}' AS layer_name, '{r.table}' AS entity_name, '{r.name}' AS test_name, "
            f"'{r.severity}' AS severity, count(*) AS failed_rows, min(v) AS sample_value FROM ({failing})")


SUITE_SQL = " UNION ALL ".join(_rule_sql(r) for r in SILVER_RULES)
RESULT = "layer_name entity_name test_name severity failed_rows:i sample_value"


def silver_results(b):
    return quality.run_suite(b.silver, SILVER_RULES)


query("dq_suite_silver", RESULT, SUITE_SQL)(silver_results)


@query("dq_suite_bronze", RESULT, " UNION ALL ".join(_rule_sql(r) for r in BRONZE_RULES))
def _(b):
    return quality.run_suite({e: b.log(e) for e in ENTITIES}, BRONZE_RULES)


@query("dq_suite_gold", RESULT, " UNION ALL ".join(_rule_sql(r) for r in GOLD_RULES))
def _(b):
    dims = {f"dim_{n}": b.gold[n] for n in ("cliente", "producto", "canal", "sucursal")}
    return quality.run_suite({"dim_fecha": b.dim_date, **dims, "fact_ventas": b.fact()}, GOLD_RULES)


STORED = [r for r in SILVER_RULES if r.table in ("slv_clientes", "slv_productos", "slv_canales", "slv_ventas", "slv_sucursales")]
STORED_KEYS = {"slv_clientes": "cliente_id", "slv_productos": "producto_id", "slv_canales": "canal_id", "slv_ventas": "venta_id", "slv_sucursales": "sucursal_id"}


def _stored_sql(r: quality.Rule) -> str:
    """What one rule leaves behind: its failing rows by key, or its failing values with the number of rows."""
    t, c = SUITE_TABLES[r.table], r.column
    values = ", ".join(_literal(v) for v in r.args.get("values", []))
    head = f"SELECT '{r.table}' AS entity_name, '{r.name}' AS test_name, "
    if r.kind == "unique":
        return head + f"CAST({c} AS VARCHAR) AS key, 1 AS failed_rows FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1"
    if r.kind == "relationship":
        parent = f"(SELECT {r.args['field']} FROM {SUITE_TABLES[r.args['to']]})"
        return head + f"CAST({c} AS VARCHAR) AS key, count(*) AS failed_rows FROM {t} WHERE {c} IS NOT NULL AND {c} NOT IN {parent} GROUP BY {c}"
    broken = {"not_null": f"{c} IS NULL", "accepted_values": f"{c} NOT IN ({values})", "not_accepted_values": f"{c} IN ({values})",
              "range": f"{c} < {r.args.get('low')}" + (f" OR {c} > {r.args['high']}" if "high" in r.args else "")}[r.kind]
    return head + f"CAST({STORED_KEYS[r.table]} AS VARCHAR) AS key, 1 AS failed_rows FROM {t} WHERE {broken}"


@query("stored_failures", "entity_name test_name key failed_rows:i", " UNION ALL ".join(_stored_sql(r) for r in STORED))
def _(b):
    path = fresh_dir(b.spark, "failures")
    tables = {n: b.silver[n] for n in (*STORED_KEYS, "slv_categorias")}
    quality.store_failures(tables, STORED, STORED_KEYS, path, "run-1")
    rows = b.spark.read.parquet(f"{path}/rows").select(F.col("entity").alias("entity_name"), F.explode("rules").alias("test_name"), F.col("row_key").alias("key"),
                                                       F.lit(1).alias("failed_rows"))
    values = b.spark.read.parquet(f"{path}/values").select("entity_name", "test_name", F.col("value").alias("key"), "failed_rows")
    return rows.unionByName(values)


@query("consolidate_quality", "run_id " + RESULT + " detected_at:t",
       f"SELECT 'run-9' AS run_id, *, {q.AS_OF} AS detected_at FROM ({SUITE_SQL}) WHERE failed_rows > 0")
def _(b):
    return quality.consolidate(silver_results(b), "run-9", AS_OF)


@query("severity_gate", "layer_name failed_errors:i failed_warnings:i verdict", f"""SELECT layer_name,
  count(*) FILTER (failed_rows > 0 AND severity = 'error') AS failed_errors,
  count(*) FILTER (failed_rows > 0 AND severity = 'warn') AS failed_warnings,
  CASE WHEN count(*) FILTER (failed_rows > 0 AND severity = 'error') > 0 THEN 'STOP' ELSE 'GO' END AS verdict
FROM ({SUITE_SQL}) GROUP BY 1""")
def _(b):
    return quality.gate_verdict(silver_results(b))


ISSUE = "table_name row_primary_key column_name issue_type severity original_clean_value corrupted_value is_repair_suggested"


@query("row_issue_log", ISSUE, """SELECT 'sales_order_lines' AS table_name, sales_order_line_id AS row_primary_key, * EXCLUDE
  (sales_order_line_id) FROM (
SELECT sales_order_line_id, 'quantity' AS column_name, 'missing' AS issue_type, 'high' AS severity,
  CAST(CAST(round(line_subtotal / unit_price) AS INT) AS VARCHAR) AS original_clean_value,
  CAST(NULL AS VARCHAR) AS corrupted_value, 'yes' AS is_repair_suggested FROM x_sales_order_lines WHERE quantity IS NULL
UNION ALL SELECT sales_order_line_id, 'cdc_operation', 'deleted', 'low', NULL, 'D', 'no' FROM x_sales_order_lines
  WHERE cdc_operation = 'D'
UNION ALL SELECT sales_order_line_id, 'discount_amount', 'missing', 'medium', NULL, NULL, 'no' FROM x_sales_order_lines
  WHERE discount_amount IS NULL)""")
def _(b):
    fixed = repair.repair_quantity(F.col("quantity"), F.col("line_subtotal"), F.col("unit_price"))
    lines = latest_event(b.log("sales_order_lines"), ["sales_order_line_id"])
    return quality.issue_log(lines, "sales_order_lines", "sales_order_line_id", [
        quality.IssueRule("missing", "quantity", F.col("quantity").isNull(), "high", fixed, "quantity not recorded"),
        quality.IssueRule("deleted", "cdc_operation", F.col("cdc_operation") == "D", "low"),
        quality.IssueRule("missing", "discount_amount", F.col("discount_amount").isNull(), "medium")])


@query("reconciliation_log", "run_id check_name period_key source_layer target_layer source_row_count:i target_row_count:i "
       "source_measure:m target_measure:m is_match checked_at:t", f"""SELECT 'run-3' AS run_id, 'silver_gold_daily' AS check_name,
  fecha_key AS period_key, 'silver' AS source_layer, 'gold' AS target_layer, coalesce(filas_silver, 0) AS source_row_count,
  coalesce(filas_gold, 0) AS target_row_count, coalesce(importe_silver, 0) AS source_measure,
  coalesce(importe_gold, 0) AS target_measure, is_match, {q.AS_OF} AS checked_at FROM ({DAILY_SQL})""")
def _(b):
    recon = monitor.recon_silver_gold(b.silver["slv_venta_detalle"], b.silver["slv_ventas"], b.fact())
    return monitor.recon_rows(recon, "silver_gold_daily", "fecha_key", ("silver", "filas_silver", "importe_silver"),
                              ("gold", "filas_gold", "importe_gold"), "run-3", AS_OF)
