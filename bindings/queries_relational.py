"""Joins, aggregates, windows, set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindings import sql as q
from bindings.binding import AS_OF, SPLIT
from bindings.registry import query
from starloom.contracts import ENTITIES
from starloom.functions.keys import month_of_key
from starloom.operators import joins, profile
from starloom.operators.calendar import number_series
from starloom.operators.cdc import first_by, latest_event
from starloom.operators.fact import active, eligible_lines
from starloom.operators.monitor import errors_24h, quality_window, recon_silver_gold, star_integrity
from starloom.operators.scd import scd2_history
from starloom.operators.segments import with_neighbour
from starloom.plans.silver import first_shipments, invoice_dates

# ---- joins ----------------------------------------------------------------------------------


@query("join_left_equi", "sales_order_id invoice_date:d ship_date:d",
       """SELECT sales_order_id, inv AS invoice_date, ship AS ship_date FROM x_sales_orders
LEFT JOIN invoice_days USING (sales_order_id) LEFT JOIN ship_days USING (sales_order_id)""")
def _(b):
    orders = latest_event(b.log("sales_orders"), ["sales_order_id"])
    return (orders.join(invoice_dates(b.log("invoices")), "sales_order_id", "left")
            .join(first_shipments(b.log("shipments")), "sales_order_id", "left"))


@query("join_inner_header_detail", "venta_detalle_id venta_id fecha_key importe:m",
       "SELECT venta_detalle_id, venta_id, fecha_key, importe FROM eligible")
def _(b):
    return eligible_lines(b.silver["slv_venta_detalle"], b.silver["slv_ventas"])


@query("join_asof_scd2", "sales_order_id seq ingested_at:t cliente_key ciudad",
       """SELECT o.sales_order_id, o.seq, o.ingested_at, c.cliente_key, c.ciudad FROM b_sales_orders o
LEFT JOIN dn_cliente c ON c.cliente_id = o.customer_id AND c.valido_desde <= o.ingested_at
  AND o.ingested_at < c.valido_hasta""")
def _(b):
    return joins.scd2_lookup(b.log("sales_orders"), b.dims(backdate_first=False)["cliente"].withColumnRenamed(
        "cliente_id", "customer_id"), "customer_id", "ingested_at", {"cliente_key": "cliente_key", "ciudad": "ciudad"})


@query("join_scd1_lookup", "venta_id canal_key sucursal_key",
       """SELECT v.venta_id, n.canal_key, s.sucursal_key FROM s_ventas v LEFT JOIN d_canal n ON n.canal_id = v.canal_id
LEFT JOIN d_sucursal s ON s.sucursal_id = v.sucursal_id""")
def _(b):
    rows = joins.scd1_lookup(b.silver["slv_ventas"], b.gold["canal"], "canal_id", {"canal_key": "canal_key"})
    return joins.scd1_lookup(rows, b.gold["sucursal"], "sucursal_id", {"sucursal_key": "sucursal_key"})


@query("resolve_unknown", "venta_id sucursal_id sucursal_key",
       """SELECT v.venta_id, v.sucursal_id, coalesce(s.sucursal_key, -1) AS sucursal_key FROM s_ventas v
LEFT JOIN d_sucursal s ON s.sucursal_id = v.sucursal_id""")
def _(b):
    rows = joins.scd1_lookup(b.silver["slv_ventas"], b.gold["sucursal"], "sucursal_id", {"sucursal_key": "_s"})
    return rows.withColumn("sucursal_key", joins.resolve_unknown(F.col("_s")))


@query("join_semi_changed", "venta_detalle_id venta_id",
       f"""SELECT venta_detalle_id, venta_id FROM s_detalle WHERE venta_id IN
  (SELECT venta_id FROM s_ventas WHERE ingested_at > {q.SPLIT})""")
def _(b):
    changed = b.silver["slv_ventas"].filter(F.col("ingested_at") > F.lit(SPLIT).cast("timestamp_ntz"))
    return b.silver["slv_venta_detalle"].join(changed.select("venta_id"), "venta_id", "left_semi")


RECON = "filas_silver:i filas_gold:i importe_silver:m importe_gold:m is_match"
RECON_SQL = """SELECT {period} AS p, s.n AS filas_silver, g.n AS filas_gold, s.a AS importe_silver, g.a AS importe_gold,
  coalesce(s.n, 0) = coalesce(g.n, 0) AND abs(coalesce(s.a, 0) - coalesce(g.a, 0)) <= 0.01 AS is_match
FROM (SELECT {sk} AS k, count(*) AS n, sum(importe) AS a FROM eligible GROUP BY 1) s
FULL OUTER JOIN (SELECT {gk} AS k, count(*) AS n, sum(importe) AS a FROM {gold} GROUP BY 1) g ON s.k = g.k"""


@query("join_full_outer_reconcile", "fecha_key " + RECON, "SELECT * RENAME (p AS fecha_key) FROM (" + RECON_SQL.format(
    period="coalesce(s.k, g.k)", sk="coalesce(fecha_key, -1)", gk="fecha_key",
    gold=f"(SELECT * FROM f_ventas WHERE fecha_venta < {q.SPLIT} OR venta_detalle_id LIKE '%-1')") + ")")
def _(b):
    # Part of the fact is missing, so both matching and differing days appear.
    fact = b.fact()
    short = fact.filter((F.col("fecha_venta") < F.lit(SPLIT).cast("timestamp_ntz")) | F.col("venta_detalle_id").like("%-1"))
    return recon_silver_gold(b.silver["slv_venta_detalle"], b.silver["slv_ventas"], short)


@query("join_cross_scalar", "filas_gold:i filas_silver:i",
       """SELECT g.n AS filas_gold, s.n AS filas_silver FROM (SELECT count(*) AS n FROM f_ventas) g
CROSS JOIN (SELECT count(*) AS n FROM eligible) s""")
def _(b):
    return joins.compare_counts(b.fact(), eligible_lines(b.silver["slv_venta_detalle"], b.silver["slv_ventas"]),
                                "filas_gold", "filas_silver")


def visits(b):
    """Ranges of each user's events: from one event to a moment after it that depends on its id."""
    log = b.log("log").select("user_id", F.col("ingested_at").alias("start"), "seq")
    return log.withColumn("end", F.col("start") + F.make_dt_interval(mins=F.pmod("seq", F.lit(400)).cast("int") + 1))


@query("join_self_overlap", "user_id seq start:t end:t".replace("end:t", "end_ts:t").replace("start:t", "start_ts:t"),
       """SELECT DISTINCT a.*
FROM (SELECT user_id, seq, ingested_at AS start_ts, ingested_at + to_minutes(seq % 400 + 1) AS end_ts FROM b_log) a
JOIN (SELECT user_id, ingested_at AS start_ts, ingested_at + to_minutes(seq % 400 + 1) AS end_ts FROM b_log) b
  ON a.user_id = b.user_id AND a.start_ts <> b.start_ts AND a.start_ts < b.end_ts AND b.start_ts < a.end_ts""")
def _(b):
    return joins.overlaps(visits(b), ["user_id"], "start", "end").withColumnsRenamed({"start": "start_ts", "end": "end_ts"})


@query("join_anti_orphans", "value rows:i",
       """SELECT sucursal_id AS value, count(*) AS rows FROM s_ventas
WHERE sucursal_id IS NOT NULL AND sucursal_id NOT IN (SELECT sucursal_id FROM s_sucursales) GROUP BY 1""")
def _(b):
    return joins.orphans(b.silver["slv_ventas"], "sucursal_id", b.silver["slv_sucursales"], "sucursal_id")


# Source rows behind each of the 16 entities, to count what a complete initial load must have: table and condition.
SOURCES = {"customers": ("customer", "true"), "products": ("part", "true"), "suppliers": ("supplier", "true"), "warehouses": ("nation", "true"),
           "sales_orders": ("orders", "true"), "sales_order_lines": ("lineitem", "true"), "shipments": ("lineitem", "true"),
           "invoices": ("orders", "true"), "payments": ("orders", "true"), "returns": ("lineitem", "l_returnflag = 'R'"),
           "purchase_orders": ("orders", "true"), "purchase_order_lines": ("lineitem", "true"), "supplier_invoices": ("orders", "true"),
           "supplier_payments": ("orders", "true"), "inventory_snapshots": ("lineitem", "true"), "support_tickets": ("events", "true")}


def source_counts(b):
    """Rows of every entity's source, counted in one pass over each source table."""
    parts = []
    for table in dict.fromkeys(t for t, _ in SOURCES.values()):
        mine = {e: condition for e, (t, condition) in SOURCES.items() if t == table}
        counts = b.table(table).agg(*[F.count_if(F.expr(c)).alias(e) for e, c in mine.items()])
        parts.append(counts.select(F.explode(F.array(*[F.struct(F.lit(e).alias("entidad"), F.col(e).alias("filas_oltp")) for e in mine])).alias("x")).select("x.*"))
    return reduce(DataFrame.unionByName, parts)


def completeness_sql(missing=()):
    return "SELECT *, CASE WHEN claves >= filas_oltp THEN 'OK' ELSE 'FALTAN CLAVES' END AS veredicto FROM (" + " UNION ALL ".join(
        f"SELECT '{e}' AS entidad, (SELECT count(*) FROM {t} WHERE {c}) AS filas_oltp, "
        + ("NULL" if e in missing else f"(SELECT count(DISTINCT {ENTITIES[e].key}) FROM b_{e})") + " AS claves"
        for e, (t, c) in SOURCES.items()) + ")"


@query("join_left_expected", "entidad filas_oltp:i claves:i veredicto", completeness_sql(missing=["suppliers"]))
def _(b):
    # One entity was never landed, so a missing one shows too.
    observed = profile.distinct_keys({e: (b.log(e), ENTITIES[e].key) for e in SOURCES if e != "suppliers"})
    return joins.completeness(source_counts(b), observed, "entidad", "filas_oltp", "claves")


def quality_entries(b):
    """A quality log derived from the events: one entry per event, dated two days before AS_OF and on."""
    span = F.expr("make_dt_interval(0, 0, CAST(pmod(event_id * 7, 4320) AS INT), 0)")
    return b.table("events").select(
        F.concat(F.lit("slv_"), F.col("event_type")).alias("entity_name"),
        F.when(F.col("event_id") % 3 == 0, "unique").otherwise("not_null").alias("test_name"),
        F.when(F.col("event_id") % 4 == 0, "warn").otherwise("error").alias("severity"),
        (F.col("event_id") % 9).alias("failed_rows"),
        (F.lit(AS_OF).cast("timestamp_ntz") - span).alias("detected_at"))


QUALITY_SQL = f"""(SELECT 'slv_' || event_type AS entity_name,
  CASE WHEN event_id % 3 = 0 THEN 'unique' ELSE 'not_null' END AS test_name,
  CASE WHEN event_id % 4 = 0 THEN 'warn' ELSE 'error' END AS severity, event_id % 9 AS failed_rows,
  {q.AS_OF} - to_minutes(event_id * 7 % 4320) AS detected_at FROM events)"""


@query("scalar_subquery_count", "entity_name fallos:i",
       f"""SELECT entity_name, count(*) AS fallos FROM {QUALITY_SQL}
WHERE severity = 'error' AND detected_at > {q.AS_OF} - INTERVAL 1 DAY GROUP BY 1""")
def _(b):
    return errors_24h(quality_entries(b), AS_OF).withColumnRenamed("_errors", "fallos")


# ---- aggregates -----------------------------------------------------------------------------


@query("agg_max_per_key", "sales_order_id invoice_date:d", "SELECT sales_order_id, inv AS invoice_date FROM invoice_days")
def _(b):
    return invoice_dates(b.log("invoices"))


@query("agg_min_per_key", "sales_order_id ship_date:d", "SELECT sales_order_id, ship AS ship_date FROM ship_days")
def _(b):
    return first_shipments(b.log("shipments"))


@query("agg_daily_count_sum", "fecha_key filas:i importe:m",
       "SELECT fecha_key, count(*) AS filas, sum(importe) AS importe FROM eligible GROUP BY 1")
def _(b):
    rows = eligible_lines(b.silver["slv_venta_detalle"], b.silver["slv_ventas"])
    return profile.daily_totals(rows, F.col("fecha_key"), "fecha_key", "filas", "importe")


@query("agg_monthly_count_sum", "anio_mes filas:i importe:m",
       "SELECT fecha_key // 100 AS anio_mes, count(*) AS filas, sum(importe) AS importe FROM eligible GROUP BY 1")
def _(b):
    rows = eligible_lines(b.silver["slv_venta_detalle"], b.silver["slv_ventas"])
    return profile.daily_totals(rows, month_of_key(F.col("fecha_key")), "anio_mes", "filas", "importe")


@query("agg_count_distinct", "entidad claves:i", " UNION ALL ".join(
    f"SELECT '{e.name}' AS entidad, count(DISTINCT {e.key}) AS claves FROM b_{e.name}" for e in ENTITIES.values()))
def _(b):
    return profile.distinct_keys({e.name: (b.log(e.name), e.key) for e in ENTITIES.values()})


EVENTS = ("entidad eventos_totales:i inserts:i updates:i deletes:i primer_microlote:t ultimo_microlote:t")
EVENTS_SQL = " UNION ALL ".join(
    f"""SELECT '{e}' AS entidad, count(*) AS eventos_totales, count(*) FILTER (cdc_operation = 'I') AS inserts,
  count(*) FILTER (cdc_operation = 'U') AS updates, count(*) FILTER (cdc_operation = 'D') AS deletes,
  min(ingested_at) AS primer_microlote, max(ingested_at) AS ultimo_microlote FROM b_{e}""" for e in ENTITIES)


def all_events(b):
    return profile.event_log({e: b.log(e) for e in ENTITIES})


@query("agg_conditional", EVENTS, EVENTS_SQL)
def _(b):
    return profile.event_profile(all_events(b))


@query("agg_having", "sales_order_line_id rows:i",
       "SELECT sales_order_line_id, count(*) AS rows FROM b_sales_order_lines GROUP BY 1 HAVING count(*) > 1")
def _(b):
    return profile.repeated(b.log("sales_order_lines"), ["sales_order_line_id"])


@query("agg_global_count", "filas:i", "SELECT count(*) AS filas FROM s_detalle WHERE NOT es_borrado")
def _(b):
    return active(b.silver["slv_venta_detalle"]).agg(F.count("*").alias("filas"))


@query("agg_max_watermark", "last_loaded_at:t filas:i",
       "SELECT max(ingested_at) AS last_loaded_at, count(*) AS filas FROM s_detalle")
def _(b):
    return b.silver["slv_venta_detalle"].agg(F.max("ingested_at").alias("last_loaded_at"), F.count("*").alias("filas"))


@query("agg_quality_24h", "entity_name test_name severity filas_fallidas:i ultimo_fallo:t",
       f"""SELECT entity_name, test_name, severity, sum(failed_rows) AS filas_fallidas, max(detected_at) AS ultimo_fallo
FROM {QUALITY_SQL} WHERE detected_at > {q.AS_OF} - INTERVAL 1 DAY GROUP BY ALL""")
def _(b):
    return quality_window(quality_entries(b), AS_OF)


STAR = "dimension huerfanos:i desconocidos:i"
STAR_SQL = " UNION ALL ".join(
    f"""SELECT '{n}' AS dimension, count(*) FILTER (f.{k} NOT IN (SELECT {k} FROM {d})) AS huerfanos,
  count(*) FILTER (f.{k} = -1) AS desconocidos FROM {{fact}} f"""
    for n, k, d in (("fecha", "fecha_key", "d_fecha"), ("cliente", "cliente_key", "d_cliente"),
                    ("producto", "producto_key", "d_producto"), ("canal", "canal_key", "d_canal"),
                    ("sucursal", "sucursal_key", "d_sucursal")))


def star_dims(b):
    return {"fecha": (b.dim_date, "fecha_key"), "cliente": (b.gold["cliente"], "cliente_key"),
            "producto": (b.gold["producto"], "producto_key"), "canal": (b.gold["canal"], "canal_key"),
            "sucursal": (b.gold["sucursal"], "sucursal_key")}


@query("agg_orphan_unknown", STAR, STAR_SQL.format(fact="fn_ventas"))
def _(b):
    # A fact looked up without backdating, checked against the backdated dimensions: keys differ.
    return star_integrity(b.fact(b.dims(backdate_first=False)), star_dims(b))


MEASURES = "lineas:i cantidad:i importe:m costo:m margen:m"
MEASURES_SQL = """count(*) AS lineas, sum(f.cantidad) AS cantidad, sum(f.importe) AS importe, sum(f.costo) AS costo,
  sum(f.margen) AS margen"""


@query("star_rollup", "anio_mes pais " + MEASURES,
       f"""SELECT d.anio_mes, c.pais, {MEASURES_SQL} FROM f_ventas f LEFT JOIN d_fecha d USING (fecha_key)
LEFT JOIN d_cliente c USING (cliente_key) GROUP BY 1, 2""")
def _(b):
    return profile.star_rollup(b.fact(), {"fecha": (b.dim_date, "fecha_key", ["anio_mes"]),
                                          "cliente": (b.gold["cliente"], "cliente_key", ["pais"])})


@query("star_rollup_product_branch", "categoria_nombre sucursal_nombre canal_nombre " + MEASURES,
       f"""SELECT p.categoria_nombre, s.sucursal_nombre, n.canal_nombre, {MEASURES_SQL} FROM f_ventas f
LEFT JOIN d_producto p USING (producto_key) LEFT JOIN d_sucursal s USING (sucursal_key)
LEFT JOIN d_canal n USING (canal_key) GROUP BY ALL""")
def _(b):
    return profile.star_rollup(b.fact(), {
        "producto": (b.gold["producto"], "producto_key", ["categoria_nombre"]),
        "sucursal": (b.gold["sucursal"], "sucursal_key", ["sucursal_nombre"]),
        "canal": (b.gold["canal"], "canal_key", ["canal_nombre"])})


PROFILED = {"customer": ("c_custkey", None), "part": ("p_partkey", None), "supplier": ("s_suppkey", None),
            "orders": ("o_orderkey", "o_orderdate"), "lineitem": ("l_orderkey", "l_shipdate"), "events": ("event_id", "ts")}


def _profile_sql(table: str, k: str, day: str | None) -> str:
    low, high = (f"CAST(min({day}) AS DATE)", f"CAST(max({day}) AS DATE)") if day else ("CAST(NULL AS DATE)",) * 2
    return f"""SELECT '{table}' AS table_name, count(*) AS rows,
  (SELECT count(*) FROM duckdb_columns() WHERE table_name = '{table}') AS columns,
  (SELECT coalesce(sum(n), 0) FROM (SELECT sum(CASE WHEN x IS NULL THEN 1 ELSE 0 END) AS n FROM
    (SELECT unnest([{{cols}}]) AS x FROM {table}))) AS nulls,
  count(DISTINCT {k}) AS distinct_keys, count(*) = count(DISTINCT {k}) AS key_is_unique,
  {low} AS first_date, {high} AS last_date FROM {table}"""


COLUMNS = {
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag "
                "l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type value props",
}


@query("profile_table", "table_name rows:i columns:i nulls:i distinct_keys:i key_is_unique first_date:d last_date:d",
       " UNION ALL ".join(
           _profile_sql(t, k, d).replace(f"(SELECT count(*) FROM duckdb_columns() WHERE table_name = '{t}')",
                                         str(len(COLUMNS[t].split())))
           .format(cols=", ".join(f"CAST({c} AS VARCHAR)" for c in COLUMNS[t].split()))
           for t, (k, d) in PROFILED.items()))
def _(b):
    parts = None
    for table, (k, day) in PROFILED.items():
        one = profile.profile_table(b.table(table), table, k, day)
        parts = one if parts is None else parts.unionByName(one)
    return parts


# The date by which each entity is profiled.
PROFILE_DAYS = {"customers": "customer_since", "products": "product_launch_date", "suppliers": "supplier_since", "warehouses": None,
                "sales_orders": "order_date", "sales_order_lines": None, "shipments": "ship_date", "invoices": "invoice_date", "payments": "payment_date",
                "returns": "return_date", "purchase_orders": "order_date", "purchase_order_lines": None, "supplier_invoices": "invoice_date",
                "supplier_payments": "payment_date", "inventory_snapshots": "snapshot_date", "support_tickets": "created_at"}


def _entity_profile_sql(entity: str) -> str:
    k, day, columns = ENTITIES[entity].key, PROFILE_DAYS[entity], ENTITIES[entity].source_schema.names
    low, high = (f"CAST(min({day}) AS DATE)", f"CAST(max({day}) AS DATE)") if day else ("CAST(NULL AS DATE)",) * 2
    nulls = " + ".join(f"count(*) FILTER ({c} IS NULL)" for c in columns)
    return f"""SELECT '{entity}' AS table_name, count(*) AS rows, {len(columns)} AS columns, {nulls} AS nulls, count(DISTINCT {k}) AS distinct_keys,
  count(*) = count(DISTINCT {k}) AS key_is_unique, {low} AS first_date, {high} AS last_date FROM b_{entity} WHERE cdc_operation = 'I'"""


@query("profile_entities", "table_name rows:i columns:i nulls:i distinct_keys:i key_is_unique first_date:d last_date:d",
       " UNION ALL ".join(_entity_profile_sql(e) for e in PROFILE_DAYS))
def _(b):
    # The initial load of every entity, as its source held it.
    return reduce(DataFrame.unionByName, [profile.profile_table(
        b.log(e).filter("cdc_operation = 'I'").select(*ENTITIES[e].source_schema.names), e, ENTITIES[e].key, day) for e, day in PROFILE_DAYS.items()])


# ---- windows, sorts, set operations ---------------------------------------------------------


@query("row_number_dedup", "l_orderkey l_linenumber l_partkey l_suppkey l_shipdate:t",
       """SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount) = 1""")
def _(b):
    return first_by(b.table("lineitem"), ["l_orderkey", "l_linenumber"], [
        F.col(c).asc() for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount")])


@query("number_series", "n o_orderkey", """SELECT g.n, o.o_orderkey FROM (SELECT unnest(range(min(o_orderkey), max(o_orderkey) + 1)) AS n
  FROM orders) g LEFT JOIN orders o ON o.o_orderkey = g.n""")
def _(b):
    orders = b.table("orders")
    numbers = number_series(orders.agg(F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high")))
    return numbers.join(orders.select("o_orderkey"), F.col("n") == F.col("o_orderkey"), "left")


@query("version_intervals", "user_id event_type valid_from:t valid_to:t",
       """SELECT user_id, event_type, ingested_at AS valid_from,
  lead(ingested_at) OVER (PARTITION BY user_id ORDER BY seq) AS valid_to
FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY seq) AS before FROM b_log)
WHERE before IS NULL OR before <> event_type""")
def _(b):
    return scd2_history(b.log("log"), "user_id", ["event_type"], ["event_type"])


@query("neighbour_events", "user_id seq previous_type next_seq",
       """SELECT user_id, seq, lag(event_type) OVER w AS previous_type, lead(seq) OVER w AS next_seq FROM b_log
WINDOW w AS (PARTITION BY user_id ORDER BY ingested_at, seq)""")
def _(b):
    log = b.log("log").select("user_id", "event_type", "ingested_at", "seq")
    order = ["ingested_at", "seq"]
    before = with_neighbour(log, ["user_id"], order, "ingested_at", F.col("event_type"), "previous_type")
    return with_neighbour(before, ["user_id"], order, "ingested_at", F.col("seq"), "next_seq", forward=True)


@query("order_by_report", "entidad claves:i", " UNION ALL ".join(
    f"SELECT '{e}' AS entidad, count(DISTINCT {ENTITIES[e].key}) AS claves FROM b_{e}" for e in ENTITIES) + " ORDER BY claves DESC, entidad")
def _(b):
    counts = profile.distinct_keys({e: (b.log(e), ENTITIES[e].key) for e in ENTITIES})
    return counts.orderBy(F.col("claves").desc(), "entidad")


@query("union_all", "entidad cdc_operation ingested_at:t", " UNION ALL ".join(
    f"SELECT '{e}' AS entidad, cdc_operation, ingested_at FROM b_{e}" for e in ENTITIES))
def _(b):
    return all_events(b)
