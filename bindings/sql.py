"""Building blocks of the DuckDB oracles: named subqueries that an oracle may refer to.

``oracle(sql)`` puts every named subquery the text mentions, directly or not, in front of it.
"""

from __future__ import annotations

import re

from bindings.bronze import columns_of, duck_log
from starloom.contracts import ENTITIES

AS_OF = "TIMESTAMP '2002-01-01 00:00:00'"
SPLIT = "TIMESTAMP '1998-06-01 00:00:00'"
FOREVER = "TIMESTAMP '9999-12-31 00:00:00'"
ORIGIN = "TIMESTAMP '1900-01-01 00:00:00'"


def text(c: str) -> str:
    return f"nullif(trim({c}), '')"


def label(c: str) -> str:
    return f"upper({text(c)})"


def country(c: str) -> str:
    x = label(c)
    return (f"CASE WHEN {x} IN ('US', 'USA', 'U.S.A.') THEN 'UNITED STATES' "
            f"WHEN {x} IN ('UK', 'U.K.', 'ENGLAND') THEN 'UNITED KINGDOM' ELSE {x} END")


def category(c: str) -> str:
    return f"CASE {label(c)} WHEN 'ELECTRONICS ACCESSORY' THEN 'ELECTRONICS ACCESSORIES' ELSE {label(c)} END"


def phone(c: str) -> str:
    return f"nullif(translate({c}, ' -().', ''), '')"


def ymd(c: str) -> str:
    return f"CAST(strftime({c}, '%Y%m%d') AS INT)"


def ms(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S.%g')"


def signed(digest: str) -> str:
    """First eight bytes of a hex digest as a signed integer."""
    u = f"CAST(CAST('0x' || substr({digest}, 1, 16) AS UBIGINT) AS HUGEINT)"
    return f"CAST(CASE WHEN {u} >= 9223372036854775808 THEN {u} - 18446744073709551616 ELSE {u} END AS BIGINT)"


def parts(*columns: str) -> str:
    return " || ".join(f"coalesce(CAST({c} AS VARCHAR), '<null>') || '||'" for c in columns)


def key(*columns: str) -> str:
    return signed(f"sha256({parts(*columns)})")


def minutes(a: str, b: str) -> str:
    return f"date_diff('minute', {a}, {b})"


def newest(entity: str, source: str | None = None) -> str:
    k = "user_id" if entity == "log" else ENTITIES[entity].key
    rest = [c for c, _ in columns_of(entity) if c not in (k, "ingested_at", "seq")]
    order = ", ".join(f"{c} DESC" for c in ["ingested_at", "seq", *rest])
    return f"SELECT * FROM {source or 'b_' + entity} QUALIFY row_number() OVER (PARTITION BY {k} ORDER BY {order}) = 1"


def customer_model(source: str) -> str:
    email = f"lower({text('contact_email')})"
    return f"""SELECT customer_id AS cliente_id, {text('company_name')} AS nombre, CAST(NULL AS VARCHAR) AS apellido,
  {text('company_name')} AS nombre_completo, {email} AS email, {phone('contact_phone')} AS telefono,
  {country('country')} AS pais, {text('city')} AS ciudad,
  coalesce({email} LIKE '%_@_%.__%', FALSE) AS email_valido, CAST(customer_since AS TIMESTAMP) AS creado_en,
  CAST(customer_since AS TIMESTAMP) AS actualizado_en, cdc_operation = 'D' AS es_borrado, ingested_at, seq
FROM {source}"""


def product_model(source: str) -> str:
    cost, price = "CAST(unit_cost AS DECIMAL(19,4))", "CAST(list_price AS DECIMAL(19,4))"
    return f"""SELECT product_id AS producto_id, product_id AS sku, {text('product_name')} AS nombre_producto,
  {category('category')} AS categoria_id, {category('category')} AS categoria_nombre,
  CAST(NULL AS VARCHAR) AS categoria_padre_id, CAST(NULL AS VARCHAR) AS categoria_padre_nombre,
  {text('primary_supplier_id')} AS marca, {cost} AS costo_unitario, {price} AS precio_unitario,
  CASE WHEN list_price > 0 THEN CAST(round(CAST({price} - {cost} AS DOUBLE) / CAST({price} AS DOUBLE), 6)
    AS DECIMAL(9,6)) END AS margen_unitario,
  NOT coalesce(is_discontinued, FALSE) AS activo,
  CAST(coalesce(discontinued_date, product_launch_date) AS TIMESTAMP) AS actualizado_en,
  cdc_operation = 'D' AS es_borrado, ingested_at, seq
FROM {source}"""


def history(source: str, k: str, checked: list[str], backdate: bool = True) -> str:
    state = " || ".join(f"coalesce(CAST({c} AS VARCHAR), '~') || '^'" for c in checked)
    start = f"CASE WHEN before IS NULL THEN {ORIGIN} ELSE ingested_at END" if backdate else "ingested_at"
    return f"""SELECT * EXCLUDE (state, before), {start} AS valid_from,
  lead(ingested_at) OVER (PARTITION BY {k} ORDER BY ingested_at, seq) AS valid_to
FROM (SELECT * FROM (SELECT *, lag(state) OVER (PARTITION BY {k} ORDER BY ingested_at, seq) AS before
  FROM (SELECT *, {state} AS state FROM {source})) WHERE before IS NULL OR before <> state)"""


CUSTOMER_COLS = ("nombre, apellido, nombre_completo, email, telefono, pais, ciudad, email_valido, creado_en, "
                 "es_borrado")
PRODUCT_COLS = ("sku, nombre_producto, categoria_id, categoria_nombre, categoria_padre_id, categoria_padre_nombre, "
                "marca, costo_unitario, precio_unitario, margen_unitario, activo, es_borrado")
CUSTOMER_CHECK = ["nombre_completo", "email", "pais", "ciudad", "es_borrado"]
PRODUCT_CHECK = ["nombre_producto", "categoria_id", "marca", "costo_unitario", "precio_unitario", "activo",
                 "es_borrado"]


def versioned(source: str, dim_key: str, natural: str, columns: str, unknown: str) -> str:
    return f"""SELECT {key(natural, ms('valid_from'))} AS {dim_key}, {natural}, {columns}, valid_from AS valido_desde,
  coalesce(valid_to, {FOREVER}) AS valido_hasta, valid_to IS NULL AS es_version_vigente, {AS_OF} AS ingested_at
FROM {source} UNION ALL SELECT -1, '-1', {unknown}, {ORIGIN}, {FOREVER}, TRUE, {AS_OF}"""


UNKNOWN_CUSTOMER = ("'Desconocido', 'Desconocido', 'Desconocido', NULL, NULL, 'DESCONOCIDO', 'Desconocido', FALSE, "
                    "NULL, FALSE")
UNKNOWN_PRODUCT = ("'DESCONOCIDO', 'Desconocido', '-1', 'Desconocido', NULL, NULL, 'Desconocido', 0, 0, NULL, FALSE, "
                   "FALSE")
SWAPPED = "CASE WHEN day(order_date) <= 12 THEN make_date(year(order_date), day(order_date), month(order_date)) END"


def sold(swap: bool) -> str:
    late = (f"coalesce(CASE WHEN ({SWAPPED}) <= ship THEN ({SWAPPED}) END, inv)" if swap else "inv")
    return f"coalesce(CASE WHEN order_date > ship THEN {late} ELSE order_date END, inv, ship)"


def orders_model(swap: bool = True, source: str = "x_sales_orders") -> str:
    return f"""SELECT sales_order_id AS venta_id, customer_id AS cliente_id, {label('sales_channel')} AS canal_id,
  warehouse_id AS sucursal_id, CAST(d AS TIMESTAMP) AS fecha_venta, {ymd('d')} AS fecha_key,
  {label('order_status')} AS estado, coalesce(upper(trim(order_status)) = 'COMPLETED', FALSE) AS es_venta_efectiva,
  CAST(NULL AS VARCHAR) AS moneda, ingested_at AS actualizado_en, cdc_operation = 'D' AS es_borrado, ingested_at
FROM (SELECT *, {sold(swap)} AS d FROM {source} LEFT JOIN invoice_days USING (sales_order_id)
  LEFT JOIN ship_days USING (sales_order_id))"""


_DISC = "coalesce(discount_amount, line_subtotal * coalesce(discount_rate, 0))"


def lines_model(source: str = "x_sales_order_lines") -> str:
    return f"""SELECT *, importe_calculado AS importe, abs(importe_origen - importe_calculado) AS diferencia_importe,
  coalesce(abs(importe_origen - importe_calculado) > 0.01, FALSE) AS tiene_descuadre, ingested_at AS actualizado_en
FROM (SELECT sales_order_line_id AS venta_detalle_id, sales_order_id AS venta_id, product_id AS producto_id,
  coalesce(quantity, CAST(round(line_subtotal / nullif(unit_price, 0)) AS INT)) AS cantidad,
  CAST(CAST(unit_price AS VARCHAR) AS DECIMAL(19,4)) AS precio_unitario, CAST({_DISC} AS DECIMAL(19,4)) AS descuento,
  CAST(line_total AS DECIMAL(19,4)) AS importe_origen,
  CAST(coalesce(line_subtotal, 0) - {_DISC} AS DECIMAL(19,4)) AS importe_calculado,
  cdc_operation = 'D' AS es_borrado, ingested_at FROM {source})"""


def fact_model(cliente: str = "d_cliente", producto: str = "d_producto", lines: str = "s_detalle",
               heads: str = "s_ventas") -> str:
    cost = "l.cantidad * coalesce(p.costo_unitario, 0)"
    return f"""SELECT l.venta_detalle_id, l.venta_id, coalesce(h.fecha_key, -1) AS fecha_key,
  coalesce(c.cliente_key, -1) AS cliente_key, coalesce(p.producto_key, -1) AS producto_key,
  coalesce(n.canal_key, -1) AS canal_key, coalesce(s.sucursal_key, -1) AS sucursal_key,
  h.cliente_id, l.producto_id, h.canal_id, h.sucursal_id, h.fecha_venta, l.cantidad, l.precio_unitario,
  l.descuento, l.importe, CAST({cost} AS DECIMAL(19,4)) AS costo, CAST(l.importe - {cost} AS DECIMAL(19,4)) AS margen,
  l.tiene_descuadre, greatest(l.ingested_at, h.ingested_at) AS ingested_at
FROM {lines} l JOIN {heads} h ON h.venta_id = l.venta_id AND NOT h.es_borrado AND h.es_venta_efectiva
LEFT JOIN {cliente} c ON c.cliente_id = h.cliente_id AND h.fecha_venta >= c.valido_desde AND h.fecha_venta < c.valido_hasta
LEFT JOIN {producto} p ON p.producto_id = l.producto_id AND h.fecha_venta >= p.valido_desde
  AND h.fecha_venta < p.valido_hasta
LEFT JOIN d_canal n ON n.canal_id = h.canal_id LEFT JOIN d_sucursal s ON s.sucursal_id = h.sucursal_id
WHERE NOT l.es_borrado"""


CTES: dict[str, str] = {
    **{f"b_{e}": duck_log(e) for e in [*ENTITIES, "log"]},
    **{f"x_{e}": newest(e) for e in [*ENTITIES, "log"]},
    "s_clientes": f"SELECT * EXCLUDE (seq) FROM ({customer_model('x_customers')})",
    "s_categorias": f"""SELECT c AS categoria_id, c AS categoria_nombre, CAST(NULL AS VARCHAR) AS categoria_padre_id,
  CAST(NULL AS VARCHAR) AS categoria_padre_nombre, max(ingested_at) AS actualizado_en,
  bool_and(cdc_operation = 'D') AS es_borrado, max(ingested_at) AS ingested_at
FROM (SELECT {category('category')} AS c, * FROM x_products) WHERE c IS NOT NULL GROUP BY c""",
    "s_productos": f"SELECT * EXCLUDE (seq) FROM ({product_model('x_products')})",
    "s_canales": f"""SELECT c AS canal_id, c AS canal_nombre, CAST(NULL AS VARCHAR) AS canal_tipo,
  max(ingested_at) AS actualizado_en, bool_and(cdc_operation = 'D') AS es_borrado, max(ingested_at) AS ingested_at
FROM (SELECT {label('sales_channel')} AS c, * FROM x_sales_orders) WHERE c IS NOT NULL GROUP BY c""",
    "s_sucursales": f"""SELECT warehouse_id AS sucursal_id, {text('warehouse_name')} AS sucursal_nombre,
  {text('city')} AS ciudad, CAST(NULL AS VARCHAR) AS region, {label('country')} AS pais,
  ingested_at AS actualizado_en, cdc_operation = 'D' AS es_borrado, ingested_at FROM x_warehouses""",
    "invoice_days": """SELECT sales_order_id, max(coalesce(invoice_date, due_date - payment_term_days)) AS inv
FROM x_invoices WHERE cdc_operation <> 'D' GROUP BY sales_order_id""",
    "ship_days": """SELECT sales_order_id, min(ship_date) AS ship FROM x_shipments WHERE cdc_operation <> 'D'
GROUP BY sales_order_id""",
    "s_ventas": orders_model(),
    "s_detalle": lines_model(),
    "e_clientes": customer_model("b_customers"),
    "e_productos": product_model("b_products"),
    "h_clientes": history("e_clientes", "cliente_id", CUSTOMER_CHECK),
    "h_productos": history("e_productos", "producto_id", PRODUCT_CHECK),
    "hn_clientes": history("e_clientes", "cliente_id", CUSTOMER_CHECK, False),
    "hn_productos": history("e_productos", "producto_id", PRODUCT_CHECK, False),
    "d_cliente": versioned("h_clientes", "cliente_key", "cliente_id", CUSTOMER_COLS, UNKNOWN_CUSTOMER),
    "d_producto": versioned("h_productos", "producto_key", "producto_id", PRODUCT_COLS, UNKNOWN_PRODUCT),
    "dn_cliente": versioned("hn_clientes", "cliente_key", "cliente_id", CUSTOMER_COLS, UNKNOWN_CUSTOMER),
    "dn_producto": versioned("hn_productos", "producto_key", "producto_id", PRODUCT_COLS, UNKNOWN_PRODUCT),
    "d_canal": f"""SELECT {key('canal_id')} AS canal_key, canal_id, canal_nombre, canal_tipo, es_borrado,
  {AS_OF} AS ingested_at FROM s_canales UNION ALL SELECT -1, '-1', 'Desconocido', 'DESCONOCIDO', FALSE, {AS_OF}""",
    "d_sucursal": f"""SELECT {key('sucursal_id')} AS sucursal_key, sucursal_id, sucursal_nombre, ciudad, region, pais,
  es_borrado, {AS_OF} AS ingested_at FROM s_sucursales
UNION ALL SELECT -1, '-1', 'Desconocido', 'Desconocido', 'Desconocido', 'DESCONOCIDO', FALSE, {AS_OF}""",
    "cal": """SELECT CAST(unnest(generate_series(date_trunc('year', min(o_orderdate)),
  date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS fecha
FROM orders""",
    "d_fecha": f"""SELECT {ymd('fecha')} AS fecha_key, fecha, year(fecha) AS anio, quarter(fecha) AS trimestre,
  month(fecha) AS mes, day(fecha) AS dia, dayofyear(fecha) AS dia_del_anio,
  CAST(floor((dayofyear(fecha) + dayofweek(date_trunc('year', fecha)) + 1 - 2) / 7) AS INT) + 1 AS semana_anio,
  dayofweek(fecha) + 1 AS dia_semana, monthname(fecha) AS mes_nombre, dayname(fecha) AS dia_semana_nombre,
  year(fecha) * 100 + month(fecha) AS anio_mes, year(fecha) * 10 + quarter(fecha) AS anio_trimestre,
  CAST(date_trunc('month', fecha) AS DATE) AS primer_dia_mes, last_day(fecha) AS ultimo_dia_mes,
  dayofweek(fecha) IN (0, 6) AS es_fin_semana, fecha = last_day(fecha) AS es_fin_de_mes,
  fecha <= CAST({AS_OF} AS DATE) AS es_pasado, {AS_OF} AS ingested_at FROM cal
UNION ALL SELECT -1, DATE '1900-01-01', 1900, 0, 0, 0, 0, 0, 0, 'Desconocido', 'Desconocido', 190001, 19000,
  DATE '1900-01-01', DATE '1900-01-31', FALSE, FALSE, FALSE, {AS_OF}""",
    "f_ventas": fact_model(),
    "fn_ventas": fact_model("dn_cliente", "dn_producto"),
    "eligible": """SELECT l.*, h.fecha_key FROM s_detalle l JOIN s_ventas h ON h.venta_id = l.venta_id
WHERE NOT l.es_borrado AND NOT h.es_borrado AND h.es_venta_efectiva""",
}

_NAME = re.compile(r"\b[a-z]+_?[a-z_]*\b")


def _needed(sql: str, found: dict[str, None]) -> None:
    for name in dict.fromkeys(_NAME.findall(sql)):
        if name in CTES and name not in found:
            _needed(CTES[name], found)
            found[name] = None


def oracle(sql: str) -> str:
    found: dict[str, None] = {}
    _needed(sql, found)
    if not found:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in found) + "\n" + sql
