"""Cleaning and repair rules, scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings import sql as q
from bindings.binding import AS_OF
from bindings.registry import query
from starloom.contracts import CATEGORY_ALIASES, COUNTRY_ALIASES
from starloom.functions import dates, keys, repair
from starloom.functions.text import clean_email, clean_phone, clean_text, conform, conform_by_table, upper_label
from starloom.operators import profile
from starloom.operators.cdc import latest_event
from starloom.operators.fact import clamp_returns
from starloom.operators.profile import null_counts, repair_audit
from starloom.plans.silver import first_shipments, invoice_dates

QTY = "coalesce(quantity, CAST(round(line_subtotal / nullif(unit_price, 0)) AS INT))"


@query("clean_text", "customer_id seq company_name city",
       f"SELECT * REPLACE ({q.text('company_name')} AS company_name, {q.text('city')} AS city) FROM b_customers")
def _(b):
    return b.log("customers").withColumns({c: clean_text(F.col(c)) for c in ("company_name", "city")})


@query("clean_email", "customer_id seq contact_email",
       f"SELECT * REPLACE (lower({q.text('contact_email')}) AS contact_email) FROM b_customers")
def _(b):
    return b.log("customers").withColumn("contact_email", clean_email(F.col("contact_email")))


@query("clean_phone", "customer_id seq contact_phone",
       """SELECT * REPLACE (nullif(regexp_replace(contact_phone, '[-(). ]', '', 'g'), '')
  AS contact_phone) FROM b_customers""")
def _(b):
    return b.log("customers").withColumn("contact_phone", clean_phone(F.col("contact_phone")))


@query("conform_country", "entity id seq country",
       f"""SELECT 'customers' AS entity, customer_id AS id, seq, {q.country('country')} AS country FROM b_customers
UNION ALL SELECT 'suppliers', supplier_id, seq, {q.country('country')} FROM b_suppliers""")
def _(b):
    country = conform(F.col("country"), COUNTRY_ALIASES).alias("country")
    customers = b.log("customers").select(F.lit("customers").alias("entity"), F.col("customer_id").alias("id"), "seq", country)
    suppliers = b.log("suppliers").select(F.lit("suppliers").alias("entity"), F.col("supplier_id").alias("id"), "seq", country)
    return customers.unionByName(suppliers)


@query("conform_category", "product_id seq category",
       f"SELECT * REPLACE ({q.category('category')} AS category) FROM b_products")
def _(b):
    aliases = b.spark.createDataFrame(list(CATEGORY_ALIASES.items()), "alias string, label string")
    return conform_by_table(b.log("products"), "category", aliases)


@query("upper_label", "sales_order_id seq canal estado",
       f"SELECT *, {q.label('sales_channel')} AS canal, {q.label('order_status')} AS estado FROM b_sales_orders")
def _(b):
    return b.log("sales_orders").withColumns({"canal": upper_label(F.col("sales_channel")),
                                              "estado": upper_label(F.col("order_status"))})


@query("repair_invoice_date", "invoice_id invoice_date:d",
       "SELECT * REPLACE (coalesce(invoice_date, due_date - payment_term_days) AS invoice_date) FROM b_invoices")
def _(b):
    fixed = repair.repair_invoice_date(F.col("invoice_date"), F.col("due_date"), F.col("payment_term_days"))
    return b.log("invoices").withColumn("invoice_date", fixed)


def dated_orders(b):
    """Latest orders with their repaired invoice date and first shipment."""
    return (latest_event(b.log("sales_orders"), ["sales_order_id"])
            .join(invoice_dates(b.log("invoices")), "sales_order_id", "left")
            .join(first_shipments(b.log("shipments")), "sales_order_id", "left"))


DATED = "x_sales_orders LEFT JOIN invoice_days USING (sales_order_id) LEFT JOIN ship_days USING (sales_order_id)"


@query("repair_order_date", "sales_order_id order_date:d repaired_date:d",
       f"SELECT sales_order_id, order_date, {q.sold(False)} AS repaired_date FROM {DATED}")
def _(b):
    fixed = repair.repair_order_date(F.col("order_date"), F.col("ship_date"), F.col("invoice_date"), swap=False)
    return dated_orders(b).withColumn("repaired_date", fixed)


@query("swap_day_month", "sales_order_id order_date:d swapped_date:d",
       f"""SELECT sales_order_id, order_date,
  CASE WHEN order_date > ship AND ({q.SWAPPED}) <= ship THEN ({q.SWAPPED}) END AS swapped_date FROM {DATED}""")
def _(b):
    return dated_orders(b).withColumn("swapped_date", repair.swap_day_month(F.col("order_date"), F.col("ship_date")))


@query("repair_quantity", "sales_order_line_id seq quantity",
       f"SELECT * REPLACE ({QTY} AS quantity) FROM b_sales_order_lines")
def _(b):
    fixed = repair.repair_quantity(F.col("quantity"), F.col("line_subtotal"), F.col("unit_price"))
    return b.log("sales_order_lines").withColumn("quantity", fixed)


@query("repair_discount_amount", "sales_order_line_id seq discount_amount:m",
       f"SELECT * REPLACE (CAST({q._DISC} AS DECIMAL(19,4)) AS discount_amount) FROM b_sales_order_lines")
def _(b):
    fixed = repair.repair_discount(F.col("discount_amount"), F.col("line_subtotal"), F.col("discount_rate"))
    return b.log("sales_order_lines").withColumn("discount_amount", repair.money(fixed))


@query("repair_discount_rate", "sales_order_line_id seq discount_rate:m",
       """SELECT * REPLACE (CAST(coalesce(discount_rate, discount_amount / nullif(line_subtotal, 0)) AS DECIMAL(9,6))
  AS discount_rate) FROM b_sales_order_lines""")
def _(b):
    fixed = repair.repair_rate(F.col("discount_rate"), F.col("discount_amount"), F.col("line_subtotal"))
    return b.log("sales_order_lines").withColumn("discount_rate", fixed.cast("decimal(9,6)"))


@query("recompute_amount", "sales_order_line_id seq importe:m",
       f"SELECT *, CAST(coalesce(line_subtotal, 0) - {q._DISC} AS DECIMAL(19,4)) AS importe FROM b_sales_order_lines")
def _(b):
    subtotal = F.col("line_subtotal")
    discount = repair.repair_discount(F.col("discount_amount"), subtotal, F.col("discount_rate"))
    return b.log("sales_order_lines").withColumn("importe", repair.recompute_amount(subtotal, discount))


@query("repair_unit_cost", "purchase_order_line_id unit_cost repaired",
       """SELECT purchase_order_line_id, abs(unit_cost * quantity_ordered - line_total) > 0.01 AS repaired,
  CASE WHEN abs(unit_cost * quantity_ordered - line_total) > 0.01 THEN line_total / quantity_ordered
       ELSE unit_cost END AS unit_cost FROM b_purchase_order_lines""")
def _(b):
    cost = F.col("unit_cost")
    fixed = repair.repair_unit_cost(cost, F.col("quantity_ordered"), F.col("line_total"))
    return b.log("purchase_order_lines").select("purchase_order_line_id", (fixed != cost).alias("repaired"),
                                                fixed.alias("unit_cost"))


@query("clamp_returns", "return_id sales_order_line_id returned_quantity sold_quantity clamped_quantity",
       f"""SELECT r.return_id, r.sales_order_line_id, r.returned_quantity, l.q AS sold_quantity,
  least(r.returned_quantity, l.q) AS clamped_quantity
FROM x_returns r LEFT JOIN (SELECT sales_order_line_id, {QTY} AS q FROM x_sales_order_lines) l USING (sales_order_line_id)""")
def _(b):
    lines = latest_event(b.log("sales_order_lines"), ["sales_order_line_id"])
    fixed = repair.repair_quantity(F.col("quantity"), F.col("line_subtotal"), F.col("unit_price"))
    return clamp_returns(latest_event(b.log("returns"), ["return_id"]),
                         lines.select("sales_order_line_id", fixed.alias("quantity")))


@query("keep_unimputable_nulls", "table_name column_name rows:i nulls:i",
       f"""SELECT 'customers' AS table_name, 'contact_phone' AS column_name, count(*) AS rows,
  count(*) - count({q.phone('contact_phone')}) AS nulls FROM x_customers
UNION ALL SELECT 'products', 'weight_kg', count(*), count(*) - count(weight_kg) FROM x_products""")
def _(b):
    phones = latest_event(b.log("customers"), ["customer_id"]).withColumn(
        "contact_phone", clean_phone(F.col("contact_phone")))
    weights = latest_event(b.log("products"), ["product_id"])
    return null_counts(phones, "customers", ["contact_phone"]).unionByName(
        null_counts(weights, "products", ["weight_kg"]))


OUTLIERS = ["customer_segment", "region_type", "country", "city", "company_name"]


@query("report_outliers", "column_name value rows:i", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, v AS value, count(*) AS rows FROM (SELECT {q.label(c)} AS v FROM x_customers) WHERE v IS NOT NULL "
    "GROUP BY v HAVING count(*) <= 1" for c in OUTLIERS))
def _(b):
    customers = latest_event(b.log("customers"), ["customer_id"])
    return profile.rare_labels(customers.select(*[upper_label(F.col(c)).alias(c) for c in OUTLIERS]), OUTLIERS)


@query("outlier_log", "table_name row_primary_key column_name corrupted_value issue_type severity is_repair_suggested", " UNION ALL ".join(
    f"""SELECT 'customers' AS table_name, customer_id AS row_primary_key, '{c}' AS column_name, v AS corrupted_value, 'outlier' AS issue_type,
  'low' AS severity, 'no' AS is_repair_suggested FROM (SELECT customer_id, {q.label(c)} AS v FROM x_customers) WHERE v IS NOT NULL
QUALIFY count(*) OVER (PARTITION BY v) <= 1""" for c in OUTLIERS))
def _(b):
    customers = latest_event(b.log("customers"), ["customer_id"])
    return profile.outlier_log(customers.select("customer_id", *[upper_label(F.col(c)).alias(c) for c in OUTLIERS]), "customers", "customer_id", OUTLIERS)


@query("unit_margin", "product_id seq margen:m",
       """SELECT product_id, seq, CASE WHEN p > 0 THEN round(CAST(p - c AS DOUBLE) / CAST(p AS DOUBLE), 6) END AS margen
FROM (SELECT *, CAST(list_price AS DECIMAL(19,4)) AS p, CAST(unit_cost AS DECIMAL(19,4)) AS c FROM b_products)""")
def _(b):
    margin = repair.unit_margin(repair.money(F.col("list_price")), repair.money(F.col("unit_cost")))
    return b.log("products").withColumn("margen", margin)


@query("repair_audit", "rule defects:i repaired:i left_as_is:i",
       f"""SELECT rule, count(*) FILTER (bad) AS defects, count(*) FILTER (bad AND ok) AS repaired,
  count(*) FILTER (bad AND NOT ok) AS left_as_is FROM (
SELECT 'order_date_missing' AS rule, order_date IS NULL AS bad, {q.sold(True)} IS NOT NULL AS ok FROM {DATED}
UNION ALL SELECT 'order_after_shipment', coalesce(order_date > ship, FALSE), coalesce({q.sold(True)} <= ship, FALSE)
FROM {DATED}
UNION ALL SELECT 'quantity_missing', quantity IS NULL, {QTY} IS NOT NULL FROM x_sales_order_lines
UNION ALL SELECT 'discount_missing', discount_amount IS NULL, discount_rate IS NOT NULL FROM x_sales_order_lines)
GROUP BY rule""")
def _(b):
    order, ship, invoice = F.col("order_date"), F.col("ship_date"), F.col("invoice_date")
    fixed = repair.repair_order_date(order, ship, invoice)
    by_order = repair_audit(dated_orders(b), {
        "order_date_missing": (order.isNull(), fixed.isNotNull()),
        "order_after_shipment": (order > ship, fixed <= ship)})
    lines = latest_event(b.log("sales_order_lines"), ["sales_order_line_id"])
    quantity = repair.repair_quantity(F.col("quantity"), F.col("line_subtotal"), F.col("unit_price"))
    by_line = repair_audit(lines, {
        "quantity_missing": (F.col("quantity").isNull(), quantity.isNotNull()),
        "discount_missing": (F.col("discount_amount").isNull(), F.col("discount_rate").isNotNull())})
    return by_order.unionByName(by_line)


# ---- scalar functions -----------------------------------------------------------------------


@query("fn_string", "p_partkey trimmed upper_name lower_name replaced no_blank joined is_ring cut",
       """SELECT p_partkey, trim('  ' || p_name || ' ') AS trimmed, upper(p_name) AS upper_name, lower(p_brand) AS lower_name,
  replace(p_name, ' ', '_') AS replaced, nullif(p_type, 'PROMO') AS no_blank, concat(p_brand, '/', p_type) AS joined,
  p_name LIKE '%ring' AS is_ring, substr(p_name, 1, 5) AS cut FROM part""")
def _(b):
    name = F.col("p_name")
    return b.table("part").select(
        "p_partkey", clean_text(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
        F.upper(name).alias("upper_name"), F.lower("p_brand").alias("lower_name"),
        F.translate(name, " ", "_").alias("replaced"), F.nullif("p_type", F.lit("PROMO")).alias("no_blank"),
        F.concat("p_brand", F.lit("/"), "p_type").alias("joined"), name.like("%ring").alias("is_ring"),
        F.substring(name, 1, 5).alias("cut"))


@query("date_key", "sales_order_id seq fecha_key anio_mes",
       """SELECT sales_order_id, seq, CAST(strftime(order_date, '%Y%m%d') AS INT) AS fecha_key,
  CAST(strftime(order_date, '%Y%m') AS INT) AS anio_mes FROM b_sales_orders""")
def _(b):
    key = keys.date_key(F.col("order_date"))
    return b.log("sales_orders").select("sales_order_id", "seq", key.alias("fecha_key"),
                                        keys.month_of_key(key).alias("anio_mes"))


@query("fn_date_parts", "o_orderkey y q m d doy week weekday month_name day_name last:d first:d",
       """SELECT o_orderkey, year(x) AS y, quarter(x) AS q, month(x) AS m, day(x) AS d, dayofyear(x) AS doy,
  CAST(floor((dayofyear(x) + dayofweek(date_trunc('year', x)) + 1 - 2) / 7) AS INT) + 1 AS week,
  dayofweek(x) + 1 AS weekday, monthname(x) AS month_name, dayname(x) AS day_name, last_day(x) AS last,
  make_date(year(x), month(x), 1) AS first FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS x FROM orders)""")
def _(b):
    x = F.to_date("o_orderdate")
    return b.table("orders").select(
        "o_orderkey", F.year(x).alias("y"), F.quarter(x).alias("q"), F.month(x).alias("m"), F.day(x).alias("d"),
        F.dayofyear(x).alias("doy"), dates.week_of_year(x).alias("week"), F.dayofweek(x).alias("weekday"),
        F.date_format(x, "MMMM").alias("month_name"), F.date_format(x, "EEEE").alias("day_name"),
        F.last_day(x).alias("last"), F.make_date(F.year(x), F.month(x), F.lit(1)).alias("first"))


@query("fn_date_arith", "event_id day_before:d buffered:t age_minutes:i",
       f"""SELECT event_id, CAST(ts AS DATE) - 1 AS day_before, ts - INTERVAL 15 MINUTE AS buffered,
  {q.minutes(q.AS_OF, 'ts')} AS age_minutes FROM events""")
def _(b):
    ts = F.col("ts")
    return b.table("events").select(
        "event_id", F.date_sub(F.to_date(ts), 1).alias("day_before"), dates.minutes_before(ts, 15).alias("buffered"),
        dates.minutes_between(F.lit(AS_OF).cast("timestamp_ntz"), ts).alias("age_minutes"))


@query("fn_math", "l_orderkey l_linenumber l_partkey l_suppkey rounded magnitude hundreds:i guarded",
       """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_extendedprice / l_quantity) AS rounded,
  abs(l_quantity - 25) AS magnitude, l_partkey // 100 AS hundreds, l_discount / nullif(l_tax, 0) AS guarded
FROM lineitem""")
def _(b):
    return b.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.round(F.col("l_extendedprice") / F.col("l_quantity"), 0).alias("rounded"),
        F.abs(F.col("l_quantity") - 25).alias("magnitude"), F.expr("l_partkey div 100").alias("hundreds"),
        (F.col("l_discount") / F.nullif("l_tax", F.lit(0.0))).alias("guarded"))


@query("fn_conditional", "p_partkey size_class brand type price_or_zero",
       """SELECT p_partkey, CASE WHEN p_size < 10 THEN 'S' WHEN p_size < 30 THEN 'M' ELSE 'L' END AS size_class,
  coalesce(nullif(p_brand, 'Brand#1'), 'none') AS brand, ifnull(nullif(p_type, 'PROMO'), '?') AS type,
  CASE WHEN p_size > 45 THEN 0 ELSE p_retailprice END AS price_or_zero FROM part""")
def _(b):
    size = F.col("p_size")
    return b.table("part").select(
        "p_partkey", F.when(size < 10, "S").when(size < 30, "M").otherwise("L").alias("size_class"),
        F.coalesce(F.nullif("p_brand", F.lit("Brand#1")), F.lit("none")).alias("brand"),
        F.ifnull(F.nullif("p_type", F.lit("PROMO")), F.lit("?")).alias("type"),
        F.when(size > 45, 0.0).otherwise(F.col("p_retailprice")).alias("price_or_zero"))


UTF16 = "sha256(unhex(regexp_replace(hex({0}), '(..)', '\\100', 'g')))"


@query("surrogate_key", "customer_id seq plain_key dated_key utf16_key",
       f"""SELECT customer_id, seq, {q.key('customer_id')} AS plain_key,
  {q.key('contact_phone', q.ms('ingested_at'))} AS dated_key,
  {q.signed(UTF16.format(q.parts('customer_id', 'contact_phone')))} AS utf16_key FROM b_customers""")
def _(b):
    return b.log("customers").select(
        "customer_id", "seq", keys.surrogate_key(F.col("customer_id")).alias("plain_key"),
        keys.surrogate_key(F.col("contact_phone"), keys.moment_text(F.col("ingested_at"))).alias("dated_key"),
        keys.surrogate_key(F.col("customer_id"), F.col("contact_phone"), utf16=True).alias("utf16_key"))


@query("attribute_hash", "customer_id seq fingerprint",
       """SELECT customer_id, seq, upper(sha256(company_name || '||' || coalesce(city, '<null>') || '||'
  || coalesce(contact_phone, '<null>') || '||')) AS fingerprint FROM b_customers""")
def _(b):
    return b.log("customers").select("customer_id", "seq", keys.attribute_hash(
        F.col("company_name"), F.col("city"), F.col("contact_phone")).alias("fingerprint"))


@query("fn_cast", "o_orderkey price:m share:m day:t as_text parsed",
       """SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(19,4)) AS price, CAST(o_totalprice / 1000000 AS DECIMAL(9,4)) AS share,
  CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS day, CAST(o_orderkey AS VARCHAR) AS as_text,
  TRY_CAST(substr(o_orderpriority, 1, 2) AS INT) AS parsed FROM orders""")
def _(b):
    return b.table("orders").select(
        "o_orderkey", repair.money(F.col("o_totalprice")).alias("price"),
        (F.col("o_totalprice") / 1000000).cast("decimal(9,4)").alias("share"),
        F.to_date("o_orderdate").cast("timestamp_ntz").alias("day"), F.col("o_orderkey").cast("string").alias("as_text"),
        F.substring("o_orderpriority", 1, 2).try_cast("int").alias("parsed"))
