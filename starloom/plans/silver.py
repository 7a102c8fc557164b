"""The seven Silver models: clean current state, one row per natural key."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.contracts import CATEGORY_ALIASES, COUNTRY_ALIASES, INGESTED, OP, SEQ
from starloom.functions import repair
from starloom.functions.keys import date_key
from starloom.functions.text import (clean_email, clean_phone, clean_text, conform, effective_sale,
                                     is_active, upper_label, valid_email)
from starloom.operators.cdc import label_catalog, latest_as_of, latest_event, mark_deleted

CUSTOMER_INPUT = ["company_name", "country", "city", "contact_email", "contact_phone", "customer_since"]
PRODUCT_INPUT = ["product_name", "category", "primary_supplier_id", "unit_cost", "list_price", "product_launch_date",
                 "is_discontinued", "discontinued_date"]
ORDER_INPUT = ["customer_id", "warehouse_id", "order_date", "order_status", "sales_channel"]
LINE_INPUT = ["sales_order_id", "product_id", "quantity", "unit_price", "discount_rate", "line_subtotal",
              "discount_amount", "line_total"]
INVOICE_INPUT = ["sales_order_id", "invoice_date", "due_date", "payment_term_days"]
SHIPMENT_INPUT = ["sales_order_id", "ship_date"]


def _trace():
    """Delete mark and the event's own arrival time and sequence."""
    return [mark_deleted(F.col(OP)).alias("es_borrado"), F.col(INGESTED), F.col(SEQ)]


def newest(log: DataFrame, key: str, *columns: str) -> DataFrame:
    """Latest event per key, of the named columns only, so that no others are read or shuffled."""
    return latest_event(log.select(key, *columns, OP, INGESTED, SEQ), [key])


def newest_as_of(log: DataFrame, key: str, columns: Sequence[str], moment: datetime) -> tuple[DataFrame, DataFrame]:
    """The log cut to what ``newest`` finds in it as of a moment, and now, by one shuffle for both."""
    return latest_as_of(log.select(key, *columns, OP, INGESTED, SEQ), [key], moment)


def _null(dtype: str = "string"):
    return F.lit(None).cast(dtype)


def clean_customers(events: DataFrame) -> DataFrame:
    """Clean customer attributes of each event."""
    name = clean_text(F.col("company_name"))
    since = F.col("customer_since").cast("timestamp_ntz")
    return events.select(
        F.col("customer_id").alias("cliente_id"), name.alias("nombre"), _null().alias("apellido"),
        name.alias("nombre_completo"), clean_email(F.col("contact_email")).alias("email"),
        clean_phone(F.col("contact_phone")).alias("telefono"),
        conform(F.col("country"), COUNTRY_ALIASES).alias("pais"), clean_text(F.col("city")).alias("ciudad"),
        valid_email(clean_email(F.col("contact_email"))).alias("email_valido"),
        since.alias("creado_en"), since.alias("actualizado_en"), *_trace())


def slv_customers(customers: DataFrame) -> DataFrame:
    return clean_customers(newest(customers, "customer_id", *CUSTOMER_INPUT)).drop(SEQ)


def slv_categories(products: DataFrame) -> DataFrame:
    labels = label_catalog(newest(products, "product_id", "category"),
                           conform(F.col("category"), CATEGORY_ALIASES), "categoria_id")
    return labels.select(
        "categoria_id", F.col("categoria_id").alias("categoria_nombre"), _null().alias("categoria_padre_id"),
        _null().alias("categoria_padre_nombre"), F.col(INGESTED).alias("actualizado_en"), "es_borrado", INGESTED)


def clean_products(events: DataFrame, categories: DataFrame) -> DataFrame:
    """Clean product attributes of each event, with the category's catalog entry."""
    clean = events.select(
        F.col("product_id").alias("producto_id"), F.col("product_id").alias("sku"),
        clean_text(F.col("product_name")).alias("nombre_producto"),
        conform(F.col("category"), CATEGORY_ALIASES).alias("categoria_id"),
        clean_text(F.col("primary_supplier_id")).alias("marca"),
        repair.money(F.col("unit_cost")).alias("costo_unitario"),
        repair.money(F.col("list_price")).alias("precio_unitario"),
        is_active(F.col("is_discontinued")).alias("activo"),
        F.coalesce("discontinued_date", "product_launch_date").cast("timestamp_ntz").alias("actualizado_en"),
        *_trace())
    names = categories.select("categoria_id", "categoria_nombre", "categoria_padre_id", "categoria_padre_nombre")
    return clean.join(names, "categoria_id", "left").select(
        "producto_id", "sku", "nombre_producto", "categoria_id", "categoria_nombre", "categoria_padre_id",
        "categoria_padre_nombre", "marca", "costo_unitario", "precio_unitario",
        repair.unit_margin(F.col("precio_unitario"), F.col("costo_unitario")).alias("margen_unitario"),
        "activo", "actualizado_en", "es_borrado", INGESTED, SEQ)


def slv_products(products: DataFrame, categories: DataFrame) -> DataFrame:
    return clean_products(newest(products, "product_id", *PRODUCT_INPUT), categories).drop(SEQ)


def slv_channels(orders: DataFrame) -> DataFrame:
    labels = label_catalog(newest(orders, "sales_order_id", "sales_channel"), upper_label(F.col("sales_channel")),
                           "canal_id")
    return labels.select("canal_id", F.col("canal_id").alias("canal_nombre"), _null().alias("canal_tipo"),
                         F.col(INGESTED).alias("actualizado_en"), "es_borrado", INGESTED)


def slv_branches(warehouses: DataFrame) -> DataFrame:
    return newest(warehouses, "warehouse_id", "warehouse_name", "country", "city").select(
        F.col("warehouse_id").alias("sucursal_id"), clean_text(F.col("warehouse_name")).alias("sucursal_nombre"),
        clean_text(F.col("city")).alias("ciudad"), _null().alias("region"),
        upper_label(F.col("country")).alias("pais"), F.col(INGESTED).alias("actualizado_en"), *_trace()).drop(SEQ)


def clean_invoices(invoices: DataFrame) -> DataFrame:
    """The newest state of each invoice: its order and repaired date."""
    repaired = repair.repair_invoice_date(F.col("invoice_date"), F.col("due_date"), F.col("payment_term_days"))
    return newest(invoices, "invoice_id", *INVOICE_INPUT).select(
        "invoice_id", "sales_order_id", repaired.alias("day"), *_trace())


def clean_shipments(shipments: DataFrame) -> DataFrame:
    """The newest state of each shipment: its order and date."""
    return newest(shipments, "shipment_id", *SHIPMENT_INPUT).select(
        "shipment_id", "sales_order_id", F.col("ship_date").alias("day"), *_trace())


def invoice_dates(invoices: DataFrame) -> DataFrame:
    """Latest repaired invoice date per order, deleted invoices left out."""
    return clean_invoices(invoices).filter("not es_borrado").groupBy("sales_order_id").agg(F.max("day").alias("invoice_date"))


def first_shipments(shipments: DataFrame) -> DataFrame:
    """First shipment date per order, deleted shipments left out."""
    return clean_shipments(shipments).filter("not es_borrado").groupBy("sales_order_id").agg(F.min("day").alias("ship_date"))


def newest_orders(orders: DataFrame) -> DataFrame:
    """The newest event of each order, with the columns its header uses."""
    return newest(orders, "sales_order_id", *ORDER_INPUT)


def order_headers(orders: DataFrame, invoiced: DataFrame, shipped: DataFrame, swap: bool = True) -> DataFrame:
    """Headers of orders (one row each) from their last invoice and first shipment dates."""
    joined = orders.join(invoiced, "sales_order_id", "left").join(shipped, "sales_order_id", "left")
    sold = repair.repair_order_date(F.col("order_date"), F.col("ship_date"), F.col("invoice_date"), swap)
    return joined.withColumn("_sold", sold).select(
        F.col("sales_order_id").alias("venta_id"), F.col("customer_id").alias("cliente_id"),
        upper_label(F.col("sales_channel")).alias("canal_id"), F.col("warehouse_id").alias("sucursal_id"),
        F.col("_sold").cast("timestamp_ntz").alias("fecha_venta"), date_key(F.col("_sold")).alias("fecha_key"),
        upper_label(F.col("order_status")).alias("estado"),
        effective_sale(F.col("order_status")).alias("es_venta_efectiva"), _null().alias("moneda"),
        F.col(INGESTED).alias("actualizado_en"), *_trace()).drop(SEQ)


def slv_orders(orders: DataFrame, invoices: DataFrame, shipments: DataFrame, swap: bool = True) -> DataFrame:
    """Order headers with the repaired date. ``swap`` also tries the exchange of day and month."""
    return order_headers(newest_orders(orders), invoice_dates(invoices), first_shipments(shipments), swap)


def slv_order_lines(lines: DataFrame) -> DataFrame:
    """Order lines with repaired quantity and discount and the recomputed amount."""
    subtotal, price = F.col("line_subtotal"), F.col("unit_price")
    discount = repair.repair_discount(F.col("discount_amount"), subtotal, F.col("discount_rate"))
    computed = newest(lines, "sales_order_line_id", *LINE_INPUT).select(
        F.col("sales_order_line_id").alias("venta_detalle_id"), F.col("sales_order_id").alias("venta_id"),
        F.col("product_id").alias("producto_id"),
        repair.repair_quantity(F.col("quantity"), subtotal, price).alias("cantidad"),
        repair.money(price).alias("precio_unitario"), repair.money(discount).alias("descuento"),
        repair.money(F.col("line_total")).alias("importe_origen"),
        repair.recompute_amount(subtotal, discount).alias("importe_calculado"), *_trace())
    source, amount = F.col("importe_origen"), F.col("importe_calculado")
    return computed.select(
        "venta_detalle_id", "venta_id", "producto_id", "cantidad", "precio_unitario", "descuento",
        "importe_origen", "importe_calculado", amount.alias("importe"),
        repair.amount_gap(source, amount).alias("diferencia_importe"),
        repair.amount_mismatch(source, amount).alias("tiene_descuadre"),
        F.col(INGESTED).alias("actualizado_en"), "es_borrado", INGESTED)
