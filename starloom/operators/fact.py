"""The sales fact: one row per order line of an effective sale."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.contracts import INGESTED, MONEY
from starloom.functions.repair import money
from starloom.operators.joins import resolve_unknown, scd1_lookup, scd2_lookup
from starloom.operators.merge import remove_and_insert
from starloom.sources.bronze import newer_than

LINE_KEY = "venta_detalle_id"
ORDER_KEY = "venta_id"


def active(df: DataFrame) -> DataFrame:
    """Rows not logically deleted."""
    return df.filter(~F.col("es_borrado"))


def effective(headers: DataFrame) -> DataFrame:
    """Undeleted headers of effective sales."""
    return active(headers).filter("es_venta_efectiva")


def eligible_headers(headers: DataFrame) -> DataFrame:
    """What a line takes from its effective, undeleted header."""
    return effective(headers).select(
        ORDER_KEY, "cliente_id", "canal_id", "sucursal_id", "fecha_venta", "fecha_key",
        F.col(INGESTED).alias("_header_ts"))


def eligible_lines(lines: DataFrame, headers: DataFrame) -> DataFrame:
    """Undeleted lines joined to their effective, undeleted header."""
    return active(lines).join(eligible_headers(headers), ORDER_KEY, "inner")


def fact_sales(lines: DataFrame, headers: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """The fact rows. ``dims`` holds cliente, producto (versioned), canal and sucursal.

    Customer and product resolve to the version in force on the sale date; a missing dimension row
    gives the unknown key and, for the product, cost zero. What depends on the header alone is looked up
    for headers, before their lines meet them: there are several times fewer, and they are narrower.
    """
    head = eligible_headers(headers)
    head = scd2_lookup(head, dims["cliente"], "cliente_id", "fecha_venta", {"cliente_key": "_c"}, split="month")
    head = scd1_lookup(head, dims["canal"], "canal_id", {"canal_key": "_n_key"})
    head = scd1_lookup(head, dims["sucursal"], "sucursal_id", {"sucursal_key": "_s"})
    rows = active(lines).join(head, ORDER_KEY, "inner")
    rows = scd2_lookup(rows, dims["producto"], "producto_id", "fecha_venta",
                       {"producto_key": "_p", "costo_unitario": "_cost"}, split="month")
    cost = F.col("cantidad") * F.coalesce(F.col("_cost"), F.lit(0).cast(MONEY))
    return rows.select(
        LINE_KEY, ORDER_KEY, resolve_unknown(F.col("fecha_key")).alias("fecha_key"),
        resolve_unknown(F.col("_c")).alias("cliente_key"), resolve_unknown(F.col("_p")).alias("producto_key"),
        resolve_unknown(F.col("_n_key")).alias("canal_key"), resolve_unknown(F.col("_s")).alias("sucursal_key"),
        "cliente_id", "producto_id", "canal_id", "sucursal_id", "fecha_venta",
        "cantidad", "precio_unitario", "descuento", "importe",
        money(cost).alias("costo"), money(F.col("importe") - cost).alias("margen"),
        "tiene_descuadre", F.greatest(F.col(INGESTED), F.col("_header_ts")).alias(INGESTED))


def clamp_returns(returns: DataFrame, lines: DataFrame, line: str = "sales_order_line_id") -> DataFrame:
    """Returns with the quantity cut to what the line sold; a return without its line stays as it is.

    ``lines`` holds one row per line with its repaired ``quantity``.
    """
    sold = lines.select(F.col(line).alias("_line"), F.col("quantity").alias("sold_quantity"))
    joined = returns.join(sold, F.col(line) == F.col("_line"), "left").drop("_line")
    return joined.withColumn("clamped_quantity", F.least("returned_quantity", "sold_quantity"))


def changed_lines(lines: DataFrame, headers: DataFrame, watermark: datetime, orders: DataFrame | None = None) -> DataFrame:
    """Ids of the lines that changed, or whose header did, since the watermark, or whose order is among ``orders`` (one column).

    Taken before any deleted or status filter, so that a line that no longer qualifies is found too.
    """
    new = newer_than(lines, watermark).select(LINE_KEY)
    headers_new = newer_than(headers, watermark).select(ORDER_KEY)
    headers_new = (headers_new if orders is None else headers_new.unionByName(orders.select(F.col(orders.columns[0]).alias(ORDER_KEY)))).distinct()
    touched = lines.join(headers_new, ORDER_KEY, "left_semi").select(LINE_KEY)
    return new.unionByName(touched).distinct()


def lines_of(lines: DataFrame, line_ids: DataFrame, order_ids: DataFrame) -> DataFrame:
    """Ids of the lines named themselves or through their order, such as those that one batch wrote."""
    touched = lines.join(order_ids.select(ORDER_KEY).distinct(), ORDER_KEY, "left_semi").select(LINE_KEY)
    return line_ids.select(LINE_KEY).unionByName(touched).distinct()


def changed_orders(orders: DataFrame, invoices: DataFrame, shipments: DataFrame, watermark: datetime | Sequence[datetime],
                   key: str = "sales_order_id") -> DataFrame:
    """Ids of the orders that changed, or whose invoice or shipment did, since the watermark.

    Each log may have its own watermark, so that rows of one that arrive behind another are not missed.
    """
    marks = [watermark] * 3 if isinstance(watermark, datetime) else watermark
    parts = [newer_than(df, mark).select(key) for df, mark in zip((orders, invoices, shipments), marks)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).filter(F.col(key).isNotNull()).distinct()


def fact_incremental(target: DataFrame, changed: DataFrame, rows: DataFrame) -> DataFrame:
    """The fact after a batch: changed lines leave, those that still qualify come back."""
    return remove_and_insert(target, changed, rows, [LINE_KEY])
