"""Schemas, keys and fixed business values shared by every layer."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
          "boolean": T.BooleanType(), "date": T.DateType(), "timestamp_ntz": T.TimestampNTZType(),
          "decimal(38,6)": T.DecimalType(38, 6)}


def schema_of(columns: str) -> T.StructType:
    """A schema from ``name type`` pairs; needs no running session, unlike a DDL string."""
    pairs = [c.strip().split(" ", 1) for c in columns.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[dtype]) for name, dtype in pairs])


# ---- Bronze: one change log per source entity ---------------------------------------------
# Source column names and types. Every log also carries the change columns below.

OP = "cdc_operation"
INGESTED = "ingested_at"
SEQ = "seq"
CHANGE_COLUMNS = f"{OP} string, {INGESTED} timestamp_ntz, {SEQ} bigint"

_SOURCE_DDL = {
    "customers": "customer_id string, company_name string, customer_segment string, country string, "
                 "city string, region_type string, contact_email string, contact_phone string, "
                 "payment_term_days int, credit_limit double, customer_since date, is_active boolean",
    "inventory_snapshots": "inventory_snapshot_id string, snapshot_date timestamp_ntz, product_id string, "
                           "warehouse_id string, quantity_on_hand int, quantity_on_order string, "
                           "reorder_point int, is_stockout boolean, inventory_value double",
    "invoices": "invoice_id string, sales_order_id string, customer_id string, invoice_date date, "
                "due_date date, payment_term_days int, invoice_amount double, amount_paid double, "
                "balance_due double, invoice_status string, days_to_full_payment double, late_payment boolean",
    "payments": "payment_id string, invoice_id string, payment_date date, payment_amount double, "
                "payment_method string, is_partial_payment boolean",
    "products": "product_id string, product_name string, category string, subcategory string, "
                "primary_supplier_id string, unit_cost double, list_price double, gross_margin_pct double, "
                "unit_of_measure string, weight_kg double, is_seasonal boolean, product_launch_date date, "
                "is_discontinued boolean, discontinued_date date, reorder_point int, reorder_quantity int",
    "purchase_order_lines": "purchase_order_line_id string, purchase_order_id string, line_number int, "
                            "product_id string, quantity_ordered int, unit_cost double, line_total double, "
                            "quantity_received double",
    "purchase_orders": "purchase_order_id string, supplier_id string, warehouse_id string, order_date date, "
                       "expected_delivery_date date, actual_delivery_date date, po_status string, "
                       "subtotal double, freight_cost double, total_amount double",
    "returns": "return_id string, shipment_id string, sales_order_line_id string, return_date date, "
               "returned_quantity int, return_reason string, return_condition string, "
               "restocking_fee_rate double, refund_amount double",
    "sales_order_lines": "sales_order_line_id string, sales_order_id string, line_number int, "
                         "product_id string, quantity int, unit_price double, discount_rate double, "
                         "line_subtotal double, discount_amount double, line_total double",
    "sales_orders": "sales_order_id string, customer_id string, warehouse_id string, order_date date, "
                    "order_status string, sales_channel string, subtotal double, discount_total double, "
                    "tax_rate double, tax_amount double, shipping_cost double, total_amount double",
    "shipments": "shipment_id string, sales_order_id string, warehouse_id string, ship_date date, "
                 "expected_delivery_date date, actual_delivery_date date, carrier string, "
                 "shipping_status string",
    "supplier_invoices": "supplier_invoice_id string, purchase_order_id string, supplier_id string, "
                         "invoice_date date, due_date date, invoice_amount double, amount_paid double, "
                         "balance_due double, invoice_status string",
    "supplier_payments": "supplier_payment_id string, supplier_invoice_id string, payment_date date, "
                         "payment_amount double, payment_method string",
    "suppliers": "supplier_id string, supplier_name string, supplier_reliability_tier string, "
                 "country string, lead_time_days_mean int, avg_defect_rate double, "
                 "default_payment_term_days int, supplier_since date",
    "support_tickets": "support_ticket_id string, customer_id string, related_sales_order_id string, "
                       "related_shipment_id string, related_invoice_id string, created_at date, "
                       "category string, priority string, ticket_text string, sentiment string, "
                       "resolution_time_hours double, status string",
    "warehouses": "warehouse_id string, warehouse_name string, country string, city string, "
                  "capacity_units int",
}


@dataclass(frozen=True)
class Entity:
    """One source table: its name, natural key and source schema."""

    name: str
    key: str
    source_schema: T.StructType

    @property
    def change_schema(self) -> T.StructType:
        return T.StructType(self.source_schema.fields + schema_of(CHANGE_COLUMNS).fields)


def _entity(name: str, ddl: str) -> Entity:
    schema = schema_of(ddl)
    return Entity(name, schema.fields[0].name, schema)


ENTITIES: dict[str, Entity] = {name: _entity(name, ddl) for name, ddl in _SOURCE_DDL.items()}

# ---- Fixed values: business rules ---------------------------------------------------------

UNKNOWN_KEY = -1
LATE_BUFFER_MINUTES = 15
MICROBATCH = "15 minutes"
STALE_AFTER_MINUTES = 30
FRESH_WARN_MINUTES = 30
FRESH_ERROR_MINUTES = 120
AMOUNT_TOLERANCE = "0.01"
CALENDAR_START, CALENDAR_END = "2020-01-01", "2030-12-31"
FIRST_MOMENT, LAST_MOMENT = "1900-01-01", "9999-12-31"
EFFECTIVE_STATUS = "COMPLETED"
EMAIL_PATTERN = "%_@_%.__%"
MONEY = "decimal(19,4)"
MARGIN = "decimal(9,6)"

COUNTRY_ALIASES = {
    "US": "UNITED STATES",
    "USA": "UNITED STATES",
    "U.S.A.": "UNITED STATES",
    "UK": "UNITED KINGDOM",
    "U.K.": "UNITED KINGDOM",
    "ENGLAND": "UNITED KINGDOM",
}
CATEGORY_ALIASES = {
    "ELECTRONICS ACCESSORY": "ELECTRONICS ACCESSORIES",
}

DOMAINS = {
    ("sales_orders", "order_status"): ["Completed", "Cancelled", "Pending Fulfillment"],
    ("sales_orders", "sales_channel"): ["Online Portal", "Phone/Email", "Account Manager"],
    ("invoices", "invoice_status"): ["Paid", "Overdue", "Unpaid", "Partially Paid"],
    ("payments", "payment_method"): ["ACH/Bank Transfer", "Wire Transfer", "Credit Card", "Check"],
    ("shipments", "carrier"): ["Regional Carrier", "UPS", "FedEx", "DHL"],
    ("shipments", "shipping_status"): ["Delivered", "In Transit", "Lost", "Delayed"],
    ("purchase_orders", "po_status"): ["Received", "Cancelled", "In Transit"],
    ("returns", "return_reason"): ["Not as Described", "Changed Mind", "Defective",
                                   "Damaged in Transit", "Wrong Item Shipped"],
    ("returns", "return_condition"): ["Damaged/Not Resellable", "Resellable"],
    ("support_tickets", "category"): ["Shipping Delay", "Product Defect", "General Inquiry",
                                      "Billing Question"],
    ("support_tickets", "priority"): ["Low", "Medium", "High", "Urgent"],
    ("support_tickets", "sentiment"): ["Negative", "Neutral", "Positive"],
    ("support_tickets", "status"): ["Open", "Resolved", "Closed"],
    ("suppliers", "supplier_reliability_tier"): ["Reliable", "Average", "Unreliable"],
}

# Freshness promise per published table, in minutes.
SLA_MINUTES = {
    "slv_clientes": 15,
    "slv_categorias": 60,
    "slv_productos": 15,
    "slv_canales": 60,
    "slv_sucursales": 60,
    "slv_ventas": 15,
    "slv_venta_detalle": 15,
    "dim_cliente": 15,
    "dim_producto": 15,
    "dim_canal": 60,
    "dim_sucursal": 60,
    "fact_ventas": 15,
}

# ---- SCD2 dimensions: attributes carried, attributes whose change opens a version ------------

CUSTOMER_ATTRIBUTES = ["nombre", "apellido", "nombre_completo", "email", "telefono", "pais", "ciudad",
                       "email_valido", "creado_en", "es_borrado"]
CUSTOMER_CHECKED = ["nombre_completo", "email", "pais", "ciudad", "es_borrado"]
PRODUCT_ATTRIBUTES = ["sku", "nombre_producto", "categoria_id", "categoria_nombre", "categoria_padre_id",
                      "categoria_padre_nombre", "marca", "costo_unitario", "precio_unitario",
                      "margen_unitario", "activo", "es_borrado"]
PRODUCT_CHECKED = ["nombre_producto", "categoria_id", "marca", "costo_unitario", "precio_unitario",
                   "activo", "es_borrado"]

# ---- Control tables -----------------------------------------------------------------------

WATERMARK_SCHEMA = schema_of(
    "layer_name string, entity_name string, last_seq bigint, last_loaded_at timestamp_ntz, "
    "last_run_id string, rows_last_batch bigint, updated_at timestamp_ntz")
RUN_LOG_SCHEMA = schema_of(
    "run_id string, pipeline_name string, layer_name string, entity_name string, "
    "window_start timestamp_ntz, window_end timestamp_ntz, status string, rows_affected bigint, "
    "duration_ms bigint, error_message string, logged_at timestamp_ntz")
QUALITY_LOG_SCHEMA = schema_of(
    "run_id string, layer_name string, entity_name string, test_name string, severity string, "
    "failed_rows bigint, sample_value string, detected_at timestamp_ntz")
RECONCILIATION_SCHEMA = schema_of(
    "run_id string, check_name string, period_key int, source_layer string, target_layer string, "
    "source_row_count bigint, target_row_count bigint, source_measure decimal(38,6), "
    "target_measure decimal(38,6), is_match boolean, checked_at timestamp_ntz")
CONTROL_SCHEMA = schema_of(
    "entity_name string, capture_name string, last_seq bigint, last_extracted_at timestamp_ntz, "
    "rows_last_batch bigint, active boolean, updated_at timestamp_ntz")
