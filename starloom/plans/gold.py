"""The Gold dimensions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from starloom.contracts import CUSTOMER_ATTRIBUTES, CUSTOMER_CHECKED, PRODUCT_ATTRIBUTES, PRODUCT_CHECKED
from starloom.operators.scd import dim_scd1, dim_scd2, scd2_history
from starloom.plans.silver import clean_customers, clean_products

# Attributes of the unknown member of each dimension.
_UNKNOWN_CUSTOMER = {"nombre": "Desconocido", "apellido": "Desconocido", "nombre_completo": "Desconocido",
                     "pais": "DESCONOCIDO", "ciudad": "Desconocido", "email_valido": False, "es_borrado": False}
_UNKNOWN_PRODUCT = {"sku": "DESCONOCIDO", "nombre_producto": "Desconocido", "categoria_id": "-1",
                    "categoria_nombre": "Desconocido", "marca": "Desconocido", "costo_unitario": 0,
                    "precio_unitario": 0, "activo": False, "es_borrado": False}
_UNKNOWN_CHANNEL = {"canal_nombre": "Desconocido", "canal_tipo": "DESCONOCIDO", "es_borrado": False}
_UNKNOWN_BRANCH = {"sucursal_nombre": "Desconocido", "ciudad": "Desconocido", "region": "Desconocido",
                   "pais": "DESCONOCIDO", "es_borrado": False}


def customer_history(customers: DataFrame, backdate_first: bool = True) -> DataFrame:
    """All customer versions from the Bronze log, which holds net changes."""
    return scd2_history(clean_customers(customers), "cliente_id", CUSTOMER_ATTRIBUTES, CUSTOMER_CHECKED,
                        backdate_first=backdate_first)


def product_history(products: DataFrame, categories: DataFrame, backdate_first: bool = True) -> DataFrame:
    """All product versions from the Bronze log, which holds net changes."""
    return scd2_history(clean_products(products, categories), "producto_id", PRODUCT_ATTRIBUTES,
                        PRODUCT_CHECKED, backdate_first=backdate_first)


def dim_customer(history: DataFrame, as_of: datetime) -> DataFrame:
    return dim_scd2(history, "cliente_key", "cliente_id", CUSTOMER_ATTRIBUTES, as_of, _UNKNOWN_CUSTOMER)


def dim_product(history: DataFrame, as_of: datetime) -> DataFrame:
    return dim_scd2(history, "producto_key", "producto_id", PRODUCT_ATTRIBUTES, as_of, _UNKNOWN_PRODUCT)


def dim_channel(channels: DataFrame, as_of: datetime) -> DataFrame:
    return dim_scd1(channels, "canal_key", "canal_id", ["canal_nombre", "canal_tipo", "es_borrado"], as_of,
                    _UNKNOWN_CHANNEL)


def dim_branch(branches: DataFrame, as_of: datetime) -> DataFrame:
    return dim_scd1(branches, "sucursal_key", "sucursal_id",
                    ["sucursal_nombre", "ciudad", "region", "pais", "es_borrado"], as_of, _UNKNOWN_BRANCH)
