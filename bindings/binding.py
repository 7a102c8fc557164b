"""The driver tables as Bronze logs, Silver models and Gold tables of one scale factor."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindings.bronze import Spark, columns_of, derivations
from starloom.operators.calendar import dim_date_over
from starloom.operators.fact import fact_sales
from starloom.plans import gold, silver

AS_OF = datetime(2002, 1, 1)
SPLIT = datetime(1998, 6, 1)  # a moment in the middle of the data, for before/after cases


class Lazy(Mapping):
    """Named frames, each made on first use and kept."""

    def __init__(self, makers: dict[str, Callable[[], DataFrame]]):
        self._makers, self._made = makers, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __iter__(self):
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


class Binding:
    """Lazily built frames over one folder of driver tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self._sql = derivations(Spark(self.sf_dir))
        self._logs: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def log(self, entity: str) -> DataFrame:
        """An entity's change log, cast to its contract."""
        if entity not in self._logs:
            raw = self.spark.sql(self._sql[entity])
            self._logs[entity] = raw.select(*[F.col(c).cast(t).alias(c) for c, t in columns_of(entity)])
        return self._logs[entity]

    @cached_property
    def silver(self) -> Lazy:
        """The Silver models, each built when first asked for."""
        log = self.log
        return Lazy({
            "slv_clientes": lambda: silver.slv_customers(log("customers")),
            "slv_categorias": lambda: silver.slv_categories(log("products")),
            "slv_productos": lambda: silver.slv_products(log("products"), self.silver["slv_categorias"]),
            "slv_canales": lambda: silver.slv_channels(log("sales_orders")),
            "slv_sucursales": lambda: silver.slv_branches(log("warehouses")),
            "slv_ventas": lambda: silver.slv_orders(log("sales_orders"), log("invoices"), log("shipments")),
            "slv_venta_detalle": lambda: silver.slv_order_lines(log("sales_order_lines")),
        })

    def customer_history(self, backdate_first: bool = True) -> DataFrame:
        return gold.customer_history(self.log("customers"), backdate_first)

    def product_history(self, backdate_first: bool = True) -> DataFrame:
        return gold.product_history(self.log("products"), self.silver["slv_categorias"], backdate_first)

    def dims(self, backdate_first: bool = True) -> Lazy:
        return Lazy({
            "cliente": lambda: gold.dim_customer(self.customer_history(backdate_first), AS_OF),
            "producto": lambda: gold.dim_product(self.product_history(backdate_first), AS_OF),
            "canal": lambda: gold.dim_channel(self.silver["slv_canales"], AS_OF),
            "sucursal": lambda: gold.dim_branch(self.silver["slv_sucursales"], AS_OF),
        })

    @cached_property
    def gold(self) -> Lazy:
        return self.dims()

    @cached_property
    def dim_date(self) -> DataFrame:
        """Calendar over the years the order dates span."""
        bounds = self.table("orders").agg(
            F.trunc(F.min("o_orderdate"), "year").alias("start"),
            F.last_day(F.add_months(F.trunc(F.max("o_orderdate"), "year"), 11)).alias("end"))
        return dim_date_over(bounds, AS_OF)

    def fact(self, dims: Mapping[str, DataFrame] | None = None) -> DataFrame:
        return fact_sales(self.silver["slv_venta_detalle"], self.silver["slv_ventas"], dims or self.gold)
