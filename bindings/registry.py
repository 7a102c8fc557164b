"""Registry of the queries and their oracles, with one output format for both.

An output format lists columns as ``name`` or ``name:type``. Dates (d) and timestamps (t) are given
out as text, decimals (m) as doubles and counts (i) as big integers, so that both engines hand over
the same Python values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindings.binding import Binding
from bindings.sql import oracle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _columns(spec: str) -> list[tuple[str, str]]:
    return [(n, t) for n, _, t in (c.partition(":") for c in spec.split())]


def present(df: DataFrame, spec: str) -> DataFrame:
    forms = {
        "d": lambda c: F.date_format(c, "yyyy-MM-dd"), "t": lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSS"),
        "m": lambda c: c.cast("double"), "i": lambda c: c.cast("bigint"), "": lambda c: c}
    return df.select(*[forms[t](F.col(n)).alias(n) for n, t in _columns(spec)])


def present_sql(sql: str, spec: str) -> str:
    forms = {
        "d": "strftime({0}, '%Y-%m-%d')", "t": "strftime({0}, '%Y-%m-%d %H:%M:%S.%g')",
        "m": "CAST({0} AS DOUBLE)", "i": "CAST({0} AS BIGINT)", "": "{0}"}
    columns = ", ".join(f"{forms[t].format(n)} AS {n}" for n, t in _columns(spec))
    return f"SELECT {columns} FROM ({sql}) AS result"


def query(name: str, spec: str, sql: str | None):
    """Register ``fn(binding) -> DataFrame`` under a name, with its oracle's body."""
    def add(fn: Callable[[Binding], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return present(fn(Binding(spark, sf_dir)), spec)
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = oracle(present_sql(sql, spec))
        return fn
    return add
