"""Profiles, rollups and audits over whole tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.contracts import INGESTED, OP


def daily_totals(df: DataFrame, key: Column, key_name: str, count_name: str, sum_name: str,
                 amount: str = "importe") -> DataFrame:
    """Rows and amount per period key."""
    return df.groupBy(key.alias(key_name)).agg(F.count("*").alias(count_name), F.sum(amount).alias(sum_name))


def distinct_keys(logs: Mapping[str, tuple[DataFrame, str]], operations: Sequence[str] | None = None) -> DataFrame:
    """Exact number of distinct keys per entity; ``logs`` maps entity to (log, key column)."""
    parts = None
    for entity, (log, key) in logs.items():
        kept = log if operations is None else log.filter(F.col(OP).isin(list(operations)))
        one = kept.select(F.lit(entity).alias("entidad"), F.col(key).alias("_key"))
        parts = one if parts is None else parts.unionByName(one)
    # (entity, key) pairs are made distinct first: that is spread over all tasks, whereas a count
    # distinct per entity alone would gather one large entity's keys in one task.
    return parts.filter(F.col("_key").isNotNull()).distinct().groupBy("entidad").agg(F.count("*").alias("claves"))


def event_log(logs: Mapping[str, DataFrame]) -> DataFrame:
    """All entities' change events as (entity, time, operation)."""
    parts = None
    for entity, log in logs.items():
        one = log.select(F.lit(entity).alias("entidad"), INGESTED, OP)
        parts = one if parts is None else parts.unionByName(one)
    return parts


def event_profile(events: DataFrame) -> DataFrame:
    """Events by operation and first and last arrival, per entity."""
    op = F.col(OP)
    return events.groupBy("entidad").agg(
        F.count("*").alias("eventos_totales"), F.count_if(op == "I").alias("inserts"),
        F.count_if(op == "U").alias("updates"), F.count_if(op == "D").alias("deletes"),
        F.min(INGESTED).alias("primer_microlote"), F.max(INGESTED).alias("ultimo_microlote"))


def repeated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).filter("rows > 1")


def rare_values(df: DataFrame, column: str, at_most: int = 1) -> DataFrame:
    """Values that occur no more than ``at_most`` times."""
    return (df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
            .agg(F.count("*").alias("rows")).filter(F.col("rows") <= at_most))


def _labels(df: DataFrame, columns: Sequence[str], *keep: str) -> DataFrame:
    """One row per value of the columns: what is kept of the row, column_name, value. NULLs are left out."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(*keep, F.explode(pairs).alias("x")).select(*keep, "x.*").filter(F.col("value").isNotNull())


def rare_labels(df: DataFrame, columns: Sequence[str], at_most: int = 1) -> DataFrame:
    """Values of several columns that occur no more than ``at_most`` times: kept and reported. One scan, one aggregate."""
    return _labels(df, columns).groupBy("column_name", "value").agg(F.count("*").alias("rows")).filter(F.col("rows") <= at_most)


def outlier_log(df: DataFrame, table: str, key: str, columns: Sequence[str]) -> DataFrame:
    """Issue-log rows of values that occur once: the aggregate carries the key of the only row, so no join is needed."""
    once = _labels(df, columns, key).groupBy("column_name", "value").agg(F.count("*").alias("rows"), F.min(key).alias("k")).filter("rows = 1")
    return once.select(F.lit(table).alias("table_name"), F.col("k").alias("row_primary_key"), "column_name", F.lit("outlier").alias("issue_type"),
                       F.lit("low").alias("severity"), F.lit(None).cast("string").alias("original_clean_value"), F.col("value").alias("corrupted_value"),
                       F.lit(True).alias("is_auto_detectable"), F.lit("no").alias("is_repair_suggested"), F.lit("value found once").alias("description"))


def profile_table(df: DataFrame, name: str, key: str, date: str | None = None) -> DataFrame:
    """Rows, columns, NULLs per table, key uniqueness and date range, in one aggregate."""
    nulls = F.lit(0)
    for c in df.columns:
        nulls = nulls + F.col(c).isNull().cast("bigint")
    day = F.lit(None).cast("date") if date is None else F.to_date(date)
    # Grouping by key first spreads the distinct count and keeps it exact.
    per_key = df.groupBy(key).agg(F.count("*").alias("_n"), F.sum(nulls).alias("_nulls"),
                                  F.min(day).alias("_lo"), F.max(day).alias("_hi"))
    return per_key.agg(
        F.lit(name).alias("table_name"), F.sum("_n").alias("rows"), F.lit(len(df.columns)).alias("columns"),
        F.sum("_nulls").alias("nulls"), F.count(key).alias("distinct_keys"),
        F.coalesce(F.count_if(F.col("_n") > 1) == 0, F.lit(True)).alias("key_is_unique"),
        F.min("_lo").alias("first_date"), F.max("_hi").alias("last_date"))


def repair_audit(df: DataFrame, rules: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """Per rule (defect condition, repaired condition): defects found, repaired and left, in one scan."""
    counts = df.agg(*[c for i, (bad, fixed) in enumerate(rules.values())
                      for c in (F.count_if(bad).alias(f"d{i}"), F.count_if(bad & fixed).alias(f"r{i}"))])
    rows = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"d{i}").alias("defects"),
                              F.col(f"r{i}").alias("repaired"))
                     for i, name in enumerate(rules)])
    return (counts.select(F.explode(rows).alias("x")).select("x.*")
            .withColumn("left_as_is", F.col("defects") - F.col("repaired")))


def null_counts(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Missing values of the columns that are left as they are, counted in one scan."""
    counts = df.agg(F.count("*").alias("rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.select("rows", F.explode(F.array(*[
        F.struct(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"), F.col(c).alias("nulls"))
        for c in columns])).alias("x")).select("x.table_name", "x.column_name", "rows", "x.nulls")


def star_rollup(fact: DataFrame, dims: Mapping[str, tuple[DataFrame, str, Sequence[str]]]) -> DataFrame:
    """Measures by dimension attributes; ``dims`` maps a name to (dimension, key, attributes).

    The fact is summed by its dimension keys before the joins, so only group rows meet the
    dimensions, and summed again by attribute after them.
    """
    keys = [key for _, key, _ in dims.values()]
    measures = ["cantidad", "importe", "costo", "margen"]
    grouped = fact.groupBy(*keys).agg(F.count("*").alias("lineas"), *[F.sum(m).alias(m) for m in measures])
    by: list[str] = []
    for dim, key, attributes in dims.values():
        grouped = grouped.join(dim.select(key, *attributes), key, "left")
        by += attributes
    return grouped.groupBy(*by).agg(F.sum("lineas").alias("lineas"), *[F.sum(m).alias(m) for m in measures])
