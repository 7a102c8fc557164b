"""Freshness, health and reconciliation views. Every "now" is the argument ``as_of``."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.contracts import (AMOUNT_TOLERANCE, FRESH_ERROR_MINUTES, FRESH_WARN_MINUTES, INGESTED,
                                OP, RECONCILIATION_SCHEMA, SLA_MINUTES, STALE_AFTER_MINUTES)
from starloom.functions.dates import minutes_between
from starloom.operators.fact import eligible_lines
from starloom.operators.joins import reconcile
from starloom.operators.profile import daily_totals, event_profile


def _now(as_of: datetime | Column) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp_ntz")


def freshness(events: DataFrame, as_of: datetime | Column, limit: int = STALE_AFTER_MINUTES) -> DataFrame:
    """Event counts per entity with the minutes since its last arrival and a verdict."""
    age = minutes_between(F.col("ultimo_microlote"), _now(as_of))
    return event_profile(events).withColumn("minutos_sin_datos", age).withColumn(
        "estado", F.when(F.col("minutos_sin_datos") > limit, "REVISAR").otherwise("OK"))


def source_freshness(events: DataFrame, as_of: datetime | Column, warn: int = FRESH_WARN_MINUTES,
                     error: int = FRESH_ERROR_MINUTES) -> DataFrame:
    """pass, warn or error per entity by the age of its last arrival."""
    age = F.col("age_minutes")
    return (events.groupBy("entidad").agg(F.max(INGESTED).alias("max_loaded_at"))
            .withColumn("age_minutes", minutes_between(F.col("max_loaded_at"), _now(as_of)))
            .withColumn("status", F.when(age > error, "error").when(age > warn, "warn").otherwise("pass")))


def errors_24h(quality_log: DataFrame, as_of: datetime | Column) -> DataFrame:
    """Error entries per entity in the last day."""
    recent = F.col("detected_at") > _now(as_of) - F.make_dt_interval(days=F.lit(1))
    return (quality_log.filter(recent & (F.col("severity") == "error"))
            .groupBy("entity_name").agg(F.count("*").alias("_errors")))


def pipeline_health(watermarks: DataFrame, quality_log: DataFrame, as_of: datetime | Column,
                    limit: int = STALE_AFTER_MINUTES) -> DataFrame:
    """Delay, verdict and recent errors per watermark row."""
    return (watermarks.join(errors_24h(quality_log, as_of), "entity_name", "left")
            .withColumn("minutos_de_retraso", minutes_between(F.col("last_loaded_at"), _now(as_of)))
            .select("layer_name", "entity_name", "last_loaded_at", "rows_last_batch", "minutos_de_retraso",
                    F.when(F.col("minutos_de_retraso") > limit, "RETRASADO").otherwise("OK").alias("estado_sla"),
                    F.coalesce("_errors", F.lit(0)).alias("fallos_calidad_24h")))


def quality_window(quality_log: DataFrame, as_of: datetime | Column) -> DataFrame:
    """Failed rows and last failure by entity, test and severity in the last day."""
    recent = F.col("detected_at") > _now(as_of) - F.make_dt_interval(days=F.lit(1))
    return quality_log.filter(recent).groupBy("entity_name", "test_name", "severity").agg(
        F.sum("failed_rows").alias("filas_fallidas"), F.max("detected_at").alias("ultimo_fallo"))


def sla_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SLA_MINUTES.items()), "entity_name string, sla_minutes int")


def sla_status(watermarks: DataFrame, sla: DataFrame, as_of: datetime | Column) -> DataFrame:
    """Age of each entity's last load against its own promise."""
    age = minutes_between(F.col("last_loaded_at"), _now(as_of))
    return (watermarks.join(F.broadcast(sla), "entity_name", "left")  # one row per published table
            .select("layer_name", "entity_name", "last_loaded_at", "sla_minutes", age.alias("age_minutes"))
            .withColumn("status", F.when(F.col("sla_minutes").isNull(), "NO SLA")
                        .when(F.col("age_minutes") > F.col("sla_minutes"), "LATE").otherwise("OK")))


def recon_bronze_silver(pairs: Mapping[str, tuple[DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Distinct inserted or updated keys in Bronze, Silver rows, and keys Silver lacks, per entity.

    ``pairs`` maps a name to (log, log key, Silver table, Silver key).
    """
    parts = None
    for name, (log, log_key, table, key) in pairs.items():
        wanted = log.filter(F.col(OP).isin("I", "U")).select(F.col(log_key).alias("_k")).distinct()
        have = table.select(F.col(key).alias("_s"))
        both = wanted.join(have, F.col("_k") == F.col("_s"), "full_outer")
        one = both.agg(F.count("_k").alias("claves_bronze"), F.count("_s").alias("filas_silver"),
                       F.count_if(F.col("_s").isNull()).alias("faltan")).select(
            F.lit(name).alias("entidad"), "claves_bronze", "filas_silver", "faltan")
        parts = one if parts is None else parts.unionByName(one)
    return parts


def silver_totals(lines: DataFrame, headers: DataFrame, period: Column, name: str) -> DataFrame:
    """Eligible lines and amount per period; undated sales count under the unknown date."""
    return daily_totals(eligible_lines(lines, headers), period, name, "filas_silver", "importe_silver")


def recon_silver_gold(lines: DataFrame, headers: DataFrame, fact: DataFrame,
                      period=lambda key: key, name: str = "fecha_key") -> DataFrame:
    """Silver against Gold per period: counts and amounts with a verdict.

    ``period`` maps a date key to the period (the identity for days).
    """
    key = F.coalesce(F.col("fecha_key"), F.lit(-1))
    silver = silver_totals(lines, headers, period(key), name)
    gold = daily_totals(fact, period(F.col("fecha_key")), name, "filas_gold", "importe_gold")
    return reconcile(silver, gold, [name], ("filas_silver", "filas_gold"),
                     ("importe_silver", "importe_gold"), AMOUNT_TOLERANCE)


def recon_rows(verdicts: DataFrame, check: str, period: str, source: tuple[str, str, str],
               target: tuple[str, str, str], run_id: str, as_of: datetime) -> DataFrame:
    """Reconciliation-log rows; source and target are (layer, count column, measure column)."""
    values = {
        "run_id": F.lit(run_id), "check_name": F.lit(check), "period_key": F.col(period),
        "source_layer": F.lit(source[0]), "target_layer": F.lit(target[0]),
        "source_row_count": F.coalesce(F.col(source[1]), F.lit(0)),
        "target_row_count": F.coalesce(F.col(target[1]), F.lit(0)),
        "source_measure": F.coalesce(F.col(source[2]), F.lit(0)),
        "target_measure": F.coalesce(F.col(target[2]), F.lit(0)),
        "is_match": F.col("is_match"), "checked_at": _now(as_of)}
    return verdicts.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in RECONCILIATION_SCHEMA.fields])


def star_integrity(fact: DataFrame, dims: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Orphans and unknowns per dimension; ``dims`` maps a name to (dimension, key column).

    The fact is counted per key first, so the joins see one row per key.
    """
    parts = None
    for name, (dim, key) in dims.items():
        used = fact.groupBy(F.col(key).alias("_k")).agg(F.count("*").alias("_n"))
        known = dim.select(F.col(key).alias("_d")).distinct()
        one = used.join(known, F.col("_k") == F.col("_d"), "left").agg(
            F.coalesce(F.sum(F.when(F.col("_d").isNull(), F.col("_n"))), F.lit(0)).alias("huerfanos"),
            F.coalesce(F.sum(F.when(F.col("_k") == -1, F.col("_n"))), F.lit(0)).alias("desconocidos"))
        one = one.select(F.lit(name).alias("dimension"), "huerfanos", "desconocidos")
        parts = one if parts is None else parts.unionByName(one)
    return parts
