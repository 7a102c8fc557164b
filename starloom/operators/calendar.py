"""The calendar dimension."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.contracts import CALENDAR_END, CALENDAR_START, INGESTED, UNKNOWN_KEY
from starloom.functions.dates import week_of_year
from starloom.functions.keys import date_key
from starloom.operators.scd import with_unknown


def number_series(bounds: DataFrame, low: str = "low", high: str = "high", name: str = "n") -> DataFrame:
    """The integers from ``low`` to ``high`` of the one row of ``bounds``, made by all tasks; none for NULL bounds."""
    row = bounds.select(low, high).first()
    if row is None or None in row:
        return bounds.sparkSession.range(0).toDF(name)
    return bounds.sparkSession.range(row[0], row[1] + 1).toDF(name)


def calendar_days(bounds: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """The days from ``start`` to ``end`` of each row of ``bounds``, both included."""
    return bounds.select(F.explode(F.sequence(F.col(start), F.col(end))).alias("fecha"))


def dim_date(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END,
             as_of: datetime | str = "1900-01-01") -> DataFrame:
    """Calendar dimension over a fixed range."""
    bounds = spark.range(0, 1, 1, 1).select(F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end"))
    return dim_date_over(bounds, as_of)


def dim_date_over(bounds: DataFrame, as_of: datetime | str) -> DataFrame:
    """Calendar dimension over the one-row range ``(start, end)``, plus the unknown date."""
    d = F.col("fecha")
    stamp = F.lit(as_of).cast("timestamp_ntz")

    def part(c: Column) -> Column:
        return c.cast("int")

    dim = calendar_days(bounds).select(
        date_key(d).alias("fecha_key"), d,
        part(F.year(d)).alias("anio"), part(F.quarter(d)).alias("trimestre"),
        part(F.month(d)).alias("mes"), part(F.day(d)).alias("dia"),
        part(F.dayofyear(d)).alias("dia_del_anio"), week_of_year(d).alias("semana_anio"),
        part(F.dayofweek(d)).alias("dia_semana"),
        F.date_format(d, "MMMM").alias("mes_nombre"), F.date_format(d, "EEEE").alias("dia_semana_nombre"),
        (F.year(d) * 100 + F.month(d)).alias("anio_mes"),
        (F.year(d) * 10 + F.quarter(d)).alias("anio_trimestre"),
        F.trunc(d, "month").alias("primer_dia_mes"), F.last_day(d).alias("ultimo_dia_mes"),
        F.dayofweek(d).isin(1, 7).alias("es_fin_semana"),
        (d == F.last_day(d)).alias("es_fin_de_mes"),
        (d <= F.to_date(stamp)).alias("es_pasado"),
        stamp.alias(INGESTED))
    # The unknown date.
    return with_unknown(dim, {
        "fecha_key": UNKNOWN_KEY, "fecha": "1900-01-01", "anio": 1900, "trimestre": 0, "mes": 0, "dia": 0,
        "dia_del_anio": 0, "semana_anio": 0, "dia_semana": 0, "mes_nombre": "Desconocido",
        "dia_semana_nombre": "Desconocido", "anio_mes": 190001, "anio_trimestre": 19000,
        "primer_dia_mes": "1900-01-01", "ultimo_dia_mes": "1900-01-31", "es_fin_semana": False,
        "es_fin_de_mes": False, "es_pasado": False, INGESTED: stamp})
