"""Slowly changing dimensions: snapshots, histories from a log, and the dimension tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import WindowSpec

from starloom.contracts import FIRST_MOMENT, INGESTED, LAST_MOMENT, SEQ, UNKNOWN_KEY
from starloom.functions.keys import moment_text, surrogate_key
from starloom.operators.segments import DAY, edge_group, segment_of

VALID_FROM, VALID_TO = "valid_from", "valid_to"


def _moment(value: Column | datetime | str) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp_ntz")


def _differs(a: str, b: str, columns: Sequence[str]) -> Column:
    """True when any column differs; two NULLs are equal."""
    changed = F.lit(False)
    for c in columns:
        changed = changed | ~F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return changed


def snapshot_check(history: DataFrame | None, current: DataFrame, key: str, check: Sequence[str],
                   as_of: Column | datetime | str, hard_deletes: bool = True,
                   backdate_first: bool = False) -> DataFrame:
    """The history after comparing the present state with the open versions.

    A new key opens a version at ``as_of``; a changed ``check`` column closes the open version and
    opens another; an unchanged key keeps its version as it was. With ``hard_deletes`` a key missing
    from ``current`` has its version closed. ``backdate_first`` starts the first version of a key
    at 1900-01-01, so that older facts find it.

    Only open versions are joined; closed ones pass through. Keys are unique on both sides of the
    join, so no key can make one task heavy.
    """
    now = _moment(as_of)
    columns = current.columns
    if history is None:
        start = _moment(FIRST_MOMENT) if backdate_first else now
        return current.withColumns({VALID_FROM: start, VALID_TO: F.lit(None).cast("timestamp_ntz")})

    closed = history.filter(F.col(VALID_TO).isNotNull())
    if backdate_first:
        returning = closed.select(F.col(key).alias("_k")).distinct()
        current = (current.join(returning, F.col(key) == F.col("_k"), "left")
                   .withColumn("_start", F.when(F.col("_k").isNull(), _moment(FIRST_MOMENT)).otherwise(now))
                   .drop("_k"))
    else:
        current = current.withColumn("_start", now)
    opened = history.filter(F.col(VALID_TO).isNull()).select(
        F.struct(*[F.col(c) for c in history.columns]).alias("old"))
    present = current.select(F.struct(*columns).alias("new"), F.col("_start").alias("_start"))
    pair = opened.join(present, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")

    no_end = F.lit(None).cast("timestamp_ntz")

    def version(source: str, start: Column, end: Column) -> Column:
        values = [(F.col(f"{source}.{c}") if c in columns or source == "old"
                   else F.lit(None).cast(history.schema[c].dataType)).alias(c)
                  for c in history.columns if c not in (VALID_FROM, VALID_TO)]
        return F.struct(*values, start.alias(VALID_FROM), end.alias(VALID_TO))

    is_new = F.col("old").isNull()
    is_gone = F.col("new").isNull()
    changed = ~is_new & ~is_gone & _differs("old", "new", check)
    ends = changed | (is_gone & F.lit(hard_deletes))
    old_row = version("old", F.col(f"old.{VALID_FROM}"), F.when(ends, now).otherwise(no_end))
    new_row = version("new", F.when(is_new, F.col("_start")).otherwise(now), no_end)
    rows = F.array_compact(F.array(F.when(~is_new, old_row), F.when(is_new | changed, new_row)))
    touched = pair.select(F.explode(rows).alias("v")).select("v.*")
    return closed.unionByName(touched)


def scd2_history(log: DataFrame, key: str, attributes: Sequence[str], check: Sequence[str],
                 order: Sequence[str] = (INGESTED, SEQ), backdate_first: bool = False,
                 segment_seconds: int = DAY) -> DataFrame:
    """All versions from a change log in one pass, equal to folding ``snapshot_check`` over its
    microbatches. The log holds at most one row per key and moment (see ``net_changes``).

    Consecutive rows with equal ``check`` columns merge into the earlier one. A key with a large
    share of the log is worked on by time segment (see ``segments``): the first window finds the
    changes inside a segment and drops the rows that change nothing, the second settles the first
    row of each segment and carries version ends across segments.
    """
    ts = order[0]
    columns = [key, *[c for c in attributes if c != key]]
    extra = [c for c in order if c not in columns]
    rows = log.select(*columns, *extra).withColumn("_seg", segment_of(F.col(ts), segment_seconds))
    newest_first = [F.col(c).desc() for c in order]

    def step(df: DataFrame, window: WindowSpec) -> tuple[DataFrame, Column, Column]:
        """The frame with the previous row's values, whether there is one, and whether it differs."""
        previous = df.withColumns({
            "_has": F.lead(F.lit(True)).over(window),
            **{f"_p{i}": F.lead(c).over(window) for i, c in enumerate(check)}})
        same = F.lit(True)
        for i, c in enumerate(check):
            same = same & F.col(c).eqNullSafe(F.col(f"_p{i}"))
        return previous, F.col("_has").isNotNull(), ~same

    helpers = ["_has", *[f"_p{i}" for i in range(len(check))]]
    inside = Window.partitionBy(key, "_seg").orderBy(*newest_first)
    later = Window.unboundedPreceding, -1
    rows, has_previous, differs = step(rows, inside)
    rows = rows.withColumns({"_opens": ~has_previous, "_changed": has_previous & differs}).drop(*helpers)
    # The next change inside the segment, if any; rows run from newest to oldest here.
    next_change = F.last(F.when(F.col("_changed"), F.col(ts)), ignorenulls=True).over(inside.rowsBetween(*later))
    rows = (rows.withColumn("_next", next_change).filter(F.col("_opens") | F.col("_changed"))
            .withColumn("_group", edge_group(F.col("_opens") | F.col("_next").isNull(), F.col("_seg"))))

    across = Window.partitionBy(key, "_group").orderBy(*newest_first)
    rows, has_previous, differs = step(rows, across)
    rows = rows.withColumns({
        "_first": F.col("_opens") & ~has_previous,
        "_changed": F.when(F.col("_opens"), ~has_previous | differs).otherwise(True)}).drop(*helpers)
    # Where a segment's versions start at the earliest, as seen from the segments before it.
    start_here = F.when(F.col("_opens"), F.when(F.col("_changed"), F.col(ts)).otherwise(F.col("_next")))
    next_start = F.last(start_here, ignorenulls=True).over(across.rowsBetween(*later))
    start = F.col(ts)
    if backdate_first:
        start = F.when(F.col("_first"), _moment(FIRST_MOMENT)).otherwise(start)
    return (rows.withColumn("_later", next_start).filter("_changed")
            .select(*columns, start.alias(VALID_FROM), F.coalesce("_next", "_later").alias(VALID_TO)))


def unknown_row(spark: SparkSession, schema: T.StructType, values: Mapping[str, object]) -> DataFrame:
    """One typed row for the unknown member; columns without a value are NULL."""
    return spark.range(0, 1, 1, 1).select(*[
        (v if isinstance(v := values.get(f.name), Column) else F.lit(v)).cast(f.dataType).alias(f.name)
        for f in schema.fields])


def with_unknown(dim: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """The dimension plus its unknown member."""
    return dim.unionByName(unknown_row(dim.sparkSession, dim.schema, values))


def dim_scd1(df: DataFrame, key: str, natural: str, attributes: Sequence[str],
             as_of: Column | datetime | str, unknown: Mapping[str, object]) -> DataFrame:
    """Hash key, natural key and present attributes, plus the unknown member."""
    dim = df.select(surrogate_key(F.col(natural)).alias(key), natural, *attributes,
                    _moment(as_of).alias(INGESTED))
    return with_unknown(dim, {key: UNKNOWN_KEY, natural: str(UNKNOWN_KEY), INGESTED: _moment(as_of), **unknown})


def dim_scd2(history: DataFrame, key: str, natural: str, attributes: Sequence[str],
             as_of: Column | datetime | str, unknown: Mapping[str, object]) -> DataFrame:
    """A history as a dimension: hash key over (natural key, start), open end as 9999-12-31, a flag
    for the version in force, plus the unknown member, which is valid at any time."""
    forever = _moment(LAST_MOMENT)
    dim = history.select(
        surrogate_key(F.col(natural), moment_text(F.col(VALID_FROM))).alias(key), natural, *attributes,
        F.col(VALID_FROM).alias("valido_desde"),
        F.coalesce(VALID_TO, forever).alias("valido_hasta"),
        F.col(VALID_TO).isNull().alias("es_version_vigente"),
        _moment(as_of).alias(INGESTED))
    return with_unknown(dim, {
        key: UNKNOWN_KEY, natural: str(UNKNOWN_KEY), "valido_desde": _moment(FIRST_MOMENT),
        "valido_hasta": forever, "es_version_vigente": True, INGESTED: _moment(as_of), **unknown})


def point_in_time(dim: DataFrame, moment: Column | datetime | str) -> DataFrame:
    """The versions in force at a moment."""
    t = _moment(moment)
    return dim.filter((F.col("valido_desde") <= t) & (t < F.col("valido_hasta")))
