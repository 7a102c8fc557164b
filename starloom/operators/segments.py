"""Neighbour values within a key's history without holding the whole history in one task.

A window partitioned by the key alone sends all rows of a hot key to one task. Here each key's
history is cut into time segments. A first window over (key, segment) finds the neighbours inside a
segment and marks the edge rows, at most two per segment. A second window holds the edge rows of a key
together and leaves all others in their segment. The segment length bounds both: rows of one key in
one segment, and segments of one key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY = 86400


def segment_of(ts: Column, seconds: int = DAY) -> Column:
    """Number of the time segment a moment falls into."""
    return F.floor(F.unix_seconds(ts.cast("timestamp")) / F.lit(seconds))


def edge_group(edge: Column, segment: Column) -> Column:
    """Segment number for rows inside a segment, one common value for the edge rows of a key.

    Keep it as a column: a window partitioned by the expression itself would shuffle anew for every
    window function used.
    """
    return F.when(~edge, segment)


def with_neighbour(df: DataFrame, keys: Sequence[str], order: Sequence[str], ts: str,
                   value: Column, name: str, forward: bool = False, seconds: int = DAY) -> DataFrame:
    """Add the previous (or, ``forward``, the next) row's ``value`` within the key's history.

    ``name`` is NULL for the first (last) row of a key. ``value`` must not be NULL; wrap it in a
    struct if it can be. ``order`` must be a total order that starts with ``ts``.
    """
    neighbour = F.lead if forward else F.lag
    inside = Window.partitionBy(*keys, "_seg").orderBy(*order)
    rows = df.withColumns({"_seg": segment_of(F.col(ts), seconds), "_val": value})
    rows = rows.withColumns({
        "_local": neighbour("_val").over(inside),
        "_edge": F.lag(F.lit(1)).over(inside).isNull() | F.lead(F.lit(1)).over(inside).isNull()})
    rows = rows.withColumn("_group", edge_group(F.col("_edge"), F.col("_seg")))
    across = Window.partitionBy(*keys, "_group").orderBy(*order)
    return (rows.withColumn(name, F.coalesce("_local", neighbour("_val").over(across)))
            .drop("_seg", "_val", "_local", "_edge", "_group"))


def with_running_max(df: DataFrame, keys: Sequence[str], ts: str, value: str, name: str,
                     seconds: int = DAY) -> DataFrame:
    """Add the largest ``value`` among the key's rows before this one; ``ts`` is unique per key."""
    keys = list(keys)
    base = df.withColumn("_seg", segment_of(F.col(ts), seconds))
    before = Window.partitionBy(*keys, "_seg").orderBy(ts).rowsBetween(Window.unboundedPreceding, -1)
    segments_before = (Window.partitionBy(*keys).orderBy("_seg")
                       .rowsBetween(Window.unboundedPreceding, -1))
    edges = (base.groupBy(*keys, "_seg").agg(F.max(value).alias("_edge"))
             .withColumn("_carry", F.max("_edge").over(segments_before))
             .drop("_edge"))
    joined = base.withColumn("_local", F.max(value).over(before)).join(edges, [*keys, "_seg"], "left")
    return joined.withColumn(name, F.greatest("_local", "_carry")).drop("_seg", "_local", "_carry")
