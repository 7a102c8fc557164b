"""Dimension lookups and the joins used for checks.

Joins carry no broadcast hint unless the small side has a bound that does not grow with the data.
Adaptive execution measures the other sides: it broadcasts those below its threshold, and splits
skewed partitions of the large side when it has to shuffle both.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.contracts import AMOUNT_TOLERANCE, UNKNOWN_KEY
from starloom.operators.segments import with_neighbour, with_running_max


def resolve_unknown(key: Column) -> Column:
    """A dimension key, or the unknown member's key where the lookup found none."""
    return F.coalesce(key, F.lit(UNKNOWN_KEY))


def scd1_lookup(fact: DataFrame, dim: DataFrame, natural: str, take: Mapping[str, str]) -> DataFrame:
    """Left join to a dimension with one row per natural key; ``take`` maps dimension to output columns."""
    side = dim.select(F.col(natural).alias("_n"), *[F.col(c).alias(o) for c, o in take.items()])
    return fact.join(side, F.col(natural) == F.col("_n"), "left").drop("_n")


def scd2_lookup(fact: DataFrame, dim: DataFrame, natural: str, moment: str, take: Mapping[str, str],
                start: str = "valido_desde", end: str = "valido_hasta", split: str | None = None) -> DataFrame:
    """Left join to the dimension version in force at each row's ``moment``.

    An equi join on the natural key with the range as a residual condition. Without a version in
    force the taken columns are NULL.

    ``split`` (such as "month") is for dimensions where one key has thousands of versions, each of
    which the residual would test. Versions within one calendar unit are then joined on (key, unit);
    of the versions crossing a unit's end a key has at most one per unit, and those are joined on the
    key. Versions of a key must not overlap.
    """
    side = dim.select(F.col(natural).alias("_n"), F.col(start).alias("_from"), F.col(end).alias("_to"),
                      *[F.col(c).alias(o) for c, o in take.items()])
    in_force = ((F.col(natural) == F.col("_n"))
                & (F.col(moment) >= F.col("_from")) & (F.col(moment) < F.col("_to")))
    if split is None:
        return fact.join(side, in_force, "left").drop("_n", "_from", "_to")

    unit = F.date_trunc(split, F.col("_from"))
    within = unit == F.date_trunc(split, F.col("_to"))
    renamed = {o: f"_short_{i}" for i, o in enumerate(take.values())}
    short = side.filter(within).withColumn("_unit", unit).withColumnsRenamed(renamed)
    # The join on the key comes first: where no version is short, adaptive execution knows it by the time of the second join
    # and drops that one before the fact is shuffled for it.
    found = fact.join(side.filter(~within), in_force, "left").drop("_n", "_from", "_to")
    both = (found.withColumn("_at", F.date_trunc(split, F.col(moment)))
            .join(short, in_force & (F.col("_at") == F.col("_unit")), "left")
            .drop("_n", "_from", "_to", "_unit", "_at"))
    return both.withColumns({o: F.coalesce(s, o) for o, s in renamed.items()}).drop(*renamed.values())


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values without a parent and how many rows carry them; NULL is not an orphan.

    Child rows are counted per value first, so a frequent value is one row in the join.
    """
    used = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(
        F.count("*").alias("rows"))
    return used.join(parent.select(F.col(parent_column).alias("value")), "value", "left_anti")


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str], count: tuple[str, str],
              measure: tuple[str, str], tolerance: str = AMOUNT_TOLERANCE) -> DataFrame:
    """Full outer join of two aggregates with a verdict per key.

    ``count`` and ``measure`` name the (left, right) columns. A missing side counts as zero.
    """
    joined = left.join(right, list(keys), "full_outer")
    zero = F.lit(0)
    same_count = F.coalesce(F.col(count[0]), zero) == F.coalesce(F.col(count[1]), zero)
    gap = F.abs(F.coalesce(F.col(measure[0]), zero) - F.coalesce(F.col(measure[1]), zero))
    return joined.withColumn("is_match", same_count & (gap <= F.lit(tolerance).cast("decimal(19,4)")))


def completeness(expected: DataFrame, observed: DataFrame, key: str, expected_count: str,
                 observed_count: str) -> DataFrame:
    """Expected against observed counts; an expected key that was never observed fails."""
    enough = F.coalesce(F.col(observed_count), F.lit(0)) >= F.col(expected_count)
    return expected.join(observed, key, "left").withColumn(
        "veredicto", F.when(enough, "OK").otherwise("FALTAN CLAVES"))


def compare_counts(left: DataFrame, right: DataFrame, left_name: str, right_name: str) -> DataFrame:
    """Two row counts side by side."""
    a = left.agg(F.count("*").alias(left_name))
    b = right.agg(F.count("*").alias(right_name))
    return a.crossJoin(F.broadcast(b))  # one row each


def overlaps(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Rows whose ``[start, end)`` meets another row of the same key with a different start.

    No self join: a row overlaps an earlier one when the largest end before it lies after its start,
    and a later one when the next start lies before its end. Both come from segmented windows over
    the distinct starts.
    """
    keys = list(keys)
    starts = df.groupBy(*keys, start).agg(F.max(end).alias("_end"))
    before = with_running_max(starts, keys, start, "_end", "_reach")
    both = with_neighbour(before, keys, [start], start, F.col(start), "_next", forward=True)
    flagged = both.select(*keys, start, "_reach", "_next").filter(
        (F.col("_reach") > F.col(start)) | (F.col("_next") < F.col("_end")))
    match = [*keys, start]
    return (df.join(flagged, match, "inner")
            .filter((F.col("_reach") > F.col(start)) | (F.col("_next") < F.col(end)))
            .drop("_reach", "_next"))
