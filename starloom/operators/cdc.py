"""Resolving change events into states, and removing duplicates.

All operators reduce on the map side first (rank-1 windows through Spark's window group limit, the
others through partial aggregates), so a key holding a large share of the log shrinks to about one
row per input task before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.contracts import INGESTED, OP, SEQ


def order_columns(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> list[str]:
    """The given order extended by all other columns, so that no two different rows tie."""
    leading = [c for c in order if c in df.columns]
    return leading + [c for c in df.columns if c not in leading and c not in keys]


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key group in the given order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def latest_event(log: DataFrame, keys: Sequence[str], order: Sequence[str] = (INGESTED, SEQ)) -> DataFrame:
    """The last event of each key: by arrival, then sequence, then all remaining columns."""
    return first_by(log, keys, [F.col(c).desc() for c in order_columns(log, keys, order)])


def latest_as_of(log: DataFrame, keys: Sequence[str], moment: datetime, order: Sequence[str] = (INGESTED, SEQ)) -> tuple[DataFrame, DataFrame]:
    """Two logs of one event per key: the last up to ``moment``, and the last of all, each the one ``latest_event`` gives.

    Both come from one shuffle, which carries at most two events of a key. ``order`` starts with the arrival.
    """
    columns = order_columns(log, keys, order)
    event, then = F.struct(*columns), F.coalesce(F.col(order[0]) <= F.lit(moment).cast("timestamp_ntz"), F.lit(False))
    # What a reader asks of the keys (such as that they are not NULL) must not reach below the shuffle, nor may one side's event
    # be pruned from it: there would be two shuffles then. No filter moves past a row's number, and each side names both events.
    found = log.groupBy(*keys).agg(F.max(F.when(then, event)).alias("_then"), F.max(F.when(~then, event)).alias("_since"))
    found = found.withColumn("_number", F.monotonically_increasing_id()).filter("_number >= 0")
    last = F.greatest("_then", "_since")
    sides = found.filter(F.col("_then") <= last).withColumn("_event", F.col("_then")), found.withColumn("_event", last)
    early, now = [side.select(*[c if c in keys else F.col(f"_event.{c}").alias(c) for c in log.columns]) for side in sides]
    return early, now


def after_images(log: DataFrame, op: str = "operation") -> DataFrame:
    """Without the row images from before an update (operation 3)."""
    return log.filter(F.col(op) != 3)


def mark_deleted(op: Column) -> Column:
    """True when the event is a delete."""
    return F.coalesce(op == "D", F.lit(False))


def net_changes(log: DataFrame, keys: Sequence[str], batch: Sequence[str],
                order: Sequence[str] = (INGESTED, SEQ), op: str = OP) -> DataFrame:
    """At most one row per key and microbatch, carrying the last image and the net operation.

    Inserted and deleted in the same batch gives no row; inserted first gives I; deleted last
    gives D; anything else gives U.
    """
    group = [*batch, *keys]
    payload = [c for c in log.columns if c not in group]
    position = F.struct(*order_columns(log, group, order))
    net = log.groupBy(*group).agg(
        F.min_by(op, position).alias("_first"),
        F.max_by(F.struct(*payload), position).alias("_last"))
    last_op = F.col(f"_last.{op}")
    net_op = (F.when((F.col("_first") == "I") & (last_op != "D"), "I")
              .when(last_op == "D", "D").otherwise("U"))
    return (net.filter(~((F.col("_first") == "I") & (last_op == "D")))
            .select(*group, *[(net_op if c == op else F.col(f"_last.{c}")).alias(c) for c in payload]))


def net_state(log: DataFrame, group: Sequence[str], order: Sequence[str] = (INGESTED, SEQ), op: str = OP) -> DataFrame:
    """What composing net changes needs of each group: its first event's place and operation, and its last event.

    States of parts of a log compose by ``compose_net``; ``net_rows`` of the whole gives what ``net_changes`` gives. A group
    that was inserted and deleted keeps its state though it has no row: a later event still finds the insert.
    """
    payload = [c for c in log.columns if c not in group]
    position = F.struct(*order_columns(log, group, order))
    return log.groupBy(*group).agg(
        F.min(F.struct(position.alias("at"), F.col(op).alias("op"))).alias("_first"),
        F.max(F.struct(position.alias("at"), F.struct(*payload).alias("row"))).alias("_last"))


def compose_net(earlier: DataFrame, later: DataFrame, group: Sequence[str]) -> DataFrame:
    """The state of two parts of a log together, in whatever order they arrived."""
    return earlier.unionByName(later).groupBy(*group).agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"))


def net_rows(state: DataFrame, group: Sequence[str], op: str = OP) -> DataFrame:
    """One row per group with the net operation: I then U is I, I then D is nothing, D then I is U, D last is D."""
    first, row = F.col("_first.op"), "_last.row"
    payload = state.schema["_last"].dataType["row"].dataType.names
    last = F.col(f"{row}.{op}")
    net = F.when((first == "I") & (last != "D"), "I").when(last == "D", "D").otherwise("U")
    return (state.filter(~((first == "I") & (last == "D")))
            .select(*group, *[(net if c == op else F.col(f"{row}.{c}")).alias(c) for c in payload]))


def all_changes(log: DataFrame, low: int | None, high: int, op: str = "operation", seq: str = SEQ) -> DataFrame:
    """Every event of the sequence range (low, high], before images included, operations named.

    Operation codes 1, 2, 3, 4 are delete, insert, before image, after image.
    """
    ranged = log.filter(F.col(seq) <= high)
    if low is not None:
        ranged = ranged.filter(F.col(seq) > low)
    name = (F.when(F.col(op) == 1, "D").when(F.col(op) == 2, "I")
            .when(F.col(op) == 3, "B").when(F.col(op) == 4, "U"))
    return ranged.withColumn(OP, name)


def label_catalog(events: DataFrame, label: Column, name: str) -> DataFrame:
    """The distinct labels found in the events; a label counts as deleted when all its rows are."""
    return (events.select(label.alias(name), mark_deleted(F.col(OP)).alias("_deleted"), INGESTED)
            .filter(F.col(name).isNotNull())
            .groupBy(name)
            .agg(F.bool_and("_deleted").alias("es_borrado"), F.max(INGESTED).alias(INGESTED)))


def dedup_business(df: DataFrame, business: Sequence[str], keep: str) -> DataFrame:
    """One row per combination of business columns: the one with the lowest ``keep`` value.

    A row with a NULL among them equals no other and stays.
    """
    others = [c for c in df.columns if c not in business and c != keep]
    known = _all_known(business)
    return first_by(df.filter(known), business, [F.col(c).asc() for c in [keep, *others]]).unionByName(df.filter(~known))


def _all_known(columns: Sequence[str]) -> Column:
    known = F.lit(True)
    for c in columns:
        known = known & F.col(c).isNotNull()
    return known


def duplicate_rows(df: DataFrame, business: Sequence[str], keep: str) -> DataFrame:
    """The rows ``dedup_business`` takes out, each with the id it duplicates.

    The kept id per group comes from an aggregate and is joined back, so no window has to hold a
    whole group.
    """
    df = df.filter(_all_known(business))
    kept = df.groupBy(*business).agg(F.min(keep).alias("original_id")).select(
        "original_id", *[F.col(c).alias(f"_b{i}") for i, c in enumerate(business)])
    same = [F.col(c).eqNullSafe(F.col(f"_b{i}")) for i, c in enumerate(business)]
    return (df.join(kept, same, "inner").filter(F.col(keep) != F.col("original_id"))
            .select(F.col(keep).alias("duplicate_id"), "original_id", *business))


def dedup_normalised(df: DataFrame, key: str, columns: Sequence[str],
                     references: Sequence[DataFrame] = ()) -> DataFrame:
    """Drop the rows equal to one with a lower key after trimming and upper-casing ``columns``.

    A row some reference frame (one key column each) points to is kept even as a duplicate, and so is a row with a NULL
    among ``columns``, which equals no other.
    """
    known = _all_known(columns)
    normal = [F.upper(F.trim(F.col(c).cast("string"))) for c in columns]
    marked = df.filter(known).withColumn("_norm", F.struct(*[n.alias(f"n{i}") for i, n in enumerate(normal)]))
    first = marked.groupBy(F.col("_norm").alias("_n")).agg(F.min(key).alias("_first_key"))
    joined = marked.join(first, F.col("_norm") == F.col("_n"), "inner").drop("_norm", "_n")
    stays = F.col(key) == F.col("_first_key")
    if not references:
        return joined.filter(stays).drop("_first_key").unionByName(df.filter(~known))
    used = None
    for ref in references:
        one = ref.select(F.col(ref.columns[0]).alias("_ref")).distinct()
        used = one if used is None else used.unionByName(one)
    used = used.distinct()
    kept = (joined.join(used, F.col(key) == F.col("_ref"), "left")
            .filter(stays | F.col("_ref").isNotNull())
            .drop("_first_key", "_ref"))
    return kept.unionByName(df.filter(~known))
