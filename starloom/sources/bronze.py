"""The Bronze change log: conforming, landing, reading and extracting change rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.contracts import ENTITIES, INGESTED, OP, SEQ

INGEST_PARALLELISM = 4  # entities extracted at the same time


def conform_schema(df: DataFrame, schema: T.StructType, rescue: str | None = None) -> DataFrame:
    """Cast a raw frame to its contract, by column name.

    A missing column becomes NULL and small integers widen. Text that does not parse becomes NULL instead of failing the
    batch. With ``rescue`` nothing is lost: a column of that name, a map from column to text, holds every value that did not
    parse and every value of a column outside the contract; it is NULL for a row that has none.
    """
    have = set(df.columns)
    cast = {f.name: F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType) for f in schema.fields}
    columns = [c.alias(name) for name, c in cast.items()]
    if rescue is None:
        return df.select(*columns)
    lost = [(c, F.col(c).isNotNull() & cast[c].isNull() if c in cast else F.col(c).isNotNull()) for c in df.columns]
    entries = F.array_compact(F.array(*[
        F.when(gone, F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value"))) for c, gone in lost]))
    kept = F.when(F.size(entries) > 0, F.map_from_entries(entries)).otherwise(F.lit(None).cast("map<string, string>"))
    return df.select(*columns, kept.alias(rescue))


def rescued_issues(df: DataFrame, schema: T.StructType, table: str, key: str, rescue: str) -> DataFrame:
    """Issue-log rows of what ``conform_schema`` put aside: unknown columns and values that did not parse."""
    known = F.col("column_name").isin([f.name for f in schema.fields])
    found = df.filter(F.col(rescue).isNotNull()).select(F.col(key).cast("string").alias("row_primary_key"), F.explode(rescue).alias("column_name", "corrupted_value"))
    return found.select(
        F.lit(table).alias("table_name"), "row_primary_key", "column_name", F.when(known, "unparsable").otherwise("unknown column").alias("issue_type"),
        F.when(known, "medium").otherwise("low").alias("severity"), F.lit(None).cast("string").alias("original_clean_value"), "corrupted_value",
        F.lit(True).alias("is_auto_detectable"), F.lit("no").alias("is_repair_suggested"), F.lit("kept aside by the contract").alias("description"))


#: Types that widen into the ones after them.
_WIDER = [[T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()], [T.FloatType(), T.DoubleType()], [T.DateType(), T.TimestampNTZType()]]


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both: along a chain of widening types, integers and fractions as double
    (as decimal with a decimal), anything else as text."""
    if a == b:
        return a
    for chain in _WIDER:
        if a in chain and b in chain:
            return chain[max(chain.index(a), chain.index(b))]
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale, whole = max(a.scale, b.scale), max(a.precision - a.scale, b.precision - b.scale)
        return T.DecimalType(min(38, whole + scale), min(scale, max(0, 38 - whole)))
    integers, fractions = _WIDER[0], _WIDER[1]
    if isinstance(a, T.DecimalType) or isinstance(b, T.DecimalType):
        exact, other = (a, b) if isinstance(a, T.DecimalType) else (b, a)
        if other in integers:
            return wider(exact, T.DecimalType([3, 5, 10, 19][integers.index(other)], 0))
        return T.DoubleType() if other in fractions else T.StringType()
    if (a in integers and b in fractions) or (b in integers and a in fractions):
        return T.DoubleType()
    return T.StringType()


def widen(stored: T.StructType, seen: T.StructType) -> T.StructType:
    """The contract that holds what is stored and what has been seen: types widen, new columns come last, none goes."""
    new = {f.name: f.dataType for f in seen.fields}
    kept = [T.StructField(f.name, wider(f.dataType, new[f.name]) if f.name in new else f.dataType) for f in stored.fields]
    return T.StructType([*kept, *[T.StructField(f.name, f.dataType) for f in seen.fields if f.name not in stored.names]])


def with_cdc_columns(df: DataFrame, is_delete: Column, is_update: Column,
                     batch_ts: Column | datetime) -> DataFrame:
    """Add the operation (D before U before I) and the microbatch's UTC time."""
    op = F.when(is_delete, "D").when(is_update, "U").otherwise("I")
    stamp = batch_ts if isinstance(batch_ts, Column) else F.lit(batch_ts).cast("timestamp_ntz")
    return df.withColumns({OP: op, INGESTED: stamp})


def initial_snapshot(df: DataFrame, batch_ts: Column | datetime) -> DataFrame:
    """First load: every existing row as an insert of the first microbatch, with sequence 0."""
    return with_cdc_columns(df, F.lit(False), F.lit(False), batch_ts).withColumn(SEQ, F.lit(0).cast("bigint"))


def entity_path(root: str, entity: str) -> str:
    return f"{root.rstrip('/')}/{entity}"


def land_changes(df: DataFrame, root: str, entity: str, batch_id: str | None = None) -> None:
    """Add change rows below the entity's folder, in a folder of their own with one folder per arrival date.

    With a ``batch_id`` a retry replaces the batch's folder, so a batch landed twice is not there twice; without one
    every call has a folder of a new name. The layout is the same. The rebalance hint lets adaptive execution gather each date's
    rows into few files and still split a date that is too large for one task, such as that of the
    initial snapshot.
    """
    dated = df.withColumn("date", F.to_date(INGESTED)).hint("rebalance", "date").sortWithinPartitions("date", INGESTED)
    name = uuid.uuid4().hex if batch_id is None else batch_id
    dated.write.partitionBy("date").mode("overwrite").parquet(f"{entity_path(root, entity)}/batch={name}")


def read_bronze(spark: SparkSession, root: str, entity: str, since: datetime | None = None,
                schema: T.StructType | None = None) -> DataFrame:
    """One entity's change rows from all folders below its path, bound by column name.

    Files of any folder depth are read. ``since`` keeps the rows newer than a watermark; it is
    pushed to Parquet, whose row groups are in arrival order.
    """
    schema = schema or ENTITIES[entity].change_schema
    df = (spark.read.schema(schema).option("recursiveFileLookup", "true")
          .parquet(entity_path(root, entity)))
    return df if since is None else newer_than(df, since)


def read_bronze_dates(spark: SparkSession, root: str, entity: str, since: datetime,
                      schema: T.StructType | None = None) -> DataFrame:
    """Like ``read_bronze`` with ``since``, for logs as ``land_changes`` lays them out: whole date
    folders before the watermark are never opened."""
    schema = schema or ENTITIES[entity].change_schema
    df = spark.read.schema(schema).parquet(entity_path(root, entity))
    if "date" in df.columns:
        df = df.filter(F.col("date") >= F.lit(since.date()))
    return newer_than(df, since).select(*schema.names)


def newer_than(df: DataFrame, watermark: datetime, column: str = INGESTED) -> DataFrame:
    """Rows strictly newer than the watermark."""
    return df.filter(F.col(column) > F.lit(watermark).cast("timestamp_ntz"))


def extract_range(log: DataFrame, last_seq: int | None, seq: str = SEQ) -> tuple[DataFrame, int | None]:
    """Change rows after the checkpoint up to the log's present end, and that end.

    The end is read once, so rows arriving meanwhile belong to the next extract. Without a
    checkpoint the extract starts at the log's beginning; an end of None means nothing is new.
    """
    new = log if last_seq is None else log.filter(F.col(seq) > last_seq)
    high = new.agg(F.max(seq)).first()[0]
    if high is None:
        return new.limit(0), None
    return new.filter(F.col(seq) <= high), high


def sweep(control: DataFrame, extract: Callable[[str, int | None], tuple[int, int | None]],
          parallelism: int = INGEST_PARALLELISM) -> dict[str, tuple[int, int | None]]:
    """Run one extract per active entity of the control table, a few at a time.

    ``extract(entity, last_seq)`` copies that entity's new rows and returns (rows, new checkpoint).
    Each call is an ordinary Spark job; the control table has one row per entity.
    """
    active = [(r.entity_name, r.last_seq)
              for r in control.filter("active").select("entity_name", "last_seq").collect()]
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        futures = {name: pool.submit(extract, name, last) for name, last in active}
        return {name: future.result() for name, future in futures.items()}


def sweep_frames(control: DataFrame, sources: Mapping[str, DataFrame]) -> DataFrame:
    """The sweep as one plan: every active entity's new rows counted with its range end.

    Entities are unioned before the aggregate, so all logs are read in one job.
    """
    logs = None
    for name, log in sources.items():
        one = log.select(F.lit(name).alias("entity_name"), F.col(SEQ))
        logs = one if logs is None else logs.unionByName(one)
    active = control.filter("active").select("entity_name", "last_seq")
    return (logs.join(F.broadcast(active), "entity_name")  # one row per source entity
            .filter(F.col("last_seq").isNull() | (F.col(SEQ) > F.col("last_seq")))
            .groupBy("entity_name")
            .agg(F.count("*").alias("rows_copied"), F.min(SEQ).alias("first_seq"), F.max(SEQ).alias("new_seq")))
