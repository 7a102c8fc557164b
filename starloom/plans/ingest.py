"""The ingest job: every active source log up to its present end, in two phases.

First an entity's range of sequence numbers is written down, then its rows are landed in a folder named after the range, and
only then does the checkpoint move. Whatever fails in between, the next run finds the open range and lands the same rows in
the same folder, though the source has grown: no row is there twice, none is skipped.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.contracts import CONTROL_SCHEMA, SEQ
from starloom.operators.control import commit_batch, run_rows
from starloom.sources.bronze import INGEST_PARALLELISM, land_changes
from starloom.sources.tables import KeyedTable, append_log

PIPELINE = "ingest"
RANGES_DDL = "entity_name string, low bigint, high bigint"
DONE_DDL = "entity_name string, new_seq bigint, rows_copied bigint"
log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Ingest:
    """Where the job keeps its control table, open ranges and logs, and where it lands rows."""

    spark: SparkSession
    root: str
    by_date: bool = True  # one folder per arrival date below each range

    @property
    def control(self) -> KeyedTable:
        return KeyedTable(self.spark, f"{self.root}/meta/cdc_control", ["entity_name"])

    @property
    def ranges(self) -> KeyedTable:
        return KeyedTable(self.spark, f"{self.root}/meta/cdc_ranges", ["entity_name"])

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    def register(self, rows: list[tuple[str, str, int | None, bool]], as_of: datetime) -> None:
        """Set up the control table from (entity, capture name, last sequence, active)."""
        made = [(name, capture, last, None, None, active, as_of) for name, capture, last, active in rows]
        self.control.replace(self.spark.createDataFrame(made, CONTROL_SCHEMA).coalesce(1), 0)


def open_range(source: DataFrame, last: int | None) -> tuple[int | None, int] | None:
    """(last, end] of what is new in a source; None where nothing is. Both bounds reach the scans as literals."""
    new = source if last is None else source.filter(F.col(SEQ) > F.lit(last))
    high = new.agg(F.max(SEQ)).first()[0]
    return None if high is None else (last, high)


def in_range(source: DataFrame, low: int | None, high: int) -> DataFrame:
    upper = source.filter(F.col(SEQ) <= F.lit(high))
    return upper if low is None else upper.filter(F.col(SEQ) > F.lit(low))


def run_ingest(job: Ingest, sources: Mapping[str, Callable[[], DataFrame]], run: int, as_of: datetime,
               parallelism: int = INGEST_PARALLELISM) -> dict[str, str]:
    """One sweep over the active entities, a few at a time: SUCCEEDED, IDLE or FAILED by entity.

    A failing entity leaves the others alone; it keeps its checkpoint and its open range. ``run`` numbers the sweeps.
    The control table has one row for each source entity, so reading it here is bounded.
    """
    control = {r["entity_name"]: r["last_seq"] for r in job.control.read().filter("active").select("entity_name", "last_seq").collect()}
    held = {r["entity_name"]: (r["low"], r["high"]) for r in job.ranges.read().collect()} if job.ranges.exists() else {}
    # A range is open as long as the checkpoint has not reached its end.
    left = {e: (low, high) for e, (low, high) in held.items() if e in control and (control[e] is None or control[e] < high)}
    failed: dict[str, str] = {}

    def attempt(entity: str, work: Callable[[], object]):
        try:
            return work()
        except Exception as e:  # the entity is repeated by the next sweep; the others go on
            log.warning("%s: %s", entity, e)
            failed[entity] = str(e).splitlines()[0][:500]
            return None

    def each(work: Callable[[str], object], entities: list[str]) -> dict:
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            made = {e: pool.submit(attempt, e, lambda e=e: work(e)) for e in entities}
            return {e: f.result() for e, f in made.items()}

    found = {e: left.get(e) or None for e in control}
    found |= each(lambda e: open_range(sources[e](), control[e]), [e for e in control if e not in left])
    ranges = {e: r for e, r in found.items() if r is not None}
    fresh = [(e, low, high) for e, (low, high) in ranges.items() if e not in left]
    if fresh:
        job.ranges.upsert(job.spark.createDataFrame(fresh, RANGES_DDL).coalesce(1), run)

    def copy(entity: str) -> int:
        low, high = ranges[entity]
        name = f"seq-{'start' if low is None else low}-{high}"
        rows = in_range(sources[entity](), low, high)
        if job.by_date:
            land_changes(rows, job.bronze, entity, name)
        else:
            rows.write.mode("overwrite").parquet(f"{job.bronze}/{entity}/batch={name}")
        return job.spark.read.parquet(f"{job.bronze}/{entity}/batch={name}").count()

    copied = {e: n for e, n in each(copy, list(ranges)).items() if n is not None}
    spark = job.spark
    if copied:
        done = spark.createDataFrame([(e, ranges[e][1], n) for e, n in copied.items()], DONE_DDL)
        names = done.select("entity_name")
        moved = commit_batch(job.control.read().join(names, "entity_name", "left_semi"), done, as_of)
        job.control.upsert(moved.coalesce(1), run)
    states = {e: "FAILED" if e in failed else "SUCCEEDED" if e in copied else "IDLE" for e in control}
    rows = [run_rows(spark.createDataFrame([(e, copied.get(e, 0))], "entity_name string, rows_copied bigint"), PIPELINE, "bronze",
                     state, f"ingest-{run}", as_of, failed.get(e)) for e, state in states.items()]
    if rows:
        append_log(reduce(DataFrame.unionByName, rows).coalesce(1), f"{job.root}/meta/pipeline_run_log", f"ingest-{run}")
    return states
