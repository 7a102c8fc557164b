"""Connected components of links between documents, and work on groups of rows in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.spans import settled


class Forest:
    """Union-find over the numbers 0 to n - 1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def star_edges(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same connections as edges from each vertex to the smallest one it is connected with."""
    names, place = np.unique(np.concatenate((a, b)), return_inverse=True)
    forest = Forest(len(names))
    for x, y in zip(place[: len(a)].tolist(), place[len(a) :].tolist()):
        forest.join(x, y)
    roots = np.array([forest.root(i) for i in range(len(names))], np.int64)
    child = np.flatnonzero(roots != np.arange(len(names)))
    return names[child], names[roots[child]]


def contracted(edges: DataFrame) -> DataFrame:
    """Edges (a, b) of each Arrow batch contracted to stars: never more rows, the same components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = star_edges(batch.column(0).to_numpy(), batch.column(1).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return edges.mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(id, label) of every vertex of the edges (a, b): the smallest vertex it is connected with.

    Alternates large-star and small-star steps, each of them one aggregation and one join; every round is written, so
    its lineage is short. Ends when a round changes nothing, after a number of rounds that grows with the logarithm of
    the longest path.
    """
    now, before = settled(contracted(edges.select("a", "b").where(F.col("a") != F.col("b"))).distinct(), "edges"), None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if seen == before:
            return now.select(F.col("a").alias("id"), F.col("b").alias("label")).union(now.select("b", "b").distinct())
        before = seen
        both = now.union(now.select(F.col("b"), F.col("a"))).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").union(least)
        now = settled(contracted(small).distinct(), "edges")


HOT_KEYS = 1000


def join_hot(rows: DataFrame, one: DataFrame, key: str, counts: DataFrame | None = None) -> DataFrame:
    """rows joined with ``one``, which has one row per key; keys that hold over a thousandth of the rows are not shuffled.

    There are fewer than ``HOT_KEYS`` such keys, so their part of ``one`` is broadcast. ``counts`` gives the rows by key
    (key, copies) where they are known.
    """
    counts = rows.groupBy(key).agg(F.count("*").alias("copies")) if counts is None else counts
    total = counts.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    often = [r[0] for r in counts.where(F.col("copies") * HOT_KEYS > F.lit(total)).where(F.col(key).isNotNull()).select(key).collect()]
    if not often:
        return rows.join(one, key)
    hot = F.coalesce(F.col(key).isin(often), F.lit(False))
    return rows.where(hot).join(F.broadcast(one.where(hot)), key).unionByName(rows.where(~hot).join(one.where(~hot), key))


def in_blocks(rows: DataFrame, group: str, key: str, block: int) -> DataFrame:
    """rows with the columns ``i`` and ``j``, copied so that each pair of rows of a group meets in a block pair.

    A group of up to ``block`` rows is one block pair (0, 0). A larger one is dealt into blocks by the hash of the key; a
    row goes to the pairs of its block with each block, so no block pair holds many more than 2 * block rows.
    """
    sizes = rows.groupBy(group).count().where("count > 1")
    n = F.ceil(F.col("count") / block).cast("int")
    mine = rows.join(sizes, group).withColumn("n", n).drop("count").withColumn("mine", F.pmod(F.xxhash64(key), F.col("n")).cast("int"))
    return (mine.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).drop("n")
            .withColumn("i", F.least("mine", "other")).withColumn("j", F.greatest("mine", "other")).drop("other"))


def each_group(rows: DataFrame, keys: list[str], work: Callable[[pa.Table], list[pa.Array]], ddl: str) -> DataFrame:
    """``work`` on the rows of each group; groups are dealt by their keys and met one after another, in sorted runs."""
    names = [f.split()[0] for f in ddl.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
            change = np.zeros(batch.num_rows - 1, bool)
            for c in columns:
                change |= c[1:] != c[:-1]
            starts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
            for a, b in zip(starts, starts[1:]):
                key = tuple(c[a] for c in columns)
                if held and key != last:
                    yield pa.RecordBatch.from_arrays(work(pa.concat_tables(held)), names=names)
                    held = []
                held.append(pa.Table.from_batches([batch.slice(a, b - a)]))
                last = key
        if held:
            yield pa.RecordBatch.from_arrays(work(pa.concat_tables(held)), names=names)

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, ddl)
