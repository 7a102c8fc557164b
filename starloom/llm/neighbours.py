"""Nearest neighbours by cosine with a hierarchical k-means tree and best-bin-first traversal.

The tree is grown on a bounded sample: each node is split into ``branching`` clusters until a leaf stands for about
``leaf_rows`` rows. Every row is then filed under the leaf that it reaches from the root. A query walks the tree through
a priority queue: the nearest unvisited branch comes first, whatever its depth, which ranks all leaves. How many rows a
query looks at is calibrated: a bounded sample of queries is compared with brute force over all rows, and the number of
leaves visited is doubled until their mean recall reaches ``recall``; in the last step all leaves are visited, so the
search never ends below it. Leaves that hold fewer than k rows together are passed in any case.

Work per task stays bounded: neighbouring leaves make up shards of about ``shard_rows`` rows, and a leaf of more rows is
dealt into several shards by the hash of their id. A query goes once to each shard that holds leaves it visits; a shard
with more than ``query_block`` queries is copied for each block of them. Each shard answers with its k best rows of the
visited leaves (a matrix product proposes, cosines in double precision decide) and a window merges these. Only the tree
(bounded by the sample), the numbers of rows and queries of leaves and shards and the calibration queries' answers are
on the driver.

Defined results: vectors that are null, of length 0 or another length than the commonest one (the smaller of equally
common ones), zero, or with null or non-finite components take no part, neither as queries nor as candidates; ties go to
the smaller id; a query
with fewer than k candidates gets them all; rows that repeat an id count as one (its smallest vector); empty tables give
empty results. Only id and vector are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.llm.spans import settled

SAMPLE = 20_000
LEAF_ROWS = 400
BRANCHING = 8
SHARD_ROWS = 16_384
QUERY_BLOCK = 2_000
MAX_LEAVES = 4_096
CALIBRATION = 64


@dataclass
class Node:
    children: list[int] = field(default_factory=list)
    leaf: int = -1


class Tree:
    """Centroids of all nodes; node 0 is the root."""

    def __init__(self, rows: np.ndarray, leaves: int, branching: int):
        self.nodes, self.leaves = [Node()], 0
        self.centres = [np.zeros(rows.shape[1])]
        least = max(1, len(rows) // max(leaves, 1))
        random, todo = np.random.default_rng(5), [(0, rows)]
        while todo:
            node, own = todo.pop()
            part = kmeans(own, branching, random) if len(own) > least else None
            if part is None or len(np.unique(part)) < 2:
                self.nodes[node].leaf, self.leaves = self.leaves, self.leaves + 1
                continue
            for c in np.unique(part):
                child = own[part == c]
                self.nodes[node].children.append(len(self.nodes))
                self.centres.append(child.mean(axis=0))
                todo.append((len(self.nodes), child))
                self.nodes.append(Node())
        self.centres = np.stack(self.centres)

    def near(self, node: int, rows: np.ndarray) -> np.ndarray:
        """Squared distances of rows to the node's children."""
        c = self.centres[self.nodes[node].children]
        return (rows**2).sum(1)[:, None] - 2 * rows @ c.T + (c**2).sum(1)

    def file(self, rows: np.ndarray) -> np.ndarray:
        """The leaf that each row reaches by its nearest branches."""
        out, todo = np.zeros(len(rows), np.int64), [(0, np.arange(len(rows)))]
        while todo:
            node, at = todo.pop()
            if self.nodes[node].leaf >= 0:
                out[at] = self.nodes[node].leaf
                continue
            best = self.near(node, rows[at]).argmin(axis=1)
            todo += [(child, at[best == j]) for j, child in enumerate(self.nodes[node].children) if (best == j).any()]
        return out

    def visit(self, row: np.ndarray, sizes: np.ndarray, leaves: int, least: int) -> list[int]:
        """Leaves with rows, best bin first: ``leaves`` of them, and on until they hold ``least`` rows."""
        queue, found, rows = [(0.0, 0)], [], 0
        while queue and (len(found) < leaves or rows < least):
            _, node = heapq.heappop(queue)
            if (leaf := self.nodes[node].leaf) >= 0:
                if sizes[leaf]:
                    found.append(leaf)
                    rows += sizes[leaf]
                continue
            for d, child in zip(self.near(node, row[None])[0].tolist(), self.nodes[node].children):
                heapq.heappush(queue, (d, child))
        return found


def shards(sizes: np.ndarray, shard_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """For each leaf its first shard and over how many shards its rows are dealt."""
    first, parts = np.zeros(len(sizes), np.int32), np.maximum(1, -(-sizes // shard_rows)).astype(np.int32)
    shard, filled = 0, 0
    for leaf, size in enumerate(sizes.tolist()):
        if filled and filled + size > shard_rows:
            shard, filled = shard + 1, 0
        first[leaf] = shard
        filled += size
        if parts[leaf] > 1:
            shard, filled = shard + int(parts[leaf]), 0
    return first, parts


def kmeans(rows: np.ndarray, k: int, random: np.random.Generator, steps: int = 8) -> np.ndarray | None:
    """The cluster of each row; None where all rows are alike."""
    distinct = np.unique(rows, axis=0)
    if len(distinct) < 2:
        return None
    centres = distinct[random.choice(len(distinct), min(k, len(distinct)), replace=False)]
    for _ in range(steps):
        part = ((centres**2).sum(1) - 2 * rows @ centres.T).argmin(axis=1)
        centres = np.stack([rows[part == c].mean(axis=0) if (part == c).any() else centres[c] for c in range(len(centres))])
    return ((centres**2).sum(1) - 2 * rows @ centres.T).argmin(axis=1)


def stacked(column: pa.Array | pd.Series, dims: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else np.concatenate(column.to_numpy())
    return flat.astype(np.float64).reshape(-1, dims)


def cosines(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosines in double precision; equal vectors give equal values wherever they are."""
    dot = (rows * query).sum(axis=1)
    return dot / np.sqrt((rows * rows).sum(axis=1)) / np.sqrt((query * query).sum())


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def valid(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id`` and ``v`` (array<double>) of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    whole = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0)
    return table.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull() & F.coalesce(whole, F.lit(False)))


def search(table: DataFrame, is_query: Column, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, recall: float = 0.95,
           sample: int = SAMPLE, leaf_rows: int = LEAF_ROWS, branching: int = BRANCHING, shard_rows: int = SHARD_ROWS,
           query_block: int = QUERY_BLOCK, calibration: int = CALIBRATION) -> DataFrame:
    """For each row that meets ``is_query`` its k nearest other rows: query_id, rank (from 1), the id, score."""
    rows = valid(table.where(F.col(id_col).isNotNull()), id_col, vector_col)
    queries = valid(table.where(is_query), id_col, vector_col)
    out = f"query_id long, {id_col} long, score double"
    lengths = rows.groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), "dims").limit(1).collect()
    if not lengths:
        return table.sparkSession.createDataFrame([], f"query_id long, rank int, {id_col} long, score double")
    dims = lengths[0]["dims"]
    one = lambda t: t.where(F.size("v") == dims).groupBy("id").agg(F.min("v").alias("v"))  # noqa: E731  one row per id
    rows, queries = one(rows), one(queries)
    total = rows.count()
    # The smallest hashes; those above the part of the range that holds a third more than the sample are left out before any sort.
    part = min(1.0, (1.3 * sample + 1000) / max(1, total))
    few = rows.where(F.xxhash64("id") <= F.lit(min(2**63 - 1, int(-(2**63) + part * 2**64))))
    drawn = few.orderBy(F.xxhash64("id"), "id").limit(sample).toArrow()
    drawn = stacked(drawn.column("v").combine_chunks(), dims)
    drawn = drawn / np.sqrt((drawn**2).sum(axis=1, keepdims=True))
    tree = table.sparkSession.sparkContext.broadcast(Tree(drawn, min(MAX_LEAVES, max(1, total // leaf_rows)), branching))

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = stacked(batch.column(1), dims)
                leaf = tree.value.file(v / np.sqrt((v**2).sum(axis=1, keepdims=True)))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=["id", "v", "leaf"])

    filed = settled(rows.mapInArrow(file, "id long, v array<double>, leaf long"), "leaves")
    sizes = np.zeros(tree.value.leaves, np.int64)
    for r in filed.groupBy("leaf").count().collect():  # one row for each leaf
        sizes[r["leaf"]] = r["count"]
    first, parts = shards(sizes, shard_rows)
    at = lambda values: F.element_at(F.lit(values.tolist()).cast("array<int>"), (F.col("leaf") + 1).cast("int"))
    bins = filed.withColumn("shard", at(first) + F.pmod(F.xxhash64("id"), at(parts)).cast("int"))

    def nearest(asked: DataFrame, leaves: int) -> DataFrame:
        """The k nearest rows found in the visited leaves; all leaves count when ``leaves`` is their number."""

        def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                v, number, shard, seen = stacked(batch.column(1), dims), [], [], []
                for i, row in enumerate(v / np.sqrt((v**2).sum(axis=1, keepdims=True))):
                    by_shard: dict[int, list[int]] = {}
                    for leaf in tree.value.visit(row, sizes, leaves, k + 1):
                        for part in range(first[leaf], first[leaf] + parts[leaf]):
                            by_shard.setdefault(part, []).append(leaf)
                    number += [i] * len(by_shard)
                    shard += by_shard
                    seen += by_shard.values()
                taken = batch.take(pa.array(number, pa.int64()))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(shard, pa.int32()), pa.array(seen, pa.list_(pa.int64()))], names=["id", "v", "shard", "leaves"])

        sent = settled(asked.mapInArrow(visits, "id long, v array<double>, shard int, leaves array<long>"), "visits")
        blocks = np.zeros(int((first + parts).max()), np.int64)
        for r in sent.groupBy("shard").count().collect():  # one row for each shard
            blocks[r["shard"]] = -(-r["count"] // query_block)
        of = F.element_at(F.lit(blocks.tolist()).cast("array<int>"), F.col("shard") + 1)
        left = sent.withColumn("block", F.pmod(F.xxhash64("id"), of).cast("int"))
        right = bins.where(of > 0).withColumn("block", F.explode(F.sequence(F.lit(0), of - 1)))

        def meet(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            found = [pd.DataFrame({"query_id": np.zeros(0, np.int64), id_col: np.zeros(0, np.int64), "score": np.zeros(0)})]
            if len(left) and len(right):
                ids, leaf, v = right["id"].to_numpy(), right["leaf"].to_numpy(), stacked(right["v"], dims)
                unit = v / np.sqrt((v**2).sum(axis=1, keepdims=True))
                for (q, row, seen) in zip(left["id"], left["v"], left["leaves"]):
                    row = np.asarray(row, np.float64)
                    near = np.where(np.isin(leaf, seen) & (ids != q), unit @ (row / np.sqrt((row**2).sum())), -2.0)
                    bar = np.partition(near, -k)[-k] if len(near) > k else -2.0
                    top = np.flatnonzero((near >= bar - 1e-9) & (near > -2))
                    scores = cosines(row, v[top])
                    own = best(ids[top], scores, k)
                    found.append(pd.DataFrame({"query_id": q, id_col: ids[top][own], "score": scores[own]}))
            return pd.concat(found)

        met = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInPandas(meet, out)
        order = W.partitionBy("query_id").orderBy(F.desc("score"), id_col)
        return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", id_col, "score")

    filled = int((sizes > 0).sum())
    tested = queries.orderBy(F.xxhash64("id"), "id").limit(calibration)
    pairs = lambda frame: {(r["query_id"], r[id_col]) for r in frame.collect()}  # noqa: E731  at most calibration * k rows
    truth, leaves = pairs(brute_force(rows, tested, dims, k, id_col)), max(1, filled // 32)
    while leaves < filled and len(pairs(nearest(tested, leaves)) & truth) < recall * len(truth):
        leaves = min(2 * leaves, filled)
    return nearest(queries, leaves)


def brute_force(rows: DataFrame, asked: DataFrame, dims: int, k: int, id_col: str) -> DataFrame:
    """The true k nearest rows of a bounded set of queries (it is collected), in one pass over all rows."""
    known = [(r["id"], np.array(r["v"])) for r in asked.collect()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, v = batch.column(0).to_numpy(), stacked(batch.column(1), dims)
            for q, row in known:
                scores = np.where(ids == q, -2.0, cosines(row, v))
                top = best(ids, scores, k)
                top = top[scores[top] > -2]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(top), q)), pa.array(ids[top]), pa.array(scores[top])], names=["query_id", id_col, "score"])

    met = rows.mapInArrow(run, f"query_id long, {id_col} long, score double")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), id_col)
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
