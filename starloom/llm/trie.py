"""The prefix trie of conversations: member intervals from range minima over sorted common prefixes.

A node is a distinct sequence of first turns (role, text); its members are the conversations that start with it.

1. Turns. Each turn becomes two 64-bit hashes and its number of words. Turns are numbered in their conversation through a
   range partitioning by (conversation, turn), so a conversation of any length is spread over tasks.
2. Pieces. Sequences are cut into pieces of ``PIECE`` turns; a piece knows the exclusive-or of all position-bound turn
   hashes before it, which names the prefix it continues. Equal pieces of equal prefixes are one row with the number of
   conversations and the smallest one, so neither long conversations nor popular beginnings gather in one task.
3. Intervals. Pieces are sorted by prefix and turns. A task takes runs of them of bounded size, computes the longest common
   prefix of neighbours and a sparse table of its range minima. Each candidate prefix (piece, depth) binary-searches the
   left and the right end of its members over that table, independently of all others; sums over the interval come from
   running totals, the smallest member from a second sparse table. Runs that share a node are merged by its name.
4. Subtrees. A first pass over the intervals gives every node's members. Every node is then charged to its smallest
   member, so a sum over the different nodes of a subtree is a sum over its members, and the second pass, over the same
   sorted pieces, takes it from the same intervals.

Defined results: a null role or text is empty; a null turn comes first; repeated turns are ordered by their hashes; rows
without a conversation id take no part; a conversation without turns is a member of the root only; an empty table gives
an empty result. Other columns are not read. Turns are told apart by 128 bits of hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.scan import small_batches
from starloom.llm.spans import settled

PIECE = 64
#: Turns of a run that a task holds at once, and ids of a list hashed in one row.
RUN_TURNS, LIST_IDS = 1_000_000, 4096
KEY = ["depth", "h1", "h2"]
NODE = ("depth long, h1 long, h2 long, p1 long, p2 long, words long, n long, charge long, leaves long, "
        "least struct<s: long, own: long>, before long")


def turns_of(conversations: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(c, pos, t1, t2, words): every turn with its number in its conversation, from 1."""
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in (role_col, text_col))
    words = F.size(F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).cast("long")
    turns = conversations.select(F.col(id_col).cast("long").alias("c"), F.col(turn_col).alias("turn"), F.xxhash64(role, text).alias("t1"),
                                 F.xxhash64(F.lit("second"), text, role).alias("t2"), words.alias("words")).where("c is not null")
    order = ["c", "turn", "t1", "t2"]
    turns = settled(turns, "turn-hashes")  # the range partitioning samples its input first: texts are read once
    placed = settled(turns.repartitionByRange(*order).sortWithinPartitions(*order)
                     .select("c", "t1", "t2", "words", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "turns")
    parts = placed.groupBy("c", "part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    earlier = Window.partitionBy("c").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("c", "part", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first") + 1).alias("shift"))
    return placed.join(starts, ["c", "part"]).select("c", (F.col("at") + F.col("shift")).alias("pos"), "t1", "t2", "words")


def graft(turns: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like a common ancestor: (turns, all conversation ids).

    Conversation c takes the first h turns of c - c % ``every`` and its own turns after its first h, h = crc32(c) % ``most``.
    """
    own = turns.groupBy("c").agg(F.count("*").alias("n"))
    ids = own.select("c", (F.col("c") - F.col("c") % every).alias("base"), (F.crc32(F.col("c").cast("string")) % most).alias("h"))
    bases = own.where(F.col("c") % every == 0).select(F.col("c").alias("base"), F.col("n").alias("base_n"))
    ids = settled(ids.join(bases, "base", "left").select("c", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("got")), "conversations")
    heads = turns.where((F.col("c") % every == 0) & (F.col("pos") < most)).withColumnRenamed("c", "base")
    begun = ids.where("got > 0").join(heads, "base").where("pos <= h").select("c", "pos", "t1", "t2", "words")
    rest = turns.join(ids.select("c", "h", "got"), "c").where("pos > h").select("c", (F.col("pos") - F.col("h") + F.col("got")).alias("pos"), "t1", "t2", "words")
    return begun.unionByName(rest), ids.select("c")


def pieces_of(turns: DataFrame, ids: DataFrame, piece: int) -> tuple[DataFrame, DataFrame]:
    """(pieces, ends). Pieces: c, turns, their names (x1, x2), and the prefix before: done turns, h1, h2, words. Ends: c, depth, h1, h2, words."""
    bound = turns.select("c", "pos", F.xxhash64("t1", "pos").alias("e1"), F.xxhash64("pos", "t2").alias("e2"), "words")
    cut = settled(bound.groupBy("c", F.floor((F.col("pos") - 1) / piece).alias("k")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "e1", "e2", "words"))).alias("turns"), F.count("*").alias("n"),
        F.bit_xor("e1").alias("x1"), F.bit_xor("e2").alias("x2"), F.sum("words").alias("w")), "pieces")
    earlier = Window.partitionBy("c").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    before = cut.select("c", "k", F.coalesce(F.bit_xor("x1").over(earlier), zero).alias("h1"), F.coalesce(F.bit_xor("x2").over(earlier), zero).alias("h2"),
                        F.coalesce(F.sum("w").over(earlier), zero).alias("before"))
    whole = cut.groupBy("c").agg(F.sum("n").alias("depth"), F.bit_xor("x1").alias("h1"), F.bit_xor("x2").alias("h2"), F.sum("w").alias("words"))
    ends = settled(ids.join(whole, "c", "left").select("c", *(F.coalesce(x, zero).alias(x) for x in (*KEY, "words"))), "ends")
    return settled(cut.select("c", "k", "turns", "x1", "x2").join(before, ["c", "k"]).withColumn("done", F.col("k") * piece).drop("k"), "prefixes"), ends


def minima(values: np.ndarray) -> list[np.ndarray]:
    """A sparse table: entry i of level p is the minimum of 2**p values from i on."""
    table = [values]
    while 2 ** len(table) <= len(values):
        step = 2 ** (len(table) - 1)
        table.append(np.minimum(table[-1][:-step], table[-1][step:]))
    return table


def extents(table: list[np.ndarray], at: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last row of the rows around ``at`` that share ``depth`` turns; table: minima of each row's LCP with the one before."""
    n, left, right = len(table[0]), at.copy(), at.copy()
    for p in range(len(table) - 1, -1, -1):
        size = 2**p
        first = np.maximum(left - size + 1, 0)
        left = np.where((left - size >= 0) & (table[p][np.minimum(first, n - size)] >= depth), left - size, left)
        right = np.where((right + size < n) & (table[p][np.minimum(right + 1, n - size)] >= depth), right + size, right)
    return left, right


def least_of(table: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The minimum between two rows, both included, for each pair."""
    level = np.frexp((right - left + 1).astype(float))[1] - 1
    out = np.empty(len(left), np.int64)
    for p in np.unique(level).tolist():
        some = level == p
        out[some] = np.minimum(table[p][left[some]], table[p][right[some] - 2**p + 1])
    return out


def run_nodes(run: pa.Table) -> pa.RecordBatch:
    """The nodes of a sorted run of pieces, each with sums over its rows of the run."""
    done, h1, h2, before, n, charge, leaves, s, own = (run.column(c).to_numpy() for c in ("done", "h1", "h2", "before", "n", "charge", "leaves", "s", "own"))
    turns = run.column("turns").combine_chunks()
    size = np.diff(turns.offsets.to_numpy()).astype(np.int64)
    flat = turns.flatten()
    e1, e2, words = (flat.field(x).to_numpy() for x in ("e1", "e2", "words"))
    start = np.concatenate(([0], np.cumsum(size)))
    row = np.repeat(np.arange(len(done)), size)
    place = np.arange(len(row)) - start[row]
    # The longest common prefix of each piece with the one before; -1 where they continue different prefixes.
    same = np.concatenate(([False], (done[1:] == done[:-1]) & (h1[1:] == h1[:-1]) & (h2[1:] == h2[:-1])))
    above = np.maximum(row - 1, 0)
    partner = np.minimum(start[above] + place, len(row) - 1)
    differs = ~same[row] | (place >= size[above]) | (e1 != e1[partner]) | (e2 != e2[partner])
    lcp = np.where(same, np.minimum.reduceat(np.where(differs, place, size[row]), start[:-1]), -1)
    fresh = np.flatnonzero(place >= lcp[row])
    at, depth = row[fresh], place[fresh] + 1
    left, right = extents(minima(lcp), at, depth)
    total = lambda x: (np.concatenate(([0], np.cumsum(x)))[right + 1] - np.concatenate(([0], np.cumsum(x)))[left])
    # The smallest member by rank, which also finds what it owns.
    rank = np.argsort(np.argsort(s, kind="stable"), kind="stable")
    least = np.argsort(s, kind="stable")[least_of(minima(rank), left, right)]

    def prefixes(h: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The names of each turn's prefix with and without it."""
        running = np.bitwise_xor.accumulate(e)
        until = running ^ np.where(start[row] > 0, running[np.maximum(start[row] - 1, 0)], 0) ^ h[row]
        return until[fresh], (until ^ e)[fresh]

    (own1, up1), (own2, up2) = prefixes(h1, e1), prefixes(h2, e2)
    heard = np.cumsum(words)
    spoken = (heard - words - np.where(start[row] > 0, heard[np.maximum(start[row] - 1, 0)], 0) + before[row])[fresh]
    columns = [done[at] + depth, own1, own2, up1, up2, words[fresh], total(n), total(charge), total(leaves)]
    member = pa.StructArray.from_arrays([pa.array(s[least]), pa.array(own[least])], names=["s", "own"])
    return pa.RecordBatch.from_arrays([*(pa.array(x.astype(np.int64)) for x in columns), member, pa.array(spoken.astype(np.int64))],
                                      names=["depth", "h1", "h2", "p1", "p2", "words", "n", "charge", "leaves", "least", "before"])


def nodes_of(pieces: DataFrame, members: DataFrame) -> DataFrame:
    """Every node but the root: name, parent's name, words of its last turn and before it, and sums over its members.

    ``members`` has a row (s, n, charge, leaves, own) for each different sequence, s being its smallest conversation.
    """
    same = ["done", "h1", "h2", "x1", "x2"]
    rows = (pieces.join(members, pieces["c"] == members["s"]).groupBy(*same)
            .agg(F.first("turns").alias("turns"), F.first("before").alias("before"), F.sum("n").alias("n"), F.sum("charge").alias("charge"),
                 F.sum("leaves").alias("leaves"), F.min(F.struct("s", "own")).alias("least")).drop("x1", "x2")
            .select("done", "h1", "h2", "turns", "before", "n", "charge", "leaves", "least.s", "least.own"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, turns = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                turns += len(batch.column("turns").flatten())
            if turns > RUN_TURNS:
                yield run_nodes(pa.Table.from_batches(held))
                held, turns = [], 0
        if held:
            yield run_nodes(pa.Table.from_batches(held))

    order = ["done", "h1", "h2", "turns"]
    found = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, NODE)
    return settled(found.groupBy(*KEY).agg(*(F.first(x).alias(x) for x in ("p1", "p2", "words", "before")), *(F.sum(x).alias(x) for x in ("n", "charge", "leaves")),
                                           F.min("least").alias("least")), "nodes")


def digests(ends: DataFrame) -> DataFrame:
    """(depth, h1, h2, ids_sha256): SHA-256 of the comma-joined ids, in ascending order, of conversations that are this sequence.

    SHA-256 has to read its input in order. Many ids are joined in many tasks first; the last one reads long texts only.
    """

    def groups(batch: pa.RecordBatch) -> Iterator[tuple[tuple, int, int]]:
        names = [batch.column(x).to_numpy() for x in KEY]
        change = np.flatnonzero(np.any([x[1:] != x[:-1] for x in names], axis=0)) + 1
        bounds = np.unique(np.concatenate(([0], change, np.arange(0, batch.num_rows, LIST_IDS), [batch.num_rows]))).tolist()
        for a, b in zip(bounds, bounds[1:]):
            yield tuple(int(x[a]) for x in names), a, b

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ids, found = batch.column("c").to_pylist(), list(groups(batch))
                yield pa.RecordBatch.from_arrays([*(pa.array([key[j] for key, _, _ in found], pa.int64()) for j in range(3)), pa.array([ids[a] for _, a, _ in found], pa.int64()),
                                                  pa.array([",".join(map(str, ids[a:b])) for _, a, b in found], pa.string())], names=[*KEY, "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None

        def out(rows: list[tuple[tuple, str]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*(pa.array([key[j] for key, _ in rows], pa.int64()) for j in range(3)), pa.array([x for _, x in rows], pa.string())],
                                              names=[*KEY, "ids_sha256"])

        for batch in batches:
            done = []
            for *key, ids in zip(*(batch.column(x).to_pylist() for x in (*KEY, "ids"))):
                if last == key:
                    state.update(b"," + ids.encode())
                    continue
                if last is not None:
                    done.append((last, state.hexdigest()))
                last, state = key, hashlib.sha256(ids.encode())
            yield out(done)
        if last is not None:
            yield out([(last, state.hexdigest())])

    lists = ends.select(*KEY, "c").repartitionByRange(*KEY, "c").sortWithinPartitions(*KEY, "c").mapInArrow(listed, "depth long, h1 long, h2 long, first long, ids string")
    return lists.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(hashed, "depth long, h1 long, h2 long, ids_sha256 string")


def build(turns: DataFrame, ids: DataFrame, piece: int = PIECE) -> DataFrame:
    """The trie of numbered turns (c, pos, t1, t2, words); ``ids`` (c) also names conversations without turns.

    One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    small_batches(turns.sparkSession)
    pieces, ends = pieces_of(turns, ids, piece)
    seqs = settled(ends.groupBy(*KEY).agg(F.min("c").alias("s"), F.count("*").alias("n"), F.max("words").alias("whole")), "sequences")
    zero = F.lit(0).cast("long")
    first = nodes_of(pieces, seqs.select("s", "n", zero.alias("charge"), zero.alias("leaves"), zero.alias("own")))
    kids = first.groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("h1"), F.col("p2").alias("h2")).agg(F.count("*").alias("kids"))
    owned = first.groupBy("least.s").agg(F.sum("words").alias("owned"))
    members = settled(seqs.join(kids, KEY, "left").join(owned, "s", "left").withColumn("owned", F.coalesce("owned", zero))
                      .select("s", "n", (F.col("n") * F.col("whole") - F.col("owned")).alias("charge"), F.col("kids").isNull().cast("long").alias("leaves"),
                              (F.col("owned") - F.col("whole")).alias("own")), "members")
    nodes = nodes_of(pieces, members)
    top = members.agg(F.min("s").alias("s"), F.sum("n").alias("n"), F.sum("charge").alias("charge"), F.sum("leaves").alias("leaves")).where("s is not null")
    root = top.select(zero.alias("depth"), zero.alias("h1"), zero.alias("h2"), zero.alias("p1"), zero.alias("p2"), F.col("s").alias("conv_id"), "n", "leaves", F.col("charge").alias("saved"))
    saved = F.col("charge") + F.col("least.own") - (F.col("n") - 1) * F.col("before")
    every = nodes.select(*KEY, "p1", "p2", F.col("least.s").alias("conv_id"), "n", "leaves", saved.alias("saved")).unionByName(root)
    up = every.select((F.col("depth") + 1).alias("depth"), F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    # The root, which may have very many children, is found without a shuffle of them.
    origin = F.broadcast(root.select(F.lit(1).cast("long").alias("depth"), F.col("conv_id").alias("parent_conv_id")))
    deep = every.where("depth > 1").join(up, ["depth", "p1", "p2"], "left")
    flat = every.where("depth <= 1").join(origin, "depth", "left")
    both = deep.unionByName(flat).join(kids, KEY, "left").join(digests(ends), KEY, "left")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return both.select("conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), F.coalesce("kids", zero).alias("n_children"), F.col("leaves").alias("n_leaves"),
                       F.col("saved").alias("saved_tokens"), F.coalesce("ids_sha256", none).alias("ends_sha256"))


def trie(conversations: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
         piece: int = PIECE) -> DataFrame:
    """The prefix trie of conversations as they stand."""
    turns = settled(turns_of(conversations, id_col, turn_col, role_col, text_col), "numbered")
    return build(turns, turns.select("c").distinct(), piece)


def grafted_trie(conversations: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                 every: int = 20, most: int = 4, piece: int = PIECE) -> DataFrame:
    """The prefix trie of conversations that begin like their ancestor (see ``graft``)."""
    turns = settled(turns_of(conversations, id_col, turn_col, role_col, text_col), "numbered")
    return build(*graft(turns, every, most), piece)
