"""SimHash near-duplicates: fingerprints of word shingles, compared exactly in tiles of equal population counts.

1. Fingerprints. A text is lower-cased (A-Z only) and cut into words `[^\\x20\\x09-\\x0D]+`; every 3-word shingle,
   repeats included, is hashed with XXH64 (seed 42). Bit b of the fingerprint is 1 if it is set in over half the hashes.
2. Tiles. Equal fingerprints are one row. A row's tile is the vector of population counts of its two 32-bit halves (or
   its four quarters in a large table); there are at most 17**4 tiles, whatever the table holds. A tile is dealt into blocks
   of about ``BLOCK`` fingerprints, each of them one binary row.
3. Tile pairs. Two fingerprints within the radius have tiles whose population counts differ by at most the radius in
   sum, so all other tile pairs are skipped before anything is shipped. A block goes to the pairs of blocks that are
   left; inside a pair the same bound on the counts of all eight bytes skips pairs of sub-tiles. What remains is
   compared exactly, by exclusive-or and bit counts.
4. A pair of sub-tiles gives a spanning forest of its links, never its pairs; components of all forests are the classes.

The comparison is exact and so still quadratic in the number of different fingerprints; counts leave about a quarter of
all pairs with two parts and a twentieth with four, of which the sub-tiles skip most.

Defined results: null texts and texts without words have fingerprint zero, which links like any other; a text of fewer
words is one shingle of all; repeated rows and ids are rows of their own; a null id is never a component's id unless all
members' ids are null; an empty table gives an empty result. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.graph import components, each_group, join_hot
from starloom.llm.scan import small_batches, texts_of
from starloom.llm.spans import settled

RADIUS = 3
WORDS = 3
SEED = 42
#: Fingerprints of a block and of a sub-tile in it.
BLOCK, SUB = 4096, 128
#: Different fingerprints from which on tiles are cut by four counts instead of two.
FINE = 4_000_000
#: Hashes whose bits are counted at once.
HASHES = 1 << 16


def fingerprint(text: bytes, n: int = WORDS) -> int:
    """The 64-bit fingerprint of a text."""
    words = text.lower().split()  # of bytes: only A-Z, only ASCII blanks
    if not words:
        return 0
    line = b" ".join(words)
    gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    n = min(n, len(words))
    starts = np.concatenate(([0], gaps + 1)).tolist()
    ends = [*gaps.tolist(), len(line)][n - 1 :]
    count = np.zeros(64, np.int64)
    for at in range(0, len(ends), HASHES):
        own = [xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts[at : at + HASHES], ends[at : at + HASHES])]
        count += np.unpackbits(np.array(own, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > len(ends), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WORDS) -> DataFrame:
    """(id, fp): one row per document, the fingerprint as a signed 64-bit number."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.array([fingerprint(x, n) for x in texts_of(batch.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own.view(np.int64))], names=["id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "id long, fp long")


class Tiles:
    """The tiles of a table, the numbers of their blocks, and which tiles can hold fingerprints within the radius."""

    def __init__(self, sizes: dict[int, int], parts: int, radius: int = RADIUS, block: int = BLOCK):
        self.parts, self.bits = parts, 64 // parts
        self.blocks = {t: -(-n // block) for t, n in sizes.items()}
        self.first, at = {}, 0
        for t in sorted(sizes):
            self.first[t] = at
            at += self.blocks[t]
        self.moves = [m for m in product(range(-radius, radius + 1), repeat=parts) if sum(map(abs, m)) <= radius]

    def near(self, tile: int) -> np.ndarray:
        """The numbers of all blocks whose tiles are not ruled out against a tile."""
        counts, out = [], []
        for _ in range(self.parts):
            tile, c = divmod(tile, self.bits + 1)
            counts.append(c)
        for move in self.moves:
            other = [c + d for c, d in zip(counts, move)]
            if min(other) >= 0 and max(other) <= self.bits:
                number = sum(c * (self.bits + 1) ** k for k, c in enumerate(other))
                if number in self.first:
                    out.append(np.arange(self.first[number], self.first[number] + self.blocks[number]))
        return np.concatenate(out)


def tile_of(fp: Column, parts: int) -> Column:
    """The population counts of a fingerprint's parts as one number."""
    bits = 64 // parts
    counts = [F.bit_count(F.shiftrightunsigned(fp, bits * k).bitwiseAND(F.lit((1 << bits) - 1))) for k in range(parts)]
    out = counts[0].cast("long")
    for k, c in enumerate(counts[1:], 1):
        out = out + c * F.lit((bits + 1) ** k)
    return out


def forest(link: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs (row, column) that span the components of a link matrix: each row and column with its component's first row."""
    rows, cols = np.flatnonzero(link.any(axis=1)), np.flatnonzero(link.any(axis=0))
    own, far = link[np.ix_(rows, cols)], len(link)
    row, col = rows.copy(), np.full(len(cols), far)
    while True:
        col = np.where(own, row[:, None], far).min(axis=0, initial=far)
        new = np.minimum(row, np.where(own, col[None, :], far).min(axis=1, initial=far))
        if (new == row).all():
            return [(rows, row), (cols, col)]
        row = new


def sorted_tiles(fps: np.ndarray, sub: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprints in the order of their bytes' counts, and the least and greatest counts of each sub-tile."""
    counts = np.bitwise_count(fps.view(np.uint8).reshape(-1, 8)).astype(np.int16)
    order = np.lexsort(counts.T)
    fps, counts = fps[order], counts[order]
    starts = np.arange(0, len(fps), sub)
    return fps, np.minimum.reduceat(counts, starts), np.maximum.reduceat(counts, starts)


def compared(radius: int, sub: int):
    """Work on a pair of blocks: edges (a, b) that span its links."""

    def work(group: pa.Table) -> list[pa.Array]:
        sides = [np.frombuffer(x.as_buffer(), np.uint64) for x in group.column("fps")]
        x, x_low, x_high = sorted_tiles(sides[0], sub)
        y, y_low, y_high = (x, x_low, x_high) if len(sides) == 1 else sorted_tiles(sides[1], sub)
        apart = np.maximum(0, np.maximum(x_low[:, None] - y_high[None], y_low[None] - x_high[:, None])).sum(axis=2)
        a, b = [], []
        for i, j in np.argwhere(apart <= radius).tolist():
            if len(sides) == 1 and j < i:
                continue
            one, two = x[i * sub : (i + 1) * sub], y[j * sub : (j + 1) * sub]
            link = np.bitwise_count(one[:, None] ^ two[None]) <= radius
            if link.sum() > (len(one) if len(sides) == 1 and i == j else 0):
                (rows, r), (cols, c) = forest(link)
                a += [one[rows], two[cols]]
                b += [one[r], one[c]]
        a, b = (np.concatenate(v) if v else np.zeros(0, np.uint64) for v in (a, b))
        some = a != b
        return [pa.array(a[some].view(np.int64)), pa.array(b[some].view(np.int64))]

    return work


def near(one: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) between different fingerprints of the column fp that span all links within the radius."""
    parts = 2 if one.count() < FINE else 4
    tiled = one.select("fp", tile_of(F.col("fp"), parts).alias("tile"))
    # At most 33**2 or 17**4 rows, whatever the table holds.
    tiles = Tiles({r["tile"]: r["count"] for r in tiled.groupBy("tile").count().collect()}, parts, radius, block)
    known = one.sparkSession.sparkContext.broadcast(tiles)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = known.value
        for batch in batches:
            if batch.num_rows:
                fp, tile = (c.to_numpy() for c in batch.columns)
                here, place = np.unique(tile, return_inverse=True)
                first, count = (np.array([d[x] for x in here.tolist()], np.int64)[place] for d in (t.first, t.blocks))
                # Not the hash of a shuffle: the low bits of a fingerprint are what near ones share.
                number = first + (fp.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % count
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(number)], names=["fp", "tile", "block"])

    def packed(group: pa.Table) -> list[pa.Array]:
        fps = np.sort(group.column("fp").to_numpy())
        return [group.column("tile").slice(0, 1).combine_chunks(), group.column("block").slice(0, 1).combine_chunks(), pa.array([fps.tobytes()], pa.binary())]

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tile, own, fps in zip(*(c.to_pylist() for c in batch.columns)):
                others = known.value.near(tile)
                for at in range(0, len(others), 64):
                    some = others[at : at + 64]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(some, own)), pa.array(np.maximum(some, own)), pa.array([fps] * len(some), pa.binary())],
                                                     names=["i", "j", "fps"])

    blocks = settled(each_group(tiled.mapInArrow(numbered, "fp long, tile long, block long"), ["block"], packed, "tile long, block long, fps binary"), "blocks")
    pairs = blocks.mapInArrow(dealt, "i long, j long, fps binary")
    return each_group(pairs, ["i", "j"], compared(radius, SUB), "a long, b long")


def classes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n: int = WORDS, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """One row per document: id, fingerprint (16 hexadecimal digits), component_id (the smallest id reachable by links)."""
    rows = settled(fingerprints(docs, id_col, text_col, n), "fingerprints")
    one = settled(rows.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("copies")), "distinct-fingerprints")
    label = components(near(one, radius, block))
    linked = one.join(label, one["fp"] == label["id"]).select("fp", "label", "least")
    least = linked.groupBy("label").agg(F.min("least").alias("component"))
    # A class may hold many fingerprints; its own row is found again by its label, which is one of them.
    named = one.join(join_hot(linked.select("fp", "label"), least, "label").select("fp", "component"), "fp", "left")
    placed = named.select("fp", "copies", F.coalesce("component", "least").alias("component_id"))
    return (join_hot(rows, placed.select("fp", "component_id"), "fp", placed.select("fp", "copies"))
            .select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))
