"""Benchmark decontamination: a broadcast set of normalised test n-grams, scanned over the word windows of all texts.

A word is a run of characters that are not ASCII punctuation, blanks or control characters, with A-Z lower-cased. A
window is ``n`` consecutive words of a benchmark item; an item of fewer words, but not none, is one window of all of
them. A document word inside any occurrence of a window is hit. Candidates come from 64-bit hashes and every one is
verified on the words themselves.

The set is broadcast only up to ``block_windows`` windows. A larger benchmark is dealt into blocks of items by hash; the
documents are scanned once for each block, and what one block found is written (checkpoint) before the next one.

Defined results: null text or text without words has no windows, 0 words and no hits; null benchmark text or id gives no
window; repeated rows are scanned row by row; an item id that occurs twice counts once; empty tables give empty results,
or no hits; other columns are left alone, also where their names clash with result columns (``hits`` returns only the
key and its own columns).
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.scan import ALNUM, Words, packs, small_batches, texts_of

BLOCK_WINDOWS = 1_000_000


class WindowSet:
    """Windows of benchmark items: sorted hashes by length, and the items of each window's words."""

    def __init__(self, items: list[tuple[str, str]], n: int):
        self.items: dict[bytes, set[str]] = defaultdict(set)
        hashes: dict[int, set[int]] = defaultdict(set)
        for key, text in items:
            found = Words([text.encode()], ALNUM)
            size = min(n, len(found.start))
            if size:
                codes, at = found.windows(found.words(), size)
                hashes[size].update(codes.tolist())
                for i in at.tolist():
                    self.items[window_bytes(found, i, size)].add(key)
        self.hashes = {size: np.array(sorted(codes), np.uint64) for size, codes in hashes.items()}


def window_bytes(words: Words, i: int, n: int) -> bytes:
    return b" ".join(words.canon[a:b].tobytes() for a, b in zip(words.start[i : i + n], words.end[i : i + n]))


def find(texts: list[bytes], known: WindowSet) -> tuple[Words, np.ndarray, list[set[str]]]:
    """The words of a pack of texts, which of them are hit, and the items found in each text."""
    words = Words(texts, ALNUM)
    hit, items = np.zeros(len(words.start) + 1, np.int64), [set() for _ in texts]
    codes = words.words()
    for size, wanted in known.hashes.items():
        windows, at = words.windows(codes, size)
        place = np.minimum(np.searchsorted(wanted, windows), len(wanted) - 1)
        for i in at[wanted[place] == windows].tolist():
            if own := known.items.get(window_bytes(words, i, size)):
                items[words.owner[i]] |= own
                hit[i] += 1
                hit[i + size] -= 1
    return words, np.cumsum(hit[:-1]) > 0, items


FOUND = pa.struct([
    ("n_words", pa.int64()), ("ranges", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))),
    ("items", pa.list_(pa.string())), ("kept", pa.string())])
FOUND_DDL = "struct<n_words: bigint, ranges: array<struct<a: bigint, b: bigint>>, items: array<string>, kept: string>"


def blocks(benchmark: DataFrame, item_col: str, text_col: str, n: int, block_windows: int) -> list[DataFrame]:
    """The benchmark's rows in parts that hold about ``block_windows`` windows at most; one part for an empty benchmark."""
    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text")).dropna().distinct()
    # A window begins with a word, and words are apart, so half the characters bound an item's windows.
    size = rows.agg(F.coalesce(F.sum(F.floor(F.length("text") / 2) + 1), F.lit(0))).first()[0]
    count = max(1, -(-size // block_windows))
    return [rows.where(F.pmod(F.xxhash64("item"), F.lit(count)) == k) for k in range(count)]


def annotate(docs: DataFrame, text_at: int, benchmark: DataFrame, item_col: str, item_text_col: str, n: int, block_windows: int) -> DataFrame:
    """docs, its columns renamed c0, c1 ... by place, with the struct ``found``: the number of words, ranges of hit words,
    ids of items found (sorted), and the text without its hit words (null where nothing is hit)."""
    small_batches(docs.sparkSession)
    width = len(docs.columns)
    frame = docs.toDF(*(f"c{i}" for i in range(width))).withColumn("found", F.lit(None).cast(FOUND_DDL))
    parts = blocks(benchmark, item_col, item_text_col, n, block_windows)
    for part in parts:
        known = docs.sparkSession.sparkContext.broadcast(WindowSet([tuple(r) for r in part.collect()], n))

        def run(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts, before, found = texts_of(batch.column(text_at)), batch.column(width).to_pylist(), []
                for own in packs(texts):
                    found += pack_rows(texts[own], before[own], known.value)
                yield pa.RecordBatch.from_arrays([*batch.columns[:width], pa.array(found, FOUND)], names=batch.schema.names)

        frame = frame.mapInArrow(run, frame.schema)
        if len(parts) > 1:
            frame = frame.checkpoint()
    return frame


def pack_rows(texts: list[bytes], before: list[dict | None], known: WindowSet) -> list[dict]:
    """``found`` of each text of a pack, joined with what earlier blocks have found."""
    words, hit, items = find(texts, known)
    out = []
    for i, own in enumerate(items):
        first, last = words.first[i], words.first[i + 1]
        mine = hit[first:last]
        if before[i]:
            own = own | set(before[i]["items"])
            for r in before[i]["ranges"]:
                mine[r["a"] : r["b"]] = True
        row = {"n_words": int(last - first), "ranges": [], "items": sorted(own), "kept": None}
        if mine.any():
            edges = np.flatnonzero(np.diff(np.concatenate(([0], mine.view(np.int8), [0]))))
            kept, at, zero = [], 0, words.text_start[i]
            for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
                row["ranges"].append({"a": a, "b": b})
                kept.append(texts[i][at : words.start[first + a] - zero])
                at = words.end[first + b - 1] - zero
            row["kept"] = b"".join([*kept, texts[i][at:]]).decode()
        out.append(row)
    return out


def hits(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text", n: int = 10, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """One row per document: key, n_words, n_hit, n_items, items (sorted as strings), contaminated."""
    small = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    found = annotate(small, 1, benchmark, item_col, item_text_col, n, block_windows)
    return found.select(F.col("c0").alias(id_col), "found.n_words", n_hit().alias("n_hit"),
                        F.size("found.items").cast("long").alias("n_items"), "found.items", (n_hit() > 0).alias("contaminated"))


def n_hit():
    return F.aggregate("found.ranges", F.lit(0).cast("long"), lambda s, r: s + r["b"] - r["a"])


def clean(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
          n: int = 10, drop_share: float = 0.5, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """docs with hit spans cut out of their texts; documents of which at least ``drop_share`` of the words are hit go."""
    at = docs.columns.index(text_col)
    found = annotate(docs, at, benchmark, item_col, item_text_col, n, block_windows)
    kept = found.where((n_hit() == 0) | (n_hit() < F.lit(drop_share) * F.col("found.n_words")))
    return kept.select(*(
        (F.coalesce("found.kept", f"c{i}") if i == at else F.col(f"c{i}")).alias(c) for i, c in enumerate(docs.columns)))
