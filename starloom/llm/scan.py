"""Vectorised scans of whole texts inside Arrow tasks: packing, words, hashes and hashed n-grams.

Every function here works on one bounded pack of texts (about ``PACK_BYTES``, or one longer text) at a time, so a task's
memory follows the longest text and not the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PACK_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: A random 64-bit value for each byte.
RAW_BYTES = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64)
_powers: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base modulo 2**64 and their inverses, at least n + 1 of each."""
    if "up" not in _powers or len(_powers["up"]) <= n:
        size = max(n + 1, 2 * PACK_BYTES)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for name, base in (("up", _BASE), ("down", inverse)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"], _powers["down"]


def texts_of(column: pa.Array) -> list[bytes]:
    """The texts of a string column as UTF-8; null is empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def packs(texts: list[bytes], limit: int = PACK_BYTES) -> Iterator[slice]:
    """Slices of consecutive texts of about ``limit`` bytes together; a longer text is alone in its slice."""
    start, size = 0, 0
    for i, x in enumerate(texts):
        if i > start and size + len(x) > limit:
            yield slice(start, i)
            start, size = i, 0
        size += len(x) + 1
    if start < len(texts):
        yield slice(start, len(texts))


def joined(texts: list[bytes], gap: bytes = b"\0") -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts with a gap byte before, between and after them, and each text's start (one more: the end)."""
    data = np.frombuffer(gap + gap.join(texts) + gap, np.uint8)
    lengths = np.fromiter((len(x) + 1 for x in texts), np.int64, len(texts))
    starts = np.empty(len(texts) + 1, np.int64)
    starts[0] = 1
    np.cumsum(lengths, out=starts[1:])
    starts[1:] += 1
    return data, starts


def table(word: bytes | range | list[int], lower: bool = True) -> np.ndarray:
    """A table from byte to its canonical byte for bytes of words; other bytes give 0."""
    out = np.zeros(256, np.uint8)
    for b in word:
        out[b] = b + 32 if lower and 65 <= b <= 90 else b
    return out


#: Word bytes for `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing A-Z: digits, letters, everything beyond ASCII.
ALNUM = table([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
#: Word bytes for `[^\x20\x09-\x0D]+` after lower-casing A-Z; the 0 byte is written as 0xFF, which UTF-8 never uses.
SPACED = table([b for b in range(1, 256) if b not in (0x20, *range(0x09, 0x0E))])
SPACED[0] = 0xFF


class Words:
    """The words of a pack: canonical bytes, byte positions, owners and a running hash.

    ``start`` and ``end`` are positions in ``data``, ``owner`` is the number of the word's text in the pack, ``first``
    holds the number of each text's first word and one more entry for the end.
    """

    def __init__(self, texts: list[bytes], kinds: np.ndarray):
        self.data, self.text_start = joined(texts, b" ")
        self.canon = kinds[self.data]
        inside = (self.canon != 0).view(np.int8)
        edges = np.diff(inside)
        self.start = np.flatnonzero(edges == 1) + 1
        self.end = np.flatnonzero(edges == -1) + 1
        self.first = np.searchsorted(self.start, self.text_start)
        self.owner = np.repeat(np.arange(len(texts)), np.diff(self.first))
        up, self._down = powers(len(self.data))
        self._sum = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(RAW_BYTES[self.canon] * up[: len(self.data)], out=self._sum[1:])

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the canonical bytes between positions."""
        return mix((self._sum[end] - self._sum[start]) * self._down[start] + (end - start).astype(np.uint64))

    def words(self) -> np.ndarray:
        return self.hashes(self.start, self.end)

    def windows(self, words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of n consecutive words of one text, and the number of each one's first word."""
        count = len(words) - n + 1
        if count <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        out = np.zeros(count, np.uint64)
        for j in range(n):
            out = out * _BASE + words[j : j + count]
        at = np.flatnonzero(self.owner[:count] == self.owner[n - 1 :])
        return mix(out[at]), at


def ngram_counts(texts: list[bytes], kinds: np.ndarray, orders: tuple[int, ...], buckets: int) -> np.ndarray:
    """Counts of hashed byte n-grams, one row of ``buckets`` cells for each text; n-grams do not cross texts.

    ``kinds`` maps bytes; those that it maps to 0 count as a blank inside a text.
    """
    data, starts = joined(texts)
    canon = kinds[data].astype(np.uint32)
    owner = np.repeat(np.arange(len(texts)), np.diff(starts))
    inside = data[1:] != 0
    inside[-1] = False
    cells = np.zeros(len(texts) * buckets, np.int64)
    for n in orders:
        key = np.full(len(canon) - 1, n, np.uint32)
        for j in range(n):
            shifted = canon[1 + j :]
            key[: len(shifted)] = key[: len(shifted)] * np.uint32(0x01000193) ^ shifted
        whole = inside.copy()
        for j in range(1, n):
            whole[: len(whole) - j] &= inside[j:]
            whole[len(whole) - j :] = False
        key ^= key >> np.uint32(15)
        key *= np.uint32(0x2C1B3C6D)
        key ^= key >> np.uint32(12)
        at = owner[: len(key)][whole[: len(owner)]] * buckets + key[: len(owner)][whole[: len(owner)]] % np.uint32(buckets)
        cells += np.bincount(at, minlength=len(cells))
    return cells.reshape(len(texts), buckets)


def crc_rest(key: str, by: int) -> Column:
    """The remainder of the CRC-32 of a key as text; -1 for a null key."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string")), F.lit(by)), F.lit(-1))


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 8 MB in this session, so that memory does not follow the size of rows."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(name).removesuffix("b")) > 8 << 20:
        spark.conf.set(name, str(8 << 20))


def add_results(docs: DataFrame, text_at: int, start: Callable[[], Callable[[list[bytes]], list[list]]], ddl: str) -> DataFrame:
    """docs, its columns renamed c0, c1 ... by place (so that no name clashes), with the columns of ``ddl`` added.

    ``start`` is called once in a task and returns the function from the texts of a pack to lists of results by column.
    """
    small_batches(docs.sparkSession)
    width = len(docs.columns)
    frame = docs.toDF(*(f"c{i}" for i in range(width)))
    added = T._parse_datatype_string(ddl)
    schema = T.StructType([*frame.schema.fields, *added.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        kinds, rows_of = [to_arrow_type(f.dataType) for f in added.fields], start()
        for batch in batches:
            texts = texts_of(batch.column(text_at))
            parts = [rows_of(texts[part]) for part in packs(texts)]
            new = [pa.array([x for part in parts for x in part[j]], kind) for j, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*batch.schema.names, *added.names])

    return frame.mapInArrow(run, schema)
