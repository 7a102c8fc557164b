"""Positions of regular-expression matches with built-in column functions, and written intermediate tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.session import fresh_dir

SPAN = "struct<start: int, rank: int, kind: string, end: int>"


#: Matches whose places one fold gathers; longer lists are cut into such chunks, so the work follows their length.
CHUNK = 128


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def placed(gaps: Column, at: Column, out: str, make: Callable[[Column, Column], Column]) -> Column:
    """An array of ``make(x, start)`` for (gap, size) pairs in order, from the place ``at`` on; ``make`` may give null."""
    none = F.array().cast(out)

    def fold(chunk: Column, start: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            begin = acc["at"] + x["gap"]
            return F.struct((begin + F.coalesce(x["size"], F.lit(0))).alias("at"), F.concat(acc["out"], F.array(make(x, begin))).alias("out"))

        return F.filter(F.aggregate(chunk, F.struct(start.cast("int").alias("at"), none.alias("out")), step, lambda acc: acc["out"]), lambda x: x.isNotNull())

    def in_chunks(pairs: Column) -> Column:
        cut = F.transform(F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / CHUNK).cast("int")), lambda i: F.slice(pairs, i * CHUNK + 1, F.lit(CHUNK)))
        length = lambda chunk: F.aggregate(chunk, F.lit(0), lambda n, x: n + x["gap"] + F.coalesce(x["size"], F.lit(0)))
        starts = lambda chunks: F.aggregate(chunks, F.array(at.cast("int")), lambda acc, c: F.concat(acc, F.array(F.element_at(acc, -1) + length(c))))
        return let(cut, lambda chunks: F.flatten(F.zip_with(chunks, F.slice(starts(chunks), F.lit(1), F.size(chunks)), fold)))

    return let(gaps, lambda pairs: F.when(F.size(pairs) <= CHUNK, fold(pairs, at)).otherwise(in_chunks(pairs)))


def matches(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches: array of (match, start, end) in code points, end exclusive.

    The pieces between matches come from splitting at the same pattern, so their lengths give the positions.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(found, F.split(text, pattern, -1), lambda m, gap: F.struct(m.alias("m"), F.length(gap).alias("gap"), F.length(m).alias("size")))
    kind = "array<struct<match: string, start: int, end: int>>"

    def make(x: Column, start: Column) -> Column:
        return F.when(x["m"].isNotNull(), F.struct(x["m"].alias("match"), start.alias("start"), (start + x["size"]).alias("end")))

    return F.when(F.size(found) > 0, placed(pairs, F.lit(0), kind, make)).otherwise(F.array().cast(kind))


def spans(found: Column, rank: int, kind: str) -> Column:
    """Matches as spans of a kind; ``rank`` orders kinds that start together."""
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), m["end"].alias("end")))


def count(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")


def digest(found: Column) -> Column:
    """kind:start:end by start, then kind, comma-joined."""
    return F.array_join(F.transform(F.array_sort(found), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def outside(word_start: Column, word_end: Column, found: Column) -> Column:
    """Whether a range overlaps no span."""
    return ~F.exists(found, lambda s: (s["start"] < word_end) & (word_start < s["end"]))


#: Code points of a piece of a text; words and spans meet by pieces.
PIECE = 256


def pieces(text: Column) -> Column:
    """The text in pieces of ``PIECE`` code points, in one pass."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def by_piece(found: Column, count: Column) -> Column:
    """For each piece the parts (start, end) of spans in it: an array of ``count`` arrays.

    Spans are cut at the ends of pieces, and each piece has a first entry of its own, so that one sort brings every piece's
    parts together and their borders are found by comparing neighbours.
    """
    part = lambda p, a, b: F.struct(p.cast("int").alias("p"), a.cast("int").alias("start"), b.cast("int").alias("end"))
    cut = F.flatten(F.transform(found, lambda s: F.transform(F.sequence(F.floor(s["start"] / PIECE), F.floor((s["end"] - 1) / PIECE)), lambda p: part(
        p, F.greatest(s["start"], p * PIECE), F.least(s["end"], (p + 1) * PIECE)))))
    first = F.transform(F.sequence(F.lit(0), count - 1), lambda p: part(p, F.lit(-1), F.lit(-1)))

    def grouped(parts: Column) -> Column:
        begins = F.filter(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: F.get(parts, i)["start"] == -1)
        return let(begins, lambda b: F.transform(b, lambda i, k: F.slice(parts, i + 1, F.coalesce(F.get(b, k + 1), F.size(parts)) - i)))

    return let(F.array_sort(F.concat(first, cut)), grouped)


def free(start: Column, end: Column, parts: Column) -> Column:
    """Whether a range overlaps no span; ``parts`` as from ``by_piece``. Only the range's own pieces are looked at."""
    p, q = F.floor(start / PIECE).cast("int"), F.floor((end - 1) / PIECE).cast("int")
    return outside(start, end, F.flatten(F.slice(parts, p + 1, q - p + 1)))


def settled(frame: DataFrame, label: str) -> DataFrame:
    """The frame written as a table below the shared folder and read again: later steps do not compute it anew."""
    path = fresh_dir(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
