"""Deterministic keys: calendar keys, hash keys and change fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# How a missing part is written and how each part ends, so that keys stay stable.
MISSING = "<null>"
PART_END = "||"


def date_key(d: Column) -> Column:
    """``yyyymmdd`` as an integer; NULL stays NULL."""
    return F.year(d) * 10000 + F.month(d) * 100 + F.day(d)


def month_of_key(key: Column) -> Column:
    """``yyyymm`` of a date key, by integer division towards zero (so -1 becomes 0)."""
    return (key / F.lit(100)).cast("int")


def moment_text(ts: Column) -> Column:
    """A timestamp as text with milliseconds, so that a key never depends on session formatting."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS")


def _parts(columns: Sequence[Column]) -> Column:
    return F.concat(*[
        F.concat(F.coalesce(c.cast("string"), F.lit(MISSING)), F.lit(PART_END))
        for c in columns])


def surrogate_key(*columns: Column, utf16: bool = False) -> Column:
    """First eight bytes of a SHA-256 over the parts, as a signed big integer.

    ``utf16`` hashes the UTF-16LE bytes instead of UTF-8, for keys that must equal those of a
    warehouse that stores national character text.
    """
    text = _parts(columns)
    digest = F.sha2(F.encode(text, "UTF-16LE") if utf16 else text, 256)
    return F.conv(F.substring(digest, 1, 16), 16, -10).cast("bigint")


def attribute_hash(*columns: Column) -> Column:
    """SHA-256 fingerprint (64 upper-case hex digits) of the attributes, to detect any change."""
    return F.upper(F.sha2(_parts(columns), 256))
