"""Text cleaning and label conforming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.contracts import EFFECTIVE_STATUS, EMAIL_PATTERN


def clean_text(c: Column, width: int | None = None) -> Column:
    """Trim blanks and turn an empty text into NULL; only an explicit ``width`` cuts the text."""
    return F.nullif(F.trim(c if width is None else F.substring(c, 1, width)), F.lit(""))


def clean_email(c: Column) -> Column:
    return F.lower(clean_text(c))


def clean_phone(c: Column) -> Column:
    """Drop blanks, dashes, brackets and dots; nothing left means NULL."""
    return F.nullif(F.translate(c, " -().", ""), F.lit(""))


def upper_label(c: Column) -> Column:
    return F.upper(clean_text(c))


def conform(c: Column, aliases: dict[str, str]) -> Column:
    """Upper-case label with the known aliases replaced; other labels pass through.

    The aliases are grouped by target, so the plan holds one IN list per conformed value.
    """
    label = upper_label(c)
    by_target: dict[str, list[str]] = {}
    for alias, target in aliases.items():
        by_target.setdefault(target, []).append(alias)
    result = None
    for target, names in by_target.items():
        hit = label.isin(names)
        result = F.when(hit, target) if result is None else result.when(hit, target)
    return label if result is None else result.otherwise(label)


def conform_by_table(df: DataFrame, column: str, aliases: DataFrame) -> DataFrame:
    """Conform through an ``(alias, label)`` table when the aliases are data, not constants.

    The join carries no hint: Spark broadcasts the alias table while it is small and falls back
    to a shuffled join beyond that.
    """
    known = aliases.select(F.upper("alias").alias("_alias"), F.col("label").alias("_label"))
    joined = df.withColumn("_raw", upper_label(F.col(column))).join(
        known, F.col("_raw") == F.col("_alias"), "left")
    return joined.withColumn(column, F.coalesce("_label", "_raw")).drop("_raw", "_alias", "_label")


def valid_email(c: Column) -> Column:
    """True when the address has the usual shape; a missing address is False, never NULL."""
    return F.coalesce(c.like(EMAIL_PATTERN), F.lit(False))


def effective_sale(status: Column) -> Column:
    """The one definition of a completed sale; a missing status is not one."""
    return F.coalesce(F.upper(F.trim(status)) == EFFECTIVE_STATUS, F.lit(False))


def is_active(discontinued: Column) -> Column:
    """A product counts as active unless it is known to be discontinued."""
    return ~F.coalesce(discontinued, F.lit(False))
