"""Text clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from retailspark.schemas import NA_TOKENS


def null_if_na(c: Column) -> Column:
    """NULL for every token that stands for a missing value."""
    return F.when(~c.isin(NA_TOKENS), c)


def first_phone(c: Column) -> Column:
    """First entry of a comma-separated phone list, trimmed."""
    return F.trim(F.split_part(c, F.lit(","), F.lit(1)))


def digits_only(c: Column) -> Column:
    """Digits of ``c``; NULL when none are left."""
    return F.nullif(F.regexp_replace(c, r"[^0-9]", ""), F.lit(""))


def or_empty(c: Column) -> Column:
    """The value as text, with '' for NULL."""
    return F.coalesce(c.cast("string"), F.lit(""))
