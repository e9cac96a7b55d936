"""Numeric parsing and exact sums."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Texts that are numbers. The JVM would parse more: type suffixes and hex ('5d', '0x1p3'), NaN and Infinity by name.
# Any other text never gets to a cast: a failing one raises and catches an error, which costs a hundred times the match.
_INTEGER = r"^[\x00-\x20\x7F]*[+-]?[0-9]+[\x00-\x20\x7F]*$"
_NUMBER = r"^[\x00-\x20]*[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?[\x00-\x20]*$"
_NUMBER_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double")


def is_number_type(dtype: str) -> bool:
    return dtype in _NUMBER_TYPES or dtype.startswith("decimal")


def number(c: Column, dtype: str = "string") -> Column:
    """DOUBLE value of ``c``; NULL for text that is no number, NaN and infinity."""
    if not is_number_type(dtype):
        value = c.try_cast("double")
        return F.when(c.rlike(_NUMBER) & is_finite(value), value)
    if dtype in ("float", "double"):
        return F.when(is_finite(c), c.cast("double"))
    return c.cast("double")


def is_finite(c: Column) -> Column:
    return F.abs(c) < float("inf")  # NaN is above infinity


def integer(c: Column) -> Column:
    """BIGINT value of text made of digits, else NULL."""
    return F.when(c.rlike(_INTEGER), c.try_cast("bigint"))


def whole(c: Column, dtype: str = "string") -> Column:
    """BIGINT value of ``c``, fractions cut toward zero; NULL if not a number.

    Plain digits, the usual case, are parsed as BIGINT directly: it is cheaper, and
    ids above 2^53 stay exact.
    """
    if dtype in ("tinyint", "smallint", "int", "bigint"):
        return c.cast("bigint")
    if is_number_type(dtype):
        return c.try_cast("bigint")
    return F.coalesce(integer(c), number(c).try_cast("bigint"))


def required(parsed: Column, raw: Column, label: str) -> Column:
    """``parsed``, or fail the job where it is NULL (missing or unparseable)."""
    message = F.concat(
        F.lit(f"{label}: not a valid number: "), F.coalesce(raw.cast("string"), F.lit("NULL"))
    )
    return F.when(parsed.isNotNull(), parsed).otherwise(F.raise_error(message))


def money(c: Column) -> Column:
    """Line money as an exact decimal, so that sums do not depend on row order.

    A line of 1e20 and more fails the job rather than lose digits.
    """
    return c.cast("decimal(28,8)")


def exact_sum(c: Column) -> Column:
    return F.sum(money(c))


def ratio(total: Column, n: Column) -> Column:
    """``total / n`` as DOUBLE, NULL when ``n`` is 0 or NULL."""
    return F.try_divide(total.cast("double"), n.cast("double"))


def pct(part: Column, base: Column, digits: int = 2) -> Column:
    """Percentage rounded to ``digits``; 0 for an empty base."""
    share = F.try_divide(part.cast("double") * 100.0, base.cast("double"))
    return F.round(F.coalesce(share, F.lit(0.0)), digits)
