"""Cleaning steps. Each takes a DataFrame and returns one, or a kept/rejected split."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from retailspark.functions import dates, numbers, text

REASON = "rejected_because"


class Split(NamedTuple):
    """Rows kept, and the rows dropped with their first failing rule in ``REASON``."""

    clean: DataFrame
    quarantine: DataFrame


def first_reason(rules: Iterable[tuple[str, Column]]) -> Column:
    """Name of the first rule whose condition holds; a NULL condition does not hold."""
    reasons = [F.when(condition, F.lit(name)) for name, condition in rules]
    return F.coalesce(*reasons) if reasons else F.lit(None).cast("string")


def standardise_names(df: DataFrame) -> DataFrame:
    """Lowercase column names, spaces to underscores."""
    names = [standard_name(c) for c in df.columns]
    clash = sorted({n for n in names if names.count(n) > 1})
    if clash:
        raise ValueError(f"column names collide once standardised: {', '.join(clash)}")
    return df.toDF(*names)


def standard_name(name: str) -> str:
    return name.lower().replace(" ", "_")


def drop_duplicates(df: DataFrame) -> DataFrame:
    """One row of each set of equal rows.

    A plain grouping on all columns, so copies collapse before the shuffle and a
    very common row does not overload one task.
    """
    return df.dropDuplicates()


_READ = "_read_"


def read_once(df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """``df`` with the values as further columns, each computed once a row; ``read`` names them.

    A filter on plain computed columns is moved in front of their projection and computes them there again, at each
    mention, in one method that soon is too long for the JVM to compile. Past a generator no filter moves.
    """
    if not values:
        return df
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(_READ + name) for name, c in values.items()]))))


def read(name: str) -> Column:
    return F.col(_READ + name)


def drop_null_keys(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(subset=columns)


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.withColumns(
        {c: F.coalesce(_given(df, c), F.lit(v).cast(_type(df, c))) for c, v in defaults.items()}
    )


def cast_strict(
    df: DataFrame, integers: Iterable[str] = (), decimals: Iterable[str] = ()
) -> DataFrame:
    """BIGINT / DOUBLE casts that fail the job on bad text (and on NULL for integers)."""
    casts = {c: strict_integer(df, c) for c in integers}
    casts |= {c: strict_decimal(df, c) for c in decimals}
    return df.withColumns(casts)


def strict_integer(df: DataFrame, name: str, default: object = None) -> Column:
    raw = F.col(name) if default is None else F.coalesce(F.col(name), _default(df, name, default))
    return numbers.required(numbers.whole(raw, _type(df, name)), raw, name)


def strict_decimal(df: DataFrame, name: str) -> Column:
    raw = F.col(name)
    parsed = numbers.number(raw, _type(df, name))
    return F.when(raw.isNotNull(), numbers.required(parsed, raw, name))


def safe_numeric(
    df: DataFrame, integers: Iterable[str] = (), decimals: Iterable[str] = ()
) -> Split:
    """Cast the columns; rows with a value that is no finite number are set aside.

    The reason names the first failing column in the order given.
    """
    integers, decimals = list(integers), list(decimals)
    parsed = {c: numbers.whole(F.col(c), _type(df, c)) for c in integers}
    parsed |= {c: numbers.number(F.col(c), _type(df, c)) for c in decimals}
    reason = first_reason((f"invalid {c}", read(c).isNull()) for c in parsed)
    rows = kept = read_once(df, parsed)
    for c in parsed:
        kept = kept.filter(read(c).isNotNull())
    kept = kept.select(*[read(c).alias(c) if c in parsed else F.col(f"`{c}`") for c in df.columns])
    dropped = rows.select(*[F.col(f"`{c}`") for c in df.columns], reason.alias(REASON))
    return Split(kept, dropped.filter(F.col(REASON).isNotNull()))


def drop_non_finite(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop rows with NaN or an infinity in one of the (numeric) columns."""
    for c in columns:
        df = df.filter(numbers.is_finite(F.col(c)))
    return df


def keep_range(df: DataFrame, column: str, low: float, inclusive: bool = True) -> DataFrame:
    """Keep rows at or above (or strictly above) ``low``; NULL is dropped."""
    value = F.col(column)
    return df.filter(value >= low if inclusive else value > low)


def add_full_name(df: DataFrame) -> DataFrame:
    """``full_name`` from the filled first and last name, unless the column exists."""
    if "full_name" in df.columns:
        return df
    return df.withColumn("full_name", F.concat("first_name", F.lit(" "), "last_name"))


def keep_first_phone(df: DataFrame, column: str = "phone") -> DataFrame:
    return df.withColumn(column, text.first_phone(F.col(column)))


def keep_phone_digits(df: DataFrame, column: str = "phone") -> DataFrame:
    return df.withColumn(column, text.digits_only(F.col(column)))


def repair_dates(
    df: DataFrame,
    columns: Iterable[str],
    mode: str = "repair",
    latest: int = dates.LATEST_YEAR,
    formats: tuple[str, ...] = (),
) -> DataFrame:
    return df.withColumns({c: repaired(df, c, mode, latest, formats) for c in columns})


def repaired(
    df: DataFrame, name: str, mode: str, latest: int, formats: tuple[str, ...] = ()
) -> Column:
    text = F.col(name) if _type(df, name) == "string" else None
    return dates.repair_year(read_date(df, name, formats), mode, latest, of=text)


def read_date(df: DataFrame, name: str, formats: tuple[str, ...] = ()) -> Column:
    return dates.parse_timestamp(F.col(name), _type(df, name), formats)


def count_unread_dates(
    df: DataFrame, table: str, columns: Iterable[str], formats: tuple[str, ...] = ()
) -> DataFrame:
    """(table_name, column_name, unread): values that are there but no date that can be read."""
    columns = list(columns)
    counts = df.agg(
        *[F.count_if(F.col(c).isNotNull() & read_date(df, c, formats).isNull()).alias(c) for c in columns]
    )
    return counts.select(
        F.lit(table).alias("table_name"),
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("unread")) for c in columns])
        ).alias("x"),
    ).select("table_name", "x.*")


def count_invalid_dates(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """One row: how many rows lack at least one of the dates."""
    missing = F.lit(False)
    for c in columns:
        missing = missing | F.col(c).isNull()
    return df.agg(F.count_if(missing).alias("invalid_dates"))


def row_delta(name: str, before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: table name with its row counts before and after a step."""
    counts = before.agg(F.count("*").alias("rows_before"), F.lit(0).alias("rows_after")).unionAll(
        after.agg(F.lit(0).alias("rows_before"), F.count("*").alias("rows_after"))
    )
    totals = counts.agg(
        F.sum("rows_before").alias("rows_before"), F.sum("rows_after").alias("rows_after")
    )
    return totals.select(F.lit(name).alias("table_name"), "*")


def _given(df: DataFrame, name: str) -> Column:
    """The value, or NULL for NaN as well."""
    if _type(df, name) in ("float", "double"):
        return F.nullif(F.col(name), F.lit(float("nan")).cast(_type(df, name)))
    return F.col(name)


def _type(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def _default(df: DataFrame, name: str, value: object) -> Column:
    return F.lit(value).cast(_type(df, name))
