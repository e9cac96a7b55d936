"""The nine cleaning recipes, stated as data and run as one dedup plus one projection.

The order of rules is part of the meaning: equal rows go first, on the raw values;
then rows without their critical columns; then rows with bad numbers, column by
column; then rows out of range. A dropped row is kept in the quarantine with the
first rule it broke.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from retailspark.functions import dates, numbers, text
from retailspark.operators import clean as steps
from retailspark.operators.clean import REASON, Split
from retailspark.operators.profile import digest
from retailspark.schemas import UNKNOWN, UNKNOWN_EMAIL, UNKNOWN_ZIP


@dataclass(frozen=True)
class Recipe:
    """``strict`` columns fail the job on a bad value, ``safe`` ones set the row aside."""

    required: tuple[str, ...] = ()
    defaults: Mapping[str, object] = field(default_factory=dict)
    strict_integers: tuple[str, ...] = ()
    strict_decimals: tuple[str, ...] = ()
    safe_integers: tuple[str, ...] = ()
    safe_decimals: tuple[str, ...] = ()
    at_least: Mapping[str, float] = field(default_factory=dict)
    above: Mapping[str, float] = field(default_factory=dict)
    timestamps: tuple[str, ...] = ()
    phone: str | None = None  # "first": first of a list, "all": every digit
    full_name: bool = False


_CONTACT = {"email": UNKNOWN_EMAIL, "phone": UNKNOWN}
_ADDRESS = {"street": UNKNOWN, "city": UNKNOWN, "state": UNKNOWN, "zip_code": UNKNOWN_ZIP}
_PERSON = {"first_name": UNKNOWN, "last_name": UNKNOWN}

RECIPES: dict[str, Recipe] = {
    "brands": Recipe(strict_integers=("brand_id",), defaults={"brand_name": UNKNOWN}),
    "categories": Recipe(strict_integers=("category_id",), defaults={"category_name": UNKNOWN}),
    "products": Recipe(
        required=("product_id", "product_name"),
        defaults={"model_year": 0},
        strict_integers=("model_year", "product_id", "category_id", "brand_id"),
        strict_decimals=("list_price",),
        at_least={"list_price": 0},
    ),
    "customers": Recipe(
        required=("customer_id",),
        defaults={**_PERSON, **_CONTACT, **_ADDRESS},
        strict_integers=("customer_id",),
        phone="first",
        full_name=True,
    ),
    "orders": Recipe(
        required=("order_id", "customer_id"),
        strict_integers=("order_id", "customer_id", "order_status", "store_id", "staff_id"),
        timestamps=("order_date", "required_date", "shipped_date"),
    ),
    "order_items": Recipe(
        required=("order_id", "product_id", "item_id"),
        safe_integers=("order_id", "item_id", "product_id", "quantity"),
        safe_decimals=("list_price", "discount"),
        above={"quantity": 0},
    ),
    "staffs": Recipe(
        required=("staff_id",),
        defaults={**_PERSON, **_CONTACT, "manager_id": 0},
        safe_integers=("staff_id", "store_id", "active", "manager_id"),
        phone="all",
    ),
    "stores": Recipe(
        required=("store_id",),
        defaults={"store_name": UNKNOWN, **_CONTACT, **_ADDRESS},
        strict_integers=("store_id",),
        phone="all",
    ),
    "stocks": Recipe(
        required=("store_id", "product_id"),
        defaults={"quantity": 0},
        strict_integers=("store_id", "product_id", "quantity"),
        at_least={"quantity": 0},
    ),
}


@dataclass(frozen=True)
class Staged:
    """Distinct raw rows, the numbers read from them, the rules a row must meet, and the finished columns.

    Rules and columns refer to the numbers by ``steps.read``, so each value is parsed once.
    """

    rows: DataFrame
    numbers: dict[str, Column]
    judged: set[str]  # the numbers that rules refer to
    rules: list[tuple[str, Column]]
    columns: dict[str, Column]
    source: DataFrame

    @property
    def clean(self) -> DataFrame:
        kept = steps.read_once(self.rows, self.numbers)
        for _, accepted in self.rules:
            kept = kept.filter(accepted)
        return self._finished(kept)

    def _finished(self, rows: DataFrame) -> DataFrame:
        return rows.select(*[c.alias(name) for name, c in self.columns.items()])

    @property
    def _judged(self) -> dict[str, Column]:
        return {name: c for name, c in self.numbers.items() if name in self.judged}

    @property
    def tagged(self) -> DataFrame:
        broken = [(name, ~F.coalesce(ok, F.lit(False))) for name, ok in self.rules]
        return steps.read_once(self.rows, self._judged).select(
            *[F.col(f"`{c}`") for c in self.rows.columns], steps.first_reason(broken).alias(REASON)
        )

    @property
    def quarantine(self) -> DataFrame:
        return self.tagged.filter(F.col(REASON).isNotNull())

    def delta(self, name: str) -> DataFrame:
        """One row: the table's name, its rows as they came and those that stay, from one scan; digests of rows are
        counted, not rows."""
        kept = F.lit(True)
        for _, accepted in self.rules:
            kept = kept & F.coalesce(accepted, F.lit(False))
        rows = steps.read_once(self.source, self._judged)
        kinds = rows.select(digest(self.source).alias("digest"), kept.cast("bigint").alias("kept")).groupBy(
            "digest"
        ).agg(F.count("*").alias("copies"), F.min("kept").alias("kept"))
        return kinds.agg(
            F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_before"), F.coalesce(F.sum("kept"), F.lit(0)).alias("rows_after")
        ).select(F.lit(name).alias("table_name"), "*")

    def stored(self, path: str) -> Split:
        """Both parts, from the tagged rows written once to ``path`` and read back.

        Kept and dropped rows land in the partitions ``rejected=false`` and
        ``rejected=true``, so reading either one skips the other.
        """
        tagged = self.tagged.withColumn("rejected", F.col(REASON).isNotNull())
        tagged.write.mode("overwrite").partitionBy("rejected").parquet(path)
        back = self.rows.sparkSession.read.schema(tagged.schema).parquet(path)
        return Split(
            self._finished(steps.read_once(back.filter(~F.col("rejected")), self.numbers)),
            back.filter("rejected").drop("rejected"),
        )


def stage_table(
    name: str,
    df: DataFrame,
    on_bad: str = "raise",
    year_mode: str = "repair",
    latest_year: int = dates.LATEST_YEAR,
    date_formats: tuple[str, ...] = (),
) -> Staged:
    """Prepare the recipe of table ``name`` for ``df``.

    ``on_bad="quarantine"`` treats strict columns like safe ones instead of
    failing the job. ``date_formats`` are tried on dates first, before the usual readings.
    """
    if on_bad not in ("raise", "quarantine"):
        raise ValueError(f"on_bad must be 'raise' or 'quarantine', not {on_bad!r}")
    recipe = RECIPES[name]
    df = steps.standardise_names(df)
    present = set(df.columns)
    types = dict(df.dtypes)

    def value(c: str) -> Column:
        if c in recipe.defaults:
            return F.coalesce(F.col(c), F.lit(recipe.defaults[c]).cast(types[c]))
        return F.col(c)

    def keep(names):
        return [c for c in names if c in present]

    integers = {
        c: numbers.whole(value(c), types[c])
        for c in keep(recipe.strict_integers + recipe.safe_integers)
    }
    decimals = {
        c: numbers.number(value(c), types[c])
        for c in keep(recipe.strict_decimals + recipe.safe_decimals)
    }
    parsed = {**integers, **decimals}
    lenient = keep(recipe.safe_integers + recipe.safe_decimals)
    if on_bad == "quarantine":
        lenient = keep(recipe.strict_integers + recipe.strict_decimals) + lenient

    rules = [(f"missing {c}", F.col(c).isNotNull()) for c in keep(recipe.required)]
    rules += [(f"invalid {c}", steps.read(c).isNotNull()) for c in lenient]
    # A value out of range is dropped, and so is a NULL one; bad text in a strict
    # column passes, for the projection to fail the job on it.
    for c in keep(recipe.at_least):
        in_range = steps.read(c) >= recipe.at_least[c]
        if c not in lenient:
            in_range = in_range | (steps.read(c).isNull() & value(c).isNotNull())
        rules.append((f"{c} out of range", in_range))
    rules += [(f"{c} out of range", steps.read(c) > recipe.above[c]) for c in keep(recipe.above)]

    columns: dict[str, Column] = {}
    for c in df.columns:
        if c in parsed:
            columns[c] = steps.read(c)
            if on_bad == "raise" and c in recipe.strict_integers + recipe.strict_decimals:
                columns[c] = numbers.required(steps.read(c), value(c), f"{name}.{c}")
        elif c in recipe.timestamps:
            columns[c] = steps.repaired(df, c, year_mode, latest_year, date_formats)
        elif c == "phone" and recipe.phone:
            phone = value(c)
            columns[c] = text.digits_only(
                text.first_phone(phone) if recipe.phone == "first" else phone
            )
        else:
            columns[c] = value(c)
    if recipe.full_name and {"first_name", "last_name"} <= present and "full_name" not in present:
        columns["full_name"] = F.concat(value("first_name"), F.lit(" "), value("last_name"))

    judged = {*lenient, *keep(recipe.at_least), *keep(recipe.above)}
    return Staged(steps.drop_duplicates(df), parsed, judged, rules, columns, df)


def clean_table(name: str, df: DataFrame, **options) -> Split:
    staged = stage_table(name, df, **options)
    return Split(staged.clean, staged.quarantine)


def clean_all(
    tables: Mapping[str, DataFrame],
    gates: Mapping[str, bool] | None = None,
    cleaning_needed: bool = True,
    **options,
) -> dict[str, Split]:
    """Run the recipe of every table present.

    ``gates`` (table -> flagged by the profile) skips tables judged clean; a table
    not in ``gates`` is cleaned. ``cleaning_needed=False`` skips all of them.
    """
    result = {}
    for name, df in tables.items():
        if cleaning_needed and (gates is None or gates.get(name, True)):
            result[name] = clean_table(name, df, **options)
        else:
            plain = steps.standardise_names(df)
            nothing = plain.filter(F.lit(False)).withColumn(REASON, F.lit(None).cast("string"))
            result[name] = Split(plain, nothing)
    return result
