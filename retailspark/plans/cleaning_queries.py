"""Registered cleaning and enrichment queries over the untidy tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from retailspark.operators import clean, enrich, profile, recipes
from retailspark.plans.query import Query
from retailspark.schemas import UNKNOWN, UNKNOWN_EMAIL, UNKNOWN_ZIP
from retailspark.sources import dirt, starschema

DATES = ["order_date", "required_date", "shipped_date"]


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def standardise_names(spark: SparkSession, folder: str) -> DataFrame:
    return clean.standardise_names(dirt.misnamed_orders(spark, folder))


def dedup(spark, folder):
    return clean.drop_duplicates(dirt.customers(spark, folder))


def drop_null_keys(spark, folder):
    return clean.drop_null_keys(dirt.products(spark, folder), ["product_id", "product_name"])


CUSTOMER_FILLS = {
    "first_name": UNKNOWN,
    "last_name": UNKNOWN,
    "phone": UNKNOWN,
    "email": UNKNOWN_EMAIL,
    "street": UNKNOWN,
    "city": UNKNOWN,
    "state": UNKNOWN,
    "zip_code": UNKNOWN_ZIP,
}


def fill_defaults(spark, folder):
    return clean.fill_defaults(dirt.customers(spark, folder), CUSTOMER_FILLS)


def cast_strict(spark, folder):
    filled = clean.fill_defaults(dirt.products(spark, folder), {"model_year": "0"})
    return clean.cast_strict(
        filled, ["product_id", "brand_id", "category_id", "model_year"], ["list_price"]
    )


ITEM_INTEGERS = ["order_id", "item_id", "product_id", "quantity"]
ITEM_DECIMALS = ["list_price", "discount"]


def safe_numeric(spark, folder):
    return clean.safe_numeric(
        dirt.order_items(spark, folder), ITEM_INTEGERS, ITEM_DECIMALS
    ).clean


def quarantine(spark, folder):
    """Line items the recipe drops, as they came in, with the first rule they break."""
    return recipes.clean_table("order_items", dirt.order_items(spark, folder)).quarantine


def finite(spark, folder):
    numeric = dirt.staffs(spark, folder).select(
        "staff_id", F.col("active").cast("double").alias("active")
    )
    return clean.drop_non_finite(numeric, ["active"])


def range_filter(spark, folder):
    items = clean.safe_numeric(dirt.order_items(spark, folder), ITEM_INTEGERS, ITEM_DECIMALS)
    priced = clean.keep_range(items.clean, "list_price", 0)
    return clean.keep_range(priced, "quantity", 0, inclusive=False)


def full_name(spark, folder):
    filled = clean.fill_defaults(dirt.customers(spark, folder), CUSTOMER_FILLS)
    return clean.add_full_name(filled).select("customer_id", "full_name")


def first_phone(spark, folder):
    phones = dirt.customers(spark, folder).select("customer_id", "phone")
    return clean.keep_first_phone(phones)


def phone_digits(spark, folder):
    filled = clean.fill_defaults(dirt.customers(spark, folder), {"phone": UNKNOWN})
    return clean.keep_phone_digits(clean.keep_first_phone(filled)).select("customer_id", "phone")


def date_repair(spark, folder):
    repaired = clean.repair_dates(dirt.orders(spark, folder), DATES)
    return repaired.select("order_id", *DATES)


def date_repair_null(spark, folder):
    """The variant that gives up on years before 1900."""
    repaired = clean.repair_dates(dirt.orders(spark, folder), DATES, mode="null")
    return repaired.select("order_id", *DATES)


def invalid_dates(spark, folder):
    orders = recipes.clean_table("orders", dirt.orders(spark, folder)).clean
    return clean.count_invalid_dates(orders, ["order_date", "required_date"])


def row_delta(spark, folder):
    tables = dirt.dirty_tables(spark, folder)
    return union_all([recipes.stage_table(name, tables[name]).delta(name) for name in recipes.RECIPES])


# Forms of one date, as datetime patterns.
DATE_FORMS = (
    "dd-MMM-yy", "MMM d, yyyy", "M.d.yyyy", "yyyyMMdd HH:mm", "MMMM yyyy", "EEE, dd MMM yyyy HH:mm:ss", "M/d/yyyy h:mm a",
    "d MMMM yyyy", "yyyy.MM.dd", "yyyyMMdd'T'HHmmss", "MMMM d yyyy h a", "yyyy-MM-dd HH:mm:ss",
)


def date_forms(spark, folder):
    """Order dates, with a time of day, written in twelve forms and read again."""
    orders = starschema.source(spark, folder, "orders")
    key = F.col("o_orderkey")
    moment = F.col("o_orderdate") + F.make_dt_interval(hours=(key % 24).cast("int"), mins=(key % 60).cast("int"))
    written = F.coalesce(*[
        F.when(key % len(DATE_FORMS) == i, F.date_format(moment, form)) for i, form in enumerate(DATE_FORMS)
    ])
    forms = orders.select(key.alias("order_id"), written.alias("order_date"))
    return forms.select("order_id", clean.read_date(forms, "order_date").alias("order_date"))


def unread_dates(spark, folder):
    """How many values of each date column cannot be read."""
    return clean.count_unread_dates(dirt.orders(spark, folder), "orders", DATES)


def _recipe(name: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return recipes.clean_table(name, dirt.VIEWS[name](spark, folder)).clean

    return query


def enrich_products(spark, folder):
    """Names for bare products; every sixth product names a brand that does not exist."""
    t = starschema.retail_tables(spark, folder)
    unknown = F.when(F.col("product_id") % 6 == 0, F.col("brand_id") + 1000).otherwise(F.col("brand_id"))
    bare = t["products"].drop("brand_name", "category_name").withColumn("brand_id", unknown)
    return enrich.enrich_products(bare, t["brands"], t["categories"])


def item_total(spark, folder):
    items = recipes.clean_table("order_items", dirt.order_items(spark, folder)).clean
    return enrich.add_item_total(items)


def order_total(spark, folder):
    orders = starschema.plain_orders(spark, folder)
    items = starschema.order_items(spark, folder)
    return enrich.add_order_total(orders, items, keep_line_counts=True)


def gated(spark, folder):
    """Only what is missing is derived: products have their names, lines and orders lack their totals."""
    t = starschema.retail_tables(spark, folder)
    tables = {n: t[n] for n in ("products", "brands", "categories", "order_items")}
    tables["order_items"] = tables["order_items"].drop("total_price")
    tables["orders"] = starschema.plain_orders(spark, folder)
    needed = {r.transformation: r.needed for r in profile.transforms_needed(tables).collect()}  # three rows
    derived = enrich.enrich_all(tables, needed)
    frames = [
        derived[name].agg(
            F.lit(name).alias("table_name"), F.lit(needed[step]).alias("derived"), F.count("*").alias("row_count"),
            F.sum(F.round(F.col(column).cast("decimal(28,8)"), 4)).cast("double").alias("total"),
        )
        for name, step, column in (
            ("products", "enrich_products", "list_price"), ("order_items", "calculate_item_total", "total_price"),
            ("orders", "calculate_order_total", "order_total"),
        )
    ]
    return union_all(frames)


def summary(spark, folder):
    items = starschema.order_items(spark, folder)
    orders = enrich.add_order_total(starschema.plain_orders(spark, folder), items)
    return enrich.summary(items, orders)


QUERIES: dict[str, Query] = {
    "cln_standardise_names": standardise_names,
    "cln_dedup": dedup,
    "cln_drop_null_keys": drop_null_keys,
    "cln_fill_defaults": fill_defaults,
    "cln_cast_strict": cast_strict,
    "cln_safe_numeric": safe_numeric,
    "cln_quarantine": quarantine,
    "cln_finite": finite,
    "cln_range_filter": range_filter,
    "cln_full_name": full_name,
    "cln_first_phone": first_phone,
    "cln_phone_digits": phone_digits,
    "cln_date_repair": date_repair,
    "cln_date_repair_null": date_repair_null,
    "cln_date_forms": date_forms,
    "cln_unread_dates": unread_dates,
    "cln_invalid_dates": invalid_dates,
    "cln_row_delta": row_delta,
    **{f"cln_{name}": _recipe(name) for name in recipes.RECIPES},
    "enr_products": enrich_products,
    "enr_item_total": item_total,
    "enr_order_total": order_total,
    "enr_summary": summary,
    "enr_gated": gated,
}
