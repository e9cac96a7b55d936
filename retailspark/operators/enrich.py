"""Derived columns: dimension names on products, line totals, order totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from retailspark.functions.numbers import exact_sum, money, ratio
from retailspark.operators.joins import lookup, unique_lookup


def enrich_products(
    products: DataFrame, brands: DataFrame, categories: DataFrame
) -> DataFrame:
    """Add brand and category names; products without a match get NULL.

    A name column that already exists stays, unless it holds NULLs only.
    """
    named = _with_name(products, brands, "brand_id", "brand_name")
    return _with_name(named, categories, "category_id", "category_name")


def _with_name(products: DataFrame, dim: DataFrame, key: str, name: str) -> DataFrame:
    found = unique_lookup(dim, key, name).withColumnRenamed(name, "_found")
    joined = lookup(products, found, key, F.col("product_id"), "left")
    if name not in products.columns:
        return joined.withColumnRenamed("_found", name)
    return joined.withColumn(name, _keep_unless_empty(products, name, F.col("_found"))).drop(
        "_found"
    )


def _keep_unless_empty(df: DataFrame, name: str, replacement: Column) -> Column:
    """The existing column, or ``replacement`` if it is NULL in every row of ``df``."""
    filled = df.agg(F.count(name)).scalar()
    return F.when(filled > 0, F.col(name)).otherwise(replacement)


def add_item_total(items: DataFrame) -> DataFrame:
    if "total_price" in items.columns:
        return items
    quantity, price, discount = F.col("quantity"), F.col("list_price"), F.col("discount")
    return items.withColumn("total_price", quantity * price * (1 - discount))


def line_measures(items: DataFrame) -> DataFrame:
    """One row per order: total, number of lines, units. Hot orders combine map-side."""
    return items.groupBy("order_id").agg(
        exact_sum(F.col("total_price")).alias("order_total"),
        F.count("*").alias("line_count"),
        F.sum(F.col("quantity").cast("bigint")).alias("unit_count"),
    )


def add_order_total(
    orders: DataFrame, items: DataFrame, keep_line_counts: bool = False
) -> DataFrame:
    """Add ``order_total``, the sum over the order's lines, 0 without lines.

    An existing ``order_total`` stays, unless it holds NULLs only.
    ``keep_line_counts`` also stores ``line_count`` and ``unit_count``, which spare
    the line-grain reports their join with the items.
    """
    measures = line_measures(items).withColumnRenamed("order_total", "_total")
    if not keep_line_counts:
        measures = measures.select("order_id", "_total")
    joined = orders.join(measures, "order_id", "left")
    total = F.col("_total").cast("double")
    if "order_total" in orders.columns:
        total = _keep_unless_empty(orders, "order_total", total)
    columns = {"order_total": F.coalesce(total, F.lit(0.0))}
    if keep_line_counts:
        columns |= {c: F.coalesce(c, F.lit(0)) for c in ("line_count", "unit_count")}
    return joined.withColumns(columns).drop("_total")


def summary(items: DataFrame, orders: DataFrame) -> DataFrame:
    """One row: total revenue over the items, mean order value over all orders."""
    nothing = F.lit(None).cast("double")
    parts = items.agg(
        exact_sum(F.col("total_price")).cast("double").alias("total_revenue"),
        nothing.alias("avg_order_value"),
    ).unionAll(
        orders.agg(
            nothing.alias("total_revenue"),
            ratio(F.sum(money(F.col("order_total"))), F.count("order_total")).alias(
                "avg_order_value"
            ),
        )
    )
    return parts.agg(
        F.max("total_revenue").alias("total_revenue"),
        F.max("avg_order_value").alias("avg_order_value"),
    )


def enrich_all(
    tables: dict[str, DataFrame],
    needed: dict[str, bool] | None = None,
    keep_line_counts: bool = False,
) -> dict[str, DataFrame]:
    """Products, then item totals, then order totals; ``needed`` may switch each off."""
    needed = needed or {}
    out = dict(tables)
    if needed.get("enrich_products", True):
        out["products"] = enrich_products(out["products"], out["brands"], out["categories"])
    if needed.get("calculate_item_total", True):
        out["order_items"] = add_item_total(out["order_items"])
    if needed.get("calculate_order_total", True):
        out["orders"] = add_order_total(out["orders"], out["order_items"], keep_line_counts)
    return out
