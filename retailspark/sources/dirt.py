"""Untidy variants of the nine retail tables, spoiled by key arithmetic.

They stand in for raw files: every column is text, in the raw column set, with
missing values, repeated rows, bad numbers and bad dates at known keys. Repeated
rows come from one scan (explode of a short array), not from a second read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from retailspark.sources.starschema import (
    with_store,
    Views,
    brand_id,
    category_id,
    source,
    stocks as clean_stocks,
)


def _text(c: Column) -> Column:
    return c.cast("string")


def _repeated(df: DataFrame, condition: Column) -> DataFrame:
    """Rows meeting ``condition`` twice, the others once."""
    copies = F.when(condition, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.withColumn("_copy", F.explode(copies)).drop("_copy")


def _plain(c: Column, scale: int) -> Column:
    """A number as text without exponent, the same in every engine."""
    return _text(c.cast(f"decimal(18,{scale})"))


def brands(spark, folder):
    names = source(spark, folder, "part").select("p_brand").distinct()
    key = brand_id(F.col("p_brand"))
    return _repeated(
        names.select(
            _text(key).alias("brand_id"),
            F.when(key % 5 != 0, F.col("p_brand")).alias("brand_name"),
        ),
        F.col("brand_id") == "7",
    )


def categories(spark, folder):
    names = source(spark, folder, "part").select("p_type").distinct()
    key = category_id(F.col("p_type"))
    return _repeated(
        names.select(
            _text(key).alias("category_id"),
            F.when(key % 5 != 0, F.col("p_type")).alias("category_name"),
        ),
        F.col("category_id").cast("bigint") % 2 == 0,
    )


def products(spark, folder):
    key = F.col("p_partkey")
    part = _repeated(source(spark, folder, "part"), key % 150 == 0)
    price = F.when(key % 25 == 0, -F.col("p_retailprice")).otherwise(F.col("p_retailprice"))
    return part.select(
        _text(key).alias("product_id"),
        F.when(key % 90 != 0, F.col("p_name")).alias("product_name"),
        _text(brand_id(F.col("p_brand"))).alias("brand_id"),
        _text(category_id(F.col("p_type"))).alias("category_id"),
        F.when(key % 8 != 0, _text(2010 + key % 10)).alias("model_year"),
        _plain(price, 2).alias("list_price"),
    )


def customers(spark, folder):
    key = F.col("c_custkey")
    customer = _repeated(source(spark, folder, "customer"), key % 50 == 0)
    phone = (
        F.when(key % 4 == 1, "(555) 010-0001, 555-010-0002")
        .when(key % 4 == 2, "555.010.0003")
        .when(key % 4 == 3, "5550100004")
    )
    return customer.select(
        _text(key).alias("customer_id"),
        F.col("c_name").alias("first_name"),
        F.when(key % 11 != 0, F.col("c_mktsegment")).alias("last_name"),
        phone.alias("phone"),
        F.when(key % 7 != 0, F.concat(F.lower("c_name"), F.lit("@example.com"))).alias("email"),
        F.when(key % 13 != 0, F.concat(_text(key % 900), F.lit(" Main St"))).alias("street"),
        F.when(key % 17 != 0, F.concat(F.lit("City "), _text(F.col("c_nationkey")))).alias("city"),
        F.when(key % 19 != 0, F.concat(F.lit("S"), _text(F.col("c_nationkey") % 5))).alias("state"),
        F.when(key % 9 != 0, F.lpad(_text(key % 100000), 5, "0")).alias("zip_code"),
    )


def orders(spark, folder):
    key, day = F.col("o_orderkey"), F.col("o_orderdate")
    iso = F.date_format(day, "yyyy-MM-dd")
    month_day = F.date_format(day, "-MM-dd")
    placed = (
        F.when(key % 97 == 0, "not a date")
        .when(key % 101 == 0, F.lit(None))
        .when(key % 50 == 0, F.concat(F.lit("1016"), month_day))
        .when(key % 53 == 0, F.concat(F.lit("1800"), month_day))
        .when(key % 10 == 3, F.date_format(day, "M/d/yyyy"))
        .when(key % 10 == 7, F.date_format(day, "yyyy/MM/dd"))
        .when(key % 10 == 9, F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
        .when((key % 10 == 1) & (F.dayofmonth(day) > 12), F.date_format(day, "dd/MM/yyyy"))
        .when(key % 10 == 2, F.date_format(day, "yyyyMMdd"))
        .when(key % 10 == 4, F.date_format(day, "MMM d, yyyy"))
        .when(key % 10 == 5, F.date_format(day, "dd-MMM-yyyy"))
        .when(key % 10 == 6, F.date_format(day, "MM-dd-yyyy"))
        .when(key % 10 == 8, F.date_format(day, "M/d/yy"))
        .otherwise(iso)
    )
    due = F.when(key % 20 == 0, F.date_sub(day, 3)).otherwise(F.date_add(day, 7))
    status = F.col("o_orderstatus")
    spoiled = with_store(source(spark, folder, "orders"), spark, folder).select(
        _text(key).alias("order_id"),
        _text(F.col("o_custkey")).alias("customer_id"),
        F.when(status == "O", "1").when(status == "P", "2").when(status == "F", "4")
        .alias("order_status"),
        placed.alias("order_date"),
        F.date_format(due, "yyyy-MM-dd").alias("required_date"),
        F.when(status != "O", F.date_format(F.date_add(day, 2), "yyyy-MM-dd"))
        .alias("shipped_date"),
        _text(F.col("store_id")).alias("store_id"),
        _text(key % 100).alias("staff_id"),
    )
    return _repeated(spoiled, F.col("order_id").cast("bigint") % 500 == 0)


def order_items(spark, folder):
    order, part, line = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    item = (
        F.when(order % 40 == 0, "x")
        .when(order % 41 == 0, F.concat(_text(line), F.lit(".0")))
        .otherwise(_text(line))
    )
    quantity = (
        F.when(part % 33 == 0, "-1")
        .when(part % 35 == 0, "0")
        .when(part % 37 == 0, F.concat(_text(F.col("l_quantity").cast("bigint")), F.lit("E+000")))
        .otherwise(_text(F.col("l_quantity").cast("bigint")))
    )
    discount = F.when(part % 60 == 0, "1.5").otherwise(_plain(F.col("l_discount"), 2))
    lines = _repeated(source(spark, folder, "lineitem"), order % 200 == 1)
    return lines.select(
        _text(order).alias("order_id"),
        item.alias("item_id"),
        _text(part).alias("product_id"),
        quantity.alias("quantity"),
        _plain(F.col("l_extendedprice") / F.col("l_quantity"), 8).alias("list_price"),
        discount.alias("discount"),
    )


def staffs(spark, folder):
    key = F.col("s_suppkey")
    supplier = _repeated(source(spark, folder, "supplier"), key % 40 == 0)
    return supplier.select(
        _text(key).alias("staff_id"),
        F.lit("Staff").alias("first_name"),
        F.when(key % 14 != 0, F.col("s_name")).alias("last_name"),
        F.when(key % 6 != 0, F.concat(F.lower("s_name"), F.lit("@example.com"))).alias("email"),
        F.when(key % 5 != 0, F.concat(F.lit("+1 555-"), F.lpad(_text(key), 4, "0"))).alias("phone"),
        F.when(key % 17 == 0, "inf")
        .otherwise(_text((F.col("s_acctbal") > 0).cast("int"))).alias("active"),
        F.when(key % 10 != 0, _text(F.col("s_nationkey"))).alias("store_id"),
        F.when(key % 3 != 0, _text(key % 4)).alias("manager_id"),
    )


def stores(spark, folder):
    key, name = F.col("n_nationkey"), F.col("n_name")
    nation = _repeated(source(spark, folder, "nation"), key == 11)
    return nation.select(
        _text(key).alias("store_id"),
        F.when(key % 5 != 0, name).alias("store_name"),
        F.concat(F.lit("(555) 020-00"), F.lpad(_text(key), 2, "0")).alias("phone"),
        F.when(key % 5 != 0, F.concat(F.lower(name), F.lit("@example.com"))).alias("email"),
        F.concat(_text(key), F.lit(" High St")).alias("street"),
        F.concat(F.lit("City "), _text(key)).alias("city"),
        F.concat(F.lit("S"), _text(F.col("n_regionkey"))).alias("state"),
        F.when(key % 5 != 0, F.lpad(_text(key), 5, "0")).alias("zip_code"),
    )


def stocks(spark, folder):
    product = F.col("product_id")
    quantity = (
        F.when(product % 7 == 0, F.lit(None))
        .when(product % 13 == 0, "-1")
        .otherwise(_text(F.col("quantity")))
    )
    return clean_stocks(spark, folder).select(
        _text(F.col("store_id")).alias("store_id"),
        _text(product).alias("product_id"),
        quantity.alias("quantity"),
    )


VIEWS = {
    "brands": brands,
    "categories": categories,
    "stores": stores,
    "staffs": staffs,
    "products": products,
    "customers": customers,
    "orders": orders,
    "order_items": order_items,
    "stocks": stocks,
}


def dirty_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return Views(spark, folder, VIEWS)


def misnamed_orders(spark, folder):
    """Orders whose column names break the naming standard."""
    df = orders(spark, folder)
    return df.withColumnsRenamed(
        {"order_id": "Order ID", "order_date": "OrderDate", "customer_id": "customer id"}
    )


def orphaned_items(spark, folder):
    """Line items, some of which name products that do not exist."""
    items = source(spark, folder, "lineitem")
    part = F.col("l_partkey")
    return items.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").cast("bigint").alias("item_id"),
        F.when(part % 70 == 0, part + 1000000).otherwise(part).alias("product_id"),
    )


def tokenised_customers(spark, folder):
    """Customers with every kind of missing-value token in the text columns."""
    from retailspark.schemas import NA_TOKENS

    key = F.col("c_custkey")
    tokens = F.array(*[F.lit(t) for t in NA_TOKENS])
    token = F.element_at(tokens, (key % len(NA_TOKENS) + 1).cast("int"))
    return source(spark, folder, "customer").select(
        _text(key).alias("customer_id"),
        F.when(key % 3 == 0, token).otherwise(F.col("c_name")).alias("full_name"),
        F.when(key % 4 == 0, token).otherwise(F.col("c_mktsegment")).alias("segment"),
    )
