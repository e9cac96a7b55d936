"""The nine retail tables as views over a TPC-H-like star schema.

Every view is a projection or an aggregate of the source tables. Stores are nations:
an order's is that of its customer, a stock's that of the line's supplier.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from retailspark.functions.numbers import money

# Suppliers are customers as well, under keys that no order has.
SUPPLIER_KEYS = 1_000_000_000_000


# The source columns, stated so that planning needs no footer read.
SOURCES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def source(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SOURCES[name]).parquet(f"{folder}/{name}.parquet")


def category_id(name: Column) -> Column:
    """A category number that depends on the name alone, so no numbering pass is needed."""
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 7), 16, 10).cast("bigint")


def brand_id(name: Column) -> Column:
    return F.substring(name, 7, 10).cast("bigint")


def brands(spark, folder):
    names = source(spark, folder, "part").select(F.col("p_brand").alias("brand_name")).distinct()
    return names.select(brand_id(F.col("brand_name")).alias("brand_id"), "brand_name")


def categories(spark, folder):
    names = source(spark, folder, "part").select(F.col("p_type").alias("category_name")).distinct()
    return names.select(category_id(F.col("category_name")).alias("category_id"), "category_name")


def products(spark, folder):
    return source(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        brand_id(F.col("p_brand")).alias("brand_id"),
        category_id(F.col("p_type")).alias("category_id"),
        F.col("p_retailprice").alias("list_price"),
        F.col("p_brand").alias("brand_name"),
        F.col("p_type").alias("category_name"),
    )


def _places(spark, folder):
    nation = source(spark, folder, "nation")
    region = source(spark, folder, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("bigint").alias("place_id"),
        F.col("n_name").alias("nation_name"),
        F.col("r_name").alias("region_name"),
    )


def stores(spark, folder):
    return _places(spark, folder).select(
        F.col("place_id").alias("store_id"),
        F.col("nation_name").alias("store_name"),
        F.col("region_name").alias("city"),
        F.substring("region_name", 1, 2).alias("state"),
    )


def staffs(spark, folder):
    return source(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("staff_id"),
        F.lit("Staff").alias("first_name"),
        F.col("s_name").alias("last_name"),
        F.concat(F.lower("s_name"), F.lit("@example.com")).alias("email"),
        (F.col("s_acctbal") > 0).cast("bigint").alias("active"),
        F.col("s_nationkey").cast("bigint").alias("store_id"),
    )


def customers(spark, folder):
    places = _places(spark, folder)
    customer = source(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey")
    supplier = source(spark, folder, "supplier").select(F.col("s_suppkey") + SUPPLIER_KEYS, "s_name", "s_nationkey")
    customer = customer.unionAll(supplier)
    return customer.join(places, customer.c_nationkey == places.place_id).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("full_name"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        F.lpad(F.col("c_custkey").cast("string"), 10, "0").alias("phone"),
        F.col("nation_name").alias("city"),
        F.col("region_name").alias("state"),
        F.lpad((F.col("c_custkey") % 100000).cast("string"), 5, "0").alias("zip_code"),
    )


def order_items(spark, folder):
    return source(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").cast("bigint").alias("item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("list_price"),
        F.col("l_discount").alias("discount"),
        money(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("total_price"),
    )


def with_store(orders: DataFrame, spark, folder) -> DataFrame:
    """``orders`` with the store_id of their customers; Spark splits a hot customer's partition.

    Grouped, customers are known to be unique, so the join is left out where nobody asks for the store.
    """
    places = source(spark, folder, "customer").groupBy(F.col("c_custkey").alias("o_custkey")).agg(
        F.min(F.col("c_nationkey").cast("bigint")).alias("store_id")
    )
    return orders.join(places, "o_custkey", "left")


def plain_orders(spark, folder):
    """Orders as they come in: no totals, no staff. The customer's nation is the store."""
    status = F.col("o_orderstatus")
    return with_store(source(spark, folder, "orders"), spark, folder).select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(status == "O", 1).when(status == "P", 2).when(status == "F", 4)
        .cast("bigint").alias("order_status"),
        F.col("o_orderdate").alias("order_date"),
        "store_id",
    )


def orders(spark, folder):
    """Orders with the measures of their lines, taken in one pass over the lines.

    ``line_count`` and ``unit_count`` let line-grain reports stay on order rows.
    """
    lines = source(spark, folder, "lineitem")
    per_order = lines.groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.min("l_suppkey").alias("staff_id"),
        F.sum(money(F.col("l_extendedprice") * (1 - F.col("l_discount")))).alias("total"),
        F.count("*").alias("line_count"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("unit_count"),
    )
    joined = plain_orders(spark, folder).join(per_order, "order_id", "left")
    return joined.select(
        "order_id",
        "customer_id",
        "order_status",
        "order_date",
        "store_id",
        "staff_id",
        F.coalesce("total", F.lit(0)).cast("decimal(38,8)").alias("order_total"),
        F.coalesce("line_count", F.lit(0)).alias("line_count"),
        F.coalesce("unit_count", F.lit(0)).alias("unit_count"),
    )


def stocks(spark, folder):
    """The units of all lines stand in for stock, in the supplier's nation; summed up before suppliers are looked up."""
    supplied = source(spark, folder, "lineitem").groupBy("l_suppkey", F.col("l_partkey").alias("product_id")).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("units")
    )
    supplier = source(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").cast("bigint").alias("store_id")
    )
    placed = supplied.join(supplier, "l_suppkey", "left")
    return placed.groupBy("store_id", "product_id").agg(F.sum("units").alias("quantity"))


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


class Views(dict):
    """Views by table name, each built when first asked for.

    A report touches two or three of the nine tables; the others would cost a
    footer read each just to be planned.
    """

    def __init__(self, spark: SparkSession, folder: str, views: Mapping[str, Callable]):
        super().__init__()
        self._make = lambda name: views[name](spark, folder)

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self._make(name)
        return self[name]


def retail_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return Views(spark, folder, VIEWS)
