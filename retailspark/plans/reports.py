"""The analytic queries, as functions of a dict of retail tables.

Names with ``_full`` carry the wider column set of the hand-run script, the plain
ones that of the report run. Facts are aggregated to the join key before every join
with a dimension, so no join sees more than one row per key and hot keys combine
map-side. Orders, products and customers are counted by distinct key where the SQL
counts distinct keys, so a repeated key does no harm.

``*_linegrain`` queries and ``monthly`` count an order's total once per line of the
order: this is what their SQL says, and it inflates revenue. They are computed at
order grain as ``order_total * line_count`` without joining the lines.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, Window, functions as F

from retailspark.functions.numbers import exact_sum, ratio
from retailspark.operators.enrich import line_measures
from retailspark.operators.joins import lookup
from retailspark.schemas import CUSTOMER_TYPES, SEGMENT_NAMES, STATUS_NAMES
from retailspark.session import together

Tables = dict[str, DataFrame]

LOW_STOCK_BELOW = 10
SEGMENT_BOUNDS = (500, 2000)


def _double(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def _units(c: str = "quantity") -> Column:
    return F.sum(F.col(c).cast("bigint"))


def _grouping(name: str, ignore_case: bool) -> Column:
    """A name used as grouping key; binary comparison unless told otherwise."""
    return F.collate(F.col(name), "UTF8_LCASE") if ignore_case else F.col(name)


# ------------------------------------------------- sums that reports share


def with_sums(t: Tables, folder: str) -> Tables:
    """The tables, and beside them the sums several reports start from, stored in ``folder`` so that facts are summed once.

    A sum that fails is left out, for each of its reports to fail by itself.
    """
    def stored(name: str, build) -> DataFrame | None:
        path = f"{folder}/{name}"
        try:
            df = build(t)
            df.write.mode("overwrite").parquet(path)
            return df.sparkSession.read.schema(df.schema).parquet(path)
        except Exception:  # the reports meet it again, and it goes to their log
            return None

    found = together(partial(stored, name, build) for name, build in SUMS.items())
    return {**t, **{name: df for name, df in zip(SUMS, found) if df is not None}}


def _sums(t: Tables, name: str) -> DataFrame:
    return t[name] if name in t else SUMS[name](t)


# ---------------------------------------------------------------- products


def _sales_by_product(t: Tables, with_orders: bool) -> DataFrame:
    measures = [
        _units().alias("units"),
        exact_sum(F.col("total_price")).alias("revenue"),
        F.count("total_price").alias("priced_lines"),
        F.sum(F.col("list_price").cast("decimal(24,8)")).alias("price_sum"),
        F.count("list_price").alias("listed_lines"),
    ]
    if with_orders:
        measures.append(F.count_distinct("order_id").alias("orders"))
    return t["order_items"].groupBy("product_id").agg(*measures)


def _top_products(t: Tables, top_n: int, with_orders: bool) -> DataFrame:
    names = t["products"].select("product_id", "product_name", "brand_name", "category_name")
    sales = _sales_by_product(t, True) if with_orders else _sums(t, "sales_by_product")
    joined = sales.join(names, "product_id")
    columns = [
        "product_id",
        "product_name",
        "brand_name",
        "category_name",
        F.col("units").alias("total_quantity_sold"),
        _double("revenue").alias("total_revenue"),
        ratio(F.col("price_sum"), F.col("listed_lines")).alias("avg_selling_price"),
    ]
    if with_orders:
        columns.append(F.col("orders").alias("number_of_orders"))
    return (
        joined.select(*columns)
        .orderBy(F.desc("total_quantity_sold"), "product_id")
        .limit(top_n)
    )


def top_products(t: Tables, top_n: int = 10) -> DataFrame:
    return _top_products(t, top_n, with_orders=False)


def top_products_full(t: Tables, top_n: int = 10) -> DataFrame:
    return _top_products(t, top_n, with_orders=True)


def _product_group(t: Tables, dim: str, key: str, name: str, full: bool, ignore_case: bool):
    """Sales by brand or category. ``full`` groups by key and name, else by name only."""
    labels = t[dim].select(
        key, _grouping(name, ignore_case and not full).alias(name)
    )
    members = t["products"].select("product_id", key)
    # From one row per product to one row per key before the names come in.
    sales = (
        _sums(t, "sales_by_product")
        .join(members, "product_id")
        .groupBy(key)
        .agg(
            F.count_distinct("product_id").alias("number_of_products"),
            F.sum("units").alias("total_quantity_sold"),
            F.sum("revenue").alias("revenue"),
            F.sum("priced_lines").alias("priced_lines"),
        )
        .join(labels, key)
    )
    if not full:
        return (
            sales.groupBy(name)
            .agg(
                F.sum("number_of_products").alias("number_of_products"),
                F.sum("total_quantity_sold").alias("total_quantity_sold"),
                _double(F.sum("revenue")).alias("total_revenue"),
            )
            .orderBy(F.desc("total_revenue"), name)
        )
    # Distinct orders need the lines themselves: a lookup at fact grain.
    pairs = t["order_items"].select("product_id", "order_id")
    reach = (
        lookup(pairs, members, "product_id", F.col("order_id"))
        .groupBy(key)
        .agg(F.count_distinct("order_id").alias("total_orders"))
    )
    return (
        sales.join(reach, key)
        .select(
            key,
            name,
            "number_of_products",
            "total_quantity_sold",
            _double("revenue").alias("total_revenue"),
            ratio(F.col("revenue"), F.col("priced_lines")).alias("avg_transaction_value"),
            "total_orders",
        )
        .orderBy(F.desc("total_revenue"), key)
    )


def category(t: Tables, ignore_case: bool = False) -> DataFrame:
    return _product_group(t, "categories", "category_id", "category_name", False, ignore_case)


def category_full(t: Tables) -> DataFrame:
    return _product_group(t, "categories", "category_id", "category_name", True, False)


def brand(t: Tables, ignore_case: bool = False) -> DataFrame:
    return _product_group(t, "brands", "brand_id", "brand_name", False, ignore_case)


def brand_full(t: Tables) -> DataFrame:
    return _product_group(t, "brands", "brand_id", "brand_name", True, False)


# ------------------------------------------------------------------ orders


def _order_grain(t: Tables) -> DataFrame:
    """Orders with ``line_count`` and ``unit_count``; those with no line are left out."""
    orders = t["orders"]
    if not {"line_count", "unit_count"} <= set(orders.columns):
        per_order = line_measures(t["order_items"]).drop("order_total")
        return orders.join(per_order, "order_id")
    return orders.filter(F.col("line_count") > 0)


def _line_grain_measures() -> dict[str, Column]:
    """What a join with the lines would sum: the order total once per line."""
    total = F.col("order_total").cast("decimal(27,8)")
    lines = F.col("line_count").cast("decimal(10,0)")
    return {
        "orders": F.count_distinct("order_id"),
        "revenue": F.sum(total * lines),
        "lines": F.sum(F.when(F.col("order_total").isNotNull(), F.col("line_count"))),
        "units": F.sum("unit_count"),
    }


def _order_grain_measures() -> dict[str, Column]:
    return {
        "orders": F.count_distinct("order_id"),
        "revenue": F.sum(F.col("order_total").cast("decimal(28,8)")),
        "totals": F.count("order_total"),
    }


def _measures(picked: dict[str, Column]) -> list[Column]:
    return [c.alias(name) for name, c in picked.items()]


def store_revenue_linegrain(t: Tables) -> DataFrame:
    by_store = _order_grain(t).groupBy("store_id").agg(*_measures(_line_grain_measures()))
    stores = t["stores"].select("store_id", "store_name", "city", "state")
    return (
        by_store.join(stores, "store_id")
        .select(
            "store_id",
            "store_name",
            "city",
            "state",
            F.col("orders").alias("total_orders"),
            _double("revenue").alias("total_revenue"),
            ratio(F.col("revenue"), F.col("lines")).alias("avg_order_value"),
            F.col("units").alias("total_items_sold"),
        )
        .orderBy(F.desc("total_revenue"), "store_id")
    )


def store_revenue(t: Tables) -> DataFrame:
    by_store = t["orders"].groupBy("store_id").agg(*_measures(_order_grain_measures()))
    stores = t["stores"].select("store_id", "store_name", "city")
    return (
        by_store.join(stores, "store_id")
        .select(
            "store_id",
            "store_name",
            "city",
            F.col("orders").alias("total_orders"),
            _double("revenue").alias("total_revenue"),
            ratio(F.col("revenue"), F.col("totals")).alias("avg_order_value"),
        )
        .orderBy(F.desc("total_revenue"), "store_id")
    )


def _by_month(orders: DataFrame, measures: list[Column]) -> DataFrame:
    day = F.col("order_date")
    return (
        orders.filter(day.isNotNull())
        .groupBy(F.year(day).alias("order_year"), F.month(day).alias("order_month"))
        .agg(*measures)
        .withColumn(
            "month_name",
            F.date_format(F.make_date("order_year", "order_month", F.lit(1)), "MMMM"),
        )
    )


def monthly_linegrain(t: Tables) -> DataFrame:
    """Distinct orders and distinct customers are both asked for, which Spark would answer with three copies of each row.
    Instead rows are summed by order and customer, and one row of each order is marked, so customers alone are left to be
    made distinct. Orders without an id are marked by nobody, and spread by customer.
    """
    day, measures = F.col("order_date"), _line_grain_measures()
    month = [F.year(day).alias("order_year"), F.month(day).alias("order_month")]
    sums = [measures[name].alias(name) for name in ("revenue", "lines", "units")]
    pairs = _order_grain(t).filter(day.isNotNull()).groupBy(*month, "order_id", "customer_id").agg(*sums)
    spread = F.when(F.col("order_id").isNull(), F.col("customer_id"))
    of_order = Window.partitionBy("order_year", "order_month", "order_id", spread).orderBy("customer_id")
    first = F.col("order_id").isNotNull() & (F.row_number().over(of_order) == 1)
    return (
        pairs.withColumn("first", first.cast("bigint"))
        .groupBy("order_year", "order_month")
        .agg(
            F.sum("first").alias("orders"), *[F.sum(name).alias(name) for name in ("revenue", "lines", "units")],
            F.count_distinct("customer_id").alias("unique_customers"),
        )
        .select(
            "order_year",
            "order_month",
            F.date_format(F.make_date("order_year", "order_month", F.lit(1)), "MMMM").alias("month_name"),
            F.col("orders").alias("total_orders"),
            _double("revenue").alias("total_revenue"),
            ratio(F.col("revenue"), F.col("lines")).alias("avg_order_value"),
            F.col("units").alias("total_items_sold"),
            "unique_customers",
        )
        .orderBy(F.desc("order_year"), F.desc("order_month"))
    )


def monthly(t: Tables) -> DataFrame:
    """Line-grain like its SQL: see the note at the top and ``monthly_ordergrain``."""
    return (
        _by_month(_order_grain(t), _measures(_line_grain_measures()))
        .select(
            "order_year",
            "order_month",
            "month_name",
            F.col("orders").alias("total_orders"),
            _double("revenue").alias("total_revenue"),
            F.col("units").alias("total_items_sold"),
        )
        .orderBy("order_year", "order_month")
    )


def monthly_ordergrain(t: Tables) -> DataFrame:
    """The true monthly revenue: each order's total counted once."""
    measures = _measures(_order_grain_measures()) + [F.sum("unit_count").alias("units")]
    return (
        _by_month(_order_grain(t), measures)
        .select(
            "order_year",
            "order_month",
            "month_name",
            F.col("orders").alias("total_orders"),
            _double("revenue").alias("total_revenue"),
            F.col("units").alias("total_items_sold"),
        )
        .orderBy("order_year", "order_month")
    )


def _status_name(otherwise: str | None) -> Column:
    name = F.lit(None).cast("string") if otherwise is None else F.lit(otherwise)
    for code, label in STATUS_NAMES.items():
        name = F.when(F.col("order_status") == code, label).otherwise(name)
    return name


def _share_of_rows(n: str) -> Column:
    """Percentage of ``n`` in the sum over all grouped rows, as DECIMAL(5,2)."""
    # The window has no partition but spans grouped rows only, one per status.
    whole = F.sum(n).over(Window.partitionBy())
    return (F.col(n) * F.lit(100.0) / whole).cast("decimal(5,2)").cast("double")


def _statuses(t: Tables) -> DataFrame:
    rows = {**_order_grain_measures(), "orders": F.count("*")}  # rows are counted here, not keys
    return t["orders"].groupBy("order_status").agg(*_measures(rows))


def status(t: Tables) -> DataFrame:
    """Status names have no fallback here: other codes get a NULL name."""
    return (
        _statuses(t)
        .select(
            "order_status",
            _status_name(None).alias("status_name"),
            F.col("orders").alias("order_count"),
            _double("revenue").alias("total_revenue"),
            _share_of_rows("orders").alias("percentage"),
        )
        .orderBy("order_status")
    )


def status_full(t: Tables) -> DataFrame:
    return (
        _statuses(t)
        .select(
            "order_status",
            _status_name("Unknown").alias("status_name"),
            F.col("orders").alias("order_count"),
            _double("revenue").alias("total_revenue"),
            ratio(F.col("revenue"), F.col("totals")).alias("avg_order_value"),
            _share_of_rows("orders").alias("percentage_of_total"),
        )
        .orderBy("order_status")
    )


# --------------------------------------------------------------- inventory


def _stock_totals(t: Tables) -> DataFrame:
    return t["stocks"].groupBy("product_id").agg(
        _units().alias("units"), F.count("store_id").alias("stores")
    )


def _low_stock(t: Tables, below: int) -> DataFrame:
    columns = ["product_id", "product_name", "brand_name", "category_name", "list_price"]
    joined = t["products"].select(*columns).join(_stock_totals(t), "product_id", "left")
    return joined.filter((F.col("units") < below) | F.col("units").isNull())


def low_stock(t: Tables, low_stock_below: int = LOW_STOCK_BELOW) -> DataFrame:
    return (
        _low_stock(t, low_stock_below)
        .drop("stores")
        .withColumnRenamed("units", "total_stock")
        .orderBy(F.asc_nulls_first("total_stock"), "product_id")
    )


def low_stock_detail(t: Tables, low_stock_below: int = LOW_STOCK_BELOW) -> DataFrame:
    """Low stock with the stock of each store as text, stores in name order.

    Only stock rows of products found low are looked up and listed.
    """
    low = _low_stock(t, low_stock_below)
    stores = t["stores"].select("store_id", "store_name")
    rows = t["stocks"].join(low.select("product_id"), "product_id", "left_semi")
    held = (
        lookup(rows, stores, "store_id", F.col("product_id"), "left")
        .groupBy("product_id")
        .agg(
            F.expr(
                "listagg(concat(coalesce(store_name, ''), ': ', coalesce(cast(quantity as string),"
                " '')), ', ') within group (order by store_name, quantity)"
            ).alias("stock_by_store")
        )
    )
    return (
        low.join(held, "product_id", "left")
        .select(
            "product_id",
            "product_name",
            "brand_name",
            "category_name",
            "list_price",
            F.col("units").alias("total_stock_across_stores"),
            F.coalesce("stores", F.lit(0)).alias("number_of_stores_stocking"),
            # A product without any stock row reads ': ', an empty name and quantity.
            F.coalesce("stock_by_store", F.lit(": ")).alias("stock_by_store"),
        )
        .orderBy(F.asc_nulls_first("total_stock_across_stores"), "product_id")
    )


def _priced_stocks(t: Tables) -> DataFrame:
    prices = t["products"].select("product_id", F.col("list_price").cast("decimal(24,8)").alias("_price"))
    return lookup(t["stocks"], prices, "product_id", F.col("store_id"))


def _stock_measures(rows: DataFrame, group: list[str], products: Column) -> DataFrame:
    quantity = F.col("quantity").cast("bigint")
    return rows.groupBy(*group).agg(
        products.alias("products"),
        F.sum(quantity).alias("units"),
        F.count("quantity").alias("counted"),
        F.sum(quantity.cast("decimal(12,0)") * F.col("_price")).alias("value"),
    )


def store_inventory(t: Tables) -> DataFrame:
    """Grouped by store name and city, so stores that share both count as one."""
    stores = t["stores"].select("store_id", "store_name", "city")
    placed = lookup(_priced_stocks(t), stores, "store_id", F.col("product_id"))
    return (
        _stock_measures(placed, ["store_name", "city"], F.count_distinct("product_id"))
        .select(
            "store_name",
            "city",
            F.col("products").alias("unique_products"),
            F.col("units").alias("total_inventory_units"),
            _double("value").alias("total_inventory_value"),
        )
        .orderBy(F.desc("total_inventory_units"), "store_name", "city")
    )


def store_inventory_full(t: Tables, integer_avg: bool = True) -> DataFrame:
    """``integer_avg`` truncates the mean of the INT quantity, as the source SQL does."""
    mean = (
        F.expr("units div counted") if integer_avg else ratio(F.col("units"), F.col("counted"))
    )
    columns = ["store_name", "city", "state"]
    # One row of each product in a store is marked, which takes a sort that may spill; distinct products would take two
    # hash tables of all stock rows. Names come in when one row a store is left.
    of_product = Window.partitionBy("store_id", "product_id").orderBy("quantity")
    marked = _priced_stocks(t).withColumn("_first", (F.row_number().over(of_product) == 1).cast("bigint"))
    by_store = _stock_measures(marked, ["store_id"], F.sum("_first"))
    return (
        by_store.join(t["stores"].select("store_id", *columns), "store_id")
        .select(
            "store_id",
            *columns,
            F.col("products").alias("unique_products_stocked"),
            F.col("units").alias("total_inventory_units"),
            mean.alias("avg_stock_per_product"),
            _double("value").alias("total_inventory_value"),
        )
        .orderBy(F.desc("total_inventory_units"), "store_id")
    )


# ------------------------------------------------------------------- staff


def _active_staff(t: Tables) -> DataFrame:
    """Active staff with the name and city of their store, if any."""
    stores = t["stores"].select("store_id", "store_name", F.col("city").alias("store_city"))
    active = t["staffs"].filter(F.col("active") == 1).select(
        "staff_id",
        # NULL if either part is NULL.
        F.concat("first_name", F.lit(" "), "last_name").alias("staff_name"),
        "email",
        "store_id",
    )
    return lookup(active, stores, "store_id", F.col("staff_id"), "left")


def _orders_by_staff(t: Tables) -> DataFrame:
    return t["orders"].groupBy("staff_id").agg(*_measures(_order_grain_measures()))


def staff(t: Tables) -> DataFrame:
    return (
        _active_staff(t)
        .join(_sums(t, "orders_by_staff"), "staff_id", "left")
        .select(
            "staff_id",
            "staff_name",
            "store_name",
            F.coalesce("orders", F.lit(0)).alias("total_orders_handled"),
            _double("revenue").alias("total_sales_revenue"),
            ratio(F.col("revenue"), F.col("totals")).alias("avg_order_value"),
        )
        .orderBy(F.desc("total_orders_handled"), "staff_id")
    )


def staff_full(t: Tables) -> DataFrame:
    by_staff = t["orders"].groupBy("staff_id").agg(
        *_measures(_order_grain_measures()),
        F.count_distinct("customer_id").alias("customers"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )
    return (
        _active_staff(t)
        .join(by_staff, "staff_id", "left")
        .select(
            "staff_id",
            "staff_name",
            "email",
            "store_name",
            "store_city",
            F.coalesce("orders", F.lit(0)).alias("total_orders_handled"),
            _double("revenue").alias("total_sales_revenue"),
            ratio(F.col("revenue"), F.col("totals")).alias("avg_order_value"),
            F.coalesce("customers", F.lit(0)).alias("unique_customers_served"),
            "first_order_date",
            "last_order_date",
        )
        .orderBy(F.desc("total_orders_handled"), "staff_id")
    )


def best_staff(t: Tables, top_n: int = 1) -> DataFrame:
    return (
        _active_staff(t)
        .join(_sums(t, "orders_by_staff"), "staff_id")
        .select(
            "staff_id",
            "staff_name",
            "store_name",
            F.col("orders").alias("total_orders_handled"),
            _double("revenue").alias("total_sales_revenue"),
            ratio(F.col("revenue"), F.col("totals")).alias("avg_order_value"),
        )
        .orderBy(F.desc("total_sales_revenue"), "staff_id")
        .limit(top_n)
    )


def best_staff_linegrain(t: Tables, top_n: int = 1) -> DataFrame:
    by_staff = _order_grain(t).groupBy("staff_id").agg(
        *_measures(_line_grain_measures()),
        F.count_distinct("customer_id").alias("customers"),
        F.datediff(F.max("order_date"), F.min("order_date")).alias("days"),
    )
    return (
        _active_staff(t)
        .join(by_staff, "staff_id")
        .select(
            "staff_id",
            "staff_name",
            "email",
            "store_name",
            F.col("orders").alias("total_orders_handled"),
            _double("revenue").alias("total_sales_revenue"),
            ratio(F.col("revenue"), F.col("lines")).alias("avg_order_value"),
            F.col("units").alias("total_items_sold"),
            F.col("customers").alias("unique_customers_served"),
            ratio(F.col("revenue"), F.col("orders")).alias("revenue_per_order"),
            ratio(F.col("orders"), F.col("days")).alias("avg_orders_per_day"),
        )
        .orderBy(F.desc("total_sales_revenue"), "staff_id")
        .limit(top_n)
    )


# --------------------------------------------------------------- customers


def _orders_by_customer(t: Tables) -> DataFrame:
    return t["orders"].groupBy("customer_id").agg(
        *_measures(_order_grain_measures()),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )


def _top_customers(t: Tables, top_n: int, columns: list[str], last_date: bool) -> DataFrame:
    measures = [
        F.col("orders").alias("total_orders"),
        _double("revenue").alias("total_spent"),
        ratio(F.col("revenue"), F.col("totals")).alias("avg_order_value"),
    ]
    if last_date:
        measures.append(F.col("last_order_date"))
    return (
        t["customers"]
        .select(*columns)
        .join(_sums(t, "orders_by_customer"), "customer_id")
        .select(*columns, *measures)
        .orderBy(F.desc("total_spent"), "customer_id")
        .limit(top_n)
    )


def top_customers(t: Tables, top_n: int = 5) -> DataFrame:
    return _top_customers(t, top_n, ["customer_id", "full_name", "city", "state"], False)


def top_customers_full(t: Tables, top_n: int = 5) -> DataFrame:
    columns = ["customer_id", "full_name", "email", "city", "state"]
    return _top_customers(t, top_n, columns, True)


def _without_orders(t: Tables, columns: list[str]) -> DataFrame:
    buyers = t["orders"].select("customer_id").distinct()
    return (
        t["customers"].join(buyers, "customer_id", "left_anti").select(*columns)
        .orderBy("customer_id")
    )


def customers_no_orders(t: Tables) -> DataFrame:
    return _without_orders(t, ["customer_id", "full_name", "email", "city", "state"])


def customers_no_orders_full(t: Tables) -> DataFrame:
    return _without_orders(
        t, ["customer_id", "full_name", "email", "phone", "city", "state", "zip_code"]
    )


def _segment(bounds: tuple[float, float]) -> Column:
    (low, high), (none, lower, middle, upper) = bounds, SEGMENT_NAMES
    return (
        F.when(F.col("total_orders") == 0, none)
        .when(F.col("revenue") < low, lower)
        .when(F.col("revenue").between(low, high), middle)
        .otherwise(upper)
    )


def _spending(t: Tables, bounds: tuple[float, float], columns: list[str], full: bool) -> DataFrame:
    zero = F.lit(0.0)
    joined = (
        t["customers"]
        .select(*columns)
        .join(_sums(t, "orders_by_customer"), "customer_id", "left")
        .withColumn("total_orders", F.coalesce("orders", F.lit(0)))
    )
    return joined.select(
        *columns,
        "total_orders",
        F.coalesce(_double("revenue"), zero).alias("total_spent"),
        F.coalesce(ratio(F.col("revenue"), F.col("totals")), zero).alias("avg_order_value"),
        *(["first_order_date", "last_order_date"] if full else []),
        _segment(bounds).alias("customer_segment"),
    ).orderBy(F.desc("total_spent"), "customer_id")


def customer_spending(
    t: Tables, segment_bounds: tuple[float, float] = SEGMENT_BOUNDS
) -> DataFrame:
    return _spending(t, segment_bounds, ["customer_id", "full_name", "city", "state"], False)


def customer_spending_full(
    t: Tables, segment_bounds: tuple[float, float] = SEGMENT_BOUNDS
) -> DataFrame:
    columns = ["customer_id", "full_name", "email", "city", "state"]
    return _spending(t, segment_bounds, columns, True)


def spend_overall(t: Tables) -> DataFrame:
    joined = t["customers"].select("customer_id").join(
        _orders_by_customer(t), "customer_id", "left"
    )
    single = joined.groupBy("customer_id").agg(
        F.sum("revenue").alias("revenue"), F.sum("totals").alias("totals"),
        F.max(F.col("orders").isNotNull()).alias("ordered"),
    )
    return single.agg(
        F.count("*").alias("total_customers"),
        F.count_if("ordered").alias("customers_with_orders"),
        F.count_if(~F.col("ordered")).alias("customers_without_orders"),
        F.sum("revenue").alias("revenue"),
        F.sum("totals").alias("totals"),
    ).select(
        "total_customers",
        "customers_with_orders",
        "customers_without_orders",
        _double("revenue").alias("total_revenue"),
        ratio(F.col("revenue"), F.col("totals")).alias("avg_order_value"),
        ratio(F.col("revenue"), F.col("customers_with_orders")).alias(
            "avg_spending_per_customer"
        ),
    )


def retention(t: Tables, integer_avg: bool = True) -> DataFrame:
    """Customers by number of orders: 1, 2 to 3, more."""
    kinds = F.create_map(*(F.lit(x) for pair in CUSTOMER_TYPES.items() for x in pair))
    kind = kinds[F.least(F.col("orders").cast("int"), F.lit(max(CUSTOMER_TYPES)))]
    per_customer = _orders_by_customer(t).join(
        t["customers"].select("customer_id"), "customer_id"
    )
    classes = per_customer.groupBy(kind.alias("customer_type")).agg(
        F.count("*").alias("number_of_customers"),
        F.sum("revenue").alias("revenue"),
        F.count("revenue").alias("spenders"),
        F.sum("orders").alias("orders"),
    )
    mean = (
        F.expr("orders div number_of_customers")
        if integer_avg
        else ratio(F.col("orders"), F.col("number_of_customers"))
    )
    return classes.select(
        "customer_type",
        "number_of_customers",
        ratio(F.col("revenue"), F.col("spenders")).alias("avg_total_spent"),
        mean.alias("avg_orders_per_customer"),
    ).orderBy(F.desc("number_of_customers"), "customer_type")


# ------------------------------------------- results derived from the reports


def kpis(t: Tables) -> DataFrame:
    """One row: revenue and orders over all stores, mean order value, customers."""
    none = F.lit(None)
    rows = {**_order_grain_measures(), "orders": F.count("*")}
    by_store = t["orders"].groupBy("store_id").agg(*_measures(rows))
    sold = by_store.join(t["stores"].select("store_id"), "store_id", "left_semi").agg(
        F.sum("revenue").alias("revenue"),
        F.sum("orders").alias("orders"),
        none.cast("bigint").alias("customers"),
    )
    known = t["customers"].agg(
        none.cast("decimal(38,8)").alias("revenue"),
        none.cast("bigint").alias("orders"),
        F.count("*").alias("customers"),
    )
    return (
        sold.unionAll(known)
        .agg(F.max("revenue").alias("r"), F.max("orders").alias("o"), F.max("customers").alias("c"))
        .select(
            _double("r").alias("total_revenue"),
            F.col("o").alias("total_orders"),
            F.coalesce(ratio(F.col("r"), F.col("o")), F.lit(0.0)).alias("avg_order_value"),
            F.col("c").alias("total_customers"),
        )
    )


def kpi_labels(t: Tables) -> DataFrame:
    """The same figures as text: dollars with cents, counts with thousands separators."""

    def dollars(c: str) -> Column:
        return F.concat(F.lit("$"), F.format_number(F.coalesce(c, F.lit(0.0)), 2)).alias(c)

    def count(c: str) -> Column:
        return F.format_number(F.coalesce(c, F.lit(0)), 0).alias(c)

    return kpis(t).select(
        dollars("total_revenue"),
        count("total_orders"),
        dollars("avg_order_value"),
        count("total_customers"),
    )


def series_monthly(t: Tables) -> DataFrame:
    key = F.concat(
        F.col("order_year").cast("string"),
        F.lit("-"),
        F.lpad(F.col("order_month").cast("string"), 2, "0"),
    )
    return monthly(t).select(
        key.alias("year_month"), "total_revenue", "total_orders"
    ).orderBy("year_month")


def segment_share(
    t: Tables, segment_bounds: tuple[float, float] = SEGMENT_BOUNDS
) -> DataFrame:
    sizes = customer_spending(t, segment_bounds).groupBy("customer_segment").agg(
        F.count("*").alias("customers")
    )
    whole = F.sum("customers").over(Window.partitionBy())
    return sizes.select(
        "customer_segment",
        "customers",
        F.round(F.col("customers") * 100.0 / whole, 1).alias("share_pct"),
    ).orderBy(F.desc("customers"), "customer_segment")


def category_share(t: Tables) -> DataFrame:
    # One row per category reaches the window.
    whole = F.sum("total_revenue").over(Window.partitionBy())
    return category(t).select(
        "category_name",
        "total_revenue",
        F.round(F.col("total_revenue") * 100.0 / whole, 1).alias("share_pct"),
    ).orderBy(F.desc("total_revenue"), "category_name")


def status_labels(t: Tables) -> DataFrame:
    label = F.concat(
        F.col("order_count").cast("string"),
        F.lit("\n("),
        F.col("percentage").cast("string"),
        F.lit("%)"),
    )
    return status(t).select(
        "order_status", "status_name", "order_count", label.alias("label")
    ).orderBy("order_status")


def low_stock_alert(
    t: Tables, low_stock_below: int = LOW_STOCK_BELOW, top_n: int = 10
) -> DataFrame:
    """The first products of the low-stock list, with the length of the whole list."""
    low = low_stock(t, low_stock_below)
    length = _low_stock(t, low_stock_below).agg(F.count("*")).scalar()
    return low.limit(top_n).select(
        "product_id",
        "product_name",
        "brand_name",
        "category_name",
        F.coalesce("total_stock", F.lit(0)).alias("stock_level"),
        "list_price",
        length.alias("alert_count"),
    )


def inactive_count(t: Tables) -> DataFrame:
    buyers = t["orders"].select("customer_id").distinct()
    inactive = t["customers"].join(buyers, "customer_id", "left_anti")
    return inactive.agg(F.count("*").alias("inactive_customers"))


def series_staff(t: Tables) -> DataFrame:
    return staff(t).select("staff_id", "staff_name", "total_sales_revenue").orderBy(
        F.asc_nulls_last("total_sales_revenue"), "staff_id"
    )


def series_brand(t: Tables) -> DataFrame:
    return brand(t).select("brand_name", "total_revenue").orderBy("total_revenue", "brand_name")


def series_inventory(t: Tables) -> DataFrame:
    return store_inventory(t).select(
        "store_name", "city", "total_inventory_units", "total_inventory_value"
    )


# Sums that two or three of the reports below start from.
SUMS = {
    "sales_by_product": lambda t: _sales_by_product(t, with_orders=False),
    "orders_by_customer": _orders_by_customer,
    "orders_by_staff": _orders_by_staff,
}

# Reports written by a report run, under their file names.
REPORTS = {
    "top_products": top_products,
    "top_customers": top_customers,
    "revenue_by_store": store_revenue,
    "revenue_by_category": category,
    "monthly_sales": monthly,
    "low_stock_products": low_stock,
    "store_inventory": store_inventory,
    "staff_orders": staff,
    "best_staff": best_staff,
    "customers_no_orders": customers_no_orders,
    "customer_spending": customer_spending,
    "revenue_by_brand": brand,
    "order_status_dist": status,
}

# Statements of the hand-run script.
SCRIPT = {
    "top_products_full": top_products_full,
    "top_customers_full": top_customers_full,
    "store_revenue_linegrain": store_revenue_linegrain,
    "category_full": category_full,
    "monthly_linegrain": monthly_linegrain,
    "low_stock_detail": low_stock_detail,
    "store_inventory_full": store_inventory_full,
    "staff_full": staff_full,
    "best_staff_linegrain": best_staff_linegrain,
    "customers_no_orders_full": customers_no_orders_full,
    "spend_overall": spend_overall,
    "customer_spending_full": customer_spending_full,
    "brand_full": brand_full,
    "retention": retention,
    "status_full": status_full,
}
