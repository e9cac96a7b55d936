import datetime as dt

import pytest
from pyspark.sql import functions as F

from retailspark.plans import reports
from retailspark.sources.starschema import retail_tables
from tests.conftest import SMALL, plan_of, values


@pytest.fixture(scope="module")
def sales(spark):
    return retail_tables(spark, SMALL)


@pytest.fixture
def shop(spark):
    """A hand-checked shop: order 1 has two lines, 2 has one, 3 has none."""
    make = spark.createDataFrame
    day = dt.datetime
    return {
        "brands": make([(1, "Trek"), (2, "TREK")], "brand_id bigint, brand_name string"),
        "categories": make([(1, "Road")], "category_id bigint, category_name string"),
        "products": make(
            [(1, "a", 1, 1, 10.0, "Trek", "Road"), (2, "b", 2, 1, 20.0, "TREK", "Road"),
             (3, "c", 1, 1, 30.0, "Trek", "Road")],
            "product_id bigint, product_name string, brand_id bigint, category_id bigint,"
            " list_price double, brand_name string, category_name string",
        ),
        "stores": make(
            [(1, "S", "X", "x"), (2, "S", "X", "x")],
            "store_id bigint, store_name string, city string, state string",
        ),
        "staffs": make(
            [(1, "A", "B", "e", 1, 1), (2, "C", None, "e", 1, 1), (3, "D", "E", "e", 0, 1)],
            "staff_id bigint, first_name string, last_name string, email string, active bigint,"
            " store_id bigint",
        ),
        "customers": make(
            [(i, f"c{i}", "e", "p", "X", "x", "z") for i in range(1, 6)],
            "customer_id bigint, full_name string, email string, phone string, city string,"
            " state string, zip_code string",
        ),
        "orders": make(
            [
                (1, 1, 4, day(2016, 1, 1), 1, 1, 500.0),
                (2, 2, 9, day(2016, 1, 11), 1, 1, 2000.0),
                (3, 3, None, None, 2, 3, 0.0),
                (4, 4, 1, day(2016, 2, 1), 1, 1, 2000.01),
            ],
            "order_id bigint, customer_id bigint, order_status bigint, order_date timestamp_ntz,"
            " store_id bigint, staff_id bigint, order_total double",
        ),
        "order_items": make(
            [(1, 1, 1, 2, 10.0, 200.0), (1, 2, 2, 1, 20.0, 300.0), (2, 1, 1, 1, 10.0, 2000.0),
             (4, 1, 9, 1, 1.0, 1.0)],
            "order_id bigint, item_id bigint, product_id bigint, quantity bigint,"
            " list_price double, total_price double",
        ),
        "stocks": make(
            [(1, 1, 9), (2, 1, 1), (1, 2, 9), (9, 2, 0)],
            "store_id bigint, product_id bigint, quantity bigint",
        ),
    }


def test_line_grain_counts_an_order_once_per_line(shop):
    assert values(reports.monthly(shop)) == [
        (2016, 1, "January", 2, 3000.0, 4), (2016, 2, "February", 1, 2000.01, 1),
    ]
    assert values(reports.monthly_ordergrain(shop)) == [
        (2016, 1, "January", 2, 2500.0, 4), (2016, 2, "February", 1, 2000.01, 1),
    ]


def test_stored_line_counts_give_the_same_line_grain(shop):
    from retailspark.operators.enrich import add_order_total

    stored = dict(shop)
    stored["orders"] = add_order_total(shop["orders"], shop["order_items"], keep_line_counts=True)
    for report in (reports.monthly, reports.monthly_linegrain, reports.store_revenue_linegrain,
                   reports.best_staff_linegrain):
        assert values(report(stored)) == values(report(shop))


def test_names_group_binary_unless_asked(shop):
    assert [r.brand_name for r in reports.brand(shop).collect()] == ["Trek", "TREK"]
    merged = reports.brand(shop, ignore_case=True).collect()
    assert [(r.number_of_products, r.total_revenue) for r in merged] == [(2, 2500.0)]


def test_status_names_with_and_without_fallback(shop):
    assert [(r.order_status, r.status_name) for r in reports.status(shop).collect()] == [
        (None, None), (1, "Pending"), (4, "Completed"), (9, None),
    ]
    full = {r.order_status: r.status_name for r in reports.status_full(shop).collect()}
    assert (full[9], full[None]) == ("Unknown", "Unknown")
    assert {r.percentage for r in reports.status(shop).collect()} == {25.0}


def test_segment_bounds_are_inclusive(shop):
    got = {r.customer_id: (r.total_spent, r.customer_segment) for r in reports.customer_spending(shop).collect()}
    assert got == {
        1: (500.0, "Medium Spender"),
        2: (2000.0, "Medium Spender"),
        3: (0.0, "Low Spender"),
        4: (2000.01, "High Spender"),
        5: (0.0, "No Orders"),
    }


def test_low_stock_puts_products_without_stock_first(shop):
    assert [(r.product_id, r.total_stock) for r in reports.low_stock(shop).collect()] == [(3, None), (2, 9)]
    text = {r.product_id: r.stock_by_store for r in reports.low_stock_detail(shop).collect()}
    assert text == {3: ": ", 2: ": 0, S: 9"}
    alert = reports.low_stock_alert(shop, top_n=1).first()
    assert (alert.stock_level, alert.alert_count) == (0, 2)


def test_stores_sharing_name_and_city_count_as_one(shop):
    assert values(reports.store_inventory(shop)) == [("S", "X", 2, 19, 280.0)]
    full = {r.store_id: (r.total_inventory_units, r.avg_stock_per_product)
            for r in reports.store_inventory_full(shop).collect()}
    assert full == {1: (18, 9), 2: (1, 1)}


def test_staff_without_orders_stay_with_null_sums(shop):
    assert values(reports.staff(shop)) == [
        (1, "A B", "S", 3, 4500.01, 4500.01 / 3), (2, None, "S", 0, None, None),
    ]
    assert [r.staff_id for r in reports.best_staff(shop).collect()] == [1]
    best = reports.best_staff_linegrain(shop).first()
    assert (best.total_sales_revenue, best.avg_orders_per_day) == (5000.01, 3 / 31)


def test_retention_and_overall_spending(shop):
    assert values(reports.retention(shop)) == [("One-time Customer", 4, 1125.0025, 1)]
    row = reports.spend_overall(shop).first()
    assert (row.total_customers, row.customers_with_orders, row.customers_without_orders) == (5, 4, 1)
    assert (row.total_revenue, row.avg_spending_per_customer) == (4500.01, 1125.0025)


def test_kpis_of_an_empty_shop_are_zero(shop):
    empty = {name: df.limit(0) for name, df in shop.items()}
    row = reports.kpis(empty).first()
    assert (row.total_revenue, row.avg_order_value, row.total_customers) == (None, 0.0, 0)


def revenue(df, column="total_revenue"):
    return round(df.agg(F.sum(column)).first()[0], 2)


def test_revenue_is_the_same_along_every_dimension(sales):
    total = revenue(reports.store_revenue(sales))
    assert revenue(reports.status(sales)) == total
    assert revenue(reports.brand(sales)) == total
    assert revenue(reports.category(sales)) == total
    assert revenue(reports.monthly_ordergrain(sales)) == total
    assert revenue(reports.monthly(sales)) > total


def test_percentages_sum_to_a_hundred(sales):
    assert abs(revenue(reports.status(sales), "percentage") - 100) <= 0.05
    assert abs(revenue(reports.category_share(sales), "share_pct") - 100) <= 0.5


def test_line_grain_reports_do_not_join_the_lines(sales):
    """Stored line counts: one scan of the lines, aggregated to orders, and no Expand."""
    plan = plan_of(reports.monthly_linegrain(sales), "optimized")
    assert plan.count("Join ") == 1 and "Expand" not in plan


def test_facts_meet_dimensions_only_after_aggregation(sales):
    plan = plan_of(reports.top_products(sales), "optimized")
    assert plan.index("Join ") < plan.index("Aggregate [")


def test_full_inventory_makes_products_distinct_without_a_table_of_them(shop):
    again = {**shop, "stocks": shop["stocks"].unionAll(shop["stocks"])}
    once, twice = ({r.store_id: r for r in reports.store_inventory_full(t).collect()} for t in (shop, again))
    assert {s: r.unique_products_stocked for s, r in once.items()} == {s: r.unique_products_stocked for s, r in twice.items()}
    assert all(twice[s].total_inventory_units == 2 * r.total_inventory_units for s, r in once.items())
    assert "distinct" not in plan_of(reports.store_inventory_full(shop), "optimized").lower()
