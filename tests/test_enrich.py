from retailspark.operators import enrich
from tests.conftest import values


def test_products_get_names_and_null_without_match(spark):
    products = spark.createDataFrame(
        [(1, 1, 1), (2, 9, None)], "product_id bigint, brand_id bigint, category_id bigint"
    )
    brands = spark.createDataFrame([(1, "B")], "brand_id bigint, brand_name string")
    categories = spark.createDataFrame([(1, "C")], "category_id bigint, category_name string")
    got = enrich.enrich_products(products, brands, categories)
    assert values(got.select("product_id", "brand_name", "category_name")) == [
        (1, "B", "C"),
        (2, None, None),
    ]


def test_existing_names_stay_unless_all_null(spark):
    schema = "product_id bigint, brand_id bigint, category_id bigint, brand_name string, category_name string"
    products = spark.createDataFrame([(1, 1, 1, "mine", None), (2, 1, 1, None, None)], schema)
    brands = spark.createDataFrame([(1, "B")], "brand_id bigint, brand_name string")
    categories = spark.createDataFrame([(1, "C")], "category_id bigint, category_name string")
    got = enrich.enrich_products(products, brands, categories)
    assert values(got.select("product_id", "brand_name", "category_name")) == [
        (1, "mine", "C"),
        (2, None, "C"),
    ]


ITEM = "order_id bigint, item_id bigint, quantity bigint, list_price double, discount double"


def items(spark):
    return spark.createDataFrame([(1, 1, 2, 10.0, 0.5), (1, 2, 1, 0.3, 0.0), (3, 1, 1, 5.0, 0.0)], ITEM)


def test_item_total(spark):
    got = enrich.add_item_total(items(spark))
    assert [r.total_price for r in got.orderBy("order_id", "item_id").collect()] == [10.0, 0.3, 5.0]
    assert enrich.add_item_total(got).columns == got.columns


def test_order_total_is_the_sum_of_its_lines_or_zero(spark):
    orders = spark.createDataFrame([(1,), (2,)], "order_id bigint")
    lines = enrich.add_item_total(items(spark))
    got = enrich.add_order_total(orders, lines, keep_line_counts=True)
    measures = got.select("order_id", "order_total", "line_count", "unit_count")
    assert values(measures) == [(1, 10.3, 2, 3), (2, 0.0, 0, 0)]
    assert enrich.add_order_total(orders, lines).columns == ["order_id", "order_total"]


def test_existing_order_total_stays_unless_all_null(spark):
    lines = enrich.add_item_total(items(spark))
    partly = spark.createDataFrame([(1, None), (2, 7.0)], "order_id bigint, order_total double")
    got = enrich.add_order_total(partly, lines).select("order_id", "order_total")
    assert values(got) == [(1, 0.0), (2, 7.0)]
    empty = spark.createDataFrame([(1, None), (2, None)], "order_id bigint, order_total double")
    got = enrich.add_order_total(empty, lines).select("order_id", "order_total")
    assert values(got) == [(1, 10.3), (2, 0.0)]


def test_summary_counts_orders_without_lines(spark):
    lines = enrich.add_item_total(items(spark))
    orders = spark.createDataFrame([(1, 10.3), (2, 0.0)], "order_id bigint, order_total double")
    assert tuple(enrich.summary(lines, orders).first()) == (15.3, 5.15)


def test_transformations_can_be_switched_off(spark):
    off = {"enrich_products": False, "calculate_item_total": False, "calculate_order_total": False}
    tables = {"order_items": items(spark)}
    assert enrich.enrich_all(tables, off) == tables
