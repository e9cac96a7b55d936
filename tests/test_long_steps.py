"""Steps of a whole run that large tables make long."""

import contextlib
import io
import re
import time

import pytest
from pyspark.sql import functions as F

from retailspark.operators import recipes
from retailspark.plans import job, reports
from retailspark.session import LONG_STEPS, long_steps, together
from tests.conftest import plan_of, values

DATES = [("1", "Jan 5, 2017", "25/12/1016", None), ("2", "soon", None, "2016-02-30"), ("3", None, "1/2/16", "20170105")]


def longest_method(df) -> int:
    """Bytes of the longest method of the whole-stage code."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode="codegen")
    return max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue()) or [0])


@pytest.fixture
def orders(text_table):
    return text_table("order_id order_date required_date shipped_date", DATES)


def test_code_that_reads_dates_is_short_enough_to_be_compiled(spark, orders, tmp_path):
    orders.withColumn("customer_id", F.lit("1")).write.parquet(str(tmp_path / "orders"))
    raw = spark.read.parquet(str(tmp_path / "orders"))
    watched, _ = job._observed({"orders": raw}, ())
    assert longest_method(watched["orders"]) < 8000
    assert longest_method(recipes.stage_table("orders", watched["orders"]).clean) < 8000


def test_dates_read_beside_a_lambda_are_the_same(orders):
    watched, seen = job._observed({"orders": orders}, ())
    got = values(recipes.stage_table("orders", watched["orders"].withColumn("customer_id", F.lit("1"))).clean.select(
        "order_id", *[F.col(c).cast("date").cast("string") for c in ("order_date", "required_date", "shipped_date")]
    ))
    assert got == [(1, "2017-01-05", "2016-12-25", None), (2, None, None, None), (3, None, "2016-01-02", "2017-01-05")]
    assert seen["orders"].get == {"n": 3, "order_date": 1, "required_date": 0, "shipped_date": 1}


def test_only_numbers_that_rules_ask_for_are_read_while_rows_are_staged(text_table):
    rows = text_table("store_id product_id quantity", [("1", "2", "3"), ("1", "3", "-1"), ("1", "4", "x")])
    staged = recipes.stage_table("stocks", rows)
    plan = plan_of(staged.tagged, "optimized")
    assert "_read_quantity" in plan and "_read_store_id" not in plan
    assert [r.product_id for r in staged.quarantine.collect()] == ["3"]


def test_sums_are_stored_once_for_the_reports_that_share_them(spark, tmp_path):
    items = spark.createDataFrame(
        [(1, 1, 5, 2, 4.0, 8.0), (2, 1, 5, 1, 4.0, 4.0), (2, 2, 6, 1, 3.0, None)],
        "order_id bigint, item_id bigint, product_id bigint, quantity bigint, list_price double, total_price double",
    )
    products = spark.createDataFrame(
        [(5, "P", 1, "B", 7, "C"), (6, "Q", 2, "A", 7, "C")],
        "product_id bigint, product_name string, brand_id bigint, brand_name string, category_id bigint, category_name string",
    )
    plain = {
        "order_items": items, "products": products, "brands": products.select("brand_id", "brand_name"),
        "categories": products.select("category_id", "category_name").distinct(),
    }
    stored = reports.with_sums(plain, str(tmp_path / "sums"))  # no orders: their sums are left out
    assert set(stored) - set(plain) == {"sales_by_product"}
    for report in (reports.top_products, reports.brand, reports.category):
        assert [tuple(r) for r in report(stored).collect()] == [tuple(r) for r in report(plain).collect()]
        assert "item_id" not in plan_of(report(stored))


def test_pieces_of_work_run_together(spark):
    done = []

    def piece(n):
        time.sleep(0.05 * (3 - n))
        done.append(n)
        if n % 2:
            raise ValueError(f"piece {n}")
        return n

    assert together(lambda n=n: piece(n) for n in (0, 2)) == [0, 2] and done == [2, 0]
    with pytest.raises(ValueError, match="piece 1"):
        together([lambda n=n: piece(n) for n in (1, 2, 3)])
    assert sorted(done) == [0, 1, 2, 2, 3]


def test_the_session_is_left_as_it_was(spark):
    key = next(iter(LONG_STEPS))
    spark.conf.set(key, "0")
    with pytest.raises(ValueError), long_steps(spark):
        assert spark.conf.get(key) == LONG_STEPS[key]
        raise ValueError
    assert spark.conf.get(key) == "0"
    spark.conf.unset(key)
