"""Values that may not be lost, and keys that may repeat."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from retailspark.functions import dates, numbers
from retailspark.operators import clean, load, profile
from retailspark.plans import reports
from tests.conftest import plan_of, values


def test_numbers_in_any_notation(text_table):
    given = ["1e007", "1E+010", "1e100", "1e-200", "5d", "0x1p3", "NaN", "Infinity", "1e400", " 7 ", "x", None]
    df = text_table("v", [(v,) for v in given])
    got = [r[0] for r in df.select(numbers.number(F.col("v"))).collect()]
    assert got == [1e7, 1e10, 1e100, 1e-200, None, None, None, None, None, 7.0, None, None]
    assert [r[0] for r in df.select(numbers.whole(F.col("v"))).collect()][:2] == [10_000_000, 10_000_000_000]


@pytest.mark.parametrize("text, day", [
    ("25/12/2016", (2016, 12, 25)), ("20170105", (2017, 1, 5)), ("Jan 5, 2017", (2017, 1, 5)),
    ("05-Jan-2017", (2017, 1, 5)), ("12-25-2016", (2016, 12, 25)), ("1/2/16", (2016, 1, 2)), ("1/2/69", (1969, 1, 2)),
    ("3/4/2016", (2016, 3, 4)), ("2016/3/4", (2016, 3, 4)), ("1016-01-02", (1016, 1, 2)), ("13/13/2016", None), ("soon", None),
])
def test_dates_in_many_forms(text_table, text, day):
    (row,) = text_table("v", [(text,)]).select(dates.parse_timestamp(F.col("v"))).collect()
    assert row[0] == (day and dt.datetime(*day))


def test_unread_dates_are_counted(text_table):
    df = text_table("a b", [("2016-01-01", "x"), (None, "2016.01.02"), ("y", None)])
    assert values(clean.count_unread_dates(df, "t", ["a", "b"])) == [("t", "a", 1), ("t", "b", 2)]
    assert values(clean.count_unread_dates(df, "t", ["b"], ("yyyy.MM.dd",))) == [("t", "b", 1)]


def test_describe_keeps_tiny_values_and_empty_columns(spark):
    df = spark.createDataFrame([(1e-9, None), (2e-9, None)], "v double, w double")
    rows = {r.column_name: r for r in profile.describe(df, "t", ["v", "w"]).collect()}
    assert rows["v"].mean == pytest.approx(1.5e-9) and rows["v"]["std"] > 0 and rows["v"].q50 == pytest.approx(1.5e-9)
    assert rows["w"].value_count == 0 and rows["w"].mean is None


def test_distinct_counts_of_mixed_and_empty_columns(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", None)], "k bigint, s string, n string")
    assert values(profile.distinct_counts(df, "t", ["k", "s", "n"])) == [("t", "k", 2), ("t", "n", 0), ("t", "s", 1)]


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (1.0,)], "v double")
    assert profile.missing(df, "t").filter("column_name = 'v'").first()["count"] == 2
    assert [r.v for r in clean.fill_defaults(df, {"v": 0.0}).collect()] == [0.0, 0.0, 1.0]


def test_duplicates_group_no_whole_rows_but_suspects(text_table):
    df = text_table("a b", [("1", None), (None, "1"), ("1", None), ("2", "3")])
    found = profile.duplicates(df, "t")
    assert found.first()["count"] == 1
    assert "left_semi" in plan_of(found, "extended").lower() or "LeftSemi" in plan_of(found, "extended")


def test_a_repeated_order_counts_once(spark):
    orders = spark.createDataFrame(
        [(1, 1, 1, dt.datetime(2016, 1, 2), 1, 1, 10.0), (1, 1, 1, dt.datetime(2016, 1, 2), 1, 1, 10.0)],
        "order_id bigint, customer_id bigint, order_status bigint, order_date timestamp_ntz, store_id bigint,"
        " staff_id bigint, order_total double",
    )
    items = spark.createDataFrame(
        [(1, 1, 5, 2), (1, 2, 6, 1)], "order_id bigint, item_id bigint, product_id bigint, quantity bigint"
    ).withColumn("total_price", F.lit(5.0))
    stores = spark.createDataFrame([(1, "S", "c", "st")], "store_id bigint, store_name string, city string, state string")
    t = {"orders": orders, "order_items": items, "stores": stores}
    assert tuple(reports.store_revenue(t).first())[3:] == (1, 20.0, 10.0)
    month = reports.monthly(t).first()
    assert (month.total_orders, month.total_revenue, month.total_items_sold) == (1, 40.0, 6)
    assert reports.status(t).first().order_count == 2


def test_loads_refuse_and_say_why(spark, tmp_path):
    make = lambda *rows: spark.createDataFrame(rows, "brand_id string, brand_name string")
    for n, (rows, cause) in enumerate([
        ((("1", "A"), ("1", "B")), "repeated keys"), ((("zz", "A"),), "cannot hold: zz"), (((None, "A"),), "without a full key"),
        ((("1", None),), "NULLs"), ((("1", "x" * 300),), "cannot hold: x"),
    ]):
        load.create_tables(spark, f"refused_{n}", str(tmp_path / str(n)))
        (row,) = load.append_tables({"brands": make(*rows)}, f"refused_{n}", spark).collect()
        assert not row.ok and cause in row.error and spark.table(f"refused_{n}.brands").count() == 0
