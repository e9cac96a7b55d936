import datetime as dt

import pytest
from pyspark.sql import functions as F

from retailspark.functions import dates, numbers, text
from retailspark.operators import clean, recipes
from tests.conftest import plan_of, values


def column(df, expression):
    return [r[0] for r in df.select(expression).collect()]


def test_standardise_names(spark):
    df = spark.createDataFrame([(1, "Nike")], "`Brand ID` bigint, `Brand Name` string")
    assert clean.standardise_names(df).columns == ["brand_id", "brand_name"]


def test_standardise_names_keeps_words_together_and_runs_of_spaces(spark):
    df = spark.createDataFrame([(1, 2)], "ProductID bigint, `a  b` bigint")
    assert clean.standardise_names(df).columns == ["productid", "a__b"]


def test_standardise_names_refuses_collisions(spark):
    df = spark.createDataFrame([(1, 2)], "`A B` bigint, a_b bigint")
    with pytest.raises(ValueError, match="collide"):
        clean.standardise_names(df)


@pytest.mark.parametrize(
    "given, number, whole",
    [
        ("1", 1.0, 1),
        ("1.0", 1.0, 1),
        ("1.7", 1.7, 1),
        ("-1.7", -1.7, -1),
        ("1e3", 1000.0, 1000),
        (" 12 ", 12.0, 12),
        ("9007199254740993", 9007199254740992.0, 9007199254740993),
        ("inf", None, None),
        ("-Infinity", None, None),
        ("NaN", None, None),
        ("1e999", None, None),
        ("5d", None, None),
        ("0x1p3", None, None),
        ("1,000", None, None),
        ("", None, None),
        ("x", None, None),
        (None, None, None),
    ],
)
def test_numbers_from_text(text_table, given, number, whole):
    df = text_table("v", [(given,)])
    assert column(df, numbers.number(F.col("v"))) == [number]
    assert column(df, numbers.whole(F.col("v"))) == [whole]


@pytest.mark.parametrize(
    "given, number, whole",
    [
        ("+5", 5.0, 5), ("5.", 5.0, 5), (".5", 0.5, 0), ("\t5\n", 5.0, 5), ("\x7f5", None, 5), ("5e", None, None),
        ("--5", None, None), ("5\u0085", None, None), ("99999999999999999999", 1e20, None), ("abc", None, None),
    ],
)
def test_odd_numbers_from_text(text_table, given, number, whole):
    df = text_table("v", [(given,)])
    assert column(df, numbers.number(F.col("v"))) == [number]
    assert column(df, numbers.whole(F.col("v"))) == [whole]


def test_day_first_with_a_short_year_is_not_turned_twice(text_table):
    given = ["25/12/16", "25/12/2016", "12/25/16", "2016-1-5", "2016-01-05T10:20", "5 #jan# 2016"]
    got = column(text_table("v", [(v,) for v in given]), dates.parse_timestamp(F.col("v")))
    christmas = dt.datetime(2016, 12, 25)
    assert got == [christmas, christmas, christmas, dt.datetime(2016, 1, 5), dt.datetime(2016, 1, 5, 10, 20), None]


def test_each_value_is_computed_once(text_table):
    columns = ["store_id", "product_id", "quantity"]
    texts = text_table("a b c", [("1", "2", "3"), ("4", "x", "5")])
    view = texts.select(*[F.concat(F.col(c), F.lit("0")).alias(n) for c, n in zip("abc", columns)])
    split = clean.safe_numeric(view, columns)
    assert values(split.clean) == [(10, 20, 30)]
    assert [tuple(r) for r in split.quarantine.collect()] == [("40", "x0", "50", "invalid product_id")]
    assert plan_of(split.clean, "optimized").count("concat(") == 3
    staged = recipes.stage_table("stocks", view, on_bad="quarantine")
    assert values(staged.clean) == [(10, 20, 30)]
    assert plan_of(staged.clean, "optimized").count("concat(") == 5  # two more look for missing keys before the copies go


def test_numbers_from_doubles(spark):
    df = spark.createDataFrame([(1.9,), (float("nan"),), (float("inf"),), (None,)], "v double")
    assert column(df, numbers.whole(F.col("v"), "double")) == [1, None, None, None]
    assert column(df, numbers.number(F.col("v"), "double")) == [1.9, None, None, None]


@pytest.mark.parametrize(
    "given, expected",
    [
        ("2016-02-29", dt.datetime(2016, 2, 29)),
        ("2016-01-05 10:20:30", dt.datetime(2016, 1, 5, 10, 20, 30)),
        ("1/5/2016", dt.datetime(2016, 1, 5)),
        ("2016/1/5", dt.datetime(2016, 1, 5)),
        ("1016-02-29", dt.datetime(2016, 2, 29)),
        ("0025-06-01", dt.datetime(2025, 6, 1)),
        ("0026-06-01", None),
        ("1900-01-01", dt.datetime(1900, 1, 1)),
        ("1899-12-31", None),
        ("1800-01-01", None),
        ("2016-13-01", None),
        ("not a date", None),
        ("12", None),
        (None, None),
    ],
)
def test_date_repair(text_table, given, expected):
    df = text_table("d", [(given,)])
    assert column(clean.repair_dates(df, ["d"]), "d") == [expected]


def test_date_repair_null_mode_gives_up_on_old_years(text_table):
    df = text_table("d", [("1016-01-01",), ("2016-01-01",)])
    got = column(clean.repair_dates(df, ["d"], mode="null"), "d")
    assert got == [None, dt.datetime(2016, 1, 1)]


def test_date_repair_latest_year_is_a_parameter(text_table):
    df = text_table("d", [("1030-01-01",)])
    assert column(clean.repair_dates(df, ["d"]), "d") == [None]
    assert column(clean.repair_dates(df, ["d"], latest=2030), "d") == [dt.datetime(2030, 1, 1)]


def test_further_date_formats(text_table):
    df = text_table("d", [("05.01.2016",)])
    got = column(df, dates.parse_timestamp(F.col("d"), formats=("dd.MM.yyyy",)))
    assert got == [dt.datetime(2016, 1, 5)]


def test_phone_helpers(text_table):
    df = text_table("p", [("(555) 1, 2",), ("Unknown",), ("7",), (None,)])
    assert column(df, text.digits_only(text.first_phone(F.col("p")))) == ["5551", None, "7", None]


def test_cast_strict_fails_on_bad_text_and_on_null(text_table):
    good = text_table("id price", [("1.9", "2.5"), ("-3", None)])
    assert values(clean.cast_strict(good, ["id"], ["price"])) == [(-3, None), (1, 2.5)]
    for bad in [("x", "1"), (None, "1"), ("1", "x")]:
        with pytest.raises(Exception, match="not a valid number"):
            clean.cast_strict(text_table("id price", [bad]), ["id"], ["price"]).collect()


def test_safe_numeric_names_the_first_bad_column(text_table):
    df = text_table("a b", [("1", "2"), ("x", "y"), ("1", "inf"), (None, "1")])
    split = clean.safe_numeric(df, ["a"], ["b"])
    assert values(split.clean) == [(1, 2.0)]
    assert values(split.quarantine) == [
        ("1", "inf", "invalid b"),
        ("x", "y", "invalid a"),
        (None, "1", "invalid a"),
    ]


def test_drop_non_finite(spark):
    df = spark.createDataFrame([(1.0,), (float("inf"),), (float("nan"),), (None,)], "x double")
    assert values(clean.drop_non_finite(df, ["x"])) == [(1.0,)]


def test_keep_range_drops_null(spark):
    df = spark.createDataFrame([(-1,), (0,), (1,), (None,)], "q bigint")
    assert values(clean.keep_range(df, "q", 0)) == [(0,), (1,)]
    assert values(clean.keep_range(df, "q", 0, inclusive=False)) == [(1,)]


def test_brands(text_table):
    df = text_table("brand_id brand_name", [("1", "Nike"), ("1", "Nike"), ("2", None)])
    assert values(recipes.clean_table("brands", df).clean) == [(1, "Nike"), (2, "Unknown")]


def test_dedup_is_on_raw_text(text_table):
    df = text_table("brand_id brand_name", [("1", "A"), ("1.0", "A")])
    assert values(recipes.clean_table("brands", df).clean) == [(1, "A"), (1, "A")]


PRODUCT = "product_id product_name brand_id category_id model_year list_price"


def test_products(text_table):
    rows = [
        ("1", "a", "1", "1", "2016", "100"),
        ("2", "b", "1", "1", "2016", "-10"),
        ("3", "c", "1", "1", None, "0"),
        ("4", "d", "1", "1", "2016", None),
        (None, "e", "1", "1", "2016", "5"),
        ("6", None, "1", "1", "2016", "5"),
    ]
    split = recipes.clean_table("products", text_table(PRODUCT, rows))
    assert values(split.clean.select("product_id", "model_year", "list_price")) == [
        (1, 2016, 100.0),
        (3, 0, 0.0),
    ]
    reasons = {r.product_name: r.rejected_because for r in split.quarantine.collect()}
    assert reasons == {
        "b": "list_price out of range",
        "d": "list_price out of range",
        "e": "missing product_id",
        None: "missing product_name",
    }


def test_strict_columns_fail_or_go_to_quarantine(text_table):
    df = text_table(PRODUCT, [("1", "a", "x", "1", "2016", "1"), ("2", "b", "1", "1", "2016", "z")])
    with pytest.raises(Exception, match="not a valid number"):
        recipes.clean_table("products", df).clean.collect()
    split = recipes.clean_table("products", df, on_bad="quarantine")
    assert values(split.clean) == []
    assert sorted(r.rejected_because for r in split.quarantine.collect()) == [
        "invalid brand_id",
        "invalid list_price",
    ]


def test_customers(text_table):
    columns = "customer_id first_name last_name phone email street city state zip_code"
    rows = [
        ("1", "A", "B", " (1) 2 , 3", "e", "s", "c", "st", "z"),
        ("2", None, None, None, None, None, None, None, None),
        (None, "A", "B", "1", "e", "s", "c", "st", "z"),
    ]
    split = recipes.clean_table("customers", text_table(columns, rows))
    assert values(split.clean) == [
        (1, "A", "B", "12", "e", "s", "c", "st", "z", "A B"),
        (2, "Unknown", "Unknown", None, "unknown@email.com", "Unknown", "Unknown", "Unknown",
         "00000", "Unknown Unknown"),
    ]


def test_orders_fail_on_a_missing_store(text_table):
    columns = "order_id customer_id order_status order_date required_date shipped_date store_id staff_id"
    df = text_table(columns, [("1", "1", "4", "1016-01-01", "x", None, None, "1")])
    with pytest.raises(Exception, match="orders.store_id"):
        recipes.clean_table("orders", df).clean.collect()


ITEM = "order_id item_id product_id quantity list_price discount"


def test_order_items_account_for_every_row(text_table):
    rows = [
        ("1", "1", "1", "2", "9.5", "0.1"),
        ("1", "1", "1", "2", "9.5", "0.1"),
        ("1", "2.0", "1", "1.9", "9.5", "1.5"),
        ("1", "x", "1", "2", "9.5", "0.1"),
        ("1", "3", "1", "0", "9.5", "0.1"),
        ("1", "4", "1", "-1", "9.5", "0.1"),
        ("1", "5", "1", None, "9.5", "0.1"),
        ("1", "6", "1", "1", "inf", "0.1"),
        (None, "7", "1", "1", "1", "0.1"),
    ]
    df = text_table(ITEM, rows)
    split = recipes.clean_table("order_items", df)
    # A discount beyond 1 is a finding of the profile, not a reason to drop the row.
    assert values(split.clean) == [(1, 1, 1, 2, 9.5, 0.1), (1, 2, 1, 1, 9.5, 1.5)]
    assert sorted(r.rejected_because for r in split.quarantine.collect()) == [
        "invalid item_id",
        "invalid list_price",
        "invalid quantity",
        "missing order_id",
        "quantity out of range",
        "quantity out of range",
    ]
    duplicates = df.count() - clean.drop_duplicates(df).count()
    assert len(rows) == split.clean.count() + split.quarantine.count() + duplicates


def test_staffs_without_store_are_set_aside_and_no_manager_is_zero(text_table):
    columns = "staff_id first_name last_name email phone active store_id manager_id"
    rows = [
        ("1", "A", None, "e", "+1 2", "1", "3", None),
        ("2", "A", "B", "e", "1", "1", None, "1"),
        ("3", "A", "B", "e", "1", "inf", "1", "1"),
    ]
    split = recipes.clean_table("staffs", text_table(columns, rows))
    assert values(split.clean) == [(1, "A", "Unknown", "e", "12", 1, 3, 0)]
    assert sorted(r.rejected_because for r in split.quarantine.collect()) == [
        "invalid active",
        "invalid store_id",
    ]


def test_stores_keep_every_digit(text_table):
    columns = "store_id store_name phone email street city state zip_code"
    df = text_table(columns, [("1", None, "(1) 2, 3", None, "s", "c", "st", None)])
    assert values(recipes.clean_table("stores", df).clean) == [
        (1, "Unknown", "123", "unknown@email.com", "s", "c", "st", "00000")
    ]


def test_stocks(text_table):
    rows = [("1", "1", None), ("1", "2", "-1"), ("1", "3", "0"), (None, "4", "5")]
    split = recipes.clean_table("stocks", text_table("store_id product_id quantity", rows))
    assert values(split.clean) == [(1, 1, 0), (1, 3, 0)]


def test_cleaning_twice_changes_nothing(spark):
    from retailspark.sources import dirt
    from tests.conftest import SMALL

    for name in ("customers", "orders", "order_items", "staffs"):
        once = recipes.clean_table(name, dirt.VIEWS[name](spark, SMALL)).clean
        twice = recipes.clean_table(name, once)
        assert values(twice.quarantine) == []
        # Lines that only became equal by cleaning collapse in the second run.
        assert values(twice.clean) == values(once.distinct())


def test_stored_split_equals_the_lazy_one(spark, text_table, tmp_path):
    df = text_table(ITEM, [("1", "1", "1", "2", "9.5", "0.1"), ("1", "x", "1", "2", "9.5", "0.1")])
    staged = recipes.stage_table("order_items", df)
    stored = staged.stored(str(tmp_path / "staged"))
    assert values(stored.clean) == values(staged.clean)
    assert values(stored.quarantine) == values(staged.quarantine)


def test_gates(text_table):
    tables = {
        "brands": text_table("brand_id brand_name", [("1", "A"), ("1", "A")]),
        "categories": text_table("category_id category_name", [("1", "A"), ("1", "A")]),
    }

    def rows(splits):
        return {n: s.clean.count() for n, s in splits.items()}

    assert rows(recipes.clean_all(tables)) == {"brands": 1, "categories": 1}
    assert rows(recipes.clean_all(tables, {"brands": False})) == {"brands": 2, "categories": 1}
    assert rows(recipes.clean_all(tables, cleaning_needed=False)) == {"brands": 2, "categories": 2}


@pytest.mark.parametrize("written, read", [
    ("05-Jan-17", dt.datetime(2017, 1, 5)), ("Sept 5, 2017", dt.datetime(2017, 9, 5)), ("5.1.2017", dt.datetime(2017, 5, 1)),
    ("31.12.2016 10:11:12", dt.datetime(2016, 12, 31, 10, 11, 12)), ("20161231 10:00", dt.datetime(2016, 12, 31, 10)),
    ("20161231 1011", dt.datetime(2016, 12, 31, 10, 11)), ("20161231T101112", dt.datetime(2016, 12, 31, 10, 11, 12)),
    ("January 2017", dt.datetime(2017, 1, 1)), ("Mon, 05 Jan 2017 10:00:00", dt.datetime(2017, 1, 5, 10)),
    ("May 5th, 2016", dt.datetime(2016, 5, 5)), ("2016 Dec 31", dt.datetime(2016, 12, 31)), ("5Jan2017", dt.datetime(2017, 1, 5)),
    ("1/5/2017 3:04 PM", dt.datetime(2017, 1, 5, 15, 4)), ("1/5/2017 12:04 am", dt.datetime(2017, 1, 5, 0, 4)),
    ("September 12 2016 5pm", dt.datetime(2016, 9, 12, 17)), ("2016.05.06", dt.datetime(2016, 5, 6)),
    ("2016-01-02T03:04:05.123456", dt.datetime(2016, 1, 2, 3, 4, 5, 123456)), ("12/31/99", dt.datetime(1999, 12, 31)),
    ("Marchen 5 2016", None), ("13/13/2016", None), ("January 5", None), ("2016-02-30", None), ("10:00", None), ("", None),
    ("not a date", None), ("99-99-99", None),
])
def test_lenient_dates(spark, written, read):
    df = spark.createDataFrame([(written,)], "t string")
    assert column(df, dates.parse_timestamp(F.col("t"))) == [read]
    assert column(df, dates.unread(F.col("t"))) == [read is None]
