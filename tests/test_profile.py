from pyspark.sql import functions as F

from retailspark.operators import profile
from tests.conftest import plan_of, values


def summary(df):
    return df.filter("column_name is null").first()


def details(df, *columns):
    return values(df.filter("column_name is not null").select(*columns))


def test_names_to_standardise_are_listed_one_issue_each(spark):
    df = spark.createDataFrame([(1, "A")], "ProductID bigint, `Product Name` string")
    found = profile.column_names(df, "products")
    assert (summary(found).needed, summary(found)["count"]) == (True, 3)
    assert details(found, "column_name", "issue") == [
        ("Product Name", "spaces"),
        ("Product Name", "uppercase"),
        ("ProductID", "uppercase"),
    ]


def test_standard_names_pass(spark):
    df = spark.createDataFrame([(1, "A")], "product_id bigint, product_name string")
    found = summary(profile.column_names(df, "products"))
    assert (found.needed, found["count"]) == (False, 0)


def test_duplicates_count_rows_beyond_the_first(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "id bigint, val string")
    found = summary(profile.duplicates(df, "t"))
    assert (found.needed, found["count"], found.pct) == (True, 1, 33.33)


def test_duplicates_treat_null_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None)], "id bigint, val string")
    assert summary(profile.duplicates(df, "t"))["count"] == 1


def test_no_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id bigint, val string")
    assert not summary(profile.duplicates(df, "t")).needed


def test_missing_lists_columns_with_gaps_only(spark):
    df = spark.createDataFrame([(1, None), (2, "b"), (3, "c")], "id bigint, val string")
    found = profile.missing(df, "t")
    assert summary(found).needed
    assert details(found, "column_name", "count", "pct") == [("val", 1, 33.33)]


def test_nothing_missing(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, val string")
    found = profile.missing(df, "t")
    assert not summary(found).needed
    assert details(found, "column_name") == []


def test_empty_table_profiles_to_zeros(spark):
    df = spark.createDataFrame([], "id bigint, val string")
    found = profile.profile_table(df, "t")
    assert values(found.filter("needed")) == []
    assert summary(found.filter("check_name = 'duplicates'")).pct == 0.0


def test_text_dates_should_be_datetimes(spark):
    df = spark.createDataFrame([("2021-01-01",), ("2021-01-02",)], "order_date string")
    found = profile.types(df, "orders")
    assert details(found, "column_name", "current_type", "expected_type") == [
        ("order_date", "string", "datetime")
    ]


def test_text_columns_count_as_the_narrowest_type_that_fits(text_table):
    df = text_table("a_id b_id c_id price", [("1", "1.0", "x", "2"), ("2", "2", "3", "2.5")])
    assert details(profile.types(df, "t"), "column_name", "current_type") == [
        ("b_id", "double"),
        ("c_id", "string"),
    ]


def test_integers_with_gaps_drift_only_on_request(text_table):
    df = text_table("a_id", [("1",), (None,)])
    assert not summary(profile.types(df, "t")).needed
    assert summary(profile.types(df, "t", nullable_int_is_drift=True)).needed


def test_strict_types_apply_every_rule(spark):
    df = spark.createDataFrame([(1, 2)], "price_date_id int, brand_name int")
    found = details(profile.types(df, "t", strict=True), "column_name", "expected_type")
    assert found == [
        ("brand_name", "string"),
        ("price_date_id", "datetime"),
        ("price_date_id", "float"),
        ("price_date_id", "int"),
    ]
    assert details(profile.types(df, "t"), "column_name") == []


def test_item_rules_at_their_boundaries(text_table):
    rows = [("-1", "0"), ("0", "1"), ("1", "1.01"), ("2", "-0.01"), (None, None)]
    df = text_table("Quantity discount", rows)
    found = details(profile.quality(df, "order_items"), "column_name", "issue", "count")
    assert found == [
        ("Quantity", "negative_quantities", 1),
        ("Quantity", "zero_quantities", 1),
        ("discount", "invalid_discounts", 2),
    ]


def test_negative_prices_leave_null_out(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (None,)], "list_price double")
    assert details(profile.quality(df, "products"), "issue", "count") == [("negative_prices", 1)]


def test_customer_rules(text_table):
    df = text_table("first_name last_name phone", [("a", "b", "1,2"), ("c", "d", None)])
    assert details(profile.quality(df, "customers"), "issue") == [
        ("missing_full_name",),
        ("multiple_phones",),
    ]


def test_missing_advice_takes_the_first_match(spark):
    rows = [("phone", 60.0), ("phone", 50.0), ("unit_price", 10.0), ("city", 1.0)]
    df = spark.createDataFrame(rows, "column_name string, pct double").selectExpr(
        "'t' as table_name", "'missing' as check_name", "column_name", "1L as count", "pct"
    )
    assert [r.advice for r in profile.missing_advice(df).collect()] == [
        "mostly_empty",
        "use_placeholder",
        "use_median",
        "inspect",
    ]


def test_duplicate_sample_shows_copies(spark):
    df = spark.createDataFrame([(1,)] * 6 + [(2,)] * 2 + [(3,)], "id bigint")
    assert [tuple(r) for r in profile.duplicate_sample(df).collect()] == [
        (1, 6, 1), (1, 6, 2), (1, 6, 3), (1, 6, 4),
    ]
    assert values(profile.duplicate_groups(df)) == [(1, 6), (2, 2)]


def test_describe_interpolates(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (None,)], "x double")
    row = profile.describe(df, "t", ["x"]).first()
    assert (row.value_count, row.q25, row.q50, row.q75) == (3, 1.5, 2.0, 3.0)
    assert (row.min_value, row.max_value, row.mean) == (1.0, 4.0, 7 / 3)


def test_describe_brackets_agree_with_exact_percentiles(spark, monkeypatch):
    """With a coarse sketch the brackets are really used, also around a hot value."""
    monkeypatch.setattr(profile, "ACCURACY", 100)
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, 500.0).otherwise((F.col("id") * 7919 % 10007).cast("double"))
        .alias("x")
    )
    row = profile.describe(df, "t", ["x"]).first()
    want = df.agg(F.expr("percentile(x, array(0.25, 0.5, 0.75))").alias("p")).first().p
    assert [row.q25, row.q50, row.q75] == want


def test_orphans_are_distinct_and_skip_null(spark):
    child = spark.createDataFrame([(i,) for i in [1, 7, 7, 8, 9, 10, 11, 12, None]], "k bigint")
    parent = spark.createDataFrame([(1,)], "k bigint")
    row = profile.orphans(child, "c", "k", parent, "p", "k").first()
    assert (row.orphaned_keys, row.examples) == (6, "7, 8, 9, 10, 11")


def test_table_score_caps_and_bands(spark):
    clean = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, v string")
    assert tuple(profile.table_score(clean, "t").first()) == ("t", 100.0, "Excellent")
    # Half the cells missing takes 30 points, three of four rows repeated takes 20.
    poor = spark.createDataFrame([(1, None)] * 4, "id bigint, v string")
    assert tuple(profile.table_score(poor, "t").first()) == ("t", 50.0, "Fair")
    empty = spark.createDataFrame([], "id bigint")
    assert tuple(profile.table_score(empty, "t").first()) == ("t", None, None)


def retail_raw(text_table):
    """Nine raw tables with the flaws of a real delivery: 10 of 39 checks flagged."""
    item = ("1", "1", "1", "2", "9.5", "0.1")
    return {
        "brands": text_table("brand_id brand_name", [("1", "A")]),
        "categories": text_table("category_id category_name", [("1", "C")]),
        "products": text_table(
            "product_id product_name brand_id category_id model_year list_price",
            [("1", "P", "1", "1", "2016", "9.5")] * 2,
        ),
        "customers": text_table(
            "customer_id first_name last_name phone email street city state zip_code",
            [("1", "a", "b", None, "e", "s", "c", "st", "z")],
        ),
        "orders": text_table(
            "order_id customer_id order_status order_date required_date shipped_date store_id staff_id",
            [("1", "1", "4", "2016-01-01", "2016-01-03", None, "1", "1")],
        ),
        "order_items": text_table(
            "order_id item_id product_id quantity list_price discount",
            [item, item, ("1", "x", "1", "1", "9.5", "0")],
        ),
        "staffs": text_table(
            "staff_id first_name last_name email phone active store_id manager_id",
            [("1", "a", None, "e", "p", "1", None, None), ("2", "a", "b", "e", "p", "1", "1", "1")],
        ),
        "stores": text_table(
            "store_id store_name phone email street city state zip_code",
            [("1", "S", "p", None, "s", "c", "st", "z")],
        ),
        "stocks": text_table("store_id product_id quantity", [("1", "1", "5")]),
    }


def test_overall_score_and_gates(text_table):
    raw = retail_raw(text_table)
    findings = profile.profile(raw, nullable_int_is_drift=True).cache()
    assert tuple(profile.score(findings).first()) == (39, 29, 74.36)
    flagged = {r.table_name for r in profile.table_gates(findings).filter("needs_cleaning").collect()}
    assert flagged == {"products", "customers", "orders", "order_items", "staffs", "stores"}
    steps = {r.step: r.needed for r in profile.gates(findings, profile.transforms_needed(raw)).collect()}
    assert steps == {
        "column_standardization": False,
        "data_cleaning": True,
        "data_transformation": True,
    }
    lines = {r.table_name: r.issues for r in profile.issue_summary(findings).collect()}
    assert lines["stocks"] == "Clean"
    assert lines["order_items"] == "duplicates (1), types (1 cols)"
    assert lines["customers"] == "missing (1 cols), quality"


def test_profile_reads_each_table_once(spark, text_table):
    text = plan_of(profile.profile_table(text_table("a b", [("1", "2")]), "t"), "optimized")
    assert text.count("LogicalRDD") + text.count("LocalRelation") == 1
    assert "Join" not in text


def test_rows_that_look_alike_joined_are_no_copies(spark):
    """What a digest of the joined values would take for equal: values that move between columns, NULL and its signs."""
    rows = [("ab", "c"), ("a", "bc"), ("1:a", ""), ("", "1:a"), (None, "-"), ("-", None), (None, None), ("", "")]
    df = spark.createDataFrame(rows + [("a", "bc")], "x string, y string")
    found = profile.duplicates(df, "t").first()
    assert found["count"] == 1


def test_digests_group_as_values_do(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (0.0D, 'a', array(1)), (-0.0D, 'a', array(1)), (double('nan'), 'b', array(2)),"
        " (double('nan'), 'b', array(2)), (1.0D, NULL, NULL) AS t(d, s, l)"
    )
    assert df.select(profile.digest(df)).distinct().count() == df.distinct().count() == 3


def test_quartiles_of_a_wide_bracket_are_ranked_in_parts(spark, monkeypatch):
    """Many distinct values in the brackets, and a hot one at a quartile's edge."""
    monkeypatch.setattr(profile, "ACCURACY", 20)
    df = spark.range(60_000).select(
        F.when(F.col("id") % 4 == 0, 0.0).otherwise((F.col("id") * 7919 % 60_013).cast("double")).alias("x"),
        F.when(F.col("id") < 3, F.col("id").cast("double")).alias("few"), F.lit(None).cast("double").alias("none"),
    )
    for row in profile.describe(df, "t", ["x", "few", "none"]).collect():
        want = df.agg(F.expr(f"percentile({row.column_name}, array(0.25, 0.5, 0.75))").alias("p")).first().p
        assert [row.q25, row.q50, row.q75] == (want or [None] * 3)


def test_digest_joins_a_row_in_one_go_and_tells_rows_apart(text_table):
    rows = [(None, None), ("", None), (None, ""), ("-", None), ("-:", ""), ("1:a", "b"), ("1", ":ab"), ("a", "1:b"), ("a1:b", "")]
    df = text_table("a b", rows + rows)
    digests = df.select(profile.digest(df).alias("d"))
    assert plan_of(digests, "optimized").count("concat(") == 1
    assert digests.distinct().count() == len(rows)
