import datetime as dt

import pytest

from retailspark.operators import constraints, load
from retailspark.schemas import TABLES
from retailspark.sources import files
from tests.conftest import values


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{tmp_path.name}".replace("-", "_").lower()
    load.create_tables(spark, name, str(tmp_path / "tables"))
    return name


def brands(spark, *rows):
    return spark.createDataFrame(rows, "brand_id bigint, brand_name string")


def test_load_appends_once_to_the_named_table(spark, database):
    log = load.append_tables({"brands": brands(spark, (1, "A"))}, database, spark)
    assert [tuple(r) for r in log.collect()] == [(1, "brands", 1, 1, True, None)]
    load.append_tables({"brands": brands(spark, (2, "B"))}, database, spark)
    assert values(spark.table(f"{database}.brands")) == [(1, "A"), (2, "B")]
    assert spark.table(f"{database}.stocks").count() == 0


def test_tables_are_recreated_empty_with_their_schema(spark, database, tmp_path):
    load.append_tables({"brands": brands(spark, (1, "A"))}, database, spark)
    load.create_tables(spark, database, str(tmp_path / "tables"))
    for name, table in TABLES.items():
        assert spark.table(f"{database}.{name}").count() == 0
        assert spark.table(f"{database}.{name}").dtypes == [
            (f.name, f.dataType.simpleString()) for f in table.schema
        ]


def test_a_failing_table_ends_the_load_but_earlier_ones_stay(spark, database):
    broken = brands(spark, (1, "A")).selectExpr(
        "raise_error('boom') as category_id", "brand_name as category_name"
    )
    tables = {"brands": brands(spark, (1, "A")), "categories": broken, "stores": broken}
    log = [tuple(r) for r in load.append_tables(tables, database, spark).collect()]
    assert [r[:5] for r in log] == [(1, "brands", 1, 1, True), (2, "categories", 0, 0, False)]
    assert log[0][5] is None and "boom" in log[1][5]
    assert spark.table(f"{database}.brands").count() == 1 and spark.table(f"{database}.categories").count() == 0


def family(spark, store):
    """A store, and a staff row that refers to ``store``."""
    return {
        "brands": brands(spark, (1, "A")),
        "stores": spark.createDataFrame([(1, "S")], "store_id bigint, store_name string"),
        "staffs": spark.createDataFrame([(1, store)], "staff_id bigint, store_id bigint"),
    }


def counts(spark, database, *names):
    return [spark.table(f"{database}.{n}").count() for n in names]


def test_an_orphan_leaves_every_table_of_a_whole_load_unchanged(spark, database):
    load.append_tables({"brands": brands(spark, (7, "Old"))}, database, spark)
    log = load.append_tables(family(spark, 2), database, spark, whole=True).collect()
    assert [(r.table_name, r.rows_appended, r.rows_after, r.ok) for r in log] == [
        ("brands", 0, 1, False), ("stores", 0, 0, False), ("staffs", 0, 0, False),
    ]
    assert "staffs.store_id -> stores.store_id: 1 rows" in log[-1].error
    assert counts(spark, database, "brands", "stores", "staffs") == [1, 0, 0]
    # mended, the same load goes through, with parents of the same load
    assert all(r.ok for r in load.append_tables(family(spark, 1), database, spark, whole=True).collect())
    assert counts(spark, database, "brands", "stores", "staffs") == [2, 1, 1]


def test_an_orphan_is_refused_before_its_table_is_written(spark, database):
    log = load.append_tables(family(spark, 2), database, spark).collect()
    assert [r.ok for r in log] == [True, True, False]
    assert counts(spark, database, "brands", "stores", "staffs") == [1, 1, 0]
    # a parent that an earlier load has brought will do
    again = {"staffs": family(spark, 1)["staffs"]}
    assert [r.ok for r in load.append_tables(again, database, spark).collect()] == [True]


def test_a_load_may_be_repeated(spark, database):
    for _ in range(2):
        log = load.append_tables(family(spark, 1), database, spark, load_id="first").collect()
    assert [(r.rows_appended, r.rows_after, r.ok) for r in log] == [(0, 1, True)] * 3
    assert counts(spark, database, "brands", "stores", "staffs") == [1, 1, 1]


def test_rows_of_a_load_that_broke_off_are_not_seen(spark, database):
    load._stage(load.conform(brands(spark, (1, "half")), "brands"), database, "brands", "broken")
    assert counts(spark, database, "brands") == [0]
    load.append_tables({"brands": brands(spark, (1, "A"))}, database, spark, load_id="broken")
    assert values(spark.table(f"{database}.brands")) == [(1, "A")]


def test_old_rows_count_when_keys_are_checked(spark, database):
    load.append_tables({"brands": brands(spark, (1, "A"))}, database, spark)
    row = load.append_tables({"brands": brands(spark, (1, "B"))}, database, spark).first()
    assert not row.ok and "1 repeated keys" in row.error
    assert values(spark.table(f"{database}.brands")) == [(1, "A")]


def test_load_order_puts_parents_first():
    order = list(TABLES)
    for name, table in TABLES.items():
        for parent, _ in table.references.values():
            assert order.index(parent) < order.index(name)


def test_conform_orders_casts_and_fills_columns(spark):
    df = spark.createDataFrame(
        [("2016-01-02", "7", 1.5, "x")], "order_date string, order_id string, order_total double, other string"
    )
    row = load.conform(df, "orders").first()
    assert row.__fields__ == list(TABLES["orders"].columns)
    assert (row.order_id, row.order_date, row.order_total, row.staff_id) == (
        7, dt.datetime(2016, 1, 2), 1.5, None,
    )


def test_conformance_counts_lost_and_long_values(spark):
    df = spark.createDataFrame([("x", "s" * 11), ("1", "s" * 10)], "store_id string, state string")
    row = load.conformance(df, "stores").first()
    assert (row.row_count, row.lost_values, row.too_long) == (2, 1, 1)


def test_key_violations(spark):
    stocks = spark.createDataFrame(
        [(1, 1, 5), (1, 1, 6), (1, 1, 7), (1, 2, 5), (None, 2, 5)],
        "store_id bigint, product_id bigint, quantity bigint",
    )
    row = constraints.key_violations({"stocks": stocks}).first()
    assert tuple(row) == ("stocks", "store_id, product_id", 1, 2, 1)


def test_reference_violations_leave_null_out(spark):
    stores = spark.createDataFrame([(1,)], "store_id bigint")
    staffs = spark.createDataFrame([(1,), (2,), (2,), (None,)], "store_id bigint")
    found = constraints.reference_violations({"stores": stores, "staffs": staffs})
    assert values(found) == [("staffs.store_id -> stores.store_id", 2, 1)]


def test_not_null_violations(spark):
    found = constraints.not_null_violations({"brands": brands(spark, (1, None), (2, "B"))})
    assert values(found) == [("brands", "brand_name", 1)]


def test_reconcile_flags_differences_and_absent_targets(spark):
    two, one = brands(spark, (1, "A"), (2, "B")), brands(spark, (1, "A"))
    got = load.reconcile({"a": two, "b": two, "c": two}, {"a": two, "b": one})
    assert values(got) == [("a", 2, 2, True), ("b", 2, 1, False), ("c", 2, None, False)]


def test_reports_skip_empty_and_failing_ones(spark, tmp_path):
    def fail():
        raise RuntimeError("no such table")

    log = load.write_reports(
        {"full": lambda: brands(spark, (1, "A")), "empty": lambda: brands(spark, (1, "A")).limit(0), "bad": fail},
        str(tmp_path), "run", spark,
    )
    assert [(r.report, r.row_count, r.written) for r in log.collect()] == [
        ("full", 1, True), ("empty", 0, False), ("bad", None, False),
    ]
    assert values(files.read_csv(spark, str(tmp_path / "run" / "full"))) == [("1", "A")]
    assert not (tmp_path / "run" / "empty").exists()


def test_cleaned_tables_round_trip_with_types(spark, tmp_path):
    df = spark.createDataFrame([(1, "00123", None)], "id bigint, zip_code string, phone string")
    load.write_cleaned({"t": df}, str(tmp_path))
    got = files.load_cleaned(spark, str(tmp_path), ["t"])["t"]
    assert got.dtypes == df.dtypes and values(got) == [(1, "00123", None)]


def test_cleaned_tables_must_all_exist(spark, tmp_path):
    load.write_cleaned({"a": brands(spark, (1, "A"))}, str(tmp_path))
    with pytest.raises(FileNotFoundError, match="b, c"):
        files.load_cleaned(spark, str(tmp_path), ["a", "b", "c"])


def test_report_run_sums_the_lines_for_all_reports_once(spark, monkeypatch):
    from retailspark.plans import load_queries
    from tests.conftest import SMALL, plan_of

    seen = {}
    monkeypatch.setattr(load_queries.load, "write_reports", lambda builders, *_: seen.update(builders) or spark.createDataFrame(
        [("r", 0, False)], "report string, row_count bigint, written boolean"))
    load_queries.reports_nonempty(spark, SMALL)
    for name in ("revenue_by_store", "customer_spending", "store_inventory", "order_status_dist"):
        assert "l_extendedprice" not in plan_of(seen[name](), "optimized") and "l_quantity" not in plan_of(seen[name](), "optimized")
