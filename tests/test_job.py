import pytest

from retailspark.plans import job
from retailspark.sources import files
from tests.conftest import values
from tests.test_profile import retail_raw


@pytest.fixture
def raw_folder(text_table, tmp_path):
    folder = tmp_path / "raw"
    for name, df in retail_raw(text_table).items():
        df.coalesce(1).write.option("header", True).csv(str(folder / f"{name}.csv"))
    return str(folder)


def stages(log):
    return {r.stage: (r.ok, r.rows_in, r.rows_out) for r in log.collect()}


def cleaned_folder(log, out):
    return f"{out}/cleaned/{log.first().run_id}"


def test_a_broken_reference_fails_the_load_and_ends_the_run(spark, raw_folder, tmp_path):
    log = job.run(spark, raw_folder, str(tmp_path / "out"))
    load = log.filter("stage = 'load'").first()
    # The order's staff row was dropped for its missing store.
    assert not load.ok and "orders.staff_id -> staffs.staff_id" in load.error
    assert set(stages(log)) == {"check", "transform", "load"}


def test_a_run_is_about_its_own_files(spark, raw_folder, tmp_path):
    out = str(tmp_path / "out")
    job.run(spark, raw_folder, out, skip=("check", "load", "report"))
    (tmp_path / "raw" / "stocks.csv").rename(tmp_path / "elsewhere")
    log = job.run(spark, raw_folder, out, skip=("check",), on_violation="report")
    rows = {r.stage: r for r in log.collect()}
    assert rows["transform"].ok and "stocks" in rows["transform"].error
    assert not rows["load"].ok and "stocks" in rows["load"].error and "report" not in rows


def test_malformed_records_fail_the_run_or_are_set_aside(spark, raw_folder, tmp_path):
    (tmp_path / "raw" / "brands.csv" / "more.csv").write_text('brand_id,brand_name\n2,B,surplus\n3\n4,"D\nD"\n')
    assert not job.succeeded(job.run(spark, raw_folder, str(tmp_path / "a"), multiline=True))
    out = str(tmp_path / "b")
    log = job.run(
        spark, raw_folder, out, skip=("check", "load", "report"), multiline=True, on_malformed="quarantine"
    )
    assert job.succeeded(log)
    brands = files.load_cleaned(spark, cleaned_folder(log, out), ["brands"])["brands"]
    assert values(brands) == [(1, "A"), (4, "D\nD")]
    found = spark.read.parquet(f"{out}/malformed/brands").collect()
    assert sorted(r.record.strip() for r in found) == ["2,B,surplus", "3"]


def test_cleaning_can_be_switched_off_for_all(spark, raw_folder, tmp_path):
    out = str(tmp_path / "out")
    log = job.run(spark, raw_folder, out, skip=("check", "load", "report"), cleaning_needed=False)
    assert stages(log)["transform"] == (True, 13, 13) and not (tmp_path / "out" / "staged").exists()


def test_a_run_goes_from_raw_files_to_reports(spark, raw_folder, tmp_path):
    out = str(tmp_path / "out")
    log = job.run(spark, raw_folder, out, database="job_full", on_violation="report")
    assert job.succeeded(log)
    got = stages(log)
    cleaned = cleaned_folder(log, out)
    # 13 raw rows; two copies, one line with a bad number and one staff row drop out.
    assert got["transform"] == (True, 13, 9)
    assert got["load"] == (True, 9, 9)
    items = files.load_cleaned(spark, cleaned, ["order_items"])["order_items"]
    assert values(items.select("order_id", "total_price")) == [(1, 17.1)]
    orders = spark.table("job_full.orders").collect()
    assert [(o.order_id, round(o.order_total, 2)) for o in orders] == [(1, 17.1)]
    dropped = spark.read.parquet(f"{out}/staged/staffs/rejected=true")
    assert [r.rejected_because for r in dropped.collect()] == ["invalid store_id"]
    assert spark.read.parquet(f"{out}/checks/reconcile").filter("not ok").count() == 0


def test_gated_runs_leave_clean_tables_alone(spark, raw_folder, tmp_path):
    log = job.run(
        spark, raw_folder, str(tmp_path / "out"), gated=True, database="job_gated", on_violation="report"
    )
    assert job.succeeded(log)
    assert not (tmp_path / "out" / "staged" / "brands").exists()
    assert (tmp_path / "out" / "staged" / "staffs").exists()


def test_skipped_stages_leave_no_entry(spark, raw_folder, tmp_path):
    log = job.run(spark, raw_folder, str(tmp_path / "out"), skip=("check", "load", "report"))
    assert list(stages(log)) == ["transform"]


def test_a_failed_transform_ends_the_run(spark, raw_folder, tmp_path):
    (tmp_path / "raw" / "brands.csv" / "bad.csv").write_text("brand_id,brand_name\nx,A\n")
    log = job.run(spark, raw_folder, str(tmp_path / "out"))
    assert {s: ok for s, (ok, _, _) in stages(log).items()} == {"check": True, "transform": False}
    assert not job.succeeded(log)


def test_runs_append_to_one_log(spark, raw_folder, tmp_path):
    for _ in range(2):
        job.run(spark, raw_folder, str(tmp_path / "out"), skip=("transform", "load", "report"))
    assert spark.read.parquet(str(tmp_path / "out" / "run_log")).count() == 2


def test_a_run_that_broke_in_the_load_goes_on_from_there(spark, raw_folder, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    real = job.load.append_tables

    def broken(*args, **kwargs):
        raise RuntimeError("no connection")

    monkeypatch.setattr(job.load, "append_tables", broken)
    first = job.run(spark, raw_folder, out, on_violation="report")
    assert {s: ok for s, (ok, _, _) in stages(first).items()} == {"check": True, "transform": True, "load": False}
    run_id = first.first().run_id
    cleaned = tmp_path / "out" / "cleaned" / run_id
    before = {p: p.stat().st_mtime_ns for p in cleaned.rglob("*.parquet")}

    monkeypatch.setattr(job.load, "append_tables", real)
    monkeypatch.setattr(job.recipes, "stage_table", broken)
    log = job.run(spark, raw_folder, out, on_violation="report", resume=run_id)
    assert job.succeeded(log) and {r.run_id for r in log.collect()} == {run_id}
    assert {r.stage: r.attempt for r in log.collect()} == {"check": 1, "transform": 1, "load": 2, "report": 2}
    assert {p: p.stat().st_mtime_ns for p in cleaned.rglob("*.parquet")} == before


def test_a_run_that_broke_in_the_transform_keeps_the_tables_it_has_cleaned(spark, raw_folder, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    skip = ("check", "load", "report")
    real, done = job.load.write_cleaned, []

    def few(tables, folder, **kwargs):
        if len(done) == 4:
            raise RuntimeError("disk full")
        done.extend(tables)
        real(tables, folder, **kwargs)

    monkeypatch.setattr(job.load, "write_cleaned", few)
    first = job.run(spark, raw_folder, out, skip=skip)
    assert not job.succeeded(first)
    again = []
    monkeypatch.setattr(job.load, "write_cleaned", lambda tables, folder: (again.extend(tables), real(tables, folder)))
    log = job.run(spark, raw_folder, out, skip=skip, resume=first.first().run_id)
    assert stages(log)["transform"] == (True, 13, 9) and sorted(again + done) == sorted(files.TABLES)


def test_unread_dates_are_counted_in_the_log(spark, raw_folder, tmp_path):
    (tmp_path / "raw" / "orders.csv" / "more.csv").write_text(
        "order_id,customer_id,order_status,order_date,required_date,shipped_date,store_id,staff_id\n"
        "2,1,4,some day,5.1.2017,,1,1\n3,1,4,January 2017,soon,later,1,1\n"
    )
    log = job.run(spark, raw_folder, str(tmp_path / "out"), skip=("check", "load", "report"))
    assert log.first().error == "unread dates: orders.order_date: 1, orders.required_date: 1, orders.shipped_date: 1"
    assert log.first().ok
