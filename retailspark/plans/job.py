"""The batch run: check, clean and enrich, load, report."""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable, Collection
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from retailspark.functions import dates
from retailspark.operators import constraints, enrich, load, profile, recipes
from retailspark.operators.clean import standard_name, standardise_names
from retailspark.plans import reports
from retailspark.schemas import TABLES
from retailspark.session import long_steps, together
from retailspark.sources import files

STAGES = ("check", "transform", "load", "report")
LOG_SCHEMA = (
    "run_id string, stage string, ok boolean, rows_in bigint, rows_out bigint, seconds double,"
    " error string, attempt int"
)
# What a run has finished, table by table: written behind each piece of work, read by a run that resumes.
MARK_SCHEMA = "run_id string, stage string, table_name string, rows_in bigint"


def run(
    spark: SparkSession,
    raw_folder: str,
    out_folder: str,
    skip: Collection[str] = (),
    gated: bool = False,
    database: str | None = None,
    encoding: str | None = None,
    multiline: bool = False,
    on_malformed: str = "raise",
    on_violation: str = "raise",
    cleaning_needed: bool = True,
    cleaned_folder: str | None = None,
    resume: str | None = None,
    **cleaning_options,
) -> DataFrame:
    """Run the stages over ``raw_folder/<table>.csv`` and return the run log.

    Dropped rows stay in ``out_folder/staged/<table>/rejected=true`` with their reason. The cleaned tables go to
    ``out_folder/cleaned/<run id>``, and only these are loaded and reported on; a run that skips the transform
    takes ``cleaned_folder`` of an earlier one. A failed stage ends the run. The log is appended to
    ``out_folder/run_log`` and names missing raw files in the transform's row.

    ``gated`` cleans just the tables the check has flagged and computes just the derived columns that are missing;
    ``cleaning_needed=False`` cleans none. Broken keys, references, NOT NULL columns and row counts fail the load,
    unless ``on_violation="report"`` leaves them to ``out_folder/checks``. Raw records with too many or too few
    fields fail the run, unless ``on_malformed="quarantine"`` puts them into ``out_folder/malformed``. Dates that are
    there but cannot be read become NULL; the transform's row counts them by column.

    ``resume`` names a run that broke off. Its stages that went through are not run again, nor are tables it has cleaned;
    a load that broke off has left nothing. The log returned has the last attempt of each stage.
    """
    if on_violation not in ("raise", "report"):
        raise ValueError(f"on_violation must be 'raise' or 'report', not {on_violation!r}")
    with long_steps(spark):
        return _run(
            spark, raw_folder, out_folder, skip, gated, database, encoding, multiline, on_malformed, on_violation,
            cleaning_needed, cleaned_folder, resume, cleaning_options,
        )


def _run(
    spark, raw_folder, out_folder, skip, gated, database, encoding, multiline, on_malformed, on_violation, cleaning_needed,
    cleaned_folder, resume, cleaning_options,
) -> DataFrame:
    run_id = resume or uuid.uuid4().hex
    past = _past(spark, out_folder, run_id) if resume else {}
    attempt = 1 + max((entry.attempt for entry in past.values()), default=0)
    marks = _marks(spark, out_folder, run_id) if resume else {}
    cleaned_folder = cleaned_folder or f"{out_folder}/cleaned/{run_id}"
    notes: dict[str, str] = {}
    database = database or f"retail_{run_id}"

    def stage(name: str, work: Callable[[], tuple[int, int]]) -> bool:
        if name in skip or (name in past and past[name].ok):
            return True
        start = time.time()
        try:
            rows_in, rows_out = work()
            ok, error = True, notes.get(name)
        except Exception as failure:  # the outcome goes to the log
            rows_in = rows_out = None
            ok, error = False, str(failure)[:2000]
        _append(spark, f"{out_folder}/run_log", LOG_SCHEMA, run_id, name, ok, rows_in, rows_out, time.time() - start, error, attempt)
        return ok

    raw, missing = files.load_raw(
        spark, raw_folder, encoding=encoding, multiline=multiline, on_malformed=on_malformed
    )
    if missing:
        notes["transform"] = f"raw files missing: {', '.join(missing)}"

    def check() -> tuple[int, int]:
        watched, seen = _observed(raw)
        findings = profile.profile(watched).withColumn("run_id", F.lit(run_id))
        findings.write.mode("overwrite").parquet(f"{out_folder}/findings")
        return sum(c.get["n"] for c in seen.values()), spark.read.parquet(f"{out_folder}/findings").count()

    def transform() -> tuple[int, int]:
        watched, seen = _observed(raw, cleaning_options.get("date_formats", ()))
        needed = _gates(spark, out_folder) if gated and "check" not in skip else None
        derive = _derivations(raw) if gated else {}
        if on_malformed == "quarantine":
            for name in raw:
                files.malformed_records(spark, f"{raw_folder}/{name}.csv", encoding, multiline).write.mode(
                    "overwrite"
                ).parquet(f"{out_folder}/malformed/{name}")
        fresh, one_by_one = [name for name in watched if name not in marks], threading.Lock()

        def clean(name: str, df: DataFrame) -> DataFrame:
            if name in marks:
                return files.load_cleaned(spark, cleaned_folder, [name])[name]
            if cleaning_needed and (needed is None or needed.get(name, True)):
                staged = recipes.stage_table(name, df, **cleaning_options)
                return staged.stored(f"{out_folder}/staged/{name}").clean
            return _typed(name, df)

        def finish(name: str, df: DataFrame) -> None:
            load.write_cleaned({name: df}, cleaned_folder)
            with one_by_one:  # two appends to one folder would remove each other's unfinished files
                _append(spark, f"{out_folder}/manifest", MARK_SCHEMA, run_id, "transform", name, seen[name].get["n"])
                marks[name] = seen[name].get["n"]

        cleaned = dict(zip(watched, together(partial(clean, name, df) for name, df in watched.items())))

        # Line totals are stored before the order totals are summed from them.
        steps = {**_able(cleaned, derive), "calculate_order_total": False}
        steps["enrich_products"] &= "products" not in marks
        steps["calculate_item_total"] &= "order_items" not in marks
        enriched = enrich.enrich_all(cleaned, steps)
        orders = enriched.pop("orders", None)
        together([partial(finish, name, df) for name, df in enriched.items() if name not in marks])
        if orders is not None and "orders" not in marks:
            if "order_items" in cleaned and derive.get("calculate_order_total", True):
                items = files.load_cleaned(spark, cleaned_folder, ["order_items"])["order_items"]
                orders = enrich.add_order_total(orders, items, keep_line_counts=True)
            finish("orders", orders)
        unread = [
            f"{name}.{column}: {count}"
            for name in fresh for column, count in seen[name].get.items() if column != "n" and count
        ]
        if unread:
            notes["transform"] = "; ".join(filter(None, [notes.get("transform"), f"unread dates: {', '.join(unread)}"]))
        stored = files.load_cleaned(spark, cleaned_folder, cleaned)
        return sum(marks[name] for name in cleaned), _rows(stored)

    def load_tables() -> tuple[int, int]:
        cleaned = files.load_cleaned(spark, cleaned_folder)
        load.create_tables(spark, database, f"{out_folder}/tables-{run_id}")
        strict = on_violation == "raise"
        appended = load.append_tables(
            cleaned, database, spark, check=strict, whole=strict, load_id=run_id
        ).collect()  # nine rows
        failed = [f"{row.table_name}: {row.error}" for row in appended if not row.ok]
        if failed:
            raise RuntimeError(f"load stopped at {failed[-1]}")
        target = load.target_tables(spark, database)
        checks = {
            "reconcile": load.reconcile(cleaned, target),
            "keys": constraints.key_violations(target),
            "references": constraints.reference_violations(target),
            "not_null": constraints.not_null_violations(target),
        }
        together(
            partial(found.write.mode("overwrite").parquet, f"{out_folder}/checks/{name}") for name, found in checks.items()
        )
        if strict:
            broken = _violations(spark, f"{out_folder}/checks")
            if broken:
                raise RuntimeError(f"constraints broken: {'; '.join(broken)}")
        return _rows(cleaned), sum(row.rows_after for row in appended)

    def report() -> tuple[int, int]:
        cleaned = files.load_cleaned(spark, cleaned_folder)
        tables = reports.with_sums(cleaned, f"{out_folder}/reports/{run_id}/_sums")
        builders = {
            name: (lambda fn=fn: fn(tables)) for name, fn in reports.REPORTS.items()
        }
        written = load.write_reports(builders, f"{out_folder}/reports", run_id, spark).collect()
        failed = [row.report for row in written if row.error]
        if failed:
            raise RuntimeError(f"reports failed: {', '.join(failed)}")
        return _rows(cleaned), sum(row.row_count for row in written)

    work = {"check": check, "transform": transform, "load": load_tables, "report": report}
    all(stage(name, work[name]) for name in STAGES)  # ends at the first that fails

    return _last_attempts(spark, out_folder, run_id)


def _append(spark: SparkSession, folder: str, schema: str, *row) -> None:
    spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(folder)


def _last_attempts(spark: SparkSession, out_folder: str, run_id: str) -> DataFrame:
    entries = spark.read.schema(LOG_SCHEMA).parquet(f"{out_folder}/run_log").filter(F.col("run_id") == run_id)
    last = entries.groupBy("stage").agg(F.max_by(F.struct(*entries.columns), F.coalesce("attempt", F.lit(1))).alias("e"))
    return last.select("e.*")


def _past(spark: SparkSession, out_folder: str, run_id: str) -> dict:
    """The stages an earlier attempt of the run has come to: four at most."""
    return {row.stage: row for row in _last_attempts(spark, out_folder, run_id).collect()}


def _marks(spark: SparkSession, out_folder: str, run_id: str) -> dict[str, int]:
    """The tables the run has cleaned, with their raw rows: nine at most."""
    try:
        marks = spark.read.schema(MARK_SCHEMA).parquet(f"{out_folder}/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    return {r.table_name: r.rows_in for r in marks.filter(F.col("run_id") == run_id).collect()}


def succeeded(log: DataFrame) -> bool:
    """Whether every stage of the run went through."""
    return bool(log.agg(F.min("ok")).first()[0])


def _derivations(tables: dict[str, DataFrame]) -> dict[str, bool]:
    """Which derived columns the raw tables lack, by step: three rows."""
    return {r.transformation: r.needed for r in profile.transforms_needed(tables).collect()}


def _able(tables: dict[str, DataFrame], derive: dict[str, bool]) -> dict[str, bool]:
    """The steps called for whose tables are there."""
    needs = {"enrich_products": {"products", "brands", "categories"}, "calculate_item_total": {"order_items"}}
    return {step: derive.get(step, True) and need <= set(tables) for step, need in needs.items()}


def _violations(spark: SparkSession, folder: str) -> list[str]:
    """What the stored checks found, at most one line a table, reference or column."""
    keys = spark.read.parquet(f"{folder}/keys").filter("repeated_keys > 0 OR null_key_rows > 0")
    references = spark.read.parquet(f"{folder}/references").filter("violating_rows > 0")
    nulls = spark.read.parquet(f"{folder}/not_null").filter("null_rows > 0")
    counts = spark.read.parquet(f"{folder}/reconcile").filter("NOT ok")
    return [
        *(f"{r.table_name} keys" for r in keys.collect()),
        *(f"{r.reference} ({r.violating_rows} rows)" for r in references.collect()),
        *(f"{r.table_name}.{r.column_name} NULL" for r in nulls.collect()),
        *(f"{r.table_name} row count" for r in counts.collect()),
    ]


def _typed(name: str, df: DataFrame) -> DataFrame:
    """A table that skips cleaning: standard names and target types, nothing else."""
    df = standardise_names(df)
    return load.conform(df, name).select(*[c for c in TABLES[name].columns if c in df.columns])


def _observed(
    tables: dict[str, DataFrame], date_formats: tuple[str, ...] | None = None
) -> tuple[dict[str, DataFrame], dict[str, Observation]]:
    """The tables with counters each that ride along with their next use: of rows, and with ``date_formats`` of the dates
    that cannot be read in each column of dates."""
    counters = {name: Observation(f"rows of {name}") for name in tables}
    watched = {}
    for name, df in tables.items():
        measures = [F.count(F.lit(1)).alias("n")]
        if date_formats is not None:
            dated = recipes.RECIPES[name].timestamps
            measures += [
                F.count_if(dates.unread(F.col(f"`{c}`"), kind, date_formats)).alias(c)
                for c, kind in df.dtypes if standard_name(c) in dated
            ]
        watched[name] = df.observe(counters[name], *measures)
    return watched, counters


def _rows(tables: dict[str, DataFrame]) -> int:
    return profile.shapes(tables).agg(F.sum("row_count")).first()[0]


def _gates(spark: SparkSession, out_folder: str) -> dict[str, bool]:
    """Flags per table from the stored findings: one row per table."""
    findings = spark.read.parquet(f"{out_folder}/findings")
    return {r.table_name: r.needs_cleaning for r in profile.table_gates(findings).collect()}
