"""Registered source, sink, load and job queries. They write to a fresh scratch folder."""

from __future__ import annotations

import uuid
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from retailspark.operators import constraints, load, profile, recipes
from retailspark.plans import job, reports
from retailspark.plans.query import Query
from retailspark.schemas import TABLES
from retailspark.session import scratch_folder, together
from retailspark.sources import dirt, files, starschema


def _cleaned(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    tables = dirt.dirty_tables(spark, folder)
    return {n: recipes.clean_table(n, tables[n]).clean for n in TABLES}


def _stored(spark: SparkSession, folder: str) -> str:
    """Folder with the nine cleaned tables written out."""
    out = scratch_folder(spark, "cleaned")
    load.write_cleaned(_cleaned(spark, folder), out)
    return out


def _write_raw(spark: SparkSession, folder: str) -> str:
    """The untidy tables as CSV files with header."""
    out = scratch_folder(spark, "raw")
    tables = dirt.dirty_tables(spark, folder)
    together([partial(_csv, tables[name], f"{out}/{name}.csv") for name in TABLES])
    return out


def _csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).csv(path)


def csv_load(spark: SparkSession, folder: str) -> DataFrame:
    """Shapes of the raw files as read back; one asked-for file does not exist."""
    raw, missing = files.load_raw(spark, _write_raw(spark, folder), [*TABLES, "suppliers"])
    found = profile.shapes(raw).withColumn("found", F.lit(True))
    absent = spark.range(1).select(
        F.explode(F.array(*[F.lit(n) for n in missing])).alias("table_name"),
        F.lit(0).cast("bigint").alias("row_count"),
        F.lit(0).cast("bigint").alias("column_count"),
        F.lit(False).alias("found"),
    )
    return found.unionByName(absent)


def encoding_probe(spark, folder):
    """The documents written as UTF-8 and as Latin-1, each read as the probe advises."""
    out = scratch_folder(spark, "encoding")
    docs = starschema.source(spark, folder, "documents").select("doc_id", "text")
    frames = []
    for encoding in ("UTF-8", "ISO-8859-1"):
        path = f"{out}/{encoding}.csv"
        docs.write.option("header", True).option("escape", '"').option("encoding", encoding).csv(path)  # with line breaks
        advised = files.pick_encoding(spark, path)
        read = files.read_csv(spark, path, advised, multiline=True)
        frames.append(
            read.agg(
                F.count("*").alias("row_count"),
                F.count_if(F.col("text").rlike("[À-ÿ]")).alias("accented_rows"),
            ).select(F.lit(encoding).alias("written_as"), F.lit(advised).alias("read_as"), "*")
        )
    return reduce(DataFrame.unionByName, frames)


def mixed_folder(spark, folder):
    """Documents in one folder, each language in files of its own, two in UTF-8 and two in Latin-1, read as they are."""
    out = scratch_folder(spark, "mixed")
    docs = starschema.source(spark, folder, "documents").select("doc_id", "lang", F.regexp_replace("text", "\r\n?", " ").alias("text"))
    writer = lambda df: df.write.mode("append").option("header", True).option("escape", '"')
    latin = F.col("lang").isin("de", "fr")
    writer(docs.filter(latin)).option("encoding", "ISO-8859-1").csv(out)
    writer(docs.filter(~F.coalesce(latin, F.lit(False)))).option("encoding", "UTF-8").csv(out)
    read = files.read_csv(spark, out, multiline=True)
    return read.groupBy("lang").agg(
        F.count("*").alias("row_count"), F.count_if(F.col("text").rlike("[À-ÿ]")).alias("accented_rows"),
        F.sum(F.length("text")).alias("chars"), F.sum(F.size(F.split("text", "\n"))).cast("bigint").alias("lines"),
    )


def cleaned_required(spark, folder):
    return profile.shapes(files.load_cleaned(spark, _stored(spark, folder)))


def cleaned_roundtrip(spark, folder):
    """Cleaned orders after they were written and read back, types and all."""
    out = scratch_folder(spark, "roundtrip")
    load.write_cleaned({"orders": _cleaned(spark, folder)["orders"]}, out)
    return files.load_cleaned(spark, out, ["orders"])["orders"]


def reports_nonempty(spark, folder):
    """The log of a report run. Orders and stocks are sums over all lines, so they are stored once, not summed for each
    report that reads them."""
    out, summed = scratch_folder(spark, "reports"), scratch_folder(spark, "summed")
    tables = starschema.retail_tables(spark, folder)
    load.write_cleaned({name: tables[name] for name in ("orders", "stocks")}, summed)
    tables |= files.load_cleaned(spark, summed, ["orders", "stocks"])
    builders = {name: (lambda fn=fn: fn(tables)) for name, fn in reports.REPORTS.items()}
    log = load.write_reports(builders, out, "run", spark)
    return log.select("report", "row_count", "written")


def schema_conform(spark, folder):
    """Fit of the untidy tables, as they come, to the target columns."""
    tables = dirt.dirty_tables(spark, folder)
    return reduce(DataFrame.unionByName, [load.conformance(tables[n], n) for n in TABLES])


def _loaded(spark, folder):
    """Cleaned tables, the database they were appended to, and the log of that."""
    out = _stored(spark, folder)
    cleaned = files.load_cleaned(spark, out)
    database = f"retail_{uuid.uuid4().hex}"
    load.create_tables(spark, database, f"{out}/tables")
    # The untidy tables keep repeated keys, which a checked load would refuse.
    log = load.append_tables(cleaned, database, spark, check=False)
    return cleaned, database, log


def append(spark, folder):
    _, _, log = _loaded(spark, folder)
    return log


def reconcile(spark, folder):
    cleaned, database, _ = _loaded(spark, folder)
    return load.reconcile(cleaned, load.target_tables(spark, database))


def key_violations(spark, folder):
    tables = starschema.retail_tables(spark, folder)
    tables["orders"] = starschema.plain_orders(spark, folder)
    return constraints.key_violations({n: tables[n] for n in TABLES})


def reference_violations(spark, folder):
    tables = starschema.retail_tables(spark, folder)
    tables["order_items"] = dirt.orphaned_items(spark, folder)
    return constraints.reference_violations({n: tables[n] for n in TABLES})


def not_null_violations(spark, folder):
    tables = dirt.dirty_tables(spark, folder)
    return constraints.not_null_violations({n: tables[n] for n in TABLES})


def stage_log(spark, folder):
    """A whole run from raw CSV files to loaded tables and reports, as its log."""
    out = scratch_folder(spark, "job")
    log = job.run(spark, _write_raw(spark, folder), out, on_violation="report")
    counted = F.when(F.col("stage").isin("transform", "load"), F.col("rows_out"))
    return log.select(
        "stage", "ok", "rows_in", counted.alias("rows_out"), (F.col("rows_out") > 0).alias("wrote_rows"),
        (F.col("seconds") >= 0).alias("timed"),
    )


def load_refused(spark, folder):
    """The log of a load in which a brand's key repeats."""
    brands = dirt.dirty_tables(spark, folder)["brands"].select("brand_id", F.lit("same").alias("brand_name"))
    database, out = f"retail_{uuid.uuid4().hex}", scratch_folder(spark, "refused")
    load.create_tables(spark, database, f"{out}/tables")
    log = load.append_tables({"brands": brands.unionAll(brands)}, database, spark)
    return log.select("position", "table_name", "rows_appended", "ok", F.col("error").isNotNull().alias("has_cause"))


def _tidy(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Tables that a checked load takes: states fit their columns, no line's key repeats, and orders without lines, so
    without staff, are left out."""
    tables = {name: view(spark, folder) for name, view in starschema.VIEWS.items()}
    tables["customers"] = tables["customers"].withColumns(
        {"state": F.left("state", F.lit(10)), "first_name": F.col("full_name"), "last_name": F.lit("Tidy")}
    )
    tables["orders"] = tables["orders"].filter("staff_id IS NOT NULL")
    tables["order_items"] = tables["order_items"].dropDuplicates(["order_id", "item_id"])
    return tables


def load_orphans(spark, folder):
    """Logs of two loads in which line items name products that do not exist: one table by table, one whole or not at all."""
    items = dirt.orphaned_items(spark, folder).dropDuplicates(["order_id", "item_id"])
    sources = {**_tidy(spark, folder), "order_items": items}
    logs = []
    for whole in (False, True):
        database, out = f"retail_{uuid.uuid4().hex}", scratch_folder(spark, "orphans")
        load.create_tables(spark, database, f"{out}/tables")
        log = load.append_tables(sources, database, spark, whole=whole)
        left = profile.shapes(load.target_tables(spark, database)).select("table_name", F.col("row_count").alias("rows_left"))
        logs.append(log.join(left, "table_name").select(
            F.lit(whole).alias("whole"), "position", "table_name", "rows_appended", "ok", "rows_left",
            F.nullif(F.regexp_extract("error", r"[a-z_.]+ -> [a-z_.]+", 0), F.lit("")).alias("broken"),
        ))
    return reduce(DataFrame.unionByName, logs)


def strict_run(spark, folder):
    """A whole run over tidy raw files with every check of the load in force."""
    raw, out = scratch_folder(spark, "tidy"), scratch_folder(spark, "strict")
    tidy = {
        name: df.select(*[c for c in TABLES[name].columns if c in df.columns and c not in TABLES[name].derived])
        for name, df in _tidy(spark, folder).items()
    }
    together(partial(_csv, df, f"{raw}/{name}.csv") for name, df in tidy.items())
    return job.run(spark, raw, out).select("stage", "ok", F.col("error").isNull().alias("quiet"))


QUERIES: dict[str, Query] = {
    "src_csv_load": csv_load,
    "src_encoding_probe": encoding_probe,
    "src_mixed_folder": mixed_folder,
    "src_cleaned_required": cleaned_required,
    "snk_cleaned_roundtrip": cleaned_roundtrip,
    "snk_reports_nonempty": reports_nonempty,
    "snk_schema_conform": schema_conform,
    "snk_append": append,
    "load_reconcile": reconcile,
    "load_refused": load_refused,
    "load_orphans": load_orphans,
    "load_pk_violations": key_violations,
    "load_fk_violations": reference_violations,
    "load_notnull_violations": not_null_violations,
    "job_stage_log": stage_log,
    "job_strict_run": strict_run,
}
