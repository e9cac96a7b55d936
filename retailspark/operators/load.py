"""Sinks: cleaned tables, report files, and the typed target tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from retailspark.functions import dates, numbers
from retailspark.operators import constraints
from retailspark.schemas import TABLES, Table
from retailspark.session import together

LOG_SCHEMA = (
    "position int, table_name string, rows_appended bigint, rows_after bigint, ok boolean, error string"
)
REPORT_LOG_SCHEMA = "report string, row_count bigint, written boolean, error string"


def write_cleaned(tables: Mapping[str, DataFrame], folder: str, file_format: str = "parquet") -> None:
    """Overwrite ``folder/cleaned_<name>`` for each table."""
    for name, df in tables.items():
        writer = df.write.mode("overwrite").format(file_format)
        if file_format == "csv":
            writer = writer.option("header", True)
        writer.save(f"{folder}/cleaned_{name}")


def write_reports(
    reports: Mapping[str, Callable[[], DataFrame]], folder: str, run_id: str, spark: SparkSession
) -> DataFrame:
    """Write each report as CSV with header to ``folder/run_id/<name>``.

    A failing report is noted and the others go on; an empty one leaves no file.
    Results are stored once as Parquet, so the emptiness test and the CSV do not run
    the query again.
    """
    def written(name: str, build: Callable[[], DataFrame]) -> tuple:
        try:
            stored = f"{folder}/{run_id}/_stored/{name}"
            build().write.mode("overwrite").parquet(stored)
            result = spark.read.parquet(stored)
            rows = result.count()
            if rows:
                result.write.mode("overwrite").option("header", True).csv(
                    f"{folder}/{run_id}/{name}"
                )
            return name, rows, rows > 0, None
        except Exception as error:  # one bad report must not stop the run
            return name, None, False, str(error)

    log = together(partial(written, name, build) for name, build in reports.items())
    return spark.createDataFrame(log, REPORT_LOG_SCHEMA)


# -------------------------------------------------------------- typed tables


def _target(df: DataFrame, table: Table, name: str) -> Column:
    kind, _ = table.columns[name]
    if name not in df.columns:
        return F.lit(None).cast(table.schema[name].dataType)
    source = df.schema[name].dataType.simpleString()
    c = F.col(name)
    if kind == "int":
        return numbers.whole(c, source)
    if kind == "float":
        return numbers.number(c, source)
    if kind == "time":
        return dates.parse_timestamp(c, source)
    return c.cast("string")


def conform(df: DataFrame, name: str, strict: bool = False) -> DataFrame:
    """The columns of table ``name``, in order and typed; absent ones are NULL.

    ``strict`` fails the job on a value that its type or length cannot hold.
    """
    table = TABLES[name]
    if not strict:
        return df.select(*[_target(df, table, c).alias(c) for c in table.columns])
    columns = []
    for c in table.columns:
        value = _target(df, table, c)
        if c in df.columns:
            bad = F.col(c).isNotNull() & value.isNull()
            if c in table.lengths:
                bad = bad | (F.length(c) > table.lengths[c])
            cause = F.concat(F.lit(f"{name}.{c} cannot hold: "), F.left(F.col(c).cast("string"), F.lit(100)))
            value = F.when(bad, F.raise_error(cause)).otherwise(value)
        columns.append(value.alias(c))
    return df.select(*columns)


def refused(new: DataFrame, name: str, old: DataFrame | None = None, parents: Mapping[str, DataFrame] | None = None) -> str | None:
    """Why the table's constraints refuse the ``new`` rows beside the ``old`` ones: keys that repeat, NULL where none may be,
    or references to rows that ``parents`` do not have. All are looked for in one job."""
    text = lambda *parts: F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])
    repeated, partial = F.col("repeated_keys"), F.col("null_key_rows")
    found = [
        constraints.key_violations({name: new if old is None else new.unionByName(old)}).filter((repeated > 0) | (partial > 0))
        .select(F.lit(0).alias("rank"), text(f"{name}: ", repeated, " repeated keys, ", partial, " rows without a full key").alias("cause"))
    ]
    if TABLES[name].not_null:
        found.append(constraints.not_null_violations({name: new}).filter("null_rows > 0").select(
            F.lit(1), text(f"{name}.", F.col("column_name"), ": ", F.col("null_rows"), " NULLs")
        ))
    if parents:
        found.append(constraints.lost_references(new, name, parents).filter("violating_rows > 0").select(
            F.lit(2), text(F.col("reference"), ": ", F.col("violating_rows"), " rows without a parent")
        ))
    causes = sorted((r.rank, r.cause) for r in reduce(DataFrame.unionAll, found).collect())  # one a constraint at most
    return causes[0][1] if causes else None


def conformance(df: DataFrame, name: str) -> DataFrame:
    """One row: values the target types cannot hold and texts beyond their length."""
    table = TABLES[name]
    shared = [c for c in table.columns if c in df.columns]
    lost = [F.count_if(F.col(c).isNotNull() & _target(df, table, c).isNull()) for c in shared]
    long = [F.count_if(F.length(c) > n) for c, n in table.lengths.items() if c in df.columns]
    return df.agg(
        F.count("*").alias("row_count"),
        reduce(lambda a, b: a + b, lost, F.lit(0).cast("bigint")).alias("lost_values"),
        reduce(lambda a, b: a + b, long, F.lit(0).cast("bigint")).alias("too_long"),
    ).select(
        F.lit(name).alias("table_name"),
        F.lit(len(table.columns)).cast("bigint").alias("column_count"),
        "*",
    )


# A load writes its rows to a partition of its own in each table's store. Views show the partitions of committed loads
# only, and a load commits by one insert into the table of commits, so all of its tables appear at once or none does.
COMMITS = "load_commits"


def _store(database: str, name: str) -> str:
    return f"{database}.rows_{name}"


def create_tables(spark: SparkSession, database: str, location: str) -> None:
    """(Re)create the nine empty tables of ``database`` under ``location``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    for name in reversed(TABLES):
        spark.sql(f"DROP VIEW IF EXISTS {database}.{name}")
        spark.sql(f"DROP TABLE IF EXISTS {_store(database, name)}")
    spark.sql(f"DROP TABLE IF EXISTS {database}.{COMMITS}")
    spark.sql(f"CREATE TABLE {database}.{COMMITS} (load_id string, table_name string) USING parquet")
    for name, table in TABLES.items():
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema)
        spark.sql(
            f"CREATE TABLE {_store(database, name)} ({columns}, load_id string) USING parquet PARTITIONED BY (load_id)"
        )
        spark.sql(
            f"CREATE VIEW {database}.{name} AS SELECT {', '.join(table.columns)} FROM {_store(database, name)}"
            f" WHERE load_id IN (SELECT load_id FROM {database}.{COMMITS} WHERE table_name = '{name}')"
        )


def _staged(spark: SparkSession, database: str, name: str, load_id: str) -> DataFrame:
    """What this load has written for the table, committed or not."""
    rows = spark.table(_store(database, name)).filter(F.col("load_id") == load_id)
    return rows.select(*TABLES[name].columns)


def _stage(rows: DataFrame, database: str, name: str, load_id: str) -> None:
    """Write the rows beside the table, in place of what a broken attempt of the same load has left."""
    rows.sparkSession.sql(
        f"INSERT OVERWRITE {_store(database, name)} PARTITION (load_id = '{load_id}') SELECT * FROM {{rows}}", rows=rows
    )


def _withdraw(spark: SparkSession, database: str, name: str, load_id: str) -> None:
    spark.sql(f"ALTER TABLE {_store(database, name)} DROP IF EXISTS PARTITION (load_id = '{load_id}')")


def committed(spark: SparkSession, database: str, load_id: str) -> set[str]:
    """Tables that this load has filled."""
    rows = spark.table(f"{database}.{COMMITS}").filter(F.col("load_id") == load_id).select("table_name")
    return {r.table_name for r in rows.distinct().collect()}  # nine at most


def append_tables(
    tables: Mapping[str, DataFrame],
    database: str,
    spark: SparkSession,
    check: bool = True,
    whole: bool = False,
    load_id: str | None = None,
) -> DataFrame:
    """Append to the target tables, parents first; stops at the first failure and logs its cause.

    Absent tables are skipped. Values that a column cannot hold, repeated or NULL keys, NULLs in NOT NULL columns and
    references without a parent are refused unless ``check`` is off. All rows are written once, beside the tables, and
    looked at there together with the rows the tables have. Then all tables that passed are committed in one step; with
    ``whole`` none is, unless all have passed. Until then nobody sees any of the rows. A table that the load ``load_id``
    has committed before is left as it is, so a load may be repeated.
    """
    load_id = load_id or uuid.uuid4().hex
    done = committed(spark, database, load_id)
    log, passed, failure = [], [], None
    for position, name in enumerate(TABLES, start=1):
        if name not in tables:
            continue
        if name in done:
            log.append((position, name, 0, spark.table(f"{database}.{name}").count(), True, None))
            continue
        try:
            _stage(conform(tables[name], name, strict=check), database, name, load_id)
            new = _staged(spark, database, name, load_id)
            if check:
                parents = {p for p, _ in TABLES[name].references.values()}
                seen = {
                    p: _staged(spark, database, p, load_id).unionByName(spark.table(f"{database}.{p}")) for p in parents
                }
                cause = refused(new, name, spark.table(f"{database}.{name}"), seen)
                if cause:
                    raise ValueError(cause)
        except Exception as error:  # the cause goes to the log
            _withdraw(spark, database, name, load_id)
            failure = name
            log.append((position, name, 0, spark.table(f"{database}.{name}").count(), False, str(error)[:2000]))
            break
        passed.append(name)
        rows = new.count()
        log.append((position, name, rows, spark.table(f"{database}.{name}").count() + rows, True, None))
    if whole and failure:
        for name in passed:
            _withdraw(spark, database, name, load_id)
        log = [
            (position, name, 0, after - rows, False, f"withdrawn with {failure}" if name in passed else error)
            for position, name, rows, after, _, error in log
        ]
    elif passed:
        commits = spark.createDataFrame([(load_id, name) for name in passed], "load_id string, table_name string")
        commits.coalesce(1).write.insertInto(f"{database}.{COMMITS}")
    return spark.createDataFrame(log, LOG_SCHEMA)


def target_tables(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    return {name: spark.table(f"{database}.{name}") for name in TABLES}


def append_jdbc(df: DataFrame, name: str, url: str, properties: Mapping[str, str]) -> None:
    """Append to a table of an outside database the caller names."""
    conform(df, name).write.jdbc(url, name, mode="append", properties=dict(properties))


def reconcile(source: Mapping[str, DataFrame], target: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts on both sides of the load, per table."""
    none = F.lit(None).cast("bigint")
    counts = []
    for name in source:
        counts.append(
            source[name].agg(F.count("*").alias("s")).select(
                F.lit(name).alias("table_name"), "s", none.alias("t")
            )
        )
        if name in target:
            counts.append(
                target[name].agg(F.count("*").alias("t")).select(
                    F.lit(name).alias("table_name"), none.alias("s"), "t"
                )
            )
    both = reduce(DataFrame.unionByName, counts).groupBy("table_name").agg(
        F.max("s").alias("source_rows"), F.max("t").alias("target_rows")
    )
    return both.withColumn(
        "ok", F.coalesce(F.col("source_rows") == F.col("target_rows"), F.lit(False))
    )
