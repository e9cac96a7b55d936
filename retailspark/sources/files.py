"""Raw CSV and cleaned Parquet readers."""

from __future__ import annotations

from collections.abc import Iterable
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from retailspark.functions.text import null_if_na
from retailspark.schemas import TABLES
from retailspark.session import together
from retailspark.sources import records


def latin_files(spark: SparkSession, path: str) -> tuple[list[str], int]:
    """Which of the files at ``path`` hold a line that is not valid UTF-8, and how many files there are.

    The CSV reader replaces bad bytes silently, so they have to be looked for. One scan, a row a file to the driver, which
    has listed the files anyway.
    """
    lines = spark.read.text(path)
    bad = lines.filter(~F.is_valid_utf8("value")).select(F.col("_metadata.file_path").alias("file")).distinct()
    return sorted(r.file for r in bad.collect()), len(lines.inputFiles())


MIXED = "UTF-8 or ISO-8859-1 by file"


def pick_encoding(spark: SparkSession, path: str) -> str:
    """UTF-8, ISO-8859-1, or ``MIXED`` if some of the files are the one and some the other."""
    latin, files = latin_files(spark, path)
    return "UTF-8" if not latin else "ISO-8859-1" if len(latin) == files else MIXED


RECORD = "_malformed_record"


def read_csv(
    spark: SparkSession,
    path: str,
    encoding: str | None = None,
    multiline: bool = False,
    on_malformed: str = "raise",
) -> DataFrame:
    """A CSV with header, every column as text, NA tokens as NULL.

    Without ``encoding`` each file is read as UTF-8 if it is valid, and else as ISO-8859-1. ``multiline`` allows line breaks
    inside quotes; files in these two encodings are read by many tasks even so. A record with too many or too few fields
    fails the job when it is read; with ``on_malformed="quarantine"`` it is left out, and ``malformed_records`` has it.
    """
    if on_malformed not in ("raise", "quarantine"):
        raise ValueError(f"on_malformed must be 'raise' or 'quarantine', not {on_malformed!r}")
    df = _records(spark, path, encoding, multiline)
    fine = F.col(RECORD).isNull() & _read_too(df)
    if on_malformed == "raise":
        message = F.concat(F.lit(f"malformed record in {path}: "), F.left(F.col(RECORD), F.lit(200)))
        fine = F.when(fine, True).otherwise(F.raise_error(message).cast("boolean"))
    return normalise_na(df.filter(fine).drop(RECORD))


def malformed_records(
    spark: SparkSession, path: str, encoding: str | None = None, multiline: bool = False
) -> DataFrame:
    """(record, reason) of the records that do not have one field per column."""
    df = _records(spark, path, encoding, multiline)
    df = df.filter(F.col(RECORD).isNotNull() & _read_too(df))
    return df.select(F.col(RECORD).alias("record"), F.lit("wrong number of fields").alias("reason"))


def _read_too(df: DataFrame) -> Column:
    """True, from all data columns: Spark counts a record's fields only as far as the columns it has to read."""
    columns = [F.col(f"`{name.replace('`', '``')}`") for name in df.columns if name != RECORD]
    return F.length(F.coalesce(*columns, F.lit(""))) >= 0


def _records(spark, path: str, encoding: str | None, multiline: bool) -> DataFrame:
    latin: list[str] = []
    if encoding in (None, MIXED):
        latin, files = latin_files(spark, path)
        encoding = "UTF-8" if not latin else "ISO-8859-1" if len(latin) == files else MIXED
    byte_by_byte = encoding in ("UTF-8", "ISO-8859-1", MIXED)
    # Of mixed files, all are read as Latin-1, which keeps every byte, and then the UTF-8 ones are read again from these.
    reading = "ISO-8859-1" if encoding == MIXED else encoding
    options = {
        "header": "true", "inferSchema": "false", "encoding": reading, "escape": '"', "multiLine": str(multiline).lower(),
        "columnNameOfCorruptRecord": RECORD,
    }
    reader = spark.read.options(**options)
    names = reader.csv(path).columns
    if encoding == MIXED:
        names = [_again(n) for n in names]
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in [*names, RECORD])
    is_latin = F.col("_file").isin(latin) if encoding == MIXED else F.lit(encoding != "UTF-8")
    if multiline and byte_by_byte:
        rows = records.texts(
            records.records(spark, path).withColumn("_file", F.col("file")),
            F.when(is_latin, "ISO-8859-1").otherwise("UTF-8"),
        )
        parsed = F.from_csv("record", schema, {k: v for k, v in options.items() if k not in ("header", "encoding", "inferSchema")})
        return rows.filter(~F.col("header")).select(parsed.alias("r")).select("r.*")
    df = reader.schema(schema).csv(path)
    if encoding != MIXED:
        return df
    df = df.withColumn("_file", F.col("_metadata.file_path"))
    return df.select(*[
        F.when(is_latin, c).otherwise(F.encode(c, "ISO-8859-1").cast("string")).alias(n)
        for n, c in ((n, F.col(f"`{n.replace('`', '``')}`")) for n in [*names, RECORD])
    ])


def _again(name: str) -> str:
    """A column name that was read as Latin-1, as UTF-8 if it is."""
    try:
        return name.encode("latin-1").decode("utf-8")
    except UnicodeDecodeError:
        return name


def normalise_na(df: DataFrame) -> DataFrame:
    """NULL in place of NA tokens in every text column."""
    return df.select(
        *[
            null_if_na(F.col(f"`{name}`")).alias(name) if dtype == "string" else F.col(f"`{name}`")
            for name, dtype in df.dtypes
        ]
    )


def load_raw(
    spark: SparkSession,
    folder: str,
    names: Iterable[str] = tuple(TABLES),
    encoding: str | None = None,
    multiline: bool = False,
    on_malformed: str = "raise",
) -> tuple[dict[str, DataFrame], list[str]]:
    """Read ``folder/<name>.csv`` for each name; missing files are listed, not fatal.

    Naming the ``encoding`` saves the probe, which reads a clean file to its end.
    """
    names = list(names)

    def read(name: str) -> DataFrame | None:
        try:
            return read_csv(spark, f"{folder}/{name}.csv", encoding, multiline, on_malformed)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    tables = dict(zip(names, together(partial(read, name) for name in names)))
    return {n: df for n, df in tables.items() if df is not None}, [n for n in names if tables[n] is None]


def load_cleaned(
    spark: SparkSession, folder: str, names: Iterable[str] = tuple(TABLES)
) -> dict[str, DataFrame]:
    """Read ``folder/cleaned_<name>``; all must exist, or none is returned."""
    found, missing = {}, []
    for name in names:
        try:
            found[name] = spark.read.parquet(f"{folder}/cleaned_{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            missing.append(name)
    if missing:
        raise FileNotFoundError(f"cleaned tables missing in {folder}: {', '.join(missing)}")
    return found
