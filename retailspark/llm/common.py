"""Small helpers of the operators: reading columns, staging tables, mapping Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Collection, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailspark.session import portable, scratch_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str, compression: str = "zstd") -> DataFrame:
    """``df`` written to the shared folder and read back: later jobs neither recompute nor hold its lineage."""
    spark = df.sparkSession
    folder = scratch_folder(spark, label)
    df.write.option("compression", compression).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def id_and_text(docs: DataFrame) -> DataFrame:
    """The two columns that text operators need; a null text counts as empty, other columns are left behind."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def give_back() -> None:
    """What a task has freed goes back to the system; its worker lives on and other workers need the memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone keeps freed memory and has this
    if trim:
        trim(0)


_kept: dict = {}  # what this worker process keeps from task to task, by its key
_asked: set = set()  # the keys that the task at work has asked for


def kept(key, build: Callable):
    """``build()``, made once in a worker process and kept for as long as its tasks ask for it when they begin."""
    _asked.add(key)
    if key not in _kept:
        _kept[key] = build()
    return _kept[key]


def begun(make: Callable):
    """``make()`` for a task that begins. What earlier tasks have kept and this one does not ask for is let go: the worker
    outlives its stage, and later stages need the memory."""
    _asked.clear()
    step = make()
    left = [key for key in _kept if key not in _asked]
    for key in left:
        del _kept[key]
    if left:
        give_back()
    return step


def map_rows(
    df: DataFrame, make: Callable[[], Callable[[list[tuple]], Iterator[tuple]]], schema: str, rows: int = 512
) -> DataFrame:
    """Rows of ``schema`` that ``make()``'s function yields for each group of at most ``rows`` input rows.

    ``make`` runs once a task, so that a task's counters start afresh when it is repeated.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        step = begun(make)
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                out = list(step(list(zip(*(c.to_pylist() for c in part.columns)))))
                if out:
                    columns = [pa.array(c, f.type) for c, f in zip(zip(*out), arrow)]
                    yield pa.RecordBatch.from_arrays(columns, schema=arrow)
        del step
        give_back()

    return df.mapInArrow(portable(run), schema)


def join_checked(left: DataFrame, right: DataFrame, on: list[str], most_rows: int = 2_000_000) -> DataFrame:
    """Inner join with a written table: broadcast if its rows, of a few numbers each, are at most ``most_rows``;
    by shuffle otherwise."""
    return left.join(F.broadcast(right) if right.count() <= most_rows else right, on)


def append_columns(
    df: DataFrame, inputs: list[str], make: Callable[[], Callable[[list[tuple]], list[tuple]]], schema: str, without: Collection[str] = ()
) -> DataFrame:
    """``df`` with the columns of ``schema`` behind its own: ``make()``'s function gets rows of the ``inputs`` columns and
    gives one tuple for each. Columns ``without`` go no further than the tasks."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType, _parse_datatype_string

    new = _parse_datatype_string(schema)
    arrow, places = to_arrow_schema(new), [df.columns.index(c) for c in inputs]
    left = [i for i, c in enumerate(df.columns) if c not in without]
    names = [*(df.columns[i] for i in left), *arrow.names]

    def run(batches):
        step = begun(make)
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                out = step(list(zip(*(part.column(i).to_pylist() for i in places))))
                columns = [pa.array(c, f.type) for c, f in zip(zip(*out), arrow)]
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in left), *columns], names=names)
        del step
        give_back()

    return df.mapInArrow(portable(run), StructType([*(df.schema.fields[i] for i in left), *new.fields]))
