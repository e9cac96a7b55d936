"""Key, reference and NOT NULL checks. Spark enforces none of them, so they report."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from retailspark.schemas import TABLES


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def key_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per table: repeated keys, rows beyond the first of a key, rows with a NULL in the key."""
    return _union([_key_violations(df, name) for name, df in tables.items()])


def _key_violations(df: DataFrame, name: str) -> DataFrame:
    key = list(TABLES[name].key)
    counted = df.groupBy(*key).agg(F.count("*").alias("n"))
    incomplete = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in key])
    repeated = ~incomplete & (F.col("n") > 1)
    return counted.agg(
        F.count_if(repeated).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(repeated, F.col("n") - 1)), F.lit(0)).alias("extra_rows"),
        F.coalesce(F.sum(F.when(incomplete, F.col("n"))), F.lit(0)).alias("null_key_rows"),
    ).select(F.lit(name).alias("table_name"), F.lit(", ".join(key)).alias("key_columns"), "*")


def reference_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per reference: child rows and distinct child keys without a parent, NULL left out."""
    return _union([
        _lost_keys(tables[name], name, column, tables[parent])
        for name, table in TABLES.items()
        for column, (parent, _) in table.references.items()
        if name in tables and parent in tables
    ])


def lost_references(child: DataFrame, name: str, parents: Mapping[str, DataFrame]) -> DataFrame:
    """The same for the references of one table."""
    return _union([
        _lost_keys(child, name, column, parents[parent]) for column, (parent, _) in TABLES[name].references.items()
    ])


def _lost_keys(child: DataFrame, name: str, column: str, parent_rows: DataFrame) -> DataFrame:
    """Children are counted by key first, so a frequent key is one row in the join."""
    parent, parent_key = TABLES[name].references[column]
    keys = child.select(F.col(column).alias("k")).filter("k is not null")
    parents = parent_rows.select(F.col(parent_key).alias("k"))
    lost = keys.groupBy("k").agg(F.count("*").alias("n")).join(parents, "k", "left_anti")
    return lost.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("violating_rows"), F.count("*").alias("violating_keys")
    ).select(F.lit(f"{name}.{column} -> {parent}.{parent_key}").alias("reference"), "*")


def not_null_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per NOT NULL column: number of NULLs."""
    frames = []
    for name, table in TABLES.items():
        if name not in tables or not table.not_null:
            continue
        counts = tables[name].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in table.not_null])
        frames.append(
            counts.unpivot([], list(table.not_null), "column_name", "null_rows").select(
                F.lit(name).alias("table_name"), "column_name", "null_rows"
            )
        )
    return _union(frames)
