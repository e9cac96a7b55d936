"""Runs a query in Spark and its oracle in DuckDB and compares the rows exactly."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _sort_key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(row[i] for i in order) for row in rows), key=_sort_key
    )


def same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isclose(a, b, rel_tol=1e-12) or (math.isnan(a) and math.isnan(b))
    return type(a) is type(b) and a == b


def difference(df, con, sql) -> str | None:
    """None if equal, else a short description of the first difference."""
    columns, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names, want = rows_of([d[0] for d in result.description], result.fetchall())
    if columns != names:
        return f"columns {columns} != {names}"
    if len(got) != len(want):
        return f"{len(got)} rows, oracle has {len(want)}: {got[:3]} / {want[:3]}"
    for a, b in zip(got, want):
        if not all(same(x, y) for x, y in zip(a, b)):
            return f"{columns}\n  spark  {a}\n  oracle {b}"
    return None
