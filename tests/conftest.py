import contextlib
import io
import os

import pytest

from retailspark.session import local_session

SMALL = os.environ.get("RETAILSPARK_TESTDATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("8", **{
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    yield session
    session.stop()


@pytest.fixture
def text_table(spark):
    """A table of text columns from rows of Python values."""

    def make(columns, rows):
        schema = ", ".join(f"`{c}` string" for c in columns.split())
        return spark.createDataFrame([tuple(r) for r in rows], schema)

    return make


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan_of(df, mode="extended"):
    """What ``explain`` prints; the optimized logical plan alone for ``optimized``."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode="extended" if mode == "optimized" else mode)
    text = out.getvalue()
    if mode == "optimized":
        text = text.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    return text
