"""Records of CSV files with line breaks inside quotes, found by many tasks per file.

A line of such a file may begin inside a quoted field, which its own text does not tell. What a line does to that state
does not depend on what came before it, though: there is one outcome if it begins outside of quotes and one if it begins
inside. So a first pass reduces every byte range of a file to these two outcomes, a scan over the ranges' outcomes tells
the state at the start of each, and a second pass puts the lines together. Records that cross from one range into the next
are the only ones to be moved.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from retailspark.session import portable

# Fields as the reader sees them: quoted, with whatever stands behind the closing quote up to the comma, or plain.
_CLOSED = rb'"(?:[^"]|"")*+"[^,]*+'
_OPENS = re.compile(rb'(?:(?:' + _CLOSED + rb'|[^",][^,]*+|),)*"(?:[^"]|"")*+\Z')
_CLOSES = re.compile(rb'(?:[^"]|"")*+"[^,]*+')


def opens(line: bytes) -> bool:
    """Whether a line that begins outside of quotes ends inside."""
    return b'"' in line and _OPENS.match(line) is not None


def stays(line: bytes) -> bool:
    """Whether a line that begins inside of quotes ends inside."""
    if b'"' not in line:
        return True
    closed = _CLOSES.match(line)
    if closed is None:
        return True
    rest = line[closed.end() :]
    return rest.startswith(b",") and opens(rest[1:])


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line with its file and the start of its byte range, in order within a task."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.col("value").cast("binary").alias("line"),
    )


def _outcomes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, start, state at the end if it begins outside, if inside) of each byte range of the task."""
    key, outside, inside, done = None, False, True, []
    for batch in batches:
        for file, start, line in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if (file, start) != key:
                if key is not None:
                    done.append((*key, outside, inside))
                key, outside, inside = (file, start), False, True
            if b'"' in line:
                first, second = opens(line), stays(line)
                outside, inside = second if outside else first, second if inside else first
    if key is not None:
        done.append((*key, outside, inside))
    if done:
        files, starts, outsides, insides = zip(*done)
        yield pa.RecordBatch.from_arrays(
            [pa.array(files), pa.array(starts, pa.int64()), pa.array(outsides), pa.array(insides)],
            names=["file", "start", "outside", "inside"],
        )


def _states(lines: DataFrame) -> DataFrame:
    """(file, start, quoted): whether the byte range begins inside of quotes; one row a range.

    A range whose two outcomes are the same settles the state behind it; one that exchanges them turns it around.
    """
    ranges = lines.mapInArrow(portable(_outcomes), "file string, start long, outside boolean, inside boolean")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    turned = F.coalesce(F.sum((F.col("outside") & ~F.col("inside")).cast("int")).over(before), F.lit(0))
    counted = ranges.withColumn("turned", turned)
    own = F.when(F.col("outside") & ~F.col("inside"), 1).otherwise(0)
    settled = F.max(F.when(
        F.col("outside") == F.col("inside"), F.struct("start", F.col("outside").cast("int").alias("state"), (F.col("turned") + own).alias("turned"))
    )).over(before)
    return counted.withColumn("settled", settled).select(
        "file", "start",
        ((F.coalesce("settled.state", F.lit(0)) + F.col("turned") - F.coalesce("settled.turned", F.lit(0))) % 2 == 1).alias("quoted"),
    )


WHOLE, HEAD, TAIL = 0, 1, 2
_RECORDS = "file string, start long, number long, part int, record binary"


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records, and of each byte range the end of the record it begins in and the start of the one it ends in."""
    key, number, held, part, quoted = None, 0, [], WHOLE, False

    def put(out, kind):
        nonlocal number, held
        out.append((*key, number, kind, b"\n".join(held)))
        number, held = number + 1, []

    def batch_of(rows):
        files, starts, numbers, parts, records = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(files), pa.array(starts, pa.int64()), pa.array(numbers, pa.int64()), pa.array(parts, pa.int32()),
             pa.array(records, pa.binary())],
            names=["file", "start", "number", "part", "record"],
        )

    for batch in batches:
        out = []
        for file, start, line, state in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if (file, start) != key:
                if held:  # the range before ended inside of quotes
                    put(out, HEAD if part == HEAD else TAIL)
                key, number, quoted = (file, start), 0, state
                part = HEAD if quoted else WHOLE
            held.append(line)
            quoted = stays(line) if quoted else opens(line)
            if not quoted:
                put(out, part)
                part = WHOLE
        if out:
            yield batch_of(out)
    if held:
        out = []
        put(out, HEAD if part == HEAD else TAIL)
        yield batch_of(out)


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, number, record): the records of all files at ``path`` as bytes, headers among them.

    The header of a file is its record with start 0 and number 0. Line breaks are LF or CR LF; those inside quotes are kept.
    """
    lines = _lines(spark, path)
    # One row a byte range, that is, a task or part of one: what the driver knows of each anyway.
    placed = lines.join(F.broadcast(_states(lines)), ["file", "start"], "left").select("file", "start", "line", "quoted")
    unknown = F.raise_error(F.lit(f"byte ranges of {path} changed between two passes")).cast("boolean")
    found = placed.withColumn("quoted", F.coalesce("quoted", unknown)).mapInArrow(portable(_assembled), _RECORDS)
    whole = found.filter(F.col("part") == WHOLE).select("file", "start", "number", "record")

    # A tail opens a group, and the heads behind it belong to it, several if a record is longer than a range.
    pieces = found.filter(F.col("part") != WHOLE)
    order = Window.partitionBy("file").orderBy("start", "part")
    grouped = pieces.withColumn("group", F.sum((F.col("part") == TAIL).cast("int")).over(order))
    listed = F.sort_array(F.collect_list(F.struct("start", "part", "number", F.col("record").cast("string").alias("text"))))
    joined = grouped.groupBy("file", "group").agg(listed.alias("pieces")).select(
        "file", F.col("pieces")[0]["start"].alias("start"), F.col("pieces")[0]["number"].alias("number"),
        F.array_join(F.transform("pieces", lambda p: p["text"]), "\n").cast("binary").alias("record"),
    )
    return whole.unionByName(joined)


def texts(found: DataFrame, encoding: Column) -> DataFrame:
    """(file, header, record): the records as text; empty lines are left out.

    Where lines end in CR LF, those inside quotes become LF, as with Spark's own reader.
    """
    raw = F.col("record")
    text = F.when(encoding == "UTF-8", raw.cast("string")).otherwise(F.decode(raw, "ISO-8859-1"))
    text = F.when(F.endswith(text, F.lit("\r")), F.regexp_replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), "\r$", "")).otherwise(text)
    rows = found.select(
        "file", ((F.col("start") == 0) & (F.col("number") == 0)).alias("header"), text.alias("record"),
    )
    return rows.filter(F.trim("record") != "")
