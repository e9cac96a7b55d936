"""Packing by minimum bin slack (operator 4).

Each document's ids, with an end id, are cut into whole windows and a remainder shorter than a window. A histogram of
the remainders, at most one class a length, goes to the driver. There each window is seeded with the longest length left
and filled by a subset-sum over bitsets: bit s of a number says that the lengths taken so far can add up to s. The sum
nearest to the capacity is traced back to counts per class, and the same filling is repeated as often as the classes
allow, so the plan's size depends on the window's length and not on the number of documents. Where the nearest sum leaves
slack, one more remainder is cut to fill it and its rest becomes a new class. So all windows but the last are full.

A document finds its place by its rank in its class: its rank in the task that encoded it, which is stored beside the
ids, and the count of the class in earlier tasks.

Null text is empty: the end id alone. Repeated rows are packed as often as they occur. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retailspark.llm import pieces
from retailspark.llm.common import id_and_text, join_checked, map_rows, staged

CAPACITY = 1024
TOKENIZER = "byte_bpe_50k.json"
END = 0

STORED = "task int, doc_id long, size long, rest int, rank long, windows long, ids binary"
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "padded_length long"
)


@dataclass
class Use:
    """``count`` items of a class from ``first`` on: ``each`` of them stand in every window from ``window`` on."""

    first: int
    count: int
    each: int
    window: int
    offset: int
    length: int  # of the piece; shorter than the class's length where it is cut
    rest: int | None = None  # the class of what the cut leaves


@dataclass
class Class:
    length: int
    left: int
    uses: list[Use] = field(default_factory=list)

    @property
    def used(self) -> int:
        return self.uses[-1].first + self.uses[-1].count if self.uses else 0


def fill(classes: dict[int, Class], capacity: int) -> dict[int, int]:
    """Counts per class of the multiset whose lengths add up to the most that ``capacity`` holds."""
    longest = max(classes, key=lambda c: (classes[c].length, -c))
    target, full = capacity - classes[longest].length, 1 << (capacity - classes[longest].length)
    mask, sums, trace = (full << 1) - 1, 1, []
    # Common lengths first: a filling of them can be repeated often.
    for key in sorted(classes, key=lambda c: (-classes[c].left, c)):
        item = classes[key]
        most, times = min(item.left - (key == longest), target // item.length), 1
        while most > 0 and not sums & full:
            times = min(times, most)
            trace.append((key, times, item.length * times, sums))
            sums |= (sums << item.length * times) & mask
            most, times = most - times, times * 2
        if sums & full:
            break
    at, counts = sums.bit_length() - 1, {longest: 1}
    for key, times, length, before in reversed(trace):
        if not before >> at & 1:  # only with this step can the sum be reached
            counts[key] = counts.get(key, 0) + times
            at -= length
    return counts


def plan(histogram: dict[int, int], capacity: int, first: int = 0) -> tuple[dict[int, list[Use]], int]:
    """Uses of each class (a document's remainder of length n starts in class n), and the number of windows."""
    classes = {n: Class(n, c) for n, c in histogram.items() if c > 0 and n > 0}
    alive, window, fresh = dict(classes), first, capacity
    while alive:
        counts = fill(alive, capacity)
        slack = capacity - sum(alive[k].length * n for k, n in counts.items())
        cut = None
        if slack:
            able = [k for k, c in alive.items() if c.length > slack and c.left > counts.get(k, 0)]
            cut = max(able, key=lambda k: (alive[k].left - counts.get(k, 0), alive[k].length), default=None)
        need = {**counts, **({cut: counts.get(cut, 0) + 1} if cut is not None else {})}
        repeat, offset = min(alive[k].left // n for k, n in need.items()), 0
        for key, each in counts.items():
            item = alive[key]
            item.uses.append(Use(item.used, repeat * each, each, window, offset, item.length))
            offset, item.left = offset + each * item.length, item.left - repeat * each
        if cut is not None:
            item, fresh = alive[cut], fresh + 1
            item.uses.append(Use(item.used, repeat, 1, window, offset, slack, fresh))
            item.left -= repeat
            classes[fresh] = alive[fresh] = Class(item.length - slack, repeat)
        window += repeat
        alive = {k: c for k, c in alive.items() if c.left}
    return {k: c.uses for k, c in classes.items()}, window


def places(uses: dict[int, list[Use]], key: int, rank: int) -> Iterator[tuple[int, int, int]]:
    """Length, window and offset of the pieces of the remainder with this rank in its class, in order."""
    while key is not None:
        use = uses[key][bisect_right(uses[key], rank, key=lambda u: u.first) - 1]
        rank -= use.first
        yield use.length, use.window + rank // use.each, use.offset + rank % use.each * use.length
        key = use.rest


def encoded(docs: DataFrame, tokenizer: str, capacity: int, end: int) -> DataFrame:
    """Ids of each document, with its rank among the task's remainders of the same length and the windows before it."""

    def make():
        memory = pieces.held(pieces.ByteBpe, tokenizer)
        last, task = memory.pack([end]), TaskContext.get().partitionId()
        ranks, windows = np.zeros(capacity, np.int64).tolist(), 0

        def step(rows):
            nonlocal windows
            for (doc_id, _), ids in zip(rows, memory.encode([t for _, t in rows])):
                ids += last
                size = len(ids) // memory.dtype.itemsize
                whole, rest = divmod(size, capacity)
                yield task, doc_id, size, rest, ranks[rest], windows, ids
                ranks[rest] += 1
                windows += whole

        return step

    return map_rows(id_and_text(docs), make, STORED, rows=512)


def pack(
    docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end: int = END, with_ids: bool = False
) -> DataFrame:
    """One row a piece; ``with_ids`` adds the piece's ids as little-endian 16-bit numbers.

    ``padded_length`` is the length of the piece's sequence with padding: the capacity, or the number of its ids if that
    is a power of two.
    """
    tokenizer = tokenizer or pieces.path(TOKENIZER)
    tokens = staged(encoded(docs, tokenizer, capacity, end), "packing")
    # One row a task and class; class -1 weighs the whole windows.
    parts = (
        tokens.groupBy("task", "rest").agg(F.count("*").alias("n"), F.sum(F.floor(F.col("size") / capacity)).alias("w"))
    ).select("task", F.explode(F.array(
        F.struct("rest", "n"), F.struct(F.lit(-1).alias("rest"), F.col("w").alias("n"))
    )).alias("x")).groupBy("task", "x.rest").agg(F.sum("x.n").alias("n"))
    before = Window.partitionBy("rest").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    starts = staged(starts, "packing-starts")
    total = {r["rest"]: r["n"] for r in starts.groupBy("rest").agg(F.sum("n").alias("n")).collect()}  # capacity + 1 rows
    whole = total.pop(-1, 0)
    total.pop(0, None)
    uses, end_window = plan(total, capacity, whole)
    filled = last_fill(uses, end_window, capacity)
    schema = PIECES + (", ids binary" if with_ids else "")

    def make():
        def step(rows):
            for doc_id, size, rest, rank, windows, ids, before, whole_before in rows:
                ids = np.frombuffer(ids, "<u2").astype("<u4")
                found = [(capacity, whole_before + windows + k, 0) for k in range(size // capacity)]
                if rest:
                    found += places(uses, rest, before + rank)
                start = 0
                for length, window, offset in found:
                    part = ids[start : start + length]
                    row = (doc_id, start, length, zlib.crc32(part), size, window, offset,
                           filled if window == end_window - 1 and window >= whole else capacity)
                    yield (*row, part.astype("<u2").tobytes()) if with_ids else row
                    start += length

        return step

    ranked = join_checked(tokens, starts.filter("rest >= 0").select("task", "rest", "before"), ["task", "rest"])
    wholes = starts.filter("rest = -1").select("task", F.col("before").alias("whole_before"))
    ranked = join_checked(ranked, wholes, ["task"])
    return map_rows(
        ranked.select("doc_id", "size", "rest", "rank", "windows", "ids", "before", "whole_before"), make, schema
    )


def last_fill(uses: dict[int, list[Use]], end_window: int, capacity: int) -> int:
    """Padded length of the last window, the only one that may not be full."""
    filled = sum(
        use.each * use.length
        for class_uses in uses.values() for use in class_uses
        if use.window + use.count // use.each == end_window
    )
    return filled if filled and filled & (filled - 1) == 0 else capacity
