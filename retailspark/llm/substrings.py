"""Passages that documents repeat from earlier ones (operator 11): seed and extend.

A window is ``LENGTH`` consecutive words of a document. A word is removed if it lies in a window whose words also start
somewhere in a document with a smaller doc_id.

1. Equal texts are one text with the least of their doc_ids. In all other documents that have it, every window repeats.
2. Seeds: of the runs of ``SEED`` words in a window, the one with the smallest hash (the last such) is the window's
   anchor. It depends on the window's words only, so equal windows have equal anchors at equal offsets, and each window
   belongs to one anchor. Only anchors that several texts have go on: they are counted, and joined with their places.
3. Extension: the places of an anchor meet with the words on both sides. All matches between them grow word by word to
   the left and to the right at the same time: places stay in one class as long as their words agree. The class of a
   window at a given offset is that of its left part with that of its right part, and the least doc_id of each class
   decides about all others. So no pairs are made, and a group costs as much as its rows.
4. Overlapping repeated windows are merged: maximal repeats, in words from ``start`` to ``stop``.

An anchor with more than ``GROUP`` places is dealt into that many groups as it takes, by text. Each group then names the
least doc_id of each of its windows, and the least over all groups decides. Places of one text with the same anchor and the
same words around them are one row, so a text of one repeated word does no harm.

Words are runs without white space, compared as they are, by 64-bit hashes: fifty of them in a row agree by chance with a
probability that does not matter at any size. Null text has no words. A null doc_id counts as the greatest number. Repeated
rows and equal doc_ids do not repeat one another: none is smaller. Texts are taken whole; those shorter than a window stay
as they are, but for the white space between words. An empty table gives no rows. Other columns are left behind.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailspark.llm import sketches
from retailspark.llm.common import portable, staged

LENGTH = 50
SEED = 10
GROUP = 4096  # places of an anchor that are extended together
BATCH = 16384  # places that are held at a time, at least one group
TEXTS = 256  # texts that are hashed at a time
GREATEST = (1 << 63) - 1

_BASE = np.uint64(0xD6E8FEB86659FD93)


def rolled(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` words; the array has words to spare at its end."""
    count = len(words) - size + 1
    total = np.zeros(max(count, 0), np.uint64)
    for j in range(size if count > 0 else 0):
        total = total * _BASE + words[j : j + count]
    return sketches.mix(total)


def lowest(values: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` values, the place of its smallest one, of equal ones the last."""
    place, reach = np.arange(len(values)), 1
    while 2 * reach <= width:
        place = _lower(values, place[: len(place) - reach], place[reach:])
        reach *= 2
    rest = width - reach
    return _lower(values, place[: len(place) - rest], place[rest:]) if rest else place


def _lower(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.where(values[a] < values[b], a, b)


def anchors(found: np.ndarray, edges: np.ndarray, length: int = LENGTH, seed: int = SEED):
    """(text, place, hash, least offset, greatest offset) of the anchors of each text: the windows that belong to an anchor
    start between the least and the greatest offset before it."""
    count = np.diff(edges)
    starts = int(edges[-1]) - length + 1
    none = np.zeros(0, np.int64)
    if starts <= 0 or not (count >= length).any():
        return none, none, np.zeros(0, np.uint64), none, none
    values = rolled(found, seed)
    place = lowest(values, length - seed + 1)[:starts]
    window = np.arange(starts)
    text = np.repeat(np.arange(len(count)), count)[:starts]
    whole = window + length <= edges[1:][text]
    window, place, text = window[whole], place[whole], text[whole]
    # the windows of one place stand in a row: the place never moves back from one window to the next
    first = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (text[1:] != text[:-1])]))
    last = np.concatenate([first[1:], [len(place)]]) - 1
    at = place[first]
    return text[first], at - edges[text[first]], values[at], at - window[last], at - window[first]


def _arrow(function, schema: str):
    """``function`` of record batches to lists of columns, as a function for ``mapInArrow``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        for columns in function(batches):
            if len(columns[0]):
                arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, arrow)]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return portable(run)


def _rows(batches, rows: int):
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, least, node, text): a null doc_id's stand-in, and the text's MD5."""
    doc_id, text = F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(GREATEST)).alias("least"),
        F.unhex(F.md5(text.cast("binary"))).alias("node"), text.alias("text"),
    )


def distinct_texts(rows: DataFrame) -> DataFrame:
    """(key, node, least, text): every text once, under its least doc_id and a number of its own."""
    counted = rows.groupBy("node", "least").agg(F.count("*").alias("copies"))
    firsts = counted.groupBy("node").agg(F.min_by(F.struct("least", "copies"), "least").alias("r"))
    firsts = firsts.select("node", "r.least", "r.copies")
    # joined on the pair, so that copies of a text are spread by their doc_ids
    held = rows.join(firsts, ["node", "least"]).select("node", "least", "text", "copies")
    once = held.filter("copies = 1").unionByName(held.filter("copies > 1").dropDuplicates(["node"]))
    numbered = once.select(F.monotonically_increasing_id().alias("key"), "node", "least", "text")
    return staged(numbered, "substring-texts")


def seeds(texts: DataFrame, length: int, seed: int) -> DataFrame:
    """(key, place, anchor, low, high) of every anchor of every text."""
    schema = "key long, place int, anchor long, low short, high short"

    def step(batches):
        for batch in _rows(batches, TEXTS):
            found, edges = sketches.words(batch.column(1).to_pylist(), fold=False)
            text, place, value, low, high = anchors(found, edges, length, seed)
            keys = np.asarray(batch.column(0))[text]
            yield keys, place.astype(np.int32), value.view(np.int64), low.astype(np.int16), high.astype(np.int16)

    return texts.select("key", "text").mapInArrow(_arrow(step, schema), schema)


def places(texts: DataFrame, length: int, seed: int, group: int) -> DataFrame:
    """Anchors that several texts have, with the words around them, a row for equal surroundings in a text."""
    every = staged(seeds(texts, length, seed), "substring-seeds")
    shared = every.groupBy("anchor").agg(
        F.count("*").alias("n"), F.min("key").alias("a"), F.max("key").alias("b")
    ).filter("a <> b").select("anchor", F.ceil(F.col("n") / group).cast("int").alias("parts"))
    # Written, so that the join has two plain shuffles, and Spark splits the places of a hot anchor.
    shared = staged(shared, "substring-shared")
    listed = every.join(shared, "anchor").groupBy("key").agg(
        F.collect_list(F.struct("place", "anchor", "low", "high", "parts")).alias("seeds")
    )
    side = length - seed  # the most words before or behind an anchor that a window reaches
    width = 2 * side + seed
    schema = (
        "anchor long, parts int, least long, key long, low short, high short, places array<int>, around binary"
    )

    def step(batches):
        for batch in _rows(batches, TEXTS):
            found, edges = sketches.words(batch.column(2).to_pylist(), fold=False)
            padded = np.concatenate([np.zeros(side, np.uint64), found, np.zeros(side + seed, np.uint64)])
            column = batch.column(3)
            counts = np.diff(np.asarray(column.offsets))
            fields = column.flatten()
            place, anchor, low, high, parts = (np.asarray(fields.field(i)) for i in range(5))
            text = np.repeat(np.arange(batch.num_rows), counts)
            # words beyond the text's ends count as none
            at = edges[text] + place
            column_at = at[:, None] + np.arange(width)[None, :]
            around = padded[column_at]
            real = column_at - side
            around[(real < edges[text][:, None]) | (real >= edges[1:][text][:, None])] = 0
            mark = sketches.mix(anchor.view(np.uint64) + (low * 256 + high).astype(np.uint64) * _BASE)
            for j in range(width):
                mark = mark * _BASE + around[:, j]
            mark = sketches.mix(mark ^ sketches.mix(text.astype(np.uint64)))
            _, first, group_of = np.unique(mark, return_index=True, return_inverse=True)
            order = np.argsort(group_of, kind="stable")
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(np.bincount(group_of, minlength=len(first)))]), pa.int32()),
                pa.array(place[order], pa.int32()),
            )
            kept = np.ascontiguousarray(around[first])
            held = pa.Array.from_buffers(
                pa.binary(), len(first),
                [None, pa.py_buffer((np.arange(len(first) + 1) * 8 * width).astype(np.int32)), pa.py_buffer(kept)],
            )
            key, least = (np.asarray(batch.column(i))[text[first]] for i in (0, 1))
            yield anchor[first], parts[first], least, key, low[first], high[first], lists, held

    joined = texts.select("key", "least", "text").join(listed, "key")
    return joined.mapInArrow(_arrow(step, schema), schema)


def extended(group: np.ndarray, least: np.ndarray, low: np.ndarray, high: np.ndarray, around: np.ndarray, length: int, seed: int):
    """(mask, leading): windows of each place that a smaller doc_id of its group has, a bit an offset; and for every
    offset the places of each window's least doc_id in the group, with the window's name, which all groups share.

    Rows stand in order of group and doc_id.
    """
    side = length - seed
    own = sketches.mix(group.astype(np.uint64) + np.uint64(1))
    right = np.zeros(len(group), np.uint64)
    for j in range(seed):  # the anchor's own words, lest two anchors share a hash
        right = sketches.mix(right * _BASE + around[:, side + j])
    rights = [right]
    for j in range(side):
        rights.append(sketches.mix(rights[-1] * _BASE + around[:, side + seed + j]))
    left = np.full(len(group), np.uint64(7))
    mask = np.zeros(len(group), np.int64)
    leading = []
    for offset in range(side + 1):
        if offset:
            left = sketches.mix(left * _BASE + around[:, side - offset])
        rows = np.flatnonzero((low <= offset) & (offset <= high))
        if not len(rows):
            continue
        window = sketches.mix(left[rows] * _BASE + rights[side - offset][rows])
        _, first, which = np.unique(window ^ own[rows], return_index=True, return_inverse=True)
        smallest = least[rows[first]][which]
        mask[rows[least[rows] > smallest]] |= 1 << offset
        leads = np.flatnonzero(least[rows] == smallest)
        leading.append((rows[leads], offset, window[leads]))
    return mask, leading


def matches(placed: DataFrame, length: int, seed: int) -> DataFrame:
    """(key, places, mask): places of a text whose windows at the offsets of the mask's bits start in an earlier document."""
    side, width = length - seed, 2 * (length - seed) + seed
    schema = "key long, places array<int>, mask long, window long, anchor long, least long"

    def settle(rows: pa.Table):
        rows = rows.combine_chunks()
        columns = {n: rows.column(n).chunk(0) for n in rows.column_names}
        anchor, part, least, key, low, high, parts = (
            np.asarray(columns[n]) for n in ("anchor", "part", "least", "key", "low", "high", "parts")
        )
        held = columns["around"]
        at = np.frombuffer(held.buffers()[1], np.int32)[held.offset]
        around = np.frombuffer(held.buffers()[2], np.uint8)[at : at + len(held) * 8 * width].view(np.uint64)
        around = around.reshape(len(held), width)
        group = np.cumsum(np.concatenate([[False], (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])]))
        mask, leading = extended(group, least, low, high, around, length, seed)
        hit = np.flatnonzero(mask)
        none = pa.nulls(len(hit), pa.int64())
        yield key[hit], columns["places"].take(pa.array(hit)), mask[hit], none, none, none
        # of anchors dealt into several groups, also the windows of each group's least doc_id
        for rows_at, offset, window in leading:
            wide = parts[rows_at] > 1
            rows_at = rows_at[wide]
            yield (
                key[rows_at], columns["places"].take(pa.array(rows_at)), np.full(len(rows_at), 1 << offset),
                window[wide].view(np.int64), anchor[rows_at], least[rows_at],
            )

    def step(batches):
        waiting: list[pa.RecordBatch] = []
        count = 0
        for batch in batches:
            waiting.append(batch)
            count += batch.num_rows
            if count < BATCH:
                continue
            rows = pa.Table.from_batches(waiting)
            anchor, part = (rows.column(n).to_numpy() for n in ("anchor", "part"))
            cut = np.flatnonzero((anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1]))
            if len(cut):
                whole = int(cut[-1]) + 1
                yield from settle(rows.slice(0, whole))
                waiting = rows.slice(whole).to_batches()
                count -= whole
        if count:
            yield from settle(pa.Table.from_batches(waiting))

    dealt = placed.withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int"))
    dealt = dealt.repartition("anchor", "part").sortWithinPartitions("anchor", "part", "least", "key")
    settled = staged(dealt.mapInArrow(_arrow(step, schema), schema), "substring-matches")
    # A group has the least doc_id of each of its windows once or, if the text repeats it, a few times.
    leading = settled.filter("window IS NOT NULL")
    least = leading.groupBy("anchor", "window").agg(F.min("least").alias("first"))
    across = leading.join(least, ["anchor", "window"]).filter("least > first")
    return settled.filter("window IS NULL").select("key", "places", "mask").unionByName(
        across.select("key", "places", "mask")
    )


def _covered(count: int, hits: list, length: int) -> np.ndarray:
    """Which of ``count`` words the hit windows cover."""
    turns = np.zeros(count + 1, np.int64)
    for hit in hits:
        at = np.array(hit["places"], np.int64)
        for offset in range(64):
            if hit["mask"] >> offset & 1:
                np.add.at(turns, at - offset, 1)
                np.add.at(turns, at - offset + length, -1)
    return np.cumsum(turns[:-1]) > 0


_BREAKS = {c: " " for c in "\t\n\v\f\r"}


def split(text: str) -> list[str]:
    """The words of a text: runs without blank, tab, line feed, vertical tab, form feed and carriage return."""
    return [w for w in text.translate(str.maketrans(_BREAKS)).split(" ") if w]


def repeats_removed(docs: DataFrame, length: int = LENGTH, seed: int = SEED, group: int = GROUP) -> DataFrame:
    """doc_id, n_words, n_removed, repeats (maximal runs of repeated words, ``start`` to before ``stop``) and the words kept,
    with one blank in between, of every row."""
    if not 1 <= length - seed <= 62:
        raise ValueError("a window must be 1 to 62 words longer than a seed")
    rows = keyed(docs)
    texts = distinct_texts(rows)
    found = matches(places(texts, length, seed, group), length, seed)
    hits = found.groupBy("key").agg(F.collect_list(F.struct("places", "mask")).alias("hits"))
    firsts = texts.select("key", "node", "least").join(hits, "key", "left").select(
        "node", "least", F.lit(True).alias("first"), "hits"
    )
    # A row that is not its text's first has that text in a smaller document.
    joined = rows.join(firsts, ["node", "least"], "left").select("doc_id", "text", "first", "hits")
    schema = "doc_id long, n_words long, n_removed long, repeats array<struct<start:int,stop:int>>, text string"

    def step(batches):
        for batch in _rows(batches, TEXTS):
            out = ([], [], [], [], [])
            for text, first, hits in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                words = split(text)
                n, spans, gone = len(words), [], 0
                if not first and n >= length:
                    spans, gone, words = [(0, n)], n, []
                elif hits:
                    away = _covered(n, hits, length)
                    turns = np.flatnonzero(np.diff(np.concatenate([[False], away, [False]]).astype(np.int8))).tolist()
                    spans, gone = list(zip(turns[::2], turns[1::2])), int(away.sum())
                    words = [w for w, a in zip(words, away.tolist()) if not a]
                for column, value in zip(out[1:], (n, gone, [{"start": a, "stop": b} for a, b in spans], " ".join(words))):
                    column.append(value)
            yield batch.column(0), *out[1:]

    return joined.mapInArrow(_arrow(step, schema), schema)
