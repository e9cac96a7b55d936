"""Token ids in canonical, length-limited Huffman code (operator 6).

Ids are counted over all documents; package-merge turns the counts, at most one per vocabulary entry, into code lengths
of at most ``LONGEST`` bits. The lengths alone define the canonical code and are stored beside the data.

The file format is a folder of two Parquet tables. ``code`` holds (id, bits). ``segments`` holds one row a segment:
documents that follow one another in ascending doc_id order, closed at ``SEGMENT`` ids or more, with the global index of
its first id, the documents' ids and sizes, the coded bits, and the bit offset of every block of ``BLOCK`` ids. From these checkpoints each block is decoded on its own: the decoder reads one code of every block of a segment at a
time, by one look-up in a table over the next ``LONGEST`` bits.

Null text is empty: the end id alone. Repeated rows are written as often as they occur, ties in doc_id by text. An empty
table gives empty files.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retailspark.llm import pieces
from retailspark.llm.common import id_and_text, join_checked, map_rows, portable, staged

TOKENIZER = "word_bpe_49k.json"
END = 1
LONGEST = 20
BLOCK = 256
SEGMENT = 1 << 18
SIZE_BITS = 5  # enough for LONGEST

TOKENS = "task int, place long, doc_id long, size long, ids binary"
SEGMENTS = (
    "first_id long, n_ids long, doc_ids array<long>, doc_sizes array<long>, checkpoints array<long>, bits binary"
)
DECODED = "doc_id long, start long, ids binary"


def code_lengths(counts: np.ndarray, longest: int = LONGEST) -> np.ndarray:
    """Optimal code lengths of at most ``longest`` bits, by package-merge; 0 for ids that do not occur."""
    used = np.flatnonzero(counts)
    if len(used) > 1 << longest:
        raise ValueError("more ids than codes of that length")
    found = np.zeros(len(counts), np.int64)
    if len(used) < 2:
        found[used] = 1
        return found
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.int64)
    level, leaves = weights, []
    for _ in range(longest - 1):
        packages = level[: len(level) // 2 * 2].reshape(-1, 2).sum(1)
        merged = np.concatenate([weights, packages])
        sort = np.argsort(merged, kind="stable")
        leaves.append(sort < len(weights))
        level = merged[sort]
    lengths, take = np.zeros(len(weights), np.int64), 2 * len(weights) - 2
    for leaf in reversed(leaves):
        n = int(np.count_nonzero(leaf[:take]))
        lengths[:n] += 1
        take = 2 * (take - n)
    lengths[:take] += 1
    found[order] = lengths
    return found


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, id), each one more than the one before, shifted to its length."""
    codes, code, last = np.zeros(len(lengths), np.uint64), 0, 0
    order = np.lexsort((np.arange(len(lengths)), lengths))
    for i in order[np.count_nonzero(lengths == 0) :]:
        code <<= int(lengths[i]) - last
        codes[i], last = code, int(lengths[i])
        code += 1
    return codes


def encode_bits(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The ids' bits, first bit highest, and the bit offset of each block."""
    size = lengths.astype(np.uint8).take(ids)
    ends = np.cumsum(size, dtype=np.int64)
    at = ends - size
    # Codes start at the highest bit; moved to their places, those that start in one word are joined.
    moved = (codes << (64 - np.maximum(lengths, 1)).astype(np.uint64)).take(ids)
    moved >>= (at & 31).astype(np.uint64)
    word = at >> 5
    heads = np.append(0, np.flatnonzero(word[1:] != word[:-1]) + 1)
    joined, place = np.bitwise_or.reduceat(moved, heads), word[heads]
    words = np.zeros(int(ends[-1] + 63 >> 5) + 1, np.uint64)
    words[place] |= joined >> np.uint64(32)
    words[place + 1] |= joined & np.uint64(0xFFFFFFFF)
    return words.astype(">u4").tobytes()[: int(ends[-1] + 7 >> 3)], at[::BLOCK]


class Decoder:
    """The table over the next ``LONGEST`` bits: the id whose code they start with, and the code's length."""

    def __init__(self, codes: np.ndarray, lengths: np.ndarray, longest: int = LONGEST):
        self.longest = longest
        used = np.flatnonzero(lengths)
        used = used[np.lexsort((used, lengths[used]))]
        spread = 1 << (longest - lengths[used])
        rest = (1 << longest) - int(spread.sum())  # a code of one id fills half of the table
        # One look-up finds both: the id above ``SIZE_BITS`` bits for the code's length.
        entries = np.append(used.astype(np.int64) << SIZE_BITS | lengths[used], 1).astype(np.uint32)
        self.entries = np.repeat(entries, np.append(spread, rest))

    def decode(self, bits: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        raw = np.frombuffer(bits + bytes(8), np.uint8).astype(np.uint32)
        words = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
        at, most = checkpoints.astype(np.int64), (len(words) - 1) * 8
        found = np.empty((min(BLOCK, n), len(at)), np.uint32)
        mask, room, size = np.uint32((1 << self.longest) - 1), 32 - self.longest, np.uint32((1 << SIZE_BITS) - 1)
        for row in found:
            code = words.take(at >> 3)
            code >>= (room - (at & 7)).astype(np.uint32)
            code &= mask
            self.entries.take(code, out=row, mode="clip")
            at += row & size
            np.minimum(at, most, out=at)  # the last block may be shorter than the others
        found >>= np.uint32(SIZE_BITS)
        return found.T.reshape(-1)[:n]


def tokens_in_order(docs: DataFrame, tokenizer: str, end: int) -> DataFrame:
    """Ids of each document; ``task`` and ``place``, the ids before it in the task, ascend with doc_id."""

    def make():
        memory, task, place = pieces.held(pieces.WordBpe, tokenizer), TaskContext.get().partitionId(), 0
        last = memory.pack([end])

        def step(rows):
            nonlocal place
            for (doc_id, _), ids in zip(rows, memory.encode([t for _, t in rows])):
                ids += last
                size = len(ids) // memory.dtype.itemsize
                yield task, place, doc_id, size, ids
                place += size

        return step

    ordered = id_and_text(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return staged(map_rows(ordered, make, TOKENS, rows=512), "huffman-ids")


def counts_of(tokens: DataFrame) -> np.ndarray:
    """How often each id occurs in all documents; at most one row per vocabulary entry comes back."""

    def count(batches) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            column = batch.column(0).cast(pa.large_binary())  # never null
            offsets = np.frombuffer(column.buffers()[1], "<i8")[column.offset : column.offset + len(column) + 1]
            if len(column):
                data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
                total += np.bincount(data.view("<u2"), minlength=1 << 16)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])

    found = tokens.select("ids").mapInArrow(portable(count), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max([r["id"] for r in found], default=-1) + 1, np.int64)
    for r in found:
        counts[r["id"]] = r["n"]
    return counts


def write(docs: DataFrame, folder: str, tokenizer: str | None = None, end: int = END) -> None:
    """Encode all documents into ``folder``."""
    spark = docs.sparkSession
    tokens = tokens_in_order(docs, tokenizer or pieces.path(TOKENIZER), end)
    lengths = code_lengths(counts_of(tokens))
    codes = canonical(lengths)
    table = [(i, int(lengths[i])) for i in np.flatnonzero(lengths).tolist()]
    spark.createDataFrame(table, "id long, bits long").coalesce(1).write.parquet(f"{folder}/code")

    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # one row a task
    sums = tokens.groupBy("task").agg(F.sum("size").alias("n"))
    starts = staged(sums.select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "huffman-starts")

    def make():
        def segment(rows):
            """Rows that follow one another without a gap, up to a segment's size."""
            ids = np.concatenate([np.frombuffer(r[2], "<u2") for r in rows])
            bits, checkpoints = encode_bits(ids, codes, lengths)
            sizes = [len(r[2]) // 2 for r in rows]
            return rows[0][0], len(ids), [r[1] for r in rows], sizes, checkpoints.tolist(), bits

        def step(rows):
            held, size = [], 0
            for row in rows:
                if held and (size >= SEGMENT or row[0] != held[0][0] + size):
                    yield segment(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[2]) // 2
            if held:
                yield segment(held)

        return step

    placed = join_checked(tokens, starts, ["task"])
    placed = placed.select((F.col("before") + F.col("place")).alias("first_id"), "doc_id", "ids")
    map_rows(placed, make, SEGMENTS, rows=512).write.parquet(f"{folder}/segments")


def _bytes(doc_id: int, start: int, ids: np.ndarray) -> tuple:
    return doc_id, start, ids.astype("<u4").tobytes()


def read(spark: SparkSession, folder: str, each: Callable = _bytes, schema: str = DECODED) -> DataFrame:
    """Each document with its ids as 32-bit numbers, and the number of ids of all documents before it; or what
    ``each`` makes of these three."""
    table = spark.read.parquet(f"{folder}/code").collect()  # at most one row per vocabulary entry
    lengths = np.zeros(max([r["id"] for r in table], default=0) + 1, np.int64)
    for r in table:
        lengths[r["id"]] = r["bits"]
    codes = canonical(lengths)

    def make():
        decoder = Decoder(codes, lengths)

        def step(rows):
            for first, n, doc_ids, sizes, checkpoints, bits in rows:
                ids, at = decoder.decode(bits, np.array(checkpoints), n), 0
                for doc_id, size in zip(doc_ids, sizes):
                    yield each(doc_id, first + at, ids[at : at + size])
                    at += size

        return step

    segments = spark.read.parquet(f"{folder}/segments")
    return map_rows(
        segments.select("first_id", "n_ids", "doc_ids", "doc_sizes", "checkpoints", "bits"), make, schema, rows=4
    )
