"""Fill-in-the-middle training texts (operator 12).

A text is cut into units (lines, or any runs that end in one ASCII byte), and two hashes of its doc_id choose the unit
ends at which prefix, middle and suffix meet. The cuts are found by arithmetic on words of eight bytes: the UTF-8 of many
texts is viewed as 64-bit numbers, the unit-ending bytes are marked by a carry-free test for zero bytes, marks are counted
per word, a search in the running counts gives the word of a wanted unit end, and a multiplication gives its byte in there.

Nulls: a null text is empty, a null doc_id is written as the empty string where it is hashed. Empty texts and texts that
hold a marker stay plain. Rows are treated alone, so ties and repeated rows give equal rows; an empty table gives none.
Other columns are left behind. Texts of any length are taken whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailspark.llm.common import portable

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
ROWS = 1024  # texts that are cut at a time

_ONES, _HIGH, _LOW = (np.uint64(n) for n in (0x0101010101010101, 0x8080808080808080, 0x7F7F7F7F7F7F7F7F))
_U = np.uint64


class Marks:
    """Rank and select of marked bytes in an array of bytes; ``words`` has the high bit of each marked byte set."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marked bytes in front of each place."""
        word, inside = at >> 3, ((at & 7) << 3).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.words[word] & ((_U(1) << inside) - _U(1)))

    def select(self, number: np.ndarray) -> np.ndarray:
        """Place of the marked byte with so many marked ones before it."""
        word = np.searchsorted(self.before, number, side="right") - 1
        within = (number - self.before[word]).astype(np.uint64)
        upto = (self.words[word] >> _U(7)) * _ONES  # byte i: marks in bytes 0 to i
        passed = ((within * _ONES) | _HIGH) - upto  # high bit: no more marks up to here than are to be passed
        return (word << 3) + np.bitwise_count(passed & _HIGH)


def words_of(data: np.ndarray) -> np.ndarray:
    """Bytes as little-endian 64-bit words, with at least one word of padding."""
    padded = np.zeros((len(data) >> 3) + 1 << 3, np.uint8)
    padded[: len(data)] = data
    return padded.view("<u8")


def marks(words: np.ndarray, byte: int) -> Marks:
    """The bytes equal to ``byte``, which is not 0."""
    x = words ^ (_ONES * _U(byte))
    return Marks(~((x & _LOW) + _LOW | x | _LOW))


def continuations(words: np.ndarray) -> Marks:
    """The bytes that continue a code point: the top bit set, the next one not."""
    return Marks(words & (~words << _U(1)) & _HIGH)


def cut(texts: pa.Array, first: np.ndarray, second: np.ndarray, end: str = "\n"):
    """Units of each text, its prefix, middle and suffix, and code points in prefix and middle.

    The prefix ends after the smaller of ``first % (units + 1)`` and ``second % (units + 1)`` units, the middle after the
    larger.
    """
    texts = texts.cast(pa.large_string())
    size = len(texts)
    edges = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + size + 1]
    held = texts.buffers()[2] if texts.buffers()[2] is not None else pa.py_buffer(b"")
    data = np.frombuffer(held, np.uint8)[edges[0] : edges[-1]]
    edges = edges - edges[0]
    starts, stops = edges[:-1], edges[1:]
    words = words_of(data)
    ends = marks(words, ord(end))
    before = ends.rank(starts)
    full = stops > starts
    open_end = np.zeros(size, bool)
    open_end[full] = data[stops[full] - 1] != ord(end)
    n = ends.rank(stops) - before + open_end
    a, b = first % (n + 1), second % (n + 1)
    cuts = []
    for k in (np.minimum(a, b), np.maximum(a, b)):
        at = np.where(k == 0, starts, stops)
        inner = np.flatnonzero((k > 0) & (k < n))
        at[inner] = ends.select(before[inner] + k[inner] - 1) + 1
        cuts.append(at)
    bounds = np.empty(3 * size + 1, np.int64)
    bounds[0::3], bounds[1::3], bounds[2::3] = edges, *cuts
    parts = pa.LargeStringArray.from_buffers(3 * size, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data)))
    inside = continuations(words).rank(bounds)
    chars = np.diff(bounds) - np.diff(inside)
    prefix, middle, suffix = (parts.take(pa.array(np.arange(i, 3 * size, 3))) for i in range(3))
    return n, (prefix, middle, suffix), (chars[0::3], chars[1::3])


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four numbers of 32 bits from the SHA-256 of seed and doc_id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def infilled(docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50, end: str = "\n") -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars and output of every row.

    ``rate`` percent of the texts are rearranged, ``spm`` percent of these with the suffix first; the others stay plain.
    Units end after the ASCII character ``end``; what follows the last one is a unit too.
    """
    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(
        doc_id.alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
        *(h.alias(f"h{i}") for i, h in enumerate(draws(doc_id, seed))),
    )

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                texts = batch.column(1)
                h = [np.asarray(batch.column(i)) for i in range(2, 6)]
                n, (prefix, middle, suffix), chars = cut(texts, h[0], h[1], end)
                marked = np.asarray(pc.match_substring_regex(texts, f"{PREFIX}|{SUFFIX}|{MIDDLE}").to_numpy(zero_copy_only=False))
                plain = (n == 0) | marked | (h[2] % 100 >= rate)
                last_first = h[3] % 100 < spm
                join = lambda *parts: pc.binary_join_element_wise(
                    *(pa.scalar(p, pa.large_string()) if isinstance(p, str) else p for p in parts), pa.scalar("", pa.large_string())
                )
                # each text is joined in its own form only
                where = [np.flatnonzero(plain), np.flatnonzero(~plain & last_first), np.flatnonzero(~plain & ~last_first)]
                p, m, s = ([x.take(pa.array(w)) for w in where] for x in (prefix, middle, suffix))
                joined = pa.concat_arrays([
                    texts.cast(pa.large_string()).take(pa.array(where[0])),
                    join(SUFFIX, s[1], PREFIX, p[1], MIDDLE, m[1]),
                    join(PREFIX, p[2], SUFFIX, s[2], MIDDLE, m[2]),
                ])
                back = np.empty(len(plain), np.int64)
                back[np.concatenate(where)] = np.arange(len(plain))
                form = np.where(plain, "plain", np.where(last_first, "spm", "psm"))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0), pa.array(n, pa.int64()), pa.array(form.tolist(), pa.string()),
                        *(pa.array(c, pa.int64(), mask=plain) for c in chars),
                        joined.take(pa.array(back)).cast(pa.string()),
                    ],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return rows.mapInArrow(portable(run), schema)


def restored(output: Column, form: Column) -> Column:
    """The text that ``infilled`` made ``output`` from. Texts with markers stay plain, so each marker is there once."""
    p, s, m = (F.instr(output, x) for x in (PREFIX, SUFFIX, MIDDLE))

    def between(a: Column, marker: str, b: Column) -> Column:
        return F.substring(output, a + len(marker), b - a - len(marker))

    over = F.length(output) + 1
    return (
        F.when(form == "psm", F.concat(between(p, PREFIX, s), between(m, MIDDLE, over), between(s, SUFFIX, m)))
        .when(form == "spm", F.concat(between(p, PREFIX, m), between(m, MIDDLE, over), between(s, SUFFIX, p)))
        .otherwise(output)
    )
