"""Token counts of documents in flat token files, by a separator scan (operator 2).

A flat file is ids of one width after one another, each document's followed by the end id, without index or header. A
file is read as blocks of fixed size. In each block one vector comparison finds the end ids. A prefix scan over the
blocks of a file then stitches the boundaries: it carries the number of documents that ended earlier and the place where
the last one ended, so a document may span any number of blocks.

Ids after the last end id of a file are a last document with ``closed`` false. An empty file has no documents. Two end
ids in a row enclose an empty document. A file whose size is no multiple of the width fails, as it is not such a file.

``write_flat`` makes such files with Spark's text writer: a document's bytes are a line, and the end id's bytes are the
line's end. For this they must be valid UTF-8, as those of small ids are. Null text is empty.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retailspark.llm import pieces
from retailspark.llm.common import map_rows

TOKENIZER = "piece_bpe_32k.model"
END = 2
WIDTH = 2
BLOCK = 1 << 22  # bytes

SCANNED = "file string, block long, n_ids long, ends array<long>"


class SentencePieces(pieces.Memory):
    """By a sentencepiece model that keeps white space and starts each text with its sign for a space."""

    def __init__(self, file: str, **options):
        import sentencepiece

        super().__init__(**options)
        self.model = sentencepiece.SentencePieceProcessor(model_file=file)
        self.space = self.model.piece_to_id("▁")

    def _pieces(self, found):
        ids = self.model.encode(found, num_threads=1) if found else []
        # After a line feed there is no sign for a space.
        return [self.pack(i[i[0] == self.space :] if p[0] == "\n" else i) for p, i in zip(found, ids)]

    def _whole(self, texts):
        return [self.pack(i) for i in self.model.encode(texts, num_threads=1)] if texts else []


def flat_rows(docs: DataFrame, tokenizer: str, *keys: str) -> DataFrame:
    def make():
        memory = pieces.held(SentencePieces, tokenizer)

        def step(rows):
            for row, ids in zip(rows, memory.encode([r[-1] for r in rows])):
                yield *row[:-1], ids

        return step

    kept = docs.select(*keys, F.coalesce("text", F.lit("")).alias("text"))
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.select(*keys).schema)
    return map_rows(kept, make, schema + "ids binary", rows=512)


def write_flat(docs: DataFrame, folder: str, tokenizer: str | None = None, end: int = END, width: int = WIDTH) -> None:
    """Flat token files of the documents, one a partition, in the order in which Spark reads them."""
    mark = int(end).to_bytes(width, "little").decode("utf-8")
    rows = flat_rows(docs, tokenizer or pieces.path(TOKENIZER))
    rows.select(F.col("ids").cast("string")).write.option("lineSep", mark).text(folder)


def blocks(spark: SparkSession, path: str, width: int = WIDTH, size: int = BLOCK) -> DataFrame:
    """The files under ``path``, cut into blocks. Spark reads a file of at most 2 GB as one row."""
    files = spark.read.format("binaryFile").load(path).filter("length > 0")
    whole = F.when(F.col("length") % width == 0, F.col("length")).otherwise(
        F.raise_error(F.lit("the file's size is no multiple of the ids' width")).cast("long")
    )
    last = F.floor((whole - 1) / size)
    numbered = files.select("path", "content", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"))
    start: Column = (F.col("block") * size + 1).cast("int")
    return numbered.select(
        F.regexp_extract("path", "[^/]+$", 0).alias("file"), "block", F.substring("content", start, F.lit(size)).alias("data")
    )


def scan(parts: DataFrame, end: int = END, width: int = WIDTH) -> DataFrame:
    """One row a document: (file, ordinal, start, n_tokens without the end id, closed)."""

    def make():
        def step(rows):
            for file, block, data in rows:
                ids = np.frombuffer(data, f"<u{width}")
                yield file, block, len(ids), np.flatnonzero(ids == end).tolist()

        return step

    scanned = map_rows(parts.select("file", "block", "data"), make, SCANNED, rows=8)
    ordered = Window.partitionBy("file").orderBy("block")
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    # The prefix scan: ids and documents before each block, and where the last document before it ended.
    placed = scanned.withColumn("base", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)))
    placed = placed.withColumn("final", F.when(F.size("ends") > 0, F.col("base") + F.element_at("ends", -1)))
    placed = (
        placed.withColumn("first", F.coalesce(F.sum(F.size("ends")).over(earlier), F.lit(0)))
        .withColumn("carried", F.coalesce(F.last("final", ignorenulls=True).over(earlier), F.lit(-1)))
        .withColumn("is_last", F.lead("block").over(ordered).isNull())
    )
    # What follows the last end id of a file, if anything, is one more document.
    open_at = F.col("base") + F.col("n_ids")
    has_open = F.col("is_last") & (open_at > F.coalesce("final", "carried") + 1)
    ends = F.transform("ends", lambda e: e + F.col("base"))
    ends = F.when(has_open, F.concat(ends, F.array(open_at))).otherwise(ends)
    spans = F.zip_with(F.concat(F.array("carried"), ends), ends, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    documents = placed.select("file", "first", F.size("ends").alias("n_ends"), F.posexplode(spans).alias("k", "span"))
    start = F.col("span.a") + 1
    return documents.filter("span.b IS NOT NULL").select(
        "file", (F.col("first") + F.col("k")).alias("ordinal"), start.alias("start"),
        (F.col("span.b") - start).alias("n_tokens"), (F.col("k") < F.col("n_ends")).alias("closed"),
    )
