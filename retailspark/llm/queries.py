"""The registered queries: each applies one operator to its whole table and derives digest columns from its output."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailspark.llm import (
    host_rules, huffman, infilling, licences, near_copies, nearest_labels, oracle, packing, personal_data, prefix_bpe,
    prefix_trie, separators, small_world, substrings,
)
from retailspark.llm.common import table
from retailspark.session import scratch_folder


def op1_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence paragraphs of all documents."""
    return licences.scan(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, file, ordinal, start and n_tokens of every document, from flat files scanned for the end id."""
    docs, folder = table(spark, sf_dir, "documents"), scratch_folder(spark, "flat-tokens")
    separators.write_flat(docs, folder)
    found = separators.scan(separators.blocks(spark, folder))
    # The files are unindexed. Spark cuts the table into the same partitions whichever columns it reads, so a row's place
    # in its partition is its document's ordinal in the partition's file.
    placed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("ordinal"),
    )
    found = found.withColumn("part", F.regexp_extract("file", r"^part-(\d+)", 1).cast("int"))
    return placed.join(found, ["part", "ordinal"], "full_outer").select(
        "doc_id", "file", "ordinal", "start", "n_tokens", "closed"
    )


def op3_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and class_id of every document; the class's least doc_id."""
    return near_copies.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.digests(table(spark, sf_dir, "documents"))


def op6_huffman(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, read back from the coded files."""
    folder = scratch_folder(spark, "huffman")
    huffman.write(table(spark, sf_dir, "documents"), folder)

    digest = lambda doc_id, start, ids: (doc_id, start, len(ids), zlib.crc32(ids.astype("<u4")))
    return huffman.read(spark, folder, digest, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op7_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.verdicts(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "host", "host_rate", "host_rejected",
    )


def op8_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document, encoded and decoded."""
    decoded = prefix_bpe.round_trip(table(spark, sf_dir, "documents"))
    return decoded.select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


def op9_nearest_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = nearest_labels.score(docs, table(spark, sf_dir, "labels"))
    score = F.col("toxic_score")
    return scored.select(
        "doc_id", nearest_labels.held_out(F.col("doc_id")).alias("held_out"), score.alias("score"),
        (score >= 0.5).cast("int").alias("predicted"), F.col("toxic_evidence").alias("evidence"),
    )


def op10_small_world(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    return small_world.search(embeddings, embeddings.filter("vec_id % 20 = 0"))


def op11_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_removed and the digest of the words kept of every document."""
    return substrings.repeats_removed(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )


def op12_infilling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cuts of every document, and digests of the text made and of the one restored from it."""
    made = infilling.infilled(table(spark, sf_dir, "documents"))
    back = infilling.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(back.cast("binary"), 256).alias("restored_sha256"),
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations."""
    conversations = table(spark, sf_dir, "conversations")
    sequences = prefix_trie.paths(prefix_trie.rebuilt(prefix_trie.listed(conversations)))
    return prefix_trie.nodes(sequences).drop("turn")


QUERIES = {
    "op1_licences": op1_licences,
    "op2_token_counts": op2_token_counts,
    "op3_near_copies": op3_near_copies,
    "op4_packing": op4_packing,
    "op5_personal_data": op5_personal_data,
    "op6_huffman": op6_huffman,
    "op7_host_rules": op7_host_rules,
    "op8_prefix_bpe": op8_prefix_bpe,
    "op9_nearest_labels": op9_nearest_labels,
    "op10_small_world": op10_small_world,
    "op11_substrings": op11_substrings,
    "op12_infilling": op12_infilling,
    "op13_prefix_trie": op13_prefix_trie,
}
ORACLES: dict[str, str] = {
    "op11_substrings": oracle.SUBSTRINGS,
    "op12_infilling": oracle.INFILLING,
    "op13_prefix_trie": oracle.PREFIX_TRIE,
}
