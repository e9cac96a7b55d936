"""Quality rules by host (operator 7).

Every document is measured on its whole text and held against ``RULES``. Failures are counted by host. For each rule a
beta prior is fitted to the hosts' rates by moments, and a host's rate is shrunk to the prior: (f + a) / (n + a + b). So a
host with few documents is judged by what is usual, one with many by its own. A host of which some rule's shrunk rate is
``LIMIT`` or more is rejected with all its documents; host verdicts are joined back to the documents. A document that
fails a base rule (under 20 words, or over 30 % of its words in repeated eight-word windows) is rejected by itself.

The host is the source's host part if it is a URL, else the source itself, without surrounding space and in lower case. A
null or empty source has no host, and so no host verdict. Null text has no words. Repeated rows count as often as they
occur. Where all hosts have one rate there is no spread to fit, and all are shrunk to the mean. An empty table gives none.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailspark.llm.common import append_columns, staged

WINDOW = 8
LIMIT = 0.5
MOST_PRIOR = 1e6  # documents that the prior counts for at most

MEASURES = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"


def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that stand in a window of ``window`` words found twice or more; the window is a power of two.

    Windows are told apart exactly: by numbers for words, then for pairs of numbers, and so on.
    """
    n = len(words)
    if n <= window:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    span, kinds = 1, len(number)
    while span < window:
        if kinds == len(ids):
            return 0  # all shorter windows differ
        pairs = ids[:-span] * kinds + ids[span:]
        unique, ids = np.unique(pairs, return_inverse=True)
        kinds, span = len(unique), span * 2
    if kinds == len(ids):
        return 0
    twice = np.bincount(ids)[ids] > 1
    edge = np.zeros(n + 1, np.int64)
    edge[:-window][twice] += 1
    edge[window:][twice] -= 1
    return int(np.count_nonzero(np.cumsum(edge)[:n]))


def measure(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = text.encode().split()  # bytes are split at the six white-space characters of ASCII alone
    white = sum(map(text.count, " \t\n\x0b\x0c\r"))
    symbols = sum(map(text.count, "#*$%&|<>"))
    lines = [line for line in text.split("\n") if line.strip(" \t\x0b\x0c\r")]
    return len(words), len(text) - white, symbols, len(lines), len(lines) - len(set(lines)), repeat_words(words)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def rules() -> dict[str, Column]:
    words = F.greatest("n_words", F.lit(1))
    return {
        "few_words": F.col("n_words") < 20,
        "repetition": 100 * F.col("n_repeat_words") > 30 * F.col("n_words"),
        "symbols": F.col("n_symbols") > 0.1 * F.col("n_words"),
        "repeated_lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
        "word_length": ~F.coalesce((F.col("word_chars") / words).between(2, 15), F.lit(False)),
    }


def host(source: Column) -> Column:
    plain = F.lower(F.trim(source))
    site = F.regexp_extract(plain, r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.nullif(F.when(site != "", site).otherwise(plain), F.lit(""))


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with its measures behind its columns."""

    def make():
        return lambda rows: [measure(text) for (text,) in rows]

    return append_columns(docs, ["text"], make, MEASURES)


def host_verdicts(measures: DataFrame) -> DataFrame:
    """(host, n_docs, worst_rule, worst_rate, rejected) from rows with a host and measures."""
    flags = rules()
    counts = measures.filter("host IS NOT NULL").groupBy("host").agg(
        F.count("*").alias("n"), *(F.sum(c.cast("long")).alias(k) for k, c in flags.items())
    )
    counts = staged(counts, "host-counts")
    total = counts.agg(F.count("*").alias("hosts"), F.sum("n").alias("n"), *(F.sum(k).alias(k) for k in flags)).first()
    if not total["hosts"]:
        return counts.select("host", F.col("n").alias("n_docs"), F.lit("").alias("worst_rule"),
                             F.lit(0.0).alias("worst_rate"), F.lit(False).alias("rejected"))
    mean = {k: total[k] / total["n"] for k in flags}
    spread = counts.agg(*(
        (F.sum(F.col("n") * F.pow(F.col(k) / F.col("n") - mean[k], F.lit(2))) / total["n"]).alias(k) for k in flags
    )).first()
    rates = []
    for k in flags:
        within = mean[k] * (1 - mean[k])
        between = spread[k] - within * total["hosts"] / total["n"]  # without what chance alone spreads
        weight = MOST_PRIOR if between <= 0 else min(MOST_PRIOR, max(1.0, within / between - 1))
        rate = (F.col(k) + mean[k] * weight) / (F.col("n") + weight)
        rates.append(F.struct(rate.alias("rate"), F.lit(k).alias("rule")))
    worst = counts.select("host", F.col("n").alias("n_docs"), F.greatest(*rates).alias("worst"))
    return worst.select("host", "n_docs", F.col("worst.rule").alias("worst_rule"), F.col("worst.rate").alias("worst_rate"),
                        (F.col("worst.rate") >= LIMIT).alias("rejected"))


def judged(measures: DataFrame) -> DataFrame:
    """Rows with a host and measures, with host_rate, host_rejected, base_failed and kept."""
    verdicts = staged(host_verdicts(measures), "host-verdicts").select(
        F.col("host").alias("__host"), F.col("worst_rate").alias("host_rate"), F.col("rejected").alias("host_rejected")
    )
    small = verdicts.count() <= 500_000
    joined = measures.join(F.broadcast(verdicts) if small else verdicts, F.col("host") == F.col("__host"), "left")
    rejected = F.coalesce("host_rejected", F.lit(False))
    return joined.drop("__host").withColumn("host_rejected", rejected).withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & ~F.col("host_rejected")
    )


def verdicts(docs: DataFrame) -> DataFrame:
    """One row a document: doc_id, host, its measures and the verdicts."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), host(F.col("source")).alias("host"), "text")
    return judged(staged(measured(rows).drop("text"), "host-measures"))


def keep(docs: DataFrame) -> DataFrame:
    """The documents that stay, whole rows."""
    names = [f"__{i}" for i in range(len(docs.columns))]  # the caller's columns may have the measures' names
    text, source = (names[docs.columns.index(c)] for c in ("text", "source"))
    rows = docs.toDF(*names).withColumns({"text": F.col(text), "host": host(F.col(source))})
    facts = staged(measured(rows.select("text", "host")).drop("text"), "host-measures")
    found = staged(host_verdicts(facts).filter("rejected").select(F.col("host").alias("__host")), "host-rejected")
    kept = measured(rows).filter(~base_failed())
    small = found.count() <= 500_000
    kept = kept.join(F.broadcast(found) if small else found, F.col("host") == F.col("__host"), "left_anti")
    return kept.select(*names).toDF(*docs.columns)
