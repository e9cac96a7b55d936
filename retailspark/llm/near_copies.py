"""Near-duplicate documents by order MinHash (operator 3).

Documents with equal texts are one node. A node's sketch has ``FUNCTIONS`` numbers: each stands for the ``SAMPLE``
occurrence-labelled five-word shingles that one hash function ranks lowest, in their order in the text. Nodes with an
equal number are candidates. A candidate pair is a link if the banded alignment of its shingle sequences matches M of n
and m shingles with M / (n + m - M) >= ``SIMILARITY``: word shingles' similarity, with order and repetition counted.
A pair of long texts at the threshold shares no number with probability (1 - 0.8^4)^24 = 3e-6, one of more than 12
shingles each with less than 1e-5. Of fewer shingles the chance would grow to 5e-3, so nodes of at most ``SHORT`` shingles
are also candidates by every single shingle they have in common, of which similar ones have some.

Classes are the connected components of the links, and candidates of a bucket are not all compared with one another:

1. In every bucket all nodes are compared with its most central one, that is, the one whose buckets are the largest:
   of edited copies of one text, that is the text or the copy with the fewest edits.
2. What is left are buckets whose nodes are in several components by then. In these, pairs from different components,
   one of which is not the bucket's largest, are compared unless they cannot be similar. Shingles are ordered from the
   rarest among those nodes on. Similar nodes share one of the first of both, or only such as are common, and then the
   numbers of common ones bound M. So no link between components is lost, and of many copies of one text each with its
   own edits few pairs are left.

Words are separated by white space and lower-cased. A text of fewer than five words is one shingle of all its words. Null
text is empty; empty texts are copies of one another and near copies of nothing. A null doc_id counts as the greatest.
Repeated rows give repeated rows. An empty table gives none.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailspark.llm import sketches
from retailspark.llm.common import join_checked, map_rows, staged
from retailspark.llm.components import components

WORDS = 5
SIMILARITY = 0.8
FUNCTIONS = 24
SAMPLE = 4
RARE = 16  # nodes that a rare shingle has at most
SHORT = 15  # shingles; a text of 12 may be similar to one of 15


def aligned(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> float:
    """Similarity M / (n + m - M) of two shingle sequences, or 0 if it is certainly below ``similarity``.

    M is the longest common subsequence inside the band that an alignment of at least that similarity cannot leave. Equal
    ends are matched first; in between, a row of the alignment is one number, a bit a column.
    """
    n, m = len(a), len(b)
    if not n or not m or min(n, m) < similarity * max(n, m):
        return 0.0
    short = min(n, m)
    differ = np.flatnonzero(a[:short] != b[:short])
    head = int(differ[0]) if len(differ) else short
    x, y = a[head:], b[head:]
    short = min(len(x), len(y))
    differ = np.flatnonzero(x[len(x) - short :][::-1] != y[len(y) - short :][::-1])
    tail = int(differ[0]) if len(differ) else short
    x, y = x[: len(x) - tail], y[: len(y) - tail]
    matched = head + tail
    if len(x) and len(y):
        places: dict[int, int] = {}
        for i, value in enumerate(x.tolist()):
            places[value] = places.get(value, 0) | 1 << i
        band = int((n + m) * (1 - 2 * similarity / (1 + similarity))) + 1  # M >= s / (1 + s) * (n + m)
        width, full = (1 << 2 * band + 1) - 1, (1 << len(x)) - 1
        row = full
        for j, value in enumerate(y.tolist()):
            found = places.get(value)
            if found is not None:
                found &= width << j - band if j >= band else width >> band - j
                hit = row & found
                if hit:
                    row = ((row + hit) | (row - hit)) & full
        matched += len(x) - row.bit_count()
    return matched / (n + m - matched)


def nodes_of(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5(text.cast("binary")).alias("node"), text.alias("text"))


def sketched(rows: DataFrame) -> DataFrame:
    """(node, size, keys, singles) for nodes with words; ``singles`` are the shingles of short ones."""

    def make():
        def step(part):
            values, edges = sketches.shingles(*sketches.words([t for _, t in part]), WORDS)
            numbers = sketches.order_minhash(values, edges, FUNCTIONS, SAMPLE).view(np.int64)
            for k, ((node, _), size, keys) in enumerate(zip(part, np.diff(edges).tolist(), numbers.tolist())):
                if size:
                    singles = values[edges[k] : edges[k + 1]].view(np.int64).tolist() if size <= SHORT else []
                    yield node, size, keys, sorted(set(singles))

        return step

    return map_rows(rows.select("node", "text"), make, "node string, size long, keys array<long>, singles array<long>")


def texts_of(rows: DataFrame, needed: DataFrame) -> DataFrame:
    """One (node, text) for each node of ``needed``."""
    return join_checked(rows.select("node", "text"), needed, ["node"], 500_000).dropDuplicates(["node"])


def verified(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs (a, b) that are links."""
    needed = staged(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "near-needed")
    texts = staged(texts_of(rows, needed), "near-texts")
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))

    def make():
        def step(part):
            values, edges = sketches.shingles(*sketches.words([t for row in part for t in row[2:]]), WORDS)
            for k, (a, b, *_) in enumerate(part):
                x, y = (values[edges[2 * k + i] : edges[2 * k + i + 1]] for i in (0, 1))
                if aligned(x, y) >= SIMILARITY:
                    yield a, b

        return step

    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return staged(map_rows(joined, make, "a string, b string", rows=256), "near-links")


def residual_pairs(members: DataFrame, labels: DataFrame, rows: DataFrame, sketch: DataFrame) -> DataFrame:
    """Pairs of nodes in different components that share a bucket and may be similar."""
    members = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    groups = members.groupBy("f", "key", "label").agg(F.count("*").alias("n"))
    largest = groups.groupBy("f", "key").agg(
        F.count("*").alias("labels"), F.max_by("label", F.struct("n", "label")).alias("largest")
    ).filter("labels > 1")
    open_members = staged(members.join(largest.select("f", "key", "largest"), ["f", "key"]), "near-open")

    # Occurrence-labelled shingles of these nodes, and the rare ones among them, which at most RARE of the nodes have.
    needed = staged(open_members.select("node").distinct(), "near-open-nodes")

    def make():
        def step(part):
            values, edges = sketches.shingles(*sketches.words([t for _, t in part]), WORDS)
            labelled = sketches.labelled(values, edges).view(np.int64)
            for k, (node, _) in enumerate(part):
                number = int(node[:15], 16)
                for token in labelled[edges[k] : edges[k + 1]].tolist():
                    yield token, number

        return step

    tokens = staged(map_rows(texts_of(rows, needed), make, "token long, number long"), "near-tokens")
    rare = tokens.groupBy("token").agg(F.count("*").alias("nodes")).filter(F.col("nodes") <= RARE)
    listed = tokens.join(rare, "token").groupBy("number").agg(
        F.count("*").alias("n_rare"), F.sort_array(F.collect_list(F.struct("nodes", "token"))).alias("rare")
    )
    number = F.conv(F.substring("node", 1, 15), 16, 10).cast("long")
    open_members = open_members.withColumn("number", number).join(listed, "number", "left")
    # Rarest first, two similar nodes share one of the first size - s * size + 1, if they share a rare one at all.
    first = (F.col("size") - F.ceil(F.col("size") * F.lit(SIMILARITY)) + 1).cast("int")
    shared = F.filter(F.slice("rare", F.lit(1), first), lambda x: x["nodes"] > 1)
    open_members = open_members.select(
        "f", "key", "node", "label", "size", "largest",
        (F.col("size") - F.coalesce("n_rare", F.lit(0))).alias("common"),
        F.coalesce(F.transform(shared, lambda x: x["token"]), F.array().cast("array<long>")).alias("rare"),
    )
    open_members = open_members.join(sketch.select("node", "keys", "singles"), "node")
    open_members = staged(open_members, "near-bounded")  # both sides of the join below read it

    side = lambda s: open_members.select(
        "f", "key", *(F.col(c).alias(f"{c}_{s}") for c in ("node", "label", "size", "common", "rare", "keys", "singles")),
        *(["largest"] if s == "a" else []),
    )
    # Without a rare shingle in common, no more than the common ones match.
    best = F.least("common_a", "common_b")
    able = best >= F.lit(SIMILARITY) * (F.col("size_a") + F.col("size_b") - best)
    sizes = F.least("size_a", "size_b") >= F.lit(SIMILARITY) * F.greatest("size_a", "size_b")
    # A pair that shares several buckets is made in the first of them alone.
    agree = F.array_position(F.zip_with("keys_a", "keys_b", lambda x, y: x == y), True)
    single = (agree == 0) & (F.array_min(F.array_intersect("singles_a", "singles_b")) == F.col("key"))
    here = F.when(F.col("f") < FUNCTIONS, agree == F.col("f") + 1).otherwise(single)
    pairs = side("a").filter(F.col("label_a") != F.col("largest")).join(side("b"), ["f", "key"]).filter(
        (F.col("label_a") != F.col("label_b")) & sizes & here & (able | F.arrays_overlap("rare_a", "rare_b"))
    )
    return pairs.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def links(rows: DataFrame) -> DataFrame:
    """Links (a, b) between nodes that join all nodes of each class."""
    sketch = staged(sketched(rows).dropDuplicates(["node"]), "near-sketches")
    keys = sketch.select("node", "size", F.posexplode("keys").alias("f", "key")).unionByName(
        sketch.select("node", "size", F.lit(FUNCTIONS).alias("f"), F.explode("singles").alias("key"))
    )
    shared = keys.groupBy("f", "key").agg(F.count("*").alias("n")).filter("n > 1")
    members = staged(keys.join(shared, ["f", "key"]), "near-buckets")
    central = members.groupBy("node").agg(F.sum("n").alias("central"))
    ranked = members.join(central, "node")
    heads = ranked.groupBy("f", "key").agg(F.max_by("node", F.struct("central", "node")).alias("head"))
    stars = members.join(heads, ["f", "key"]).filter("node <> head")
    stars = stars.select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")).distinct()
    first = verified(staged(stars, "near-stars"), rows)
    rest = staged(residual_pairs(members, components(first), rows, sketch), "near-rest")
    return first.union(verified(rest, rows))


def classed(rows: DataFrame) -> DataFrame:
    """(node, class_id, stays) for every node: its class's least doc_id, and whether its text stands for the class. That
    text has a row of this doc_id."""
    labels = components(links(rows))
    nodes = rows.groupBy("node").agg(F.min("doc_id").alias("least"))
    nodes = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    order = F.struct(F.col("least").isNull(), F.col("least"), F.col("node"))
    chosen = nodes.groupBy("label").agg(F.min_by("least", order).alias("class_id"), F.min_by("node", order).alias("kept"))
    return staged(nodes.join(chosen, "label").select("node", "class_id", (F.col("node") == F.col("kept")).alias("stays")), "near-classes")


def classes(docs: DataFrame) -> DataFrame:
    """(doc_id, node, class_id, stays) for every row: the class's least doc_id, and whether the row's text is the one
    that stands for the class."""
    rows = nodes_of(docs)
    return join_checked(rows.select("doc_id", "node"), classed(rows), ["node"], 500_000)


def first_of_each(docs: DataFrame) -> DataFrame:
    """One row of each class: the least doc_id, whole rows.

    Whole rows are shuffled once: the join and the removal of repeated rows have the same keys. A hot text's rows are
    spread by their doc_id.
    """
    names = [f"__{i}" for i in range(len(docs.columns))]  # the caller's columns may have any name
    text, doc_id = (F.col(names[docs.columns.index(c)]) for c in ("text", "doc_id"))
    number = doc_id.cast("long")
    marked = docs.toDF(*names).withColumns({
        "node": F.md5(F.coalesce(text, F.lit("")).cast("binary")), "id": F.coalesce(number, F.lit(0)), "no_id": number.isNull(),
    })
    kept = classed(nodes_of(docs)).filter("stays").select(
        "node", F.coalesce("class_id", F.lit(0)).alias("id"), F.col("class_id").isNull().alias("no_id")
    )
    keys = ["node", "id", "no_id"]
    return marked.join(kept, keys).dropDuplicates(keys).select(*names).toDF(*docs.columns)
