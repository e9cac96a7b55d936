"""Approximate nearest neighbours by hierarchical navigable small-world graphs (operator 10).

Equal vectors are one point, which keeps its k + 1 least ids. Points are dealt to shards by the power of two below their
norm, and among those by a hash. A shard becomes one row of flat arrays: its points, their ids, and for each layer the
neighbour numbers, a fixed number a point, -1 for none. The measure is the inner product. To make it a nearness, a point of
norm r gets one more coordinate sqrt(R^2 - r^2), with R the largest norm of the shard, and a query gets 0 there: then all
points have one length and the order of inner products is the order of distances. Norms of one shard differ by a factor of
two at most, so that coordinate outweighs no other, however long a few vectors of the table are.

Every block of query points is searched in every shard of its dimension: a shard is read once and the blocks pass by it. The
hits are scored again in double precision on the original vectors, and the shards' hits are merged. Ties go to the lesser
id; a query's own id is never a hit. Single-precision copies of vectors are scaled, so any finite components will do.

Vectors that are null or zero, or hold null or non-finite components, take no part. A query meets points of its own
dimension only. A repeated row counts once. An empty table gives no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retailspark.llm.common import join_checked, map_rows, portable, staged

NEAREST = 20
LINKS = 16  # of a point and layer; twice as many in the lowest
BUILD = 96  # points held while a place for a new one is sought
SEARCH = 320  # points held while a query's neighbours are sought
SHARD = 10_000  # points of a shard, on average, at most
QUERY_BLOCK = 1024  # query points of a block
BLOCKS = 16  # blocks that pass by one copy of a shard


class Graph:
    def __init__(self, points: np.ndarray, layers: list[np.ndarray], entry: int):
        self.points, self.layers, self.entry = points, layers, entry
        self.seen, self.round = np.zeros(len(points), np.int64), 0

    @classmethod
    def build(cls, points: np.ndarray, seed: int = 0) -> Graph:
        n = len(points)
        heights = (-np.log(1 - np.random.default_rng(seed).random(n)) / np.log(LINKS)).astype(int)
        heights = np.minimum(heights, 12)
        layers = [np.full((n, LINKS * (1 if h else 2)), -1, np.int32) for h in range(int(heights.max(initial=0)) + 1)]
        graph = cls(points, layers, 0)
        top = int(heights[0]) if n else 0
        for i in range(1, n):
            query, height, at = points[i], int(heights[i]), [graph.entry]
            for h in range(top, height, -1):
                at = [x for _, x in graph.search(query, at, 1, h)]
            for h in range(min(top, height), -1, -1):
                found = graph.search(query, at, BUILD, h)
                at = [x for _, x in found]
                chosen = graph.spread(np.array(at), np.array([s for s, _ in found]), LINKS)
                layers[h][i, : len(chosen)] = chosen
                for c in chosen.tolist():
                    graph.link(c, i, h)
            if height > top:
                graph.entry, top = i, height
        return graph

    def spread(self, ids: np.ndarray, scores: np.ndarray, most: int) -> np.ndarray:
        """Of candidates, nearest first, those nearer to the point than to any chosen one; then the nearest others."""
        if len(ids) <= most:
            return ids
        vectors = self.points[ids]
        between = vectors @ vectors.T
        blocked, chosen = np.zeros(len(ids), bool), []
        for i in range(len(ids)):
            if not blocked[i]:
                chosen.append(i)
                if len(chosen) == most:
                    break
                blocked |= between[i] > scores
        if len(chosen) < most:
            rest = np.setdiff1d(np.arange(len(ids)), chosen)[: most - len(chosen)]
            chosen = sorted([*chosen, *rest.tolist()])
        return ids[chosen]

    def link(self, at: int, new: int, layer: int) -> None:
        row = self.layers[layer][at]
        free = np.flatnonzero(row < 0)
        if len(free):
            row[free[0]] = new
            return
        ids = np.append(row, new)
        scores = self.points[ids] @ self.points[at]
        order = np.argsort(-scores, kind="stable")
        kept = self.spread(ids[order], scores[order], len(row))
        row[:] = -1
        row[: len(kept)] = kept

    def search(self, query: np.ndarray, start: list[int], most: int, layer: int) -> list[tuple[float, int]]:
        """The best ``most`` points that a best-first walk over the layer meets, best first."""
        self.round += 1
        seen, mark, links, points = self.seen, self.round, self.layers[layer], self.points
        seen[start] = mark
        scores = (points[start] @ query).tolist()
        best = list(zip(scores, start))
        ahead = [(-s, i) for s, i in best]
        heapq.heapify(best)
        heapq.heapify(ahead)
        while len(best) > most:
            heapq.heappop(best)
        while ahead:
            score, at = heapq.heappop(ahead)
            if len(best) == most and -score < best[0][0]:
                break
            near = links[at]
            near = near[(near >= 0) & (seen[near] != mark)]
            if not len(near):
                continue
            seen[near] = mark
            scores = points[near] @ query
            if len(best) == most:
                good = scores > best[0][0]
                near, scores = near[good], scores[good]
            for s, i in zip(scores.tolist(), near.tolist()):
                if len(best) < most:
                    heapq.heappush(best, (s, i))
                    heapq.heappush(ahead, (-s, i))
                elif s > best[0][0]:
                    heapq.heapreplace(best, (s, i))
                    heapq.heappush(ahead, (-s, i))
        return sorted(best, key=lambda x: (-x[0], x[1]))

    def nearest(self, query: np.ndarray, most: int) -> list[int]:
        at = [self.entry]
        for h in range(len(self.layers) - 1, 0, -1):
            at = [i for _, i in self.search(query, at, 1, h)]
        return [i for _, i in self.search(query, at, most, 0)]


def augmented(vectors: np.ndarray) -> np.ndarray:
    """Scaled, with the coordinate that gives all points one length."""
    vectors = vectors / (np.abs(vectors).max(initial=0) or 1.0)
    norms = (vectors * vectors).sum(1)
    rest = np.sqrt(np.maximum(0, norms.max(initial=0) - norms))
    return np.hstack([vectors, rest[:, None]]).astype(np.float32)


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, vector, dim, scale, key) of the rows that take part; equal vectors have equal keys. ``scale`` is the
    logarithm of the norm, to the base 2, without its fraction."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    good = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.coalesce(good, F.lit(False)) & F.exists("vector", lambda x: x != 0))
    text = F.concat_ws(",", F.transform("vector", lambda x: (x + 0.0).cast("string")))
    most = F.array_max(F.transform("vector", F.abs))
    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + (x / F.col("most")) * (x / F.col("most")))
    scale = F.floor(F.log2("most") + F.log2(squares) / 2).cast("int")
    return rows.withColumn("most", most).select(
        "vec_id", "vector", F.size("vector").alias("dim"), scale.alias("scale"), F.md5(text.cast("binary")).alias("key")
    )


def points_of(rows: DataFrame, k: int) -> DataFrame:
    """One (key, dim, scale, vector, ids) a point, with its k + 1 least ids: others are never among k hits."""
    order = Window.partitionBy("key").orderBy("vec_id")
    least = rows.dropDuplicates(["vec_id", "key"]).withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1)
    return least.groupBy("key").agg(
        F.first("dim").alias("dim"), F.first("scale").alias("scale"), F.first("vector").alias("vector"),
        F.sort_array(F.collect_list("vec_id")).alias("ids"),
    )


INDEX = (
    "dim int, scale int, shard int, n int, entry int, heights int, points binary, neighbours array<binary>, vectors binary, "
    "ids array<array<long>>"
)


def index(points: DataFrame) -> DataFrame:
    """One row a shard."""
    # A row for each dimension and power of two, of which there are two thousand.
    parts = points.groupBy("dim", "scale").agg(F.ceil(F.count("*") / SHARD).cast("int").alias("parts"))

    def build(frame):
        import pandas as pd

        frame = frame.sort_values("key")
        vectors = np.array(frame["vector"].tolist(), np.float64)
        graph = Graph.build(augmented(vectors))
        return pd.DataFrame([{
            "dim": int(frame["dim"].iloc[0]), "scale": int(frame["scale"].iloc[0]), "shard": int(frame["shard"].iloc[0]),
            "n": len(frame), "entry": graph.entry, "heights": len(graph.layers), "points": graph.points.tobytes(),
            "neighbours": [layer.tobytes() for layer in graph.layers], "vectors": vectors.tobytes(),
            "ids": frame["ids"].tolist(),
        }])

    call = portable(build)
    dealt = join_checked(points, staged(parts, "world-parts"), ["dim", "scale"], 100_000)
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int"))
    return dealt.groupBy("dim", "scale", "shard").applyInPandas(lambda frame: call(frame), INDEX)


HITS = "query string, score double, ids array<long>"


def hits(shards: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The best k + 1 points of each shard for each query point (key, dim, vector)."""
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    copies = -(-blocks // BLOCKS)
    block = F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int")
    grouped = queries.groupBy("dim", block.alias("block")).agg(F.collect_list(F.struct("key", "vector")).alias("queries"))

    def make():
        graph = vectors = ids = None

        def step(rows):
            nonlocal graph, vectors, ids
            for n, entry, dim, points, neighbours, own, own_ids, queries in rows:
                if queries is None:  # the shard that the blocks behind are for
                    points = np.frombuffer(points, np.float32).reshape(n, dim + 1)
                    graph = Graph(points, [np.frombuffer(x, np.int32).reshape(n, -1) for x in neighbours], entry)
                    vectors, ids = np.frombuffer(own).reshape(n, dim), own_ids
                    continue
                for query in queries:
                    exact = np.array(query["vector"])
                    scaled = np.append(exact / np.abs(exact).max(), 0).astype(np.float32)
                    found = np.array(graph.nearest(scaled, max(SEARCH, k + 1)))
                    scores = (vectors[found] * exact).sum(1)
                    order = np.lexsort(([ids[i][0] for i in found.tolist()], -scores))[: k + 1]
                    for i in order.tolist():
                        yield query["key"], float(scores[i]), ids[found[i]]

        return step

    place = ["dim", "scale", "shard"]
    keys = staged(shards.select(*place), "world-keys")  # a row a shard
    asked = join_checked(grouped, keys, ["dim"], 1_000_000).withColumn("copy", F.pmod("block", F.lit(copies)))
    held = shards.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    both = held.withColumn("block", F.lit(-1)).unionByName(asked, allowMissingColumns=True)
    dealt = both.repartition(*place, "copy").sortWithinPartitions(*place, "copy", "block")
    columns = ["n", "entry", "dim", "points", "neighbours", "vectors", "ids", "queries"]
    return map_rows(dealt.select(*columns), make, HITS, rows=1)


def search(embeddings: DataFrame, queries: DataFrame, k: int = NEAREST) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row of ``queries`` among ``embeddings``."""
    rows, asked = usable(embeddings), usable(queries).dropDuplicates(["vec_id", "key"])
    points = staged(points_of(rows, k), "world-points")
    asked = staged(asked, "world-queries")
    shards = staged(index(points), "world-index")
    found = hits(shards, staged(asked.groupBy("key").agg(F.first("dim").alias("dim"), F.first("vector").alias("vector")), "world-asked"), k)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("ids")[0])
    best = found.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1)
    single = best.select("query", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    single = staged(single.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1), "world-hits")
    own = asked.select(F.col("vec_id").alias("query_id"), F.col("key").alias("query"))
    pairs = own.join(single, "query").filter("vec_id <> query_id")
    order = Window.partitionBy("query_id", "query").orderBy("n")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
