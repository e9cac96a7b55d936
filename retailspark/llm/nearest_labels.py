"""Toxicity by the nearest labelled examples (operator 9).

Examples are the texts of at most ``EXAMPLES`` labelled documents, the least by a hash of doc_id; labels of rows with
crc32(doc_id) mod 5 = 0 are never read. Terms are all words of the examples. The weight of a term in a text is
(1 + log tf) * idf * sqrt(1 + chi2), with document frequencies counted over all documents and chi2 the dependence of the
labels on the term among the examples. So words that tell of the label weigh most and no word of an example is left out.
Vectors have length 1. Words that are in no example are in no vector.

The index has the most frequent terms, at most ``DENSE``, as a matrix and all others as inverted lists. A document's
cosines with all examples are summed up in single precision from both. All that can be among the nearest, by the bound of
the rounding error, are summed again in double precision. So the neighbours are exact; equal cosines go to the earlier
example. Equal texts have equal scores, whatever their doc_id: an example is a neighbour of its own text as of any other.

The vote is sum(w * label) + PRIOR * rate over sum(w) + PRIOR, w being the squared cosine, and is calibrated by isotonic
regression on the examples, each voted on by those of other documents. The neighbours are returned as evidence.

The driver has the hashes of the examples' words and their counts, compressed; vectors and index are built in the tasks.

Null and empty texts, and texts without any of the terms, have no neighbours and get the calibrated prior. Repeated labels
of a document count as their majority; null labels are left out. Without any labels, the score is 0. Repeated rows are
scored each, and are one example. Labels, lang, source and doc_id take no part in a score.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Collection, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailspark.llm import sketches
from retailspark.llm.common import append_columns, map_rows, portable, staged

EXAMPLES = 16_384
DENSE = 512  # terms at most that the index holds as a matrix
DENSE_SHARE = 0.05  # of the examples, that such a term occurs in
SLACK = 1e-4  # over twice the relative rounding error of DENSE single-precision sums
QUERIES = 64  # multiplied with the matrix at once
NEAREST = 25
PART = 1024  # examples whose vectors are made at a time
PRIOR = 0.5
HELD_OUT = 5
MEMORY = 10_000  # texts whose scores a task remembers

_WORD = re.compile(r"[^\W\d_]+")

Sparse = tuple[np.ndarray, np.ndarray]  # terms in order, and a number for each
ENTRY = np.dtype([("example", "<i4"), ("value", "<f4")])  # of an inverted list


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT == 0, F.lit(False))


# Latin-1 bytes of the letters in lower case, blanks for all others.
_LATIN = bytes(ord(chr(i).lower()) if _WORD.fullmatch(chr(i)) else 32 for i in range(256))


def _key(word: str) -> bytes:
    try:
        return word.encode("latin-1")
    except UnicodeEncodeError:
        return b"\0" + word.encode()


def words_of(text: str | None) -> bytes:
    """The words of a text with blanks between, as Latin-1 if a word has only such letters. Most texts are turned into
    bytes as a whole."""
    try:
        return (text or "").encode("latin-1").translate(_LATIN)
    except UnicodeEncodeError:
        return b" ".join(_key(w) for w in _WORD.findall(text.lower()))


class Terms:
    """The words of the examples: their 64-bit hashes in order. A term's number is its place there."""

    TEXTS = 128  # that are looked up at a time

    def __init__(self, hashes: np.ndarray):
        self.hashes, self.size = hashes, len(hashes)

    def counts_of(self, texts: list[str | None]) -> Iterator[Sparse]:
        """Each text's terms, and how often each stands in it."""
        for at in range(0, len(texts), self.TEXTS):
            found, edges = sketches.hashed([words_of(t) for t in texts[at : at + self.TEXTS]])
            place = np.searchsorted(self.hashes, found)
            known = self.hashes[np.minimum(place, self.size - 1)] == found if self.size else np.zeros(len(found), bool)
            for start, stop in zip(edges, edges[1:]):
                yield np.unique(place[start:stop][known[start:stop]], return_counts=True)

    def counts(self, text: str | None) -> Sparse:
        return next(self.counts_of([text]))


def packed(*arrays: np.ndarray) -> list[bytes]:
    return [zlib.compress(a.astype("<i4").tobytes(), 1) for a in arrays]


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), "<i4")


def sparse(counts: dict[int, float]) -> Sparse:
    order = sorted(counts)
    return np.array(order, np.int64), np.array([counts[t] for t in order], float)


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, .. for sizes[0] numbers, and so on."""
    out = np.repeat(starts - np.cumsum(sizes) + sizes, sizes)
    out += np.arange(len(out))
    return out


class Index:
    """The examples' unit vectors by rows, and by terms: a matrix of the frequent ones and inverted lists of the others."""

    def __init__(self, vectors: list[dict[int, float]], n_terms: int):
        rows = [sparse(v) for v in vectors]
        edges = np.cumsum([0, *(len(t) for t, _ in rows)])
        joined = (np.concatenate([r[k] for r in rows] or [np.zeros(0)]) for k in (0, 1))
        self.fill(edges, *joined, n_terms)

    @classmethod
    def of(cls, edges: np.ndarray, terms: np.ndarray, weights: np.ndarray, n_terms: int) -> Index:
        index = cls.__new__(cls)
        index.fill(edges, terms, weights, n_terms)
        return index

    def fill(self, edges, terms, weights, n_terms) -> None:
        """By ``PART`` examples at a time, so that little is held beside the result."""
        self.size, self.edges, self.weights = len(edges) - 1, edges, weights
        self.terms = terms.astype(np.int32, copy=False)
        seen = np.bincount(self.terms, minlength=n_terms)
        frequent = np.argsort(-seen, kind="stable")[:DENSE]
        frequent = frequent[seen[frequent] >= max(1.0, DENSE_SHARE * self.size)]
        self.column = np.full(n_terms, -1, np.int32)
        self.column[frequent] = np.arange(len(frequent))
        self.matrix = np.zeros((len(frequent), self.size), np.float32)
        sizes = np.where(self.column < 0, seen, 0)
        ends = np.cumsum(sizes)
        self.spans = np.stack([ends - sizes, sizes], 1)  # of each term: where its list starts, its length
        self.lists = np.empty(int(sizes.sum()), ENTRY)
        free = self.spans[:, 0].copy()  # of each term: the next place in its list
        del seen, sizes, ends
        for first in range(0, self.size, PART):
            part = edges[first : min(first + PART, self.size) + 1]
            examples = np.repeat(np.arange(first, first + len(part) - 1, dtype=np.int32), np.diff(part))
            found, values = self.terms[part[0] : part[-1]], weights[part[0] : part[-1]]
            columns = self.column[found]
            dense = columns >= 0
            self.matrix[columns[dense], examples[dense]] = values[dense]
            rest = np.flatnonzero(~dense)
            rest = rest[np.argsort(found[rest], kind="stable")]
            if not len(rest):
                continue
            found = found[rest]
            heads = np.flatnonzero(np.diff(found, prepend=-1))
            number = np.diff(heads, append=len(found))
            place = ranges(free[found[heads]], number)
            self.lists["example"][place], self.lists["value"][place] = examples[rest], values[rest]
            free[found[heads]] += number
        self.scratch = np.zeros(n_terms)

    def nearest(self, query: dict[int, float], k: int, without=()) -> list[tuple[float, int]]:
        """The k examples of largest positive cosine with a unit vector, nearest first, but for ``without``."""
        scores, ids = self.nearest_of_all([sparse(query)], k, [np.atleast_1d(np.array(without, np.int64))])[0]
        return list(zip(scores.tolist(), ids.tolist()))

    def nearest_of_all(self, queries: list[Sparse], k: int, without: list) -> list[tuple[np.ndarray, np.ndarray]]:
        """(cosines, examples) for each query."""
        found = []
        for at in range(0, len(queries), QUERIES):
            part = queries[at : at + QUERIES]
            dense = np.zeros((len(part), len(self.matrix)), np.float32)
            for i, (terms, weights) in enumerate(part):
                columns = self.column[terms]
                dense[i, columns[columns >= 0]] = weights[columns >= 0]
            for scores, query, own in zip(dense @ self.matrix, part, without[at : at + QUERIES]):
                found.append(self.best(scores, query, k, own))
        return found

    def best(self, scores: np.ndarray, query: Sparse, k: int, without) -> tuple[np.ndarray, np.ndarray]:
        """The nearest, from the dense terms' sums."""
        terms, weights = query
        spans = self.spans[terms]
        listed = np.flatnonzero(spans[:, 1])
        if len(listed):
            starts, sizes = spans[listed].T
            entries = self.lists.view(np.int64).take(ranges(starts, sizes)).view(ENTRY)
            values = entries["value"] * np.repeat(weights[listed].astype(np.float32), sizes)
            scores += np.bincount(entries["example"], values, self.size)
        if len(without):
            scores[without] = 0
        least = np.partition(scores, -k)[-k] * np.float32(1 - SLACK) if self.size > k else np.float32(0)
        ids = np.flatnonzero((scores >= least) & (scores > 0))
        if not len(ids):
            return np.zeros(0), ids
        sizes = self.edges[ids + 1] - self.edges[ids]
        at = ranges(self.edges[ids], sizes)
        self.scratch[terms] = weights
        exact = np.add.reduceat(self.scratch[self.terms[at]] * self.weights[at], np.cumsum(sizes) - sizes)
        self.scratch[terms] = 0
        order = np.lexsort((ids, -exact))[:k]
        return exact[order], ids[order]


class Isotonic:
    """The rising step function nearest to labels over votes, joined linearly between its steps' middles."""

    def __init__(self, votes: np.ndarray, labels: np.ndarray):
        order = np.argsort(votes, kind="stable")
        steps: list[list[float]] = []  # sum of labels, weight, sum of votes
        for v, group in zip(*_groups(votes[order], labels[order])):
            steps.append([group[0], group[1], v * group[1]])
            while len(steps) > 1 and steps[-2][0] * steps[-1][1] >= steps[-1][0] * steps[-2][1]:
                last = steps.pop()
                steps[-1] = [a + b for a, b in zip(steps[-1], last)]
        self.x = np.array([s[2] / s[1] for s in steps] or [0.0])
        self.y = np.array([s[0] / s[1] for s in steps] or [0.0])

    def __call__(self, vote: float) -> float:
        return float(np.interp(vote, self.x, self.y))


def _groups(votes, labels):
    values, at = np.unique(votes, return_inverse=True)
    return values.tolist(), list(zip(np.bincount(at, labels).tolist(), np.bincount(at).tolist()))


class Model:
    """Terms with their weights, the examples and the calibration. Vectors and index are made where they are first used."""

    def __init__(self, terms: Terms, weight: np.ndarray, ids: list[int], sizes: bytes, steps: bytes, counts: bytes, labels: np.ndarray):
        """``weight`` of each term; ``sizes``: terms of each example; ``steps`` and ``counts``: their numbers, as differences, and how often they are
        there, one example's after another's."""
        self.state = terms, weight, ids, sizes, steps, counts, labels
        self.terms, self.ids, self.known = terms, ids, labels
        self.rate = float(labels.mean()) if len(labels) else 0.0
        self.calibrate: Isotonic | None = None

    def __reduce__(self):
        return Model, self.state, {"calibrate": self.calibrate}

    @cached_property
    def vectors(self) -> tuple[np.ndarray, Index]:
        """The terms' weights, and the index."""
        _, weight, ids, sizes, steps, counts, _ = self.state
        edges = np.concatenate([[0], np.cumsum(unpacked(sizes), dtype=np.int64)])
        numbers, counts = np.cumsum(unpacked(steps), dtype=np.int32), unpacked(counts)
        weights = np.empty(len(numbers))
        for first in range(0, len(ids), PART):  # of the examples, so that little is held beside the result
            last = min(first + PART, len(ids))
            part = slice(edges[first], edges[last])
            found = (1 + np.log(counts[part])) * weight[numbers[part]]
            rows = np.repeat(np.arange(last - first), np.diff(edges[first : last + 1]))
            weights[part] = found / np.sqrt(np.bincount(rows, found * found, last - first))[rows]
        del counts
        return weight, Index.of(edges, numbers, weights, len(weight))

    @property
    def weight(self) -> np.ndarray:
        return self.vectors[0]

    @property
    def index(self) -> Index:
        return self.vectors[1]

    @cached_property
    def place(self) -> dict[int, list[int]]:
        found: dict[int, list[int]] = {}
        for i, doc_id in enumerate(self.ids):
            found.setdefault(doc_id, []).append(i)
        return found

    def unit(self, counts: Sparse) -> Sparse:
        terms, n = counts
        weights = (1 + np.log(n)) * self.weight[terms]
        return terms, weights / np.sqrt((weights * weights).sum()) if len(terms) else weights

    def example(self, i: int) -> Sparse:
        part = slice(self.index.edges[i], self.index.edges[i + 1])
        return self.index.terms[part], self.index.weights[part]

    def vote(self, cosines: np.ndarray, neighbours: np.ndarray) -> float:
        weights = cosines * cosines
        return float(((weights * self.known[neighbours]).sum() + PRIOR * self.rate) / (weights.sum() + PRIOR))

    def votes(self, examples: list[int]) -> list[float]:
        """Of the other documents' examples on these."""
        own = [self.place[self.ids[i]] for i in examples]
        return [self.vote(*x) for x in self.index.nearest_of_all([self.example(i) for i in examples], NEAREST, own)]

    def counts(self, text: str | None) -> Sparse:
        return self.terms.counts(text)

    def scores(self, counts: list[Sparse]) -> list[tuple[float, list[tuple[int, float, int]]]]:
        out = []
        for cosines, found in self.index.nearest_of_all([self.unit(c) for c in counts], NEAREST, [()] * len(counts)):
            evidence = [(self.ids[i], c, int(self.known[i])) for c, i in zip(cosines[:3].tolist(), found[:3].tolist())]
            out.append((min(1.0, max(0.0, self.calibrate(self.vote(cosines, found)))), evidence))
        return out


def dependence(vectors: list[np.ndarray], labels: np.ndarray, n_terms: int) -> np.ndarray:
    """Chi-square between each term's occurring in an example and the label; 0 for terms of all examples."""
    n, n1 = len(labels), float(labels.sum())
    seen, seen1 = np.zeros(n_terms), np.zeros(n_terms)
    for terms, label in zip(vectors, labels):  # a vector has a term once
        seen[terms] += 1
        seen1[terms] += label
    cross = seen1 * (n - n1) - (seen - seen1) * n1
    under = seen * (n - seen) * (n1 * (n - n1))
    return np.divide(n * cross * cross, under, out=np.zeros(n_terms), where=under > 0)


def chosen_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of the labelled rows to learn from."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.avg("toxic") >= 0.5).cast("int").alias("toxic"))
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(EXAMPLES)


VECTOR = ("toxic_terms", "toxic_counts")  # a text's terms, as differences, and counts: little-endian 32-bit numbers


def vector(terms: bytes, counts: bytes = b"") -> Sparse:
    return np.cumsum(np.frombuffer(terms, "<i4"), dtype=np.int32), np.frombuffer(counts, "<i4")


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """The model from the labelled rows of ``docs``, with idf over all of them."""
    return fitted(docs, labels, without=("text",))[0]


def fitted(docs: DataFrame, labels: DataFrame, without: Collection[str] = ()) -> tuple[Model, DataFrame, list[str]]:
    """The model, and ``docs`` with the vectors of their texts in two more columns, whose names come last.

    The texts are cut into words once, and written together with their vectors, but for columns ``without``.
    """
    spark = docs.sparkSession
    chosen = staged(chosen_labels(labels), "toxic-labels")
    doc_id = F.col("doc_id").cast("long")
    examples = docs.select(doc_id.alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id").select("text")

    def distinct(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                found, _ = sketches.hashed([words_of(t) for t in batch.column(0).slice(at, 256).to_pylist()])
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(found).view(np.int64))], names=["word"])

    words = examples.mapInArrow(portable(distinct), "word long").distinct().toArrow()["word"].to_numpy()
    terms = Terms(np.sort(words.astype(np.int64).view(np.uint64)))
    shared = spark.sparkContext.broadcast(terms)

    def vectors():
        known = shared.value

        def step(rows):
            return [
                (np.diff(terms, prepend=0).astype("<i4").tobytes(), counts.astype("<i4").tobytes())
                for terms, counts in known.counts_of([text for (text,) in rows])
            ]

        return step

    names = list(VECTOR)
    while set(names) & set(docs.columns):
        names = [f"{n}_" for n in names]
    held = staged(append_columns(docs, ["text"], vectors, ", ".join(f"{n} binary" for n in names), without), "toxic-vectors")
    shared.destroy()
    size = terms.size

    def occurring(batches):
        """(term, texts that have it) over all of the task's texts; term -1 stands for any."""
        seen, rows = np.zeros(size, np.int64), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                steps = batch.column(0).slice(at, 1024).to_pylist()
                rows += len(steps)
                numbers = [np.cumsum(np.frombuffer(x, "<i4"), dtype=np.int64) for x in steps]
                seen += np.bincount(np.concatenate(numbers), minlength=size)
        term = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(term, -1), pa.int64()), pa.array(np.append(seen[term], rows), pa.int64())], names=["term", "n"]
        )

    found = held.select(names[0]).mapInArrow(portable(occurring), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = found.toArrow()  # one row a term
    term, n = (found[c].to_numpy() for c in ("term", "n"))
    total, seen = int(n[term < 0].sum()), np.zeros(size)
    seen[term[term >= 0]] = n[term >= 0]
    idf = np.log((1 + total) / (1 + seen)) + 1

    # Repeated rows are one example.
    known = held.select(doc_id.alias("doc_id"), F.col(names[0]).alias("terms"), F.col(names[1]).alias("counts"))
    known = known.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id", "terms", "counts"])
    known = known.toArrow().sort_by([("doc_id", "ascending"), ("terms", "ascending"), ("counts", "ascending")])
    labelled = known["toxic"].to_numpy().astype(float)
    numbers = [vector(x)[0] for x in known["terms"].to_pylist()]
    weight = idf * np.sqrt(1 + dependence(numbers, labelled, size))
    sizes, = packed(np.array([len(x) for x in numbers]))
    steps, = packed(np.diff(np.concatenate(numbers or [np.zeros(0, np.int32)]), prepend=0))
    del numbers
    counts, = packed(np.frombuffer(b"".join(known["counts"].to_pylist()), "<i4"))
    model = Model(terms, weight, known["doc_id"].to_pylist(), sizes, steps, counts, labelled)
    model.calibrate = Isotonic(votes_of(spark, model), model.known)
    return model, held, names


def votes_of(spark, model: Model) -> np.ndarray:
    """The vote on each example, by the others."""
    shared = spark.sparkContext.broadcast(model)

    def make():
        return lambda part: zip([i for (i,) in part], shared.value.votes([i for (i,) in part]))

    found = map_rows(spark.range(len(model.ids)), make, "example long, vote double").toArrow()
    votes = np.zeros(len(model.ids))
    votes[found["example"].to_numpy()] = found["vote"].to_numpy()
    shared.destroy()
    return votes


def score(docs: DataFrame, labels: DataFrame, without: Collection[str] = ()) -> DataFrame:
    """``docs`` with toxic_score and toxic_evidence (doc_id, cosine, label of the nearest examples) behind its columns, but
    for columns ``without``, which are not written: any but doc_id."""
    model, held, names = fitted(docs, labels, without)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        known = shared.value
        memory: dict[bytes, tuple] = {}

        def step(rows):
            if len(memory) > MEMORY:
                memory.clear()
            keys = [hashlib.md5(b"%d:" % len(terms) + terms + counts).digest() for terms, counts in rows]
            new = {key: row for key, row in zip(keys, rows) if key not in memory}
            memory.update(zip(new, known.scores([vector(*row) for row in new.values()])))
            return [memory[key] for key in keys]

        return step

    schema = "toxic_score double, toxic_evidence array<struct<doc_id: long, cosine: double, label: int>>"
    return append_columns(held, names, make, schema, without=names)


def keep(docs: DataFrame, labels: DataFrame, most: float = 0.5) -> DataFrame:
    """The documents that score under ``most``, whole rows."""
    names = [f"__{i}" for i in range(len(docs.columns))]  # the caller's columns may have the score's name
    renamed = docs.toDF(*names).withColumns({c: F.col(names[docs.columns.index(c)]) for c in ("doc_id", "text")})
    scored = score(renamed, labels, without=("text",))  # it is among the names
    return scored.filter(F.col("toxic_score") < most).select(*names).toDF(*docs.columns)
