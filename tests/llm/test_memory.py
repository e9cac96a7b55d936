"""What worker processes hold: nothing of earlier stages, and little beside an index that they build."""

import tracemalloc

import numpy as np

from retailspark.llm import common, nearest_labels, packing, pieces

WORKERS = 8


def test_token_memories_go_with_the_next_stage(spark):
    """Tasks of the local session share its worker processes."""
    docs = spark.range(64).selectExpr("id AS doc_id", "concat('some words ', id) AS text").repartition(WORKERS)
    file = pieces.path(packing.TOKENIZER)
    assert packing.encoded(docs, file, 1024, 0).count() == 64

    def make():
        from retailspark.llm import common

        return lambda rows: [(len(common._kept),)]

    assert {r.held for r in common.map_rows(docs, make, "held long").collect()} == {0}


def test_columns_without_end_in_the_tasks(spark):
    df = spark.createDataFrame([(1, "a", 2)], "x int, y string, z int")
    found = common.append_columns(df, ["y", "x"], lambda: lambda rows: [(f"{y}{x}",) for y, x in rows], "n string", without=["y"])
    assert found.columns == ["x", "z", "n"] and [tuple(r) for r in found.collect()] == [(1, 2, "a1")]


def test_an_index_takes_little_beside_its_result():
    rng, terms, size, each = np.random.default_rng(1), 5_000, 8_000, 50
    numbers = np.sort(rng.integers(0, terms, (size, each)), axis=1) * 2  # some terms are in no row
    numbers = (numbers + np.arange(each)).astype(np.int32).reshape(-1)
    weights, edges = rng.random(len(numbers)), np.arange(0, size * each + 1, each)
    tracemalloc.start()
    index = nearest_labels.Index.of(edges, numbers, weights, 2 * terms + each)
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak - held < 12 * len(numbers)  # bytes; 20 if all is sorted at once
    for term in rng.integers(0, terms, 20).tolist():
        start, n = index.spans[term]
        entries = index.lists[start : start + n]
        at = np.flatnonzero(numbers == term)
        if index.column[term] < 0:
            assert entries["example"].tolist() == (at // each).tolist()
            assert entries["value"].tolist() == weights[at].astype(np.float32).tolist()
