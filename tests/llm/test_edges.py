"""What every operator does with nulls, repeated rows, clashing columns, very long texts and empty tables."""

import pytest

import __spark_entry__
import corpus_pipeline
from retailspark.llm import queries
from tests.conftest import SMALL

COLUMNS = (
    "doc_id long, text string, lang string, source string, n_chars long, node string, ids string, host string,"
    " toxic_score string, key int, clean int, __0 int, n_words string"
)
REST = ("a", "b", "c", "d", 1, 2, 3, "e")


def rows():
    long = " ".join(f"w{i % 977}x{i}" for i in range(20_000))
    plain = "one plain text of more than twenty words that says nothing at all about anyone or anything in this world of ours today"
    found = [
        (1, plain, "en", "s1", 9, *REST), (2, plain, None, None, None, *[None] * 8), (3, None, "en", "s1", 0, *REST),
        (4, "", "en", "", 0, *REST), (5, long, "en", "s2", 1, *REST), (6, "x" * 100_000, "en", "s2", 1, *REST),
        (None, plain + " but without an id", "en", "s1", 9, *REST), (7, "tie " * 30, "en", "s1", 9, *REST),
    ]
    return [*found, found[0]]  # a repeated row


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables of awkward rows, and the same without any rows."""
    base = tmp_path_factory.mktemp("edges")
    embeddings = [(20, [1.0, 0.0], 1), (20, [1.0, 0.0], 1), (21, [0.5, 0.5], None), (22, None, 1), (None, [1.0, 1.0], 1)]
    conversations = [
        (5, 1, "user", "a", "p", 1, 2, 3), (5, 1, "user", "a", "p", 1, 2, 3), (5, None, None, None, None, None, None, None),
        (6, 1, "user", "", "p", 1, 2, 3), (None, 1, "user", "a", "p", 1, 2, 3), (7, 0, "user", "x " * 50_000, "p", 1, 2, 3),
    ]
    labels = [(1, 1, 0), (2, None, None), (5, 0, 0), (7, 1, 0), (7, 1, 1), (None, 1, 1)]
    for name, keep in (("awkward", True), ("empty", False)):
        for table, data, schema in (
            ("documents", rows(), COLUMNS), ("embeddings", embeddings, "vec_id long, embedding array<float>, label int"),
            ("labels", labels, "doc_id long, quality int, toxic int"),
            ("conversations", conversations, "conv_id long, turn int, role string, text string, path string, key int, number int, keys int"),
        ):
            df = spark.createDataFrame(data if keep else [], schema)
            df.write.parquet(f"{base}/{name}/{table}.parquet")
    return str(base)


ONE_ROW_A_DOCUMENT = [
    "op2_token_counts", "op3_near_copies", "op5_personal_data", "op6_huffman", "op7_host_rules", "op8_prefix_bpe",
    "op9_nearest_labels", "op11_substrings", "op12_infilling",
]


@pytest.mark.parametrize("name", queries.QUERIES)
def test_awkward_rows(spark, folder, name):
    found = queries.QUERIES[name](spark, f"{folder}/awkward").collect()
    if name in ONE_ROW_A_DOCUMENT:
        assert sorted(r.doc_id or 0 for r in found) == sorted(r[0] or 0 for r in rows())
    if name == "op3_near_copies":
        classes = {r.doc_id: r.class_id for r in found}
        assert classes[1] == classes[2] == 1 and classes[3] == classes[4] == 3 and classes[5] == 5
    if name == "op4_packing":
        assert {r.doc_id for r in found} == {r[0] for r in rows()}


@pytest.mark.parametrize("name", queries.QUERIES)
def test_empty_tables(spark, folder, name):
    assert queries.QUERIES[name](spark, f"{folder}/empty").count() == 0


def test_the_pipeline_takes_awkward_and_empty_tables(spark, folder):
    docs = spark.read.parquet(f"{folder}/awkward/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, f"{folder}/awkward")
        assert found.columns == docs.columns
        assert found.count() <= docs.count()
    assert corpus_pipeline.run(spark, f"{folder}/awkward").count() > 0
    assert corpus_pipeline.run(spark, f"{folder}/empty").count() == 0


def test_queries_are_registered():
    registered = __spark_entry__.queries()
    assert registered.keys() >= {*queries.QUERIES, "pipeline"}
    assert [int(n[2:].split("_")[0]) for n in queries.QUERIES] == list(range(1, 11))


def test_pipeline_keeps_what_its_stages_keep(spark):
    """Every stage on its own input, against plain Python."""
    from retailspark.llm import host_rules, near_copies, nearest_labels, personal_data
    from tests.llm.test_near_copies import brute_classes

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [r.asDict() for r in docs.collect()]
    model = nearest_labels.fit(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    rows = [r for r in rows if model.scores([model.counts(r["text"])])[0][0] < 0.5]
    measures = [host_rules.measure(r["text"]) for r in rows]
    rows = [r for r, m in zip(rows, measures) if m[0] >= 20 and 100 * m[5] <= 30 * m[0]]
    least = {c for _, c in brute_classes([(r["doc_id"], r["text"]) for r in rows], near_copies.aligned)}
    rows = [r for r in rows if r["doc_id"] in least]
    texts = {r["doc_id"]: personal_data.redact(r["text"], personal_data.spans(r["text"])[1]) for r in rows}

    state = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        state = stage(spark, state, SMALL)
    got = state.collect()
    assert {r.doc_id: r.text for r in got} == texts
    assert all(r.n_chars == len(r.text) for r in got)
