import itertools
import random

import numpy as np

from retailspark.llm import near_copies, sketches
from retailspark.llm.components import components
from tests.conftest import plan_of


def shingle_lists(texts):
    values, edges = sketches.shingles(*sketches.words(texts), near_copies.WORDS)
    return [values[a:b] for a, b in zip(edges, edges[1:])]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def similarity(a, b):
    matched = lcs(a.tolist(), b.tolist())
    return matched / (len(a) + len(b) - matched)


def brute_classes(rows, alike=similarity):
    """Classes by comparing all texts with one another."""
    texts = list(dict.fromkeys(t or "" for _, t in rows))
    lists, parent = shingle_lists(texts), list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(texts)), 2):
        if len(lists[i]) and len(lists[j]) and alike(lists[i], lists[j]) >= near_copies.SIMILARITY:
            parent[find(i)] = find(j)
    place, least = {t: k for k, t in enumerate(texts)}, {}
    for d, t in rows:
        root = find(place[t or ""])
        least[root] = min(least.get(root, d), d)
    return {(d, least[find(place[t or ""])]) for d, t in rows}


def planted(seed=4):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows, n = [], itertools.count(100)
    passage = [word() for _ in range(60)]
    for _ in range(12):
        base = [word() for _ in range(rng.choice([3, 5, 40, 120]))] + (passage if rng.random() < 0.5 else [])
        rows.append((next(n), " ".join(base)))
        for _ in range(rng.choice([0, 1, 5])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 6])):
                at = rng.randrange(len(copy))
                copy[at : at + 1] = rng.choice([[], [word()], [copy[at], word()]])
            rows.append((next(n), " ".join(copy)))
    hot = [word() for _ in range(150)]
    for _ in range(60):  # edited copies of one text, many of them alike to it alone
        copy = list(hot)
        for at in rng.sample(range(150), rng.choice([1, 2, 3, 4])):
            copy[at] = word()
        rows.append((next(n), " ".join(copy)))
    rows += [(next(n), " ".join(hot)), (50, rows[3][1]), (51, rows[3][1]), (60, ""), (61, None), (62, " "), rows[0]]
    return rows


def test_alignment_equals_brute_force():
    rng = random.Random(1)
    for _ in range(200):
        a = [rng.randrange(8) for _ in range(rng.randrange(1, 60))]
        b = list(a)
        for _ in range(rng.randrange(8)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randrange(2)] = [rng.randrange(8)] * rng.randrange(2)
        matched = lcs(a, b)
        exact = matched / (len(a) + len(b) - matched)
        got = near_copies.aligned(np.array(a), np.array(b))
        assert got <= exact + 1e-12
        if exact >= near_copies.SIMILARITY:
            assert abs(got - exact) < 1e-12


def test_words_are_split_at_white_space_and_lower_cased():
    values, edges = sketches.words(["A b\ta", "", " \n", "B\r\nA"])
    assert edges.tolist() == [0, 3, 3, 3, 5]
    a, b, c, d, e = values.tolist()
    assert a == c == e and b == d and a != b


def test_sketches_depend_on_order_and_repetition():
    lists = [["x y z v w q", "x y z v w q"], ["a b c d e f a b c d e", "a b c d e f"]]
    for one, two in lists:
        values, edges = sketches.shingles(*sketches.words([one, two]), 5)
        sketch = sketches.order_minhash(values, edges, 8, 3)
        assert (sketch[0] == sketch[1]).all() == (one == two)


def test_classes_equal_brute_force(spark):
    rows = planted()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {(r.doc_id, r.class_id) for r in near_copies.classes(docs).collect()}
    assert got == brute_classes(rows)


def test_one_row_of_each_class_stays(spark):
    rows = planted(9)
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, node string")
    got = near_copies.first_of_each(docs)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == sorted({c for _, c in brute_classes(rows)})


def test_whole_rows_are_shuffled_once(spark):
    """Rows that stay are joined by shuffle, as in large tables; repeated ones and such without an id are one."""
    text = "words that stand in more rows than one, of which some have no id"
    rows = [(7, text, 1), (7, text, 1), (None, text, 2), (9, text, 3), (None, "another text", 4), (None, "another text", 4),
            (0, "a third text", 5), (None, "a third text", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = near_copies.first_of_each(docs)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted([rows[0], rows[4], rows[6]], key=repr)
        assert plan_of(got, "simple").split("== Initial Plan ==")[-1].count("Exchange hashpartitioning") == 2  # rows, classes
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_short_texts_lose_no_link(spark):
    """Texts of 8 words and the same with one word more are similar at the threshold exactly."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7))
    rows = []
    for i in range(4000):
        words = [word() for _ in range(8)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join([*words, word()]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert all(r.class_id == r.doc_id // 2 * 2 for r in near_copies.classes(docs).collect())


def test_columns_of_any_name_are_left_alone(spark):
    names = ["__node", "node", "kept", "id", "__kept", "key", "__0", "least"]
    rows = [(i, "the same words again and again in this text", *(f"{n} {i}" for n in names)) for i in range(3)]
    schema = "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names)
    (row,) = near_copies.first_of_each(spark.createDataFrame(rows, schema)).collect()
    assert tuple(row) == rows[0]


def test_components_of_a_long_chain(spark):
    edges = [(f"{i:03}", f"{i + 1:03}") for i in range(40)] + [("900", "901"), ("901", "901"), ("901", "900")]
    found = components(spark.createDataFrame(edges, "a string, b string")).collect()
    assert sorted(map(tuple, found)) == sorted([(f"{i:03}", "000") for i in range(41)] + [("900", "900"), ("901", "900")])
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0
