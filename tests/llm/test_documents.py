"""Personal data, host rules, nearest labels, licences and small worlds against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from retailspark.llm import host_rules, licences, nearest_labels, personal_data, small_world
from tests.conftest import SMALL

# ------------------------------------------------------------ personal data

PATTERNS = {  # fixed values of the contract
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m.group().split(".")),
                "card": 13 <= len(digits) <= 19 and sum(
                    sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0,
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((kind, m.start(), m.end()))
    return found


def test_plain_spans_equal_the_patterns():
    rng = random.Random(2)
    texts = ["".join(rng.choice("a1.@+- ()9z2%") for _ in range(60)) for _ in range(5000)]
    texts += ["4111 1111-1111 1111 x 1.2.3.4.5.6.7.8 a@b@c.de +1 (555) 555-1234 256.1.1.1", "1" * 5000, "a" * 5000 + "@x.y"]
    for text in texts:
        assert personal_data.plain_spans(text) == brute_spans(text)


@pytest.mark.parametrize("text, kind, part", [
    ("write john [at] example [dot] com now", "email", "john [at] example [dot] com"),
    ("jane dot doe at mail dot example dot org.", "email", "jane dot doe at mail dot example dot org"),
    ("call plus one five five five, oh one double two three four five six!", "phone",
     "plus one five five five, oh one double two three four five six"),
    ("４１１１ １１１１ １１１１ １１１１", "card", "４１１１ １１１１ １１１１ １１１１"),
    ("ask jоhn@example.com", "email", "jоhn@example.com"),
    ("é one nine two dot one six eight dot one dot one", "ip", "one nine two dot one six eight dot one dot one"),
])
def test_disguises_are_mapped_back(text, kind, part):
    plain, found = personal_data.spans(text)
    assert (kind, text.index(part), text.index(part) + len(part)) in found
    assert set(plain) <= set(found)
    assert part not in personal_data.redact(text, found)


@pytest.mark.parametrize("text", ["look at example.com (at) once", "one two three at noon dot", "Ωmega ана 1.2", ""])
def test_ordinary_text_is_left_alone(text):
    assert personal_data.spans(text) == ([], [])


@pytest.mark.parametrize("text, kind, part", [
    ("call +1 555 one two three 4567 now", "phone", "+1 555 one two three 4567"),
    ("call plus 1 (555) one double two 4567 now", "phone", "plus 1 (555) one double two 4567"),
    ("host 192 dot 168 dot one dot one is up", "ip", "192 dot 168 dot one dot one"),
    ("host 192 dot 168 dot 1 dot 1, is up", "ip", "192 dot 168 dot 1 dot 1"),
    ("number one 10.20 dot 30 dot four is up", "ip", "10.20 dot 30 dot four"),
    ("card 4111 1111 1111 one one one one.", "card", "4111 1111 1111 one one one one"),
    ("ask john at gmail.com today", "email", "john at gmail.com"),
    ("ask j.doe at corp.example.org.", "email", "j.doe at corp.example.org"),
    ("email me: jane at example.com", "email", "jane at example.com"),
])
def test_mixed_disguises_are_found(text, kind, part):
    plain, found = personal_data.spans(text)
    assert (kind, text.index(part), text.index(part) + len(part)) in found
    assert part not in personal_data.redact(text, found)


@pytest.mark.parametrize("text", ["we met at 10.30 and one of 200 2 left", "look at example.com, point 3 of 12", "one 2 three dot"])
def test_mixed_numbers_in_ordinary_text_are_left_alone(text):
    assert personal_data.spans(text) == ([], [])


# --------------------------------------------------------------- host rules


def brute_repeats(words):
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    return len({i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)})


def test_measures_equal_brute_force(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randrange(40))).encode().split() for _ in range(300)]
    assert [host_rules.repeat_words(w) for w in texts] == [brute_repeats(w) for w in texts]
    assert host_rules.measure("a b#\n\n a b#\nb\xa0\x1c &\tc") == (7, 11, 3, 3, 0, 0)
    assert host_rules.measure("x y\nx y\n \nx y") == (6, 6, 0, 3, 2, 0)
    for row in spark.read.parquet(f"{SMALL}/documents.parquet").limit(60).collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", row.text)
        got = host_rules.measure(row.text)
        assert got[:2] == (len(words), sum(map(len, words))) and got[5] == brute_repeats(words)


def test_bad_hosts_fall_and_small_ones_are_shrunk(spark):
    rng = random.Random(5)
    good = lambda: " ".join("".join(rng.choices("abcdefg", k=5)) for _ in range(40))
    bad = lambda: good() + " #$%&|" * 3
    rows = [(i, "http://Bad.example:80/x" if i % 2 else " bad.EXAMPLE ", bad()) for i in range(40)]
    rows += [(100 + i, f"good{i % 30}", good()) for i in range(900)]
    rows += [(2000, "lone", bad()), (2001, None, bad()), (2002, "good1", "few words"), (2003, "good1", None)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    found = {r.doc_id: r for r in host_rules.verdicts(docs).collect()}
    assert {r.host for r in found.values() if r.doc_id < 40} == {"bad.example"}
    assert not any(found[i].kept for i in range(40)) and all(found[100 + i].kept for i in range(900))
    assert 0 < found[2000].host_rate < 1 and found[2001].host_rate is None and found[2001].kept
    assert found[2002].base_failed and not found[2003].kept
    kept = host_rules.keep(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in found.items() if r.kept}


# ----------------------------------------------------------- nearest labels


def test_neighbours_equal_brute_force():
    rng = np.random.default_rng(0)
    vectors = []
    for _ in range(700):
        terms = rng.choice(40, rng.integers(1, 9), replace=False)
        weights = np.round(rng.random(len(terms)) + 0.1, 1)
        vectors.append(dict(zip(terms.tolist(), (weights / np.sqrt((weights**2).sum())).tolist())))
    vectors += vectors[:150]
    index, dense = nearest_labels.Index(vectors, 41), np.zeros((len(vectors), 41))
    for i, v in enumerate(vectors):
        dense[i, list(v)] = list(v.values())
    for q in range(0, len(vectors), 7):
        scores = dense @ dense[q]
        scores[q] = 0
        order = np.lexsort((np.arange(len(scores)), -np.round(scores, 12)))[:9]
        got = index.nearest(vectors[q], 9, q)
        assert np.allclose([s for s, _ in got], scores[order])
        assert len({i for _, i in got}) == 9 and q not in {i for _, i in got}
    assert index.nearest({40: 1.0}, 3) == []


def test_isotonic_steps_rise():
    fit = nearest_labels.Isotonic(np.array([0.1, 0.2, 0.2, 0.5, 0.7, 0.9]), np.array([0, 1, 0, 1, 0, 1.0]))
    values = [fit(x) for x in np.linspace(0, 1, 50)]
    assert values == sorted(values) and 0 <= values[0] and values[-1] == 1


def test_held_out_rows_are_told_apart(spark):
    folder = SMALL.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = nearest_labels.score(docs.select("doc_id", "text"), labels)
    rows = scored.join(labels, "doc_id").filter(nearest_labels.held_out(scored["doc_id"])).collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows) and len(rows) > 50
    assert np.mean([(r.toxic_score >= 0.5) == r.toxic for r in rows]) > 0.9
    kept = nearest_labels.keep(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == scored.filter("toxic_score < 0.5").count()


def test_texts_are_written_once_with_their_vectors(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "vile words here" if i % 2 else "kind words here", "x") for i in range(40)],
                                 "doc_id long, text string, source string")
    written = {}
    staged = nearest_labels.staged

    def noted(df, label):
        written[label] = df.columns
        return staged(df, label)

    monkeypatch.setattr(nearest_labels, "staged", noted)
    kept = nearest_labels.keep(docs, docs.selectExpr("doc_id", "cast(doc_id % 2 AS int) AS toxic"))
    assert {tuple(r) for r in kept.collect()} == {(i, "kind words here", "x") for i in range(0, 40, 2)}
    assert written["toxic-vectors"] == ["__0", "__1", "__2", "doc_id", *nearest_labels.VECTOR]


def test_labels_of_held_out_rows_are_not_read(spark):
    rows = [(i, "vile words here" if i % 2 else "kind words here") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = {i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 0}
    wrong = [(i, i % 2 if i not in held else 1 - i % 2) for i in range(200)]
    labels = spark.createDataFrame(wrong + [(7, None), (None, 1)], "doc_id long, toxic int")
    assert all((r.toxic_score >= 0.5) == bool(r.doc_id % 2) for r in nearest_labels.score(docs, labels).collect())


def test_equal_texts_score_alike_whatever_their_ids(spark):
    rows = [(i, ("vile words here" if i % 2 else "kind words here") + f" w{i % 7}") for i in range(100)]
    labels = [(i, i % 2) for i in range(60)]
    again = [(i + 1000, text) for i, text in rows] + [(None, rows[4][1])]
    docs = spark.createDataFrame(rows + again, "doc_id long, text string")
    found = nearest_labels.score(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    scores = {}
    for row in found:
        scores.setdefault(row.text, set()).add(row.toxic_score)
    assert len(scores) > 10 and all(len(s) == 1 for s in scores.values())


def test_neighbours_and_votes_equal_brute_force(spark):
    """Every cosine from the words' counts, the 25 largest, and the vote on their labels."""
    folder = SMALL
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = nearest_labels.fit(docs, labels)
    texts = {r.doc_id: r.text for r in docs.collect()}
    vectors = [model.unit(model.counts(texts[i])) for i in model.ids]
    dense = np.zeros((len(vectors), model.terms.size))
    for row, (terms, weights) in zip(dense, vectors):
        row[terms] = weights
    for text in list(texts.values())[::5]:
        query = np.zeros(model.terms.size)
        terms, weights = model.unit(model.counts(text))
        query[terms] = weights
        cosines = dense @ query
        order = np.lexsort((np.arange(len(cosines)), -cosines))[:25]
        order = order[cosines[order] > 0]
        ((got, ids),) = model.index.nearest_of_all([(terms, weights)], 25, [()])
        assert np.allclose(got, cosines[order])
        w = cosines[order] ** 2
        vote = ((w * model.known[order]).sum() + nearest_labels.PRIOR * model.rate) / (w.sum() + nearest_labels.PRIOR)
        assert np.isclose(model.vote(got, ids), vote)


def test_rare_words_of_examples_count(spark):
    """Near copies of labelled texts are found by words that few examples have; a repeated row is one example."""
    rng = random.Random(11)
    learnt = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5]
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9))
    rows, labels, fresh = [], [], []
    for group in range(60):
        words, toxic = [word() for _ in range(30)], int(group < 20)
        for k in range(4):
            text = " ".join(w for i, w in enumerate(words) if i != k)
            doc_id = learnt[3 * group + k] if k < 3 else 1000 + group
            rows.append((doc_id, text))
            if k < 3:
                labels.append((doc_id, toxic))
            else:
                fresh.append((doc_id, toxic, set(learnt[3 * group : 3 * group + 3])))
    docs = spark.createDataFrame(rows + 20 * rows[:1], "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = nearest_labels.fit(docs, marks)
    assert sorted(model.ids) == sorted(i for i, _ in labels)
    assert model.terms.size == len({w for _, text in rows for w in text.split()})
    found = {r.doc_id: r for r in nearest_labels.score(docs, marks).collect()}
    for doc_id, toxic, copies in fresh:
        assert {e.doc_id for e in found[doc_id].toxic_evidence} == copies
        assert all(e.cosine > 0.9 for e in found[doc_id].toxic_evidence)
        assert (found[doc_id].toxic_score >= 0.5) == bool(toxic)


# ----------------------------------------------------------------- licences


def test_licence_lines_are_found(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    lines = [s for f in licences.STATEMENTS.values() for s in f]
    want = {
        (r.doc_id, n) for r in docs.collect() for n, line in enumerate(r.text.split("\n")) if any(s in line for s in lines)
    }
    planted = [(10_000 + i, f"first line\n\n  {s}\nlast") for i, s in enumerate(lines)]
    others = [(20_000, "The licence of the poet is wide.\nVersion two of the work was released"), (20_001, None), (20_002, "")]
    found = licences.scan(docs.unionAll(spark.createDataFrame(planted + others, "doc_id long, text string"))).collect()
    assert {(r.doc_id, r.paragraph) for r in found if r.confirmed} == want | {(d, 2) for d, _ in planted}
    family = {r.doc_id: r.family for r in found}
    assert [family[10_000 + i] for i in range(len(lines))] == [f for f, s in licences.STATEMENTS.items() for _ in s]
    assert all(0.5 <= r.probability <= 1 for r in found)


def test_wrapped_and_neighbouring_licences_are_told_apart():
    rng = random.Random(4)
    others = [["".join(rng.choices("abcdefgh", k=4)) for _ in range(12)] for _ in range(200)]
    model = licences.Classifier(others)
    published = "General Public License as published by the Free Software Foundation"
    cases = [
        (f"it under the terms of the GNU Affero {published}", "agpl"),
        (f"it under the terms of the GNU Lesser {published}", "lgpl"),
        (f"it under the terms of the GNU {published}", "gpl"),
        ("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.", "cc-by-nc-sa"),
        ("This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", "cc-by-nd"),
        ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "cc-by"),
        ("Released under the ISC License.", "isc"),
    ]
    for text, family in cases:
        assert [(x[3], x[-1]) for x in model.find(text)] == [(family, True)], text
        words = text.split()
        for width in (3, 5):
            lines = [" ".join(words[i : i + width]) for i in range(0, len(words), width)]
            whole = "abcd efgh\n\n" + "\n".join(lines) + "\n\nlast"
            assert {x[3] for x in model.find(whole) if x[-1]} == {family}, whole
    two = "Permission is hereby granted, free of charge,\nto any person obtaining a copy of this software\n"
    two += "you may not use this file except in\ncompliance with the Apache License, Version 2.0"
    assert [x[3] for x in model.find(two) if x[-1]] == ["mit", "apache-2.0"]
    for text in ("Licensed under the Sleepycat License, Version 2.0.", "Licensed under the Apache License, Version 1.1."):
        assert not any(x[-1] for x in model.find(text)), text


# ------------------------------------------------------------- small worlds


def brute_nearest(rows, k):
    out = {}
    for q, v in rows:
        scores = [(-float(np.dot(v, w)), i) for i, w in rows if i != q and len(w) == len(v)]
        out[q] = [i for _, i in sorted(scores)[:k]]
    return out


def test_recall_on_the_table(spark):
    table = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in table.collect()]
    want = brute_nearest(rows, 20)
    got = {}
    for r in small_world.search(table, table.filter("vec_id % 20 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r)
    assert got.keys() == {i for i, _ in rows if i % 20 == 0}
    hits = sum(len({r.vec_id for r in found} & set(want[q])) for q, found in got.items())
    assert hits >= 0.9 * 20 * len(got)
    by_id = dict(rows)
    for q, found in got.items():
        assert [r["rank"] for r in found] == list(range(1, 21))
        assert all(abs(r.score - np.dot(by_id[q], by_id[r.vec_id])) < 1e-12 for r in found)
        assert [r.score for r in found] == sorted((r.score for r in found), reverse=True)


def test_ties_invalid_and_few_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0]) for i in range(0, 90, 3)] + [(1, [2.0, 0.0]), (2, [-0.0, 0.5]), (4, [0.0, -0.0]), (5, None)]
    rows += [(7, [nan, 1.0]), (8, [inf, 1.0]), (10, [None, 1.0]), (20, [1.0, 1.0, 1.0]), (11, []), (0, [1.0, 2.0]), (None, [1.0, 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = small_world.search(table, table.filter("vec_id % 20 = 0"), 5).orderBy("query_id", "rank").collect()
    got = {}
    for r in found:
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got[0] == [(3, 5.0), (6, 5.0), (9, 5.0), (12, 5.0), (15, 5.0)]
    assert got[60] == [(0, 5.0), (3, 5.0), (6, 5.0), (9, 5.0), (12, 5.0)]
    assert 20 not in got  # alone in its dimension
    empty = table.filter("vec_id > 1000")
    assert small_world.search(empty, empty).count() == 0


def test_vectors_of_any_length_are_found(spark):
    """Independent vectors in one shard, among them a few of quite other norms; brute force in double precision."""
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(2500, 24))
    for row, times in ((3, 1e4), (40, 1e20), (60, 1e-20), (81, 1000.0), (100, 1e4)):
        vectors[row] *= times
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = {}
    for r in small_world.search(table, table.filter("vec_id % 20 = 0")).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    recalls = []
    for q in range(0, len(vectors), 20):
        scores = vectors @ vectors[q]
        scores[q] = -np.inf
        recalls.append(len(found[q] & set(np.argsort(-scores)[:20].tolist())) / 20)
    assert np.mean(recalls) > 0.9 and min(recalls) > 0.5
