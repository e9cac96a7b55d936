"""Repeated passages and infilling against brute force."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from retailspark.llm import infilling, substrings
from tests.conftest import SMALL

GREATEST = 1 << 63


def removed(rows, length=50):
    """(doc_id, words, removed words, words left) of each (doc_id, text), window by window."""
    split = [re.findall(r"[^\x20\x09-\x0D]+", text or "") for _, text in rows]
    ids = [GREATEST if doc_id is None else doc_id for doc_id, _ in rows]
    first = {}
    for doc_id, words in zip(ids, split):
        for at in range(len(words) - length + 1):
            window = tuple(words[at : at + length])
            first[window] = min(first.get(window, doc_id), doc_id)
    out = []
    for (shown, _), doc_id, words in zip(rows, ids, split):
        gone = set()
        for at in range(len(words) - length + 1):
            if first[tuple(words[at : at + length])] < doc_id:
                gone.update(range(at, at + length))
        out.append((shown, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return sorted(out, key=repr)


def awkward(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    passage = " ".join(f"p{i}" for i in range(70))
    rows += [
        (None, rows[3][1]), (None, None), (9001, ""), (9002, "a " * 300), (9003, "b " + "a " * 200), (9004, "a " * 49),
        rows[0], (9005, "a b c " * 100), (9006, "a b c " * 100 + "d"), (-5, rows[7][1] + " tail " + rows[9][1]),
        # 9011 has the passage's head with 9010 and its end with 9012, and 9014 the middle with both
        (9010, "x y " + " ".join(passage.split()[:55]) + " q"), (9011, passage + "\n" + passage),
        (9012, "z\t" + " ".join(passage.split()[12:])), (9014, " ".join(passage.split()[3:60])), (9014, passage),
    ]
    # many texts with one passage, no two alike around it
    rows += [(20_000 + i, f"{' '.join(f'l{i}x{j % i}' for j in range(1, i + 2)) if i else ''} {passage} r{i} r{i}") for i in range(40)]
    return rows


@pytest.mark.parametrize("group", [4096, 3])
def test_repeats_equal_brute_force(spark, group):
    rows = awkward(spark)
    found = substrings.repeats_removed(spark.createDataFrame(rows, "doc_id long, text string"), group=group).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.text) for r in found), key=repr) == removed(rows)
    for row in found:
        assert sum(s.stop - s.start for s in row.repeats) == row.n_removed
        assert all(a.stop < b.start for a, b in zip(row.repeats, row.repeats[1:]))


def test_other_lengths(spark):
    rows = [(r[0], " ".join((r[1] or "").split()[:120])) for r in awkward(spark)]
    found = substrings.repeats_removed(spark.createDataFrame(rows, "doc_id long, text string"), length=12, seed=4).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.text) for r in found), key=repr) == removed(rows, 12)


def test_groups_are_dealt_evenly_and_settled_by_rows(spark):
    """Each place of a hot anchor is one row, and no group has more than its share."""
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"{passage} only{i}") for i in range(2000)]
    texts = substrings.distinct_texts(substrings.keyed(spark.createDataFrame(rows, "doc_id long, text string")))
    placed = substrings.places(texts, 50, 10, 100)
    dealt = placed.groupBy("anchor", F.pmod(F.xxhash64("key"), F.col("parts"))).count()
    assert dealt.agg(F.max("count")).first()[0] < 300


def cut_text(doc_id, text):
    units = re.findall(r"[^\n]*\n|[^\n]+", text or "")
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")):
        return len(units), "plain", None, None, text or ""
    if h[3] % 100 < 50:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_infilling_equals_brute_force_and_is_undone(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    odd = [None, "", "\n", "\n\n\n", "a\n\n\nb", "é\nü<P>\n", "€\n日本\r\nx<\n😀😀\nq" * 50, "long line " * 20_000, "x\n" * 50_000, "\x00\n\x0b"]
    rows += [(50_000 + i, text) for i, text in enumerate(odd * 8)] + [(None, "x\ny\n"), rows[0]]
    made = infilling.infilled(spark.createDataFrame(rows, "doc_id long, text string"))
    found = made.withColumn("back", infilling.restored(F.col("output"), F.col("form"))).collect()
    want = sorted(((doc_id, *cut_text(doc_id, text), text or "") for doc_id, text in rows), key=repr)
    assert sorted((tuple(r) for r in found), key=repr) == want


def test_rates_and_other_units(spark):
    docs = spark.createDataFrame([(i, "one. two. three") for i in range(400)], "doc_id long, text string")
    forms = dict(infilling.infilled(docs, rate=50, spm=0, end=".").groupBy("form").count().collect())
    assert set(forms) == {"plain", "psm"} and 140 < forms["psm"] < 260
