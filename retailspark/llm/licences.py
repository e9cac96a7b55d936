"""Licence scan by a trained paragraph classifier (operator 1).

A paragraph is a line, or several lines without a blank one between them over which a notice is wrapped: lines that are
not confirmed by themselves are judged together with as many of the next ones as the longest statement can fill. A wrapped
notice has the number and start of its first line and the end of its last. A paragraph's features are word n-grams of one to three words that occur in licence statements. Multinomial
logistic regression over them has a class for each licence family and one for unknown. It is trained on the statements,
whole, cut, embedded in other text and with words left out, and on at most ``OTHERS`` documents' paragraphs, the least by
a hash of doc_id, as unknown. The margin between the best family and unknown is calibrated by a logistic fit on statements
and paragraphs that were held out. A paragraph whose calibrated chance of being known is ``LEAST`` or more is a finding of
its best family, and is confirmed if it holds ``COVER`` or more of the word pairs of one of the family's statements.
Families whose ``MARKS`` do not agree with the paragraph (name, version, affero, lesser, noncommercial, sharealike, no
derivatives) are passed over; if none agrees, the finding is not confirmed. Licences of no family are not told apart.

Words so common that one in a hundred other paragraphs has them are no features by themselves, nor are n-grams of nothing
else. So most paragraphs have no feature at all and are unknown without more ado; that is what the model says of them.

Null and empty texts have no paragraphs. Repeated rows are scanned each. Without documents there are no rows.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailspark.llm.common import map_rows, staged

OTHERS = 400
LEAST = 0.5
COVER = 0.6
ROUNDS = 200

FOUND = (
    "doc_id long, paragraph long, start long, end long, family string, probability double, cover double, "
    "confirmed boolean"
)

# Statements by which works name their licence.
STATEMENTS: dict[str, list[str]] = {
    "mit": [
        "Released under the MIT License.",
        "This software is licensed under the MIT licence.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    ],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "you may not use this file except in compliance with the Apache License, Version 2.0",
        "Released under the Apache 2.0 licence.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "under the terms of the GNU General Public License as published by the Free Software Foundation",
        "Released under the GPL version 2 or later.",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "Released under the LGPL version 3.",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license.",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Released under the MPL 2.0.",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "agpl": [
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "Released under the AGPL version 3.",
    ],
    "isc": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    ],
    "epl": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
        "Released under the EPL 2.0.",
    ],
    "cc-by-nc-sa": [
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ],
    "cc-by-nd": [
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ],
    "cc-by-nc-nd": [
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    ],
    "public-domain": [
        "This work has been dedicated to the public domain under CC0 1.0.",
        "This is free and unencumbered software released into the public domain.",
    ],
    "proprietary": ["All rights reserved.", "Copyright, all rights reserved. No part may be reproduced without permission."],
}

_AFFERO, _LESSER = r"\bagpl|affero general", r"\blgpl|(?:lesser|library) general"
_CC = r"creative commons|\bcc\b|\bcc-by"
_NC, _SA, _ND = (
    r"non-?\s?commercial|\bby-nc", r"share-?\s?alike|\bby(?:-nc)?-sa", r"no-?\s?deriv|\bby(?:-nc)?-nd",
)
_ISC = r"\bisc\b|with or without fee"
# What a family's paragraphs have, all of these, and what they have none of; in lower-case words with single spaces.
MARKS: dict[str, tuple[list[str], list[str]]] = {
    "mit": ([r"\bmit\b|granted free of charge"], [_ISC]),
    "apache-2.0": ([r"\bapache", r"\bv?2(?:\.0)?\b"], []),
    "gpl": ([r"\bgnu\b|\bgpl"], [_AFFERO, _LESSER]),
    "lgpl": ([_LESSER], [_AFFERO]),
    "agpl": ([_AFFERO], []),
    "bsd": ([r"\bbsd|redistribution and use"], []),
    "isc": ([_ISC], []),
    "epl": ([r"\beclipse\b|\bepl"], []),
    "mpl-2.0": ([r"\bmozilla\b|\bmpl", r"\bv?2(?:\.0)?\b"], []),
    "cc-by": ([_CC], [_NC, _SA, _ND]),
    "cc-by-sa": ([_CC, _SA], [_NC, _ND]),
    "cc-by-nc": ([_CC, _NC], [_SA, _ND]),
    "cc-by-nc-sa": ([_CC, _NC, _SA], [_ND]),
    "cc-by-nd": ([_CC, _ND], [_NC, _SA]),
    "cc-by-nc-nd": ([_CC, _NC, _ND], [_SA]),
    "public-domain": ([r"public domain|\bcc0|unencumbered"], []),
    "proprietary": ([r"rights reserved"], []),
}


def agrees(family: str, text: str) -> bool:
    needed, barred = MARKS[family]
    return all(re.search(x, text) for x in needed) and not any(re.search(x, text) for x in barred)


_WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def grams(words: list[str]) -> set[str]:
    return {" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)}


def pairs(words: list[str]) -> set[tuple[str, str]]:
    return set(zip(words, words[1:]))


def paragraphs(text: str):
    """(number, start, end) of the lines that are not blank."""
    at = 0
    for number, line in enumerate(text.split("\n")):
        if line.strip():
            yield number, at, at + len(line)
        at += len(line) + 1


def blocks(text: str):
    """Lists of paragraphs' (number, start, end), one for each stretch of lines without a blank one."""
    block: list[tuple[int, int, int]] = []
    for line in paragraphs(text):
        if block and line[0] != block[-1][0] + 1:
            yield block
            block = []
        block.append(line)
    if block:
        yield block


class Classifier:
    """Fitted on the driver from the statements and a bounded number of other paragraphs."""

    def __init__(self, others: list[list[str]], seed: int = 7):
        self.families = list(STATEMENTS)
        self.covers = [[pairs(words_of(s)) for s in STATEMENTS[f]] for f in self.families]
        self.longest = max(len(words_of(s)) for f in STATEMENTS.values() for s in f)
        every = [c for f in self.covers for c in f]
        # A sampled paragraph that holds a statement is no example of unknown.
        others = [w for w in others if not any(len(c & pairs(w)) >= COVER * len(c) for c in every)] or [["the"]]
        common = Counter(w for words in others for w in set(words))
        self.common = {w for w, n in common.items() if n * 100 >= len(others)}
        all_grams = set().union(*(grams(words_of(s)) for f in STATEMENTS.values() for s in f))
        kept = sorted(g for g in all_grams if not set(g.split(" ")) <= self.common)
        self.number = {g: i for i, g in enumerate(kept)}
        self.anchors = {w for g in kept for w in g.split(" ")} - self.common
        rng = np.random.default_rng(seed)
        rows, labels = [], []
        for y, family in enumerate(STATEMENTS.values(), 1):
            for statement in family:
                words = words_of(statement)
                for k in range(40):
                    rows.append(self.features(self.variant(words, others, rng, k)))
                    labels.append(y)
        for words in others:
            rows.append(self.features(words))
            labels.append(0)
        # Single words of statements, in other text, are no licence.
        for word in sorted(self.anchors):
            for _ in range(4):
                other = list(others[rng.integers(len(others))])
                other.insert(int(rng.integers(len(other) + 1)), word)
                rows.append(self.features(other))
                labels.append(0)
        self.fit(rows, np.array(labels), rng)

    @staticmethod
    def variant(words: list[str], others: list[list[str]], rng, k: int) -> list[str]:
        """The statement itself, or with a few words left out, or between other words."""
        if k % 4 == 1 and len(words) > 6:
            words = [w for w in words if rng.random() > 0.1]
        if k % 4 >= 2:
            before, after = (others[rng.integers(len(others))][: int(rng.integers(1, 40))] for _ in range(2))
            words = [*(before if k % 4 == 3 else []), *words, *after]
        return words

    def features(self, words: list[str]) -> list[int]:
        return [self.number[g] for g in grams(words) if g in self.number]

    def fit(self, rows: list[list[int]], labels: np.ndarray, rng) -> None:
        held = np.zeros(len(rows), bool)
        held[rng.permutation(len(rows))[: len(rows) // 5]] = True
        x = np.zeros((len(rows), len(self.number) + 1), np.float32)
        x[:, -1] = 1
        for i, row in enumerate(rows):
            x[i, row] = 1
        target = np.eye(len(self.families) + 1, dtype=np.float32)[labels]
        # Each class weighs the same.
        weight = (1 / np.bincount(labels[~held], minlength=target.shape[1]).clip(1))[labels].astype(np.float32)
        weight = (weight / weight[~held].sum())[:, None]
        w = np.zeros((x.shape[1], target.shape[1]), np.float32)
        first, second, a = np.zeros_like(w), np.zeros_like(w), x[~held]
        for step in range(1, ROUNDS + 1):
            grad = a.T @ (weight[~held] * (softmax(a @ w) - target[~held])) + 1e-5 * w
            first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad * grad
            w -= 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        self.weights = w.astype(np.float64)
        margins = self.margins(x[held].astype(np.float64) @ self.weights)
        known = (labels[held] > 0).astype(float)
        slope, offset = 1.0, 0.0
        for _ in range(500):  # logistic fit of two numbers, slightly held to the uncalibrated margin
            error = 1 / (1 + np.exp(-np.clip(slope * margins + offset, -40, 40))) - known
            slope -= 0.05 * (float((error * margins).mean()) + 1e-2 * (slope - 1))
            offset -= 0.05 * (float(error.mean()) + 1e-2 * offset)
        self.slope, self.offset = max(slope, 1e-3), offset

    @staticmethod
    def margins(logits: np.ndarray) -> np.ndarray:
        return logits[:, 1:].max(1) - logits[:, 0]

    def classify(self, words: list[str]) -> tuple[str, float, float, bool] | None:
        """Family, calibrated chance of being known, the best cover by a statement and whether that confirms the family;
        None for unknown."""
        if self.anchors.isdisjoint(words):
            return None
        found = self.features(words)
        logits = self.weights[found].sum(0) + self.weights[-1]
        chance = 1 / (1 + np.exp(-np.clip(self.slope * (logits[1:].max() - logits[0]) + self.offset, -40, 40)))
        if chance < LEAST:
            return None
        text, order = " ".join(words), np.argsort(-logits[1:], kind="stable").tolist()
        best = next((i for i in order if agrees(self.families[i], text)), None)
        agreed, best = best is not None, order[0] if best is None else best
        own = pairs(words)
        cover = max(len(c & own) / len(c) for c in self.covers[best])
        return self.families[best], float(chance), cover, agreed and cover >= COVER

    def find(self, text: str):
        """(number, start, end, family, chance, cover, confirmed) of the findings, in order."""
        for block in blocks(text):
            words = [words_of(text[start:end]) for _, start, end in block]
            single = [self.classify(w) for w in words]
            anchored = [not self.anchors.isdisjoint(w) for w in words]
            i = 0
            while i < len(block):
                last, found = i, single[i]
                if not (found and found[3]) and words[i]:
                    wrapped = self.wrapped(words, single, anchored, i)
                    last, found = wrapped or (i, found)
                if found:
                    yield *block[i][:2], block[last][2], *found
                i = last + 1

    def wrapped(self, words, single, anchored, i: int):
        """The last line and the finding of the notice that starts in line i and ends in a later one, if there is one."""
        joined, last, best = list(words[i]), i, None
        while last + 1 < len(words) and len(joined) - len(words[i]) < self.longest:
            last += 1
            if single[last] and single[last][3]:
                break
            joined += words[last]
            found = self.classify(joined) if any(anchored[i : last + 1]) else None
            if not (found and found[3]):
                continue
            # Further lines belong to it if they cover more of a statement or rule the family out, and else may be another notice.
            if best is None or not agrees(best[1][0], " ".join(joined)) or (found[0] == best[1][0] and found[2] > best[1][2]):
                best = last, found
        if best is None:
            return None
        later = self.classify([w for line in words[i + 1 : best[0] + 1] for w in line])
        return None if later and later[3] and later[2] >= best[1][2] else best  # it starts in a later line


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit(docs: DataFrame) -> Classifier:
    """The classifier, with the paragraphs of the ``OTHERS`` documents of least hash as examples of unknown."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id IS NOT NULL").distinct()
    chosen = staged(ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(OTHERS), "licence-sample")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")

    def make():
        def step(part):
            for doc_id, text in part:
                for number, start, end in paragraphs(text or ""):
                    yield doc_id, number, words_of(text[start:end])[:200]  # an example, not a scan

        return step

    lines = map_rows(rows, make, "doc_id long, number long, words array<string>")
    found = lines.orderBy(F.xxhash64("doc_id", "number"), "doc_id", "number", "words").limit(10 * OTHERS).collect()
    return Classifier([r["words"] for r in found])


def scan(docs: DataFrame, classifier: Classifier | None = None) -> DataFrame:
    """One row a licence paragraph; start and end are code points in the text."""
    shared = docs.sparkSession.sparkContext.broadcast(classifier or fit(docs))

    def make():
        model = shared.value

        def step(rows):
            for doc_id, text in rows:
                for found in model.find(text or ""):
                    yield doc_id, *found

        return step

    return map_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), make, FOUND)
