"""BPE encoding and decoding by dynamic programming over prefixes (operator 8).

Every prefix of a word has one encoding, and so one last token. An automaton over all tokens reports, at each position,
the tokens that end there. The one whose start has a last token that may stand before it is the prefix's last token. Two
tokens may stand together if no merge of higher rank, of a part of the left one's right edge with a part of the right
one's left edge, would have joined them first. Following the last tokens back from the end gives the exact ids.

The vocabulary and merges come from the tokenizer's file; the tokenizers library takes no part. Words are cut by the
tokenizer's own pattern, and strings of special tokens are taken out first. A worker keeps the ids of words it has seen,
up to a bound, so that a word is solved once.

Null text is empty: no ids. Repeated rows give repeated rows, an empty table none. Words of any length are solved whole.
"""

from __future__ import annotations

import json
import re

import numpy as np
from pyspark.sql import DataFrame

from retailspark.llm import pieces
from retailspark.llm.common import id_and_text, map_rows

TOKENIZER = "byte_bpe_50k.json"
ENCODED = "doc_id long, ids binary"


def byte_signs() -> dict[str, int]:
    """The byte for each sign of a byte-level vocabulary: printable Latin-1 characters stand for themselves, other
    bytes for the characters from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class PrefixBpe(pieces.Memory):
    """Encodes and decodes with one byte-level BPE file."""

    def __init__(self, file: str, **options):
        import ahocorasick
        import public_tokenizers
        import regex

        super().__init__(**options)
        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        vocabulary, signs = spec["model"]["vocab"], byte_signs()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = special
        self.cut_special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")")
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.bytes_of = [b""] * (max([*vocabulary.values(), *special.values()]) + 1)
        for token, i in vocabulary.items():
            self.bytes_of[i] = bytes(signs[c] for c in token) if i not in special.values() else b""
        for token, i in special.items():
            self.bytes_of[i] = token.encode()
        # rank: of the merge that makes a token; parts: what it merges.
        self.merge_of: dict[tuple[int, int], int] = {}
        self.parts: list[tuple[int, int] | None] = [None] * len(self.bytes_of)
        self.rank = [-1] * len(self.bytes_of)
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b, whole = vocabulary[left], vocabulary[right], vocabulary[left + right]
            self.merge_of[a, b] = rank
            if self.parts[whole] is None:
                self.parts[whole], self.rank[whole] = (a, b), rank
        self.automaton = ahocorasick.Automaton()
        for token, i in vocabulary.items():
            if i not in special.values():
                self.automaton.add_word(self.bytes_of[i].decode("latin-1"), (i, len(self.bytes_of[i])))
        self.automaton.make_automaton()
        self.words: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}

    def together(self, left: int, right: int) -> bool:
        """Whether the encoding of the two tokens' bytes is these two tokens.

        The merges inside both are undone from the last to the first. At each time the two parts at the border must not
        be a merge that comes before the one undone last: that is when the parts stood side by side.
        """
        merge_of, rank, parts = self.merge_of, self.rank, self.parts
        until, at_left = len(merge_of) + 1, False  # merges before ``until`` were done while the two parts stood
        while True:
            merged = merge_of.get((left, right))
            if merged is not None and (merged < until or merged == until and not at_left):
                return False
            a, b = rank[left], rank[right]
            if a < 0 and b < 0:
                return True
            # Of equal merges the left one is done first, so the right one is undone first.
            if a > b:
                until, at_left, left = a, True, parts[left][1]
            else:
                until, at_left, right = b, False, parts[right][0]

    def solve(self, word: bytes) -> list[int]:
        last: list[tuple[int, int] | None] = [None] * (len(word) + 1)
        pairs = self.pairs
        for end, (token, size) in self.automaton.iter(word.decode("latin-1")):
            if last[end + 1] is not None:
                continue
            start = end + 1 - size
            if start == 0:
                last[end + 1] = token, 0
                continue
            before = last[start]
            if before is None:
                continue
            key = before[0] << 20 | token
            fits = pairs.get(key)
            if fits is None:
                fits = pairs[key] = self.together(before[0], token)
            if fits:
                last[end + 1] = token, start
        ids, at = [], len(word)
        while at:
            token, at = last[at]
            ids.append(token)
        return ids[::-1]

    def encode(self, texts):
        if len(self.words) > self.limit:
            self.words.clear()
        if len(self.pairs) > 2 * self.limit:
            self.pairs.clear()
        return super().encode(texts)

    def _pieces(self, found):
        return self._whole([p if p[0] == "\n" else " " + p for p in found])

    def _whole(self, texts):
        words, out = self.words, []
        for text in texts:
            parts = []
            for section in self.cut_special.split(text) if "<|" in text else (text,):
                if section in self.special:
                    parts.append(self.pack([self.special[section]]))
                    continue
                for word in self.pattern.findall(section):
                    ids = words.get(word)
                    if ids is None:
                        ids = self.pack(self.solve(word.encode()))
                        if len(word) <= pieces._LONG:
                            words[word] = ids
                    parts.append(ids)
            out.append(b"".join(parts))
        return out

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


def encode(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """The ids of each document, as little-endian 32-bit numbers."""
    tokenizer = tokenizer or pieces.path(TOKENIZER)

    def make():
        memory = pieces.held(PrefixBpe, tokenizer)

        def step(rows):
            for (doc_id, _), ids in zip(rows, memory.encode([t for _, t in rows])):
                yield doc_id, np.frombuffer(ids, memory.dtype).astype("<u4").tobytes()

        return step

    return map_rows(id_and_text(docs), make, ENCODED, rows=512)


def decode(encoded: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """The ids and the text they stand for."""
    tokenizer = tokenizer or pieces.path(TOKENIZER)

    def make():
        memory = pieces.held(PrefixBpe, tokenizer)

        def step(rows):
            for doc_id, ids in rows:
                yield doc_id, ids, memory.decode(np.frombuffer(ids, "<u4"))

        return step

    return map_rows(encoded.select("doc_id", "ids"), make, ENCODED + ", text string")


def round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """The ids of each document and the text decoded from them, in one pass."""
    tokenizer = tokenizer or pieces.path(TOKENIZER)

    def make():
        memory = pieces.held(PrefixBpe, tokenizer)

        def step(rows):
            for (doc_id, _), packed in zip(rows, memory.encode([t for _, t in rows])):
                ids = np.frombuffer(packed, memory.dtype)
                yield doc_id, ids.astype("<u4").tobytes(), memory.decode(ids)

        return step

    return map_rows(id_and_text(docs), make, ENCODED + ", text string", rows=256)
