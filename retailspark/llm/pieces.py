"""Token ids by way of remembered pieces: a text is cut where no token can cross, and each piece is encoded once.

A piece is what follows a single space or a line feed, up to the next one. Both tokenizers used here cut before a space
that follows something else, and around a single line feed, so the ids of a text are the ids of its pieces in order.
Texts with other white space, or with several in a row, are encoded as a whole. Unknown pieces are encoded many at a
time, as one text, and marks among the ids part them again.
"""

from __future__ import annotations

import codecs
import os
import re

import numpy as np

from retailspark.llm.common import kept

# White space, by any definition, that may join with its neighbours, and the sign put between pieces.
_ODD = re.compile(r"[\x00\x02\x09\x0b-\x0d\x1c-\x1f\x85\xa0  -     　]")
# Letters of which the tokenizer keeps as many when it lowers them, and any signs behind them.
_SIMPLE = re.compile(r"\n?([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)")
_LOWERED = re.compile("[a-zß-öø-ÿ ]+")
_SIGNS = ".,;:!?"  # the most common ones
# Signs between a letter and white space are a word of their own.
_SIGN = re.compile(r"[!-/:-@\[-`{-~](?<=[a-zß-öø-ÿ].)[!-/:-@\[-`{-~]*(?=[ \n]|\Z)")
_LONG = 64  # longer pieces are encoded each time and not remembered


def path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def cut(text: str) -> list[str] | None:
    """Pieces of a text, or None where the cut could change the ids. A piece that starts with a line feed, and the
    first one, follow no space; all others follow one."""
    if not text or "  " in text or "\n\n" in text or " \n" in text or "\n " in text:
        return None
    if text[0] in " \n" or text[-1] in " \n" or _ODD.search(text):
        return None
    return text.replace("\n", " \n").split(" ")


def lowered(text: str) -> str:
    """The text in lower case, with spaces between words and signs, if all of it is Latin-1: there this takes letter for
    letter, as the tokenizer does, and nothing is composed. A text that may have a special token is left as it is: these
    are told by their case."""
    if "<|" not in text:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text
        return _SIGN.sub(r" \g<0>", text.lower())
    return text


def remember(known: dict[str, bytes], fresh: dict[str, bytes]) -> None:
    if fresh and max(map(len, fresh)) > _LONG:
        fresh = {p: ids for p, ids in fresh.items() if len(p) <= _LONG}
    known.update(fresh)


class Memory:
    """Ids of texts as little-endian numbers of one width. ``_pieces`` and ``_whole`` are what encodes."""

    def __init__(self, dtype: str = "<u2", limit: int = 250_000):
        self.dtype, self.limit = np.dtype(dtype), limit
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # what was known before, kept until there is as much again

    def pack(self, ids) -> bytes:
        return np.asarray(ids, dtype=self.dtype).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        texts = self._same(texts)
        cuts = [cut(t) for t in texts]
        if len(self.known) > self.limit:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        # One look-up a piece; only the holes it leaves are gone through again.
        found = [list(map(known.get, c[1:])) if c else [] for c in cuts]
        holes = [[k for k, ids in enumerate(f, 1) if ids is None] if None in f else () for f in found]
        fresh = dict.fromkeys(c[k] for c, at in zip(cuts, holes) for k in at)
        again = [p for p in fresh if p in older]
        fresh.update(zip(again, map(older.__getitem__, again)))
        wanted = [p for p, ids in fresh.items() if ids is None]
        fresh.update(zip(wanted, self._pieces(wanted)))
        for c, f, at in zip(cuts, found, holes):
            for k in at:
                f[k - 1] = fresh[c[k]]
        remember(known, fresh)
        whole = iter(self._whole([t for t, c in zip(texts, cuts) if c is None]))
        first = iter(self._first([c[0] for c in cuts if c]))
        return [next(whole) if c is None else next(first) + b"".join(f) for c, f in zip(cuts, found)]

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        raise NotImplementedError

    def _whole(self, texts: list[str]) -> list[bytes]:
        raise NotImplementedError

    def _first(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that no space stands before."""
        return self._whole(pieces)

    def _same(self, texts: list[str]) -> list[str]:
        """Texts with the ids of these, but fewer different pieces."""
        return texts


class TokenizerMemory(Memory):
    """By a file of the tokenizers library. A piece takes some 200 bytes, and encoding it again fifty look-ups' time."""

    def __init__(self, file: str, limit: int = 700_000, **options):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallel units
        from tokenizers import Tokenizer

        super().__init__(limit=limit, **options)
        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.vocabulary = self.tokenizer.get_vocab()
        if max(self.vocabulary.values()) > np.iinfo(self.dtype).max:
            raise ValueError("ids do not fit the width; choose a wider dtype")

    def marks(self, test) -> np.ndarray:
        found = np.zeros(max(self.vocabulary.values()) + 1, bool)
        found[[i for token, i in self.vocabulary.items() if test(token)]] = True
        return found

    def _ids(self, texts):
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def _whole(self, texts):
        return [self.pack(x) for x in self._ids(texts)]

    def _joined(self, pieces: list[str], join, marks: np.ndarray, skip: int) -> list[bytes]:
        """Ids of each piece: ``join`` starts each with a marked id, of which ``skip`` are left out."""
        found, size = [], self.dtype.itemsize
        for at in range(0, len(pieces), 4096):
            part = pieces[at : at + 4096]
            ids = np.asarray(self._ids([join(part)])[0], self.dtype)
            starts = np.flatnonzero(marks[ids])
            if len(starts) != len(part):
                raise ValueError("the tokenizer joins pieces that were taken for separate ones")
            raw = ids.tobytes()
            edges = [*(starts * size).tolist(), len(raw)]
            found += [raw[i + skip * size : j] for i, j in zip(edges, edges[1:])]
        return found


class ByteBpe(TokenizerMemory):
    """Byte-level BPE, in which a space belongs to the word after it and a lone line feed is a token."""

    def __init__(self, file: str, **options):
        super().__init__(file, **options)
        self.spaces = self.marks(lambda token: token.startswith("Ġ"))  # the byte-level sign of a space
        self.feeds = self.marks(lambda token: token == "Ċ")  # and that of a line feed

    def _pieces(self, pieces):
        after = [p for p in pieces if p[0] != "\n"]
        lines = [p for p in pieces if p[0] == "\n"]
        known = dict(zip(after, self._joined(after, lambda part: " " + " ".join(part), self.spaces, 0)))
        known.update(zip(lines, self._joined(lines, "".join, self.feeds, 0)))
        return [known[p] for p in pieces]


class WordBpe(TokenizerMemory):
    """BPE over lower-cased words, white space dropped, with a mark on each word's last id.

    A piece of common letters, with or without signs behind them, is one or two words. Letters are lowered and turned into
    the signs of their bytes here, many at a time, so that only the tokenizer's model is left to do. Between other pieces
    stands a control sign.
    """

    def __init__(self, file: str, **options):
        super().__init__(file, **options)
        from tokenizers import Tokenizer, pre_tokenizers

        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        # Byte-level signs: printable bytes stand for themselves, all others for the signs from 256 on.
        other = [b for b in range(256) if b < 33 or 127 <= b <= 160 or b == 173]
        table = {b: chr(256 + n) for n, b in enumerate(other)} | {32: " "}  # a blank stays between words
        self.bytes = "".join(table.get(b, chr(b)) for b in range(256))
        (sign,) = self._ids(["\x02"])[0]
        self.signs = np.zeros(max(self.vocabulary.values()) + 1, bool)
        self.signs[sign] = True
        self.ends = self.marks(lambda token: token.endswith("</w>"))
        self.after = {"": b"", **dict(zip(_SIGNS, self._whole(list(_SIGNS))))}
        self.known.update(self.after)
        del self.known[""]

    def _ids(self, texts):
        if len(texts) != 1 or not _LOWERED.fullmatch(texts[0]):
            return super()._ids(texts)
        text, _ = codecs.charmap_decode(texts[0].encode(), "strict", self.bytes)
        return [self.plain.encode(text, add_special_tokens=False).ids]

    def _same(self, texts):
        return list(map(lowered, texts))

    def _first(self, pieces):
        found = list(map(self.known.get, pieces))
        rest = iter(self._whole([p for p, ids in zip(pieces, found) if ids is None]))
        return [next(rest) if ids is None else ids for ids in found]

    def _pieces(self, pieces):
        matches = list(map(_SIMPLE.fullmatch, pieces))
        others = [p for p, m in zip(pieces, matches) if m is None]
        parts = [m.groups() for m in matches if m is not None]
        simple = iter(self._simple(parts))
        rest = iter(self._joined(others, lambda part: "\x02 " + " \x02 ".join(part), self.signs, 1))
        return [next(rest) if m is None else next(simple) for m in matches]

    def _simple(self, parts: list[tuple[str, str]]) -> list[bytes]:
        """Ids of the word in lower case, encoded once whatever case, signs or line feed come with it, and of the signs."""
        words = " ".join([w for w, _ in parts]).lower().split(" ") if parts else []
        known = dict.fromkeys(words)
        known.update((w, ids) for w, ids in zip(known, map(self.known.get, known)) if ids)
        if self.older:
            known.update((w, self.older[w]) for w in [w for w, ids in known.items() if ids is None and w in self.older])
        wanted = [w for w, ids in known.items() if ids is None]
        fresh = dict(zip(wanted, self._words(wanted)))
        remember(self.known, fresh)
        known.update(fresh)
        after = {signs: self.after.get(signs) for _, signs in parts}
        new = [signs for signs, ids in after.items() if ids is None]
        after.update(zip(new, self._whole(new)))
        if len(self.after) > self.limit:
            self.after = {}
        remember(self.after, after)
        return [known[w] + after[signs] for w, (_, signs) in zip(words, parts)]

    def _words(self, words: list[str]) -> list[bytes]:
        found, size = [], self.dtype.itemsize
        for at in range(0, len(words), 4096):
            part = words[at : at + 4096]
            ids = np.asarray(self._ids([" ".join(part)])[0], self.dtype)
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(part):
                raise ValueError("the tokenizer cuts pieces into more or fewer words than were expected")
            raw, edges = ids.tobytes(), [0, *(ends * size).tolist()]
            found += [raw[i:j] for i, j in zip(edges, edges[1:])]
        return found


def held(kind: type[Memory], file: str) -> Memory:
    """A worker process keeps its memory from task to task, until one comes that does not ask for it."""
    return kept((kind, file), lambda: kind(file))
