"""Personal data, plain and disguised (operator 5).

Plain identifiers are found in the text as it is: e-mail addresses, IP addresses, payment cards and phone numbers, for
each kind from left to right without overlap; matches with bad numbers are dropped.

Disguised ones are found in a normalised text. A transducer rewrites the text from left to right and notes for every
character it emits which source characters it stands for:

- look-alike letters, full-width forms and decimal digits of other scripts become ASCII, one for one;
- runs of spelled digits (``five five oh ...``, with ``double``, ``plus`` and ``dot`` between them) and numerals, of at
  least four digits, become digits: without space between spelled ones and at dots, with a space beside numerals;
- bracketed ``[at]`` and ``(dot)``, and spaced `` at `` with `` dot `` behind it, become ``@`` and ``.``;
- spaced `` at `` before a domain with plain dots becomes ``@`` if the word before it has a digit, dot, ``_``, ``%`` or
  ``+``, or stands behind a word like ``mail`` or ``contact``, or if the domain is a mail provider's. Without any of
  these it is left alone: ``look at example.com`` has the same form.

Identifiers in the normalised text that hold a rewritten character are mapped back to source spans, and are added to the
plain ones unless a plain one of the same kind holds them. Offsets are code points, ends are exclusive.

Null text is empty. Repeated rows are searched each. Texts of any length are searched whole.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailspark.llm.common import append_columns

KINDS = ("email", "ip", "card", "phone")

Span = tuple[str, int, int]

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match starts where its run of digits starts, so later starts in a run need no trial.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def emails(text: str) -> list[tuple[int, int]]:
    """From each @ outwards: the characters before it back to the last match, and a domain behind it."""
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        if domain and at >= last:
            start = at
            while start > last and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                found.append((start, domain.end()))
                last = domain.end()
        at = text.find("@", at + 1)
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) << (i & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(filter("0123456789".__contains__, text))


def _ip_parts(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def _card_number(text: str) -> bool:
    digits = digits_of(text) if len(text) < 40 else ""
    return 13 <= len(digits) <= 19 and luhn(digits)


def _phone_number(text: str) -> bool:
    return 9 <= len(digits_of(text)) <= 15


def _matches(pattern: re.Pattern, good: Callable[[str], bool]) -> Callable[[str], list[tuple[int, int]]]:
    return lambda text: [m.span() for m in pattern.finditer(text) if good(m.group())]


FINDERS: dict[str, Callable[[str], list[tuple[int, int]]]] = {
    "email": emails, "ip": _matches(_IP, _ip_parts), "card": _matches(_CARD, _card_number),
    "phone": _matches(_PHONE, _phone_number),
}


def plain_spans(text: str) -> list[Span]:
    return [(kind, *span) for kind in KINDS for span in FINDERS[kind](text)]


# Letters of other scripts that look like ASCII letters.
LOOK_ALIKES = {
    "а": "a", "с": "c", "е": "e", "һ": "h", "і": "i", "ј": "j", "ӏ": "l", "о": "o", "р": "p", "ѕ": "s", "х": "x", "у": "y",
    "ԁ": "d", "ԛ": "q", "ԝ": "w", "ɡ": "g", "ı": "i", "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J",
    "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "Х": "X", "У": "Y", "α": "a", "ι": "i", "κ": "k", "ν": "v",
    "ο": "o", "ρ": "p", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O",
    "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "․": ".", "‐": "-", "‑": "-", "–": "-",
}
SPELLED = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7",
    "eight": "8", "nine": "9",
}
_FOREIGN = re.compile("[" + "".join(LOOK_ALIKES) + "！-～]|(?![0-9])\\d")
_DIGIT = "(?:(?:double |triple )?(?:" + "|".join(SPELLED) + r")\b)"
_ITEM = rf"(?:{_DIGIT}|[0-9]++(?:\.[0-9]++)*+\b)"
_RUN = re.compile(rf"(?i)\b(?:plus[ ,-]+)?{_ITEM}(?:(?:[ ,()-]+|[ ,]+(?:dot|point)[ ,]+){_ITEM})++")
_RUN_PART = re.compile(r"(?i)[a-z]+|[0-9.]+")
_RUN_DIGITS = 4  # an address has as many at least
_AT = re.compile(r"(?i)\s*[\[({<]\s*(?:at|@)\s*[\])}>]\s*")
_DOT = re.compile(r"(?i)\s*[\[({<]\s*(?:dot|\.)\s*[\])}>]\s*")
_SPACED = re.compile(r"(?i)(?<=[a-z0-9_%+-])( +at +|@)(?=[a-z0-9-]+ +dot +[a-z0-9-])([a-z0-9-]+)((?: +dot +[a-z0-9-]+)+)")
_SPACED_LOCAL = re.compile(r"(?i)(?<![a-z0-9._%+-])[a-z0-9_%+-]+(?: +dot +[a-z0-9_%+-]+)+(?= *[\[({<]\s*at\b| +at +[a-z0-9-]+ +dot +)")
_SPACED_DOT = re.compile(r"(?i) +dot +")
_AT_DOMAIN = re.compile(r"(?i)(?<![a-z0-9._%+-])([a-z0-9._%+-]++)( +at +)((?:[a-z0-9-]+\.)+[a-z]{2,})(?![a-z0-9-])")
_MAIL_WORD = re.compile(r"(?i)\b(?:e-?mails?|mail|mailto|contact|reach|write)(?: (?:me|us|to|is|address))*[ :=-]+$")
# Domains that are there for mail.
_PROVIDER = re.compile(
    r"(?i)(?:gmail|googlemail|yahoo|ymail|hotmail|outlook|live|msn|icloud|aol|proton|protonmail|gmx|yandex|zoho|fastmail|qq)\."
)
_DISGUISE = re.compile(r"(?i)[\[({<]\s*(?:at|dot|@|\.)\s*[\])}>]| dot ")

Edit = tuple[int, int, str]


def _foreign(text: str) -> list[Edit]:
    edits = []
    for m in _FOREIGN.finditer(text):
        c = m.group()
        plain = LOOK_ALIKES.get(c) or (chr(ord(c) - 0xFEE0) if "！" <= c <= "～" else str(unicodedata.decimal(c)))
        edits.append((m.start(), m.end(), plain))
    return edits


def _spelled(text: str) -> list[Edit]:
    """One edit a digit, so that the spans of single digits stay known; what stands between them goes."""
    edits = []
    for run in _RUN.finditer(text):
        own, spoken, n, times, before, end = [], False, 0, 1, "", run.start()
        for part in _RUN_PART.finditer(text, run.start(), run.end()):
            name = part.group().lower()
            sign = {"plus": "+", "dot": ".", "point": "."}.get(name)
            kind = "sign" if sign else "numeral" if name[0] in "0123456789." else "word"
            if times == 1 and part.start() > end:
                between = text[end : part.start()]
                if "sign" in (before, kind) or before == kind == "word":
                    own.append((end, part.start(), ""))
                elif "word" in (before, kind) or "," in between:
                    own.append((end, part.start(), " "))
            before, spoken = kind, spoken or kind != "numeral"
            if name in ("double", "triple"):
                times, end = 2 if name == "double" else 3, part.start()
                continue
            if kind != "numeral":
                own.append((end if times > 1 else part.start(), part.end(), sign or SPELLED[name] * times))
            n += 0 if sign else len(digits_of(name)) or times
            end, times = part.end(), 1
        if spoken and n >= _RUN_DIGITS:
            edits += own
    return edits


def _addressed(text: str, m: re.Match) -> bool:
    """Whether what stands before the at is meant as a mailbox."""
    return bool(
        _PROVIDER.match(m.group(3)) or re.search(r"[0-9_%+]|\w\.\w", m.group(1))
        or _MAIL_WORD.search(text, max(0, m.start() - 40), m.start())
    )


def _at_and_dot(text: str) -> list[Edit]:
    edits = [(*m.span(), "@") for m in _AT.finditer(text)] + [(*m.span(), ".") for m in _DOT.finditer(text)]
    for m in _SPACED.finditer(text):
        edits.append((*m.span(1), "@"))
        edits += [(*d.span(), ".") for d in _SPACED_DOT.finditer(text, *m.span(3))]
    edits += [(*m.span(2), "@") for m in _AT_DOMAIN.finditer(text) if _addressed(text, m)]
    for m in _SPACED_LOCAL.finditer(text):
        edits += [(*d.span(), ".") for d in _SPACED_DOT.finditer(text, *m.span())]
    return edits


class Normalised:
    """A text after edits, with the source span of each character."""

    def __init__(self, text: str):
        self.text, self.starts, self.ends, self.changed = text, None, None, None

    def apply(self, edits: list[Edit]) -> None:
        """Non-overlapping edits in order; of overlapping ones the first stays."""
        if not edits:
            return
        if self.starts is None:
            n = len(self.text)
            self.starts, self.ends, self.changed = list(range(n)), list(range(1, n + 1)), [False] * n
        text, starts, ends, changed, at = [], [], [], [], 0
        for start, end, new in sorted(edits):
            if start < at:
                continue
            text += [self.text[at:start], new]
            starts += self.starts[at:start] + [self.starts[start]] * len(new)
            ends += self.ends[at:start] + [self.ends[end - 1]] * len(new)
            changed += self.changed[at:start] + [True] * len(new)
            at = end
        text.append(self.text[at:])
        self.text, self.starts = "".join(text), starts + self.starts[at:]
        self.ends, self.changed = ends + self.ends[at:], changed + self.changed[at:]


def hidden_spans(text: str, plain: list[Span]) -> list[Span]:
    """Spans of disguised identifiers that no plain span of their kind holds."""
    foreign = not text.isascii() and _FOREIGN.search(text)
    if not (foreign or _DISGUISE.search(text) or _AT_DOMAIN.search(text) or _spelled(text)):
        return []
    form = Normalised(text)
    if foreign:
        form.apply(_foreign(form.text))
    form.apply(_spelled(form.text))
    form.apply(_at_and_dot(form.text))
    if form.starts is None:
        return []
    held: dict[str, list[tuple[int, int]]] = {}
    for kind, start, end in plain:
        held.setdefault(kind, []).append((start, end))
    found = []
    for kind, start, end in plain_spans(form.text):
        if any(form.changed[start:end]):
            source = form.starts[start], form.ends[end - 1]
            # The digit words' edits take the space before them; a span starts at its first word.
            lead = len(text[source[0] : source[1]]) - len(text[source[0] : source[1]].lstrip(" ,-"))
            source = source[0] + lead, source[1]
            if not any(a <= source[0] and source[1] <= b for a, b in held.get(kind, ())):
                found.append((kind, *source))
    return found


def spans(text: str) -> tuple[list[Span], list[Span]]:
    """Plain spans, and all spans, by kind and start."""
    plain = plain_spans(text)
    hidden = hidden_spans(text, plain)
    return plain, sorted({*plain, *hidden}, key=lambda s: (KINDS.index(s[0]), s[1:])) if hidden else plain


def redact(text: str, found: list[Span]) -> str:
    """The text with each span, or group of overlapping spans, replaced by its first span's kind in brackets."""
    out, at = [], 0
    for kind, start, end in sorted(found, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def find(docs: DataFrame) -> DataFrame:
    """``docs`` with found_base and found_all behind its columns: lists of (kind, start, end)."""

    def make():
        return lambda rows: [
            tuple([dict(zip(("kind", "start", "end"), s)) for s in part] for part in spans(text or "")) for (text,) in rows
        ]

    span = "array<struct<kind: string, start: long, end: long>>"
    return append_columns(docs, ["text"], make, f"found_base {span}, found_all {span}")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, the numbers of plain spans by kind, their hash, and all spans as text."""
    rows = find(docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text"))
    listed = lambda c: F.concat_ws(",", F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    of_kind = lambda kind: lambda s: s["kind"] == kind
    return rows.select(
        "doc_id",
        *(F.size(F.filter("found_base", of_kind(kind))).cast("long").alias(f"n_{kind}") for kind in KINDS),
        F.sha2(listed("found_base").cast("binary"), 256).alias("base_sha256"), listed("found_all").alias("spans"),
    )


def redacted(docs: DataFrame) -> DataFrame:
    """Whole rows with the personal data in ``text`` replaced, and ``n_chars``, where there is one, counted anew."""

    def make():
        def one(text):
            text = text if text is None else redact(text, spans(text)[1])
            return text, None if text is None else len(text)

        return lambda rows: [one(text) for (text,) in rows]

    names = [f"__{i}" for i in range(len(docs.columns))]  # the caller's columns may have the new ones' names
    at = docs.columns.index("text")
    rows = append_columns(docs.toDF(*names), [names[at]], make, "clean string, size long")
    new = {"text": "clean", "n_chars": "size"}
    return rows.select(*(new.get(c, names[i]) for i, c in enumerate(docs.columns))).toDF(*docs.columns)
