"""Personal data: plain identifiers, and disguised ones found through offset-preserving rewriting.

Plain (base) spans are leftmost non-overlapping matches of four patterns in the text itself.  For
disguises a chain of transducers rewrites the text - look-alike characters, spelled digits, at and
dot words - and keeps, for each rewritten stretch, where it came from.  The same patterns run on
the rewritten text, and each match is mapped back to source characters.  A match is added if a
rewriting lies in it, it passes stricter checks than a base match, and no base span of its kind
covers it.  Base spans always stay.  Offsets count code points, the end is exclusive.

Cases: null is the empty text, which has no spans; texts are scanned whole, in time linear in their
length; repeated rows give repeated rows; an empty table gives an empty table.
"""

from __future__ import annotations

import functools
import hashlib
import re
import string
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from salesmart.llm.common import pieces, schema_with, texts, with_columns

KINDS = ("email", "ip", "card", "phone")


class Span(NamedTuple):
    kind: str
    start: int
    end: int


# --- base patterns ---------------------------------------------------------------------------

_LOCAL = string.ascii_letters + string.digits + "._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match cannot start within a run of digits: what fails at its first digit fails at the others.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The local part is the run of its characters before an @, back to the match before at most."""
    begin, at = 0, text.find("@")
    while at >= 0:
        if domain := _DOMAIN.match(text, at + 1):
            start = begin + len(text[begin:at].rstrip(_LOCAL))
            if start < at:
                yield start, domain.end()
                begin = domain.end()
                at = text.find("@", begin)
                continue
        begin, at = at + 1, text.find("@", at + 1)


def _passes_luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return (sum(values[::2]) + sum(sum(divmod(2 * d, 10)) for d in values[1::2])) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """Spans of the plain patterns, by kind and start."""
    out = [Span("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        # a part of over nine digits is above 255 unless zeros lead it
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(Span("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _digits(m[0])
            if 13 <= len(digits) <= 19 and _passes_luhn(digits):
                out.append(Span("card", *m.span()))
    if "+" in text:
        out += [Span("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


# --- transducers -----------------------------------------------------------------------------


class Rewritten:
    """A rewritten text that knows the source of each character and which ones were rewritten."""

    def __init__(self, text: str):
        self.text = text
        # Stretch i of the text starts at starts[i] and comes from source[i]; changed ones come whole
        # from source[i] .. ends[i], others character by character.
        self.starts, self.source, self.ends, self.changed = [0], [0], [len(text)], [False]

    def apply(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace [start, end) of the text by a string, for edits in order that don't overlap."""
        if not edits:
            return
        parts, starts, source, ends, changed = [], [], [], [], []
        done = length = 0

        def keep(a: int, b: int) -> None:
            nonlocal length
            i = bisect_right(self.starts, a) - 1
            while a < b:
                stop = min(b, self.starts[i + 1]) if i + 1 < len(self.starts) else b
                if stop > a:
                    shift = 0 if self.changed[i] else a - self.starts[i]
                    starts.append(length)
                    source.append(self.source[i] + shift)
                    ends.append(self.ends[i])
                    changed.append(self.changed[i])
                    parts.append(self.text[a:stop])
                    length += stop - a
                a, i = stop, i + 1

        for a, b, new in edits:
            keep(done, a)
            if new:
                first, last = self.origin(a, b)
                starts.append(length)
                source.append(first)
                ends.append(last)
                changed.append(True)
                parts.append(new)
                length += len(new)
            done = b
        keep(done, len(self.text))
        self.text = "".join(parts)
        self.starts, self.source, self.ends, self.changed = starts, source, ends, changed

    def origin(self, a: int, b: int) -> tuple[int, int]:
        """The source characters of the non-empty [a, b)."""
        i, j = bisect_right(self.starts, a) - 1, bisect_right(self.starts, b - 1) - 1
        first = self.source[i] if self.changed[i] else self.source[i] + a - self.starts[i]
        last = self.ends[j] if self.changed[j] else self.source[j] + b - self.starts[j]
        return first, last

    def touched(self, a: int, b: int) -> bool:
        """Was any character of [a, b) rewritten or anything within it dropped?"""
        i, j = bisect_right(self.starts, a) - 1, bisect_right(self.starts, b - 1) - 1
        return i != j or self.changed[i]


# Letters of other scripts that look like Latin ones.
_LOOK_ALIKES = dict(
    zip("аеорсухіјѕԁһӏԛԝкАВЕКМНОРСТХІЈЅ", "aeopcyxijsdhlqwkABEKMHOPCTXIJS", strict=True)
) | dict(zip("αορνικυΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aopvikuABEZHIKMNOPTYX", strict=True))
# Other signs for the separators of identifiers.
_SIGNS = {c: "-" for c in "‐‑‒–—−﹣－"} | {c: "." for c in "․。．｡﹒"} | {c: " " for c in "    "} | {"﹫": "@"}
# Characters that show nothing.
_UNSEEN = "­​‌‍⁠﻿"


@functools.lru_cache(maxsize=1)
def _characters() -> dict[str, str]:
    """ASCII for each disguise of one character: look-alikes, signs, full-width forms, other digits."""
    table = dict(_LOOK_ALIKES) | {c: "" for c in _UNSEEN}
    for code in [*range(0x300, 0xD800), *range(0xF900, 0x10000), *range(0x1D400, 0x1D800), *range(0x1F100, 0x1F1B0)]:
        c = chr(code)
        digit, plain = unicodedata.decimal(c, None), unicodedata.normalize("NFKC", c)
        if digit is not None:
            table.setdefault(c, str(digit))
        elif len(plain) == 1 and (plain.isascii() and plain.isalnum() or plain in "@.+-()"):
            table.setdefault(c, plain)
    return table | _SIGNS


@functools.lru_cache(maxsize=1)
def _disguised() -> re.Pattern[str]:
    return re.compile("[" + re.escape("".join(_characters())) + "]")


# Digit words of four languages.
_DIGIT_WORDS = {
    "en": "zero one two three four five six seven eight nine",
    "de": "null eins zwei drei vier fünf sechs sieben acht neun",
    "fr": "zéro un deux trois quatre cinq six sept huit neuf",
    "es": "cero uno dos tres cuatro cinco seis siete ocho nueve",
}
_DIGIT_OF = {w: str(i) for words in _DIGIT_WORDS.values() for i, w in enumerate(words.split())} | {"oh": "0"}
_TIMES = {"double": 2, "triple": 3}
_WORDS = "|".join(sorted(_DIGIT_OF, key=len, reverse=True))
# Three digit words in a row, other parts of a run between them or not, are the least that is rewritten.
_BETWEEN = {"double", "triple", "dot", "point", "punkt", "punto", "plus"}
_UNIT = rf"(?:(?:(?:double|triple)[ -])?(?:{_WORDS})|[0-9]+)"
_RUN = re.compile(rf"(?<!\w)(?:plus[ -]+)?{_UNIT}(?:[ ,-]+(?:(?:dot|point|punkt|punto)[ ,-]+)?{_UNIT})+(?!\w)", re.I)
_TOKEN = re.compile(r"[^ ,-]+")
_DOTS = {"dot", "point", "punkt", "punto"}

# Lengths in the patterns below are those of mail addresses; they keep scanning linear.
# Endings that a domain needs if "at" and "dot" are plain words.
_ENDINGS = "com org net edu gov info biz io dev app ai co uk de fr es it nl eu ch at example"
_AT = re.compile(r" ?[\[({<] ?(?:at|@|arroba|ät) ?[\])}>] ?", re.I)
_DOT = re.compile(r" ?[\[({<] ?(?:dot|\.|punto|punkt|point) ?[\])}>] ?", re.I)
_PLAIN = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9_%+-]{1,64}(?: dot [A-Za-z0-9_%+-]{1,64}){0,4}(?: at | ?@ ?)"
    rf"[A-Za-z0-9-]{{1,63}}(?: dot [A-Za-z0-9-]{{1,63}}){{0,5}} dot (?:{'|'.join(_ENDINGS.split())})(?![A-Za-z0-9-])",
    re.I,
)
_SPACED = re.compile(r"(?<=[A-Za-z0-9])(?: @ ?| ?@ )(?=[A-Za-z0-9-]+\.[A-Za-z])")
_PLAIN_PARTS = re.compile(r" (dot|at) | ?@ ?", re.I)


_LATIN_DISGUISES = [c for c in (*_SIGNS, *_UNSEEN) if ord(c) < 256]


def _characters_edits(text: str) -> list[tuple[int, int, str]]:
    if text.isascii():
        return []
    try:
        text.encode("latin-1")
        if not any(c in text for c in _LATIN_DISGUISES):
            return []
    except UnicodeEncodeError:
        if _characters().keys().isdisjoint(text):
            return []
    return [(m.start(), m.end(), _characters()[m[0]]) for m in _disguised().finditer(text)]


def _has_spelled_digits(text: str) -> bool:
    words = text.lower().replace("-", " ").replace(",", " ").split()
    if _DIGIT_OF.keys().isdisjoint(words):
        return False
    row = 0
    for w in words:
        if w in _DIGIT_OF:
            row += 1
            if row == 3:
                return True
        elif w not in _BETWEEN and not w.isdigit():
            row = 0
    return False


def _spelled_edits(text: str) -> list[tuple[int, int, str]]:
    if not _has_spelled_digits(text):
        return []
    edits = []
    for run in _RUN.finditer(text):
        spelled, out, times = 0, "", 1
        for token in _TOKEN.findall(run[0].lower()):
            if token in _TIMES:
                times = _TIMES[token]
            elif token in _DOTS:
                out += "."
            elif token == "plus":
                out += "+"
            else:
                spelled += token in _DIGIT_OF
                out += _DIGIT_OF.get(token, token) * times
                times = 1
        if spelled >= 3:
            edits.append((run.start(), run.end(), out))
    return edits


def _at_dot_edits(text: str) -> list[tuple[int, int, str]]:
    low = text.lower()
    bracketed = any(b in text for b in "[({<") and any(w in low for w in ("at", "@", "arroba", "ät"))
    edits = []
    if bracketed:
        edits = [(m.start(), m.end(), "@") for m in _AT.finditer(text)]
        edits += [(m.start(), m.end(), ".") for m in _DOT.finditer(text)] if edits or "@" in text else []
    if " dot " in low:
        for m in _PLAIN.finditer(text):
            for p in _PLAIN_PARTS.finditer(text, *m.span()):
                new = "." if (p[1] or "").lower() == "dot" else "@"
                edits.append((p.start(), p.end(), new))
        if edits:  # "[at] example dot com"
            ends = "|".join(_ENDINGS.split())
            edits += [(m.start(), m.end(), ".") for m in re.finditer(rf"(?<=[a-z0-9]) dot (?=(?:[a-z0-9-]{{1,63}} dot ){{0,5}}(?:{ends})(?![a-z0-9-]))", text, re.I)]
    if " @" in text or "@ " in text:
        edits += [(m.start(), m.end(), "@") for m in _SPACED.finditer(text)]
    out: list[tuple[int, int, str]] = []
    for edit in sorted(set(edits)):
        if not out or edit[0] >= out[-1][1]:
            out.append(edit)
    return out


_GOOD_DOMAIN = re.compile(r".*\.[A-Za-z]{2,24}")


def added_spans(text: str, base: list[Span]) -> list[Span]:
    """Spans of disguised identifiers, in source characters."""
    view = Rewritten(text)
    for transducer in (_characters_edits, _spelled_edits, _at_dot_edits):
        view.apply(transducer(view.text))
    if view.text is text:
        return []
    found = []
    for span in base_spans(view.text):
        if not view.touched(span.start, span.end):
            continue
        if span.kind == "email" and not _GOOD_DOMAIN.fullmatch(view.text, span.start, span.end):
            continue
        start, end = view.origin(span.start, span.end)
        if not any(b.kind == span.kind and b.start <= start and end <= b.end for b in base):
            found.append(Span(span.kind, start, end))
    return found


def find(text: str | None) -> tuple[list[Span], list[Span]]:
    """Base spans and added spans of a text, each by kind as listed, then start."""
    text = text or ""
    base = base_spans(text)
    return base, added_spans(text, base)


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s.kind), s.start, s.end)))


def masked(text: str, spans: list[Span]) -> str:
    """The text with each stretch of overlapping spans replaced by the kind of its first span."""
    out, done, merged = [], 0, []
    for s in sorted(spans, key=lambda s: (s.start, -s.end)):
        if merged and s.start < merged[-1].end:
            merged[-1] = merged[-1]._replace(end=max(s.end, merged[-1].end))
        else:
            merged.append(s)
    for s in merged:
        out += [text[done : s.start], f"[{s.kind.upper()}]"]
        done = s.end
    return "".join([*out, text[done:]])


REPORT = {f"n_{k}": "bigint" for k in KINDS} | {"base_sha256": "string", "spans": "string", "n_added": "bigint"}


def report(frame: DataFrame, text: str = "text") -> DataFrame:
    """The frame without its text, with counts and digest of base spans and the list of all spans.

    n_added counts the spans beyond the base ones.  Columns of these names give way.
    """
    kept = [c for c in frame.columns if c not in REPORT and c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text):
                found = [find(t) for t in texts(piece, text)]
                columns = {
                    f"n_{k}": pa.array([sum(s.kind == k for s in base) for base, _ in found], pa.int64()) for k in KINDS
                }
                columns["base_sha256"] = pa.array(
                    [hashlib.sha256(_listed(base).encode()).hexdigest() for base, _ in found], pa.string()
                )
                columns["spans"] = pa.array([_listed([*base, *more]) for base, more in found], pa.string())
                columns["n_added"] = pa.array([len(more) for _, more in found], pa.int64())
                yield with_columns(piece.select(kept), columns)

    return frame.mapInArrow(run, schema_with(frame, kept, REPORT))


def redact(frame: DataFrame, text: str = "text") -> DataFrame:
    """The frame with all spans of its text replaced by their kind; null texts stay null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, text):
                out = []
                for t in piece.column(text).to_pylist():
                    base, more = find(t)
                    out.append(masked(t, [*base, *more]) if base or more else t)
                at = piece.schema.get_field_index(text)
                yield piece.set_column(at, piece.schema.field(at), pa.array(out, piece.schema.field(at).type))

    return frame.mapInArrow(run, frame.schema)
