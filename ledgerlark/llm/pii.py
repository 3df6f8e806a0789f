"""Personal data, also in disguise, found with offsets into the source text.

Plain forms are matched on the text itself. For disguised forms the text goes
over a tape whose characters know the source stretch they stand for, through
transducers in turn: look-alike characters and full-width forms to ASCII,
zero-width characters to nothing, spelled digits to digits, bracketed or spelled
dots between digits and "plus" before them to their signs, "at" and "dot" in
brackets or between the parts of an address to theirs. The same patterns
run over the tape, and what they find on rewritten characters is mapped back
to code-point offsets of the source.

Defined results: a null or empty text has no spans; a disguised span that
meets a plain one of its kind is left out; the offsets are code points, the
end exclusive; an empty table gives an empty result; repeated rows are judged
one by one; other columns pass through unchanged.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerlark.llm.common import column, ship, slices

KINDS = ("email", "ip", "card", "phone")

# The plain forms.
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)"),
    "card": re.compile(r"[0-9](?:[\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}

# Characters that look like an ASCII one and have no compatibility form.
LOOK_ALIKES = {
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X",
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ɡ": "g", "ո": "n", "ѡ": "w", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z",
    "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "α": "a",
    "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "υ": "u", "ı": "i", "ǀ": "l", "‐": "-", "‒": "-", "–": "-",
    "−": "-", "·": ".", "•": ".", "。": ".", "\u200b": "", "\u200c": "", "\u200d": "", "\u2060": "", "\ufeff": "",
    "\u00ad": "",
}
# Spelled digits and signs, English first, then French, German and Spanish.
DIGITS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "zéro": "0", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
SIGNS = {"plus": "+", "dot": ".", "point": ".", "punkt": ".", "punto": "."}


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _valid(kind: str, found: str) -> bool:
    if kind == "email":
        return True
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in found.split("."))
    digits = re.sub(r"[^0-9]", "", found)
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15


def plain_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the plain forms: leftmost, non-overlapping per kind; failing matches are dropped."""
    sign = {"email": "@" in text, "phone": "+" in text}
    sign["ip"] = sign["card"] = _NUMBER.search(text) is not None
    return [(m.start(), m.end(), k) for k in KINDS if sign[k] for m in PATTERNS[k].finditer(text) if _valid(k, m.group())]


_NUMBER = re.compile("[0-9]")
_UNUSUAL = re.compile("[^\x00-\xff]|[\xa0\xad²³·¹ªº]")
_WORDS = "|".join(sorted(DIGITS, key=lambda w: (-len(w), w)))
_DOT = "dot|point|punkt|punto"
#: Letters of a text in lower case and the rest as spaces, in UTF-8 bytes, to look its words up quickly.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))
_LETTER_RUN = re.compile(r"[^\W\d_]+")
_HINT_WORDS = frozenset(w.encode() for w in (*DIGITS, *SIGNS))
_HINT_DOTS = frozenset(w.encode() for w in _DOT.split("|"))
_HINT_BRACKET = re.compile(rf"[\[({{<]\s*(?:at|@|arroba|{_DOT}|\.)\s*[\])}}>]", re.I)
#: A spelled digit or sign with a digit or another of them as the next word, on either side.
_HINT_PAIR = re.compile(rf"\b(?:{_WORDS}|{_DOT}|plus)\b\W*(?:(?:{_WORDS}|{_DOT})\b|[0-9])|\b(?:{_WORDS})[0-9]|[0-9]\W*\b(?:{_WORDS}|{_DOT})\b", re.I)
#: Seven or more digits of which some are spelled, with signs and separators between them.
_BRACKETED = rf"[\[({{<]\s*(?:{_DOT}|\.)\s*[\])}}>]"
_SPELLED = re.compile(rf"(?:\bplus\W{{1,3}})?\b(?:{_WORDS}|[0-9])(?:[\s,-]{{0,3}}(?:\b(?:{_WORDS}|{_DOT})\b|[0-9.]|{_BRACKETED})){{6,}}", re.I)
_TOKEN = re.compile(rf"\b(?:{_WORDS}|plus|{_DOT})\b|[0-9.+]", re.I)
#: Last labels that end an address written without brackets.
_TOP = "com|org|net|edu|gov|mil|int|info|biz|io|co|ai|app|dev|me|tv|eu|uk|us|de|fr|es|it|nl|ch|be|ca|au|jp|cn|br|mx|test|example|invalid"
_NAME, _HOST = "[A-Za-z0-9._%+-]+", "[A-Za-z0-9-]+"
_OPEN, _CLOSE = r"\s*[\[({<]\s*", r"\s*[\])}>]\s*"
_POINT = rf"(?:{_OPEN}(?:{_DOT}|\.){_CLOSE}|\s+(?:{_DOT})\s+)"
#: "at" in brackets; or bare, before a host whose last label is well known or set off by a bracketed dot.
_AT = re.compile(
    rf"(?<=[A-Za-z0-9_%+-])(?:{_OPEN}(?:at|@|arroba){_CLOSE}(?={_HOST})"
    rf"|\s+at\s+(?={_HOST}(?:{_POINT}{_HOST})*?(?:{_POINT}(?:{_TOP})\b|{_OPEN}(?:{_DOT}|\.){_CLOSE}{_HOST})))",
    re.I,
)
_POINT_AFTER = re.compile(rf"(?<=[A-Za-z0-9-]){_POINT}(?={_HOST})", re.I)
#: Four groups of digits with dots of any kind between them; "plus" before what may be a phone number.
_DOTTED = re.compile(rf"[0-9]+(?:(?:\.|{_POINT})[0-9]+){{3}}", re.I)
_PLUS = re.compile(r"\bplus\W{1,3}(?=[0-9][\x20().0-9-]+[0-9])", re.I)
_ADDRESS = re.compile(rf"(?:{_NAME}{_POINT})*{_NAME}@{_HOST}(?:(?:\.|{_POINT}){_HOST})+", re.I)


@lru_cache(maxsize=4096)
def _ascii(char: str) -> str:
    """What a look-alike stands for; other characters stand for themselves."""
    if char in LOOK_ALIKES:
        return LOOK_ALIKES[char]
    plain = unicodedata.normalize("NFKC", char)
    return plain if plain.isascii() and plain else char


class Tape:
    """Characters with the source stretch that each stands for."""

    def __init__(self, text: str, starts: list[int] | None = None, ends: list[int] | None = None):
        self.text = text
        self.starts = list(range(len(text))) if starts is None else starts
        self.ends = list(range(1, len(text) + 1)) if ends is None else ends

    def rewritten(self, found: Iterator[re.Match[str]], write: Callable[[re.Match[str]], list[tuple[str, int, int]]]) -> Tape:
        """Each match becomes the pieces (new text, from, to) that ``write`` makes of it; ``from`` and ``to`` are places on this tape."""
        out, starts, ends, at = [], [], [], 0
        for m in found:
            out.append(self.text[at : m.start()])
            starts += self.starts[at : m.start()]
            ends += self.ends[at : m.start()]
            for new, a, b in write(m):
                out.append(new)
                starts += [self.starts[a]] * len(new)
                ends += [self.ends[b - 1]] * len(new)
            at = m.end()
        out.append(self.text[at:])
        return Tape("".join(out), starts + self.starts[at:], ends + self.ends[at:])


def _spelled(m: re.Match[str]) -> list[tuple[str, int, int]]:
    if not re.search(_WORDS, m.group(), re.I):
        return _points(m)
    pieces = []
    for t in _TOKEN.finditer(m.string, m.start(), m.end()):
        word = t.group().lower()
        pieces.append((DIGITS.get(word) or SIGNS.get(word) or word, t.start(), t.end()))
    return pieces


def _points(m: re.Match[str]) -> list[tuple[str, int, int]]:
    inner, at = [], m.start()
    for p in _POINT_AFTER.finditer(m.string, m.start(), m.end()):
        inner += [(m.string[k], k, k + 1) for k in range(at, p.start())] + [(".", p.start(), p.end())]
        at = p.end()
    return inner + [(m.string[k], k, k + 1) for k in range(at, m.end())]


def _hinted(text: str) -> bool:
    """Whether the text has what a spelled or bracketed disguise needs; true wherever the transducers after it show a new span."""
    if _HINT_BRACKET.search(text):
        return True
    words = set(text.encode().translate(_LETTERS).split()) if text.isascii() else {w.encode() for w in _LETTER_RUN.findall(text.lower())}
    if not _HINT_WORDS.isdisjoint(words) and _HINT_PAIR.search(text):
        return True
    return not _HINT_DOTS.isdisjoint(words) and ("@" in text or b"at" in words and _AT.search(text) is not None)


def normalised(text: str, gated: bool = True) -> Tape:
    """The tape after all transducers; ``gated`` leaves out those for which :func:`_hinted` sees no need."""
    tape = Tape(text)
    if not text.isascii():
        tape = tape.rewritten(_UNUSUAL.finditer(tape.text), lambda m: [(_ascii(m.group()), m.start(), m.end())])
    if not gated or _hinted(tape.text):
        tape = tape.rewritten(_SPELLED.finditer(tape.text), _spelled)
        tape = tape.rewritten(_DOTTED.finditer(tape.text), _points)
        tape = tape.rewritten(_PLUS.finditer(tape.text), lambda m: [("+", m.start(), m.end())])
        tape = tape.rewritten(_AT.finditer(tape.text), lambda m: [("@", m.start(), m.end())])
        if "@" in tape.text:
            tape = tape.rewritten(_ADDRESS.finditer(tape.text), _points)
    return tape


def disguised_spans(text: str, plain: list[tuple[int, int, str]], gated: bool = True) -> list[tuple[int, int, str]]:
    """(start, end, kind) of what only the normalised text shows."""
    if gated and (text.isascii() or not _UNUSUAL.search(text)) and not _hinted(text):
        return []
    tape = normalised(text, gated)
    if tape.text == text:
        return []
    taken = {k: [s for s in plain if s[2] == k] for k in KINDS}
    out = []
    for start, end, kind in plain_spans(tape.text):
        a, b = tape.starts[start], tape.ends[end - 1]
        if text[a:b] != tape.text[start:end] and all(b <= s[0] or s[1] <= a for s in taken[kind]):
            out.append((a, b, kind))
    return out


def _listed(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


SPAN = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("kind", T.StringType())]))
_ARROW_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))


def find(docs: DataFrame) -> DataFrame:
    """``docs`` with ``plain`` and ``spans``: arrays of (start, end, kind), the second with the disguised ones too."""
    own = [f for f in docs.schema.fields if f.name not in ("plain", "spans")]
    names = [f.name for f in own]
    schema = T.StructType([*own, T.StructField("plain", SPAN), T.StructField("spans", SPAN)])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            plain, spans = [], []
            for text in column(batch, "text"):
                base = plain_spans(text or "")
                plain.append(_listed(base))
                spans.append(_listed(base + disguised_spans(text or "", base)))
            as_rows = lambda rows: pa.array([[dict(zip(("start", "end", "kind"), s, strict=True)) for s in r] for r in rows], _ARROW_SPAN)
            kept = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*kept, as_rows(plain), as_rows(spans)], [*names, "plain", "spans"])

    return ship(docs).select(*names).mapInArrow(scan, schema)
