"""Personal data with offset-preserving deobfuscation (operator 5).

Base detection finds e-mail addresses, IPv4 addresses, card numbers and phone
numbers in the text as it is. For texts that show a disguise, a chain of
transducers writes a normalised text: look-alike characters become ASCII,
invisible characters go, runs of spelled digits become digits, and written
"at" / "dot" become signs. Each transducer carries, for every normalised
character, the source span it stands for, so identifiers that are found in
the normalised text map back to source characters. Such a span is added if
it touches a rewritten character and overlaps no base span of its kind.

Kinds (leftmost, non-overlapping, each on its own; a match that fails its
check is dropped without a retry):

* email ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``
* ip    four dot-joined numbers, each at most 255
* card  digits with single spaces or hyphens between, 13 to 19 digits, Luhn
* phone ``+``, a digit, then digits, spaces, ``().-``; 9 to 15 digits

The scanners are linear in the text, also on long runs of one character.

Defined cases: null and empty texts have no spans; repeated rows get equal
rows; an empty table gives an empty result; extra columns are ignored.
Offsets are code points, end exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_and_text, slices

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

# ---------------------------------------------------------------- detectors
_LOCAL = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)+")
_NUMBER = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+")


def emails(text: str) -> Iterator[Span]:
    end, at = 0, text.find("@")              # end: of the last match or the last @
    while at >= 0:
        local = text[end:at]
        start = end + len(local.rstrip(_LOCAL))
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        end = m.end() if m else at + 1
        at = text.find("@", end)


def ips(text: str) -> Iterator[Span]:
    for run in _NUMBERS.finditer(text):
        if run.group().count(".") < 3:
            continue
        parts = [m.span() for m in _NUMBER.finditer(text, run.start(), run.end())]
        for k in range(0, len(parts) - 3, 4):
            four = parts[k:k + 4]
            values = [text[x:y].lstrip("0") for x, y in four]
            if all(len(v) <= 3 and int(v or "0") <= 255 for v in values):
                yield four[0][0], four[3][1]


def _luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[::-2]) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def cards(text: str) -> Iterator[Span]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[Span]:
    if "+" not in text:
        return
    for m in _PHONE.finditer(text):
        found = m.group().rstrip(" ().-")
        # the pattern wants a digit, at least one character of the class, and a last digit
        if len(found) >= 4 and 9 <= sum(c.isdigit() for c in found) <= 15:
            yield m.start(), m.start() + len(found)


DETECTORS: dict[str, Callable[[str], Iterator[Span]]] = {"email": emails, "ip": ips, "card": cards, "phone": phones}


def base_spans(text: str) -> list[tuple[str, int, int]]:
    return [(kind, a, b) for kind in KINDS for a, b in DETECTORS[kind](text)]


# ---------------------------------------------------------------- transducers
# ASCII characters and code points that look like them.
LOOKS = {
    "a": [0x430, 0x3B1, 0x251], "c": [0x441], "d": [0x501], "e": [0x435], "g": [0x261], "h": [0x4BB], "i": [0x456, 0x3B9],
    "j": [0x458], "o": [0x43E, 0x3BF], "p": [0x440], "q": [0x51B], "s": [0x455], "w": [0x51D], "x": [0x445], "y": [0x443],
    "A": [0x410, 0x391], "B": [0x412, 0x392], "C": [0x421], "E": [0x415, 0x395], "H": [0x41D, 0x397], "I": [0x406, 0x399],
    "J": [0x408], "K": [0x41A, 0x39A], "M": [0x41C, 0x39C], "N": [0x39D], "O": [0x41E, 0x39F], "P": [0x420, 0x3A1],
    "S": [0x405], "T": [0x422, 0x3A4], "X": [0x425, 0x3A7], "Y": [0x3A5], "Z": [0x396],
    "-": [0x2010, 0x2011, 0x2012, 0x2013, 0x2014, 0x2015, 0x2212], ".": [0x2024, 0x3002, 0xFE52], "@": [0xFE6B], "+": [0xFE62],
    " ": [0xA0, 0x2007, 0x2009, 0x202F, 0x3000],
}
LOOK_ALIKES = {code: by for by, codes in LOOKS.items() for code in codes}
LOOK_ALIKES |= {0xFF01 + k: chr(0x21 + k) for k in range(94)}                                      # full-width forms
LOOK_ALIKES |= {zero + k: chr(0x30 + k) for zero in (0x660, 0x6F0, 0x966, *range(0x1D7CE, 0x1D800, 10)) for k in range(10)}
# Characters that show nothing.
INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
# Spelled digits.
DIGITS = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6",
          "seven": "7", "eight": "8", "nine": "9"}
SPELLED_RUN = 4            # so many spelled digits in a row count as a number

_ODD = re.compile("[" + re.escape("".join(map(chr, LOOK_ALIKES)) + INVISIBLE) + "]")
_DIGIT = "(?:" + "|".join(DIGITS) + ")"
_GAP = r"(?:[ \t]*+[,.-][ \t]*+|[ \t]++)"
_SPELLED = re.compile(rf"\b(?:(?P<plus>plus){_GAP})?{_DIGIT}(?:{_GAP}{_DIGIT}){{{SPELLED_RUN - 1},}}\b", re.I)
_ONE_DIGIT = re.compile(_DIGIT, re.I)
_AT = r"\s{0,3}(?:\[\s{0,3}at\s{0,3}\]|\(\s{0,3}at\s{0,3}\)|\{\s{0,3}at\s{0,3}\}|<\s{0,3}at\s{0,3}>)\s{0,3}"
_DOT = r"\s{0,3}(?:\[\s{0,3}(?:dot|\.)\s{0,3}\]|\(\s{0,3}(?:dot|\.)\s{0,3}\)|\{\s{0,3}(?:dot|\.)\s{0,3}\}|<\s{0,3}dot\s{0,3}>)\s{0,3}"
_AT_WORD, _DOT_WORD = r"[ \t]{1,3}at[ \t]{1,3}", r"[ \t]{1,3}dot[ \t]{1,3}"
_HOST = r"[A-Za-z0-9-]+"
_WRITTEN_STOP = rf"(?:{_DOT}|{_DOT_WORD})"
_STOP = rf"(?:\.|{_WRITTEN_STOP})"
# an address with a written sign: bracketed or bare "at"; a bare one needs a written dot behind it
_ADDRESS = re.compile(rf"(?P<at>(?<=[A-Za-z0-9])(?:{_AT}|@|{_AT_WORD}))(?P<host>{_HOST}(?:{_STOP}{_HOST})+)", re.I)
_WRITTEN_DOT = re.compile(_WRITTEN_STOP, re.I)
_BARE_AT = re.compile(_AT_WORD, re.I)
_NUMBER_DOTS = re.compile(rf"(?<![0-9])[0-9]++(?:{_STOP}[0-9]++){{3}}", re.I)
_LOCAL_DOT = re.compile(rf"(?<=[A-Za-z0-9]){_WRITTEN_STOP}(?=[A-Za-z0-9._%+-]++(?:{_WRITTEN_STOP}[A-Za-z0-9._%+-]++){{0,4}}@)", re.I)
_HINT = re.compile(r"\bdot\b|[\[({<]\s{0,3}(?:at|dot|\.)\s{0,3}[\])}>]|" + rf"{_DIGIT}{_GAP}{_DIGIT}{_GAP}{_DIGIT}", re.I)


class Mapped:
    """A normalised text; source start and end of each of its characters, and
    whether the character was rewritten."""

    def __init__(self, text: str):
        self.text = text
        self.start = np.arange(len(text))
        self.end = self.start + 1
        self.new = np.zeros(len(text), bool)

    def replace(self, edits: list[tuple[int, int, str]]) -> None:
        """Apply ascending, disjoint edits (start, end, replacement)."""
        texts, starts, ends, news, done = [], [], [], [], 0
        for a, b, by in [*edits, (len(self.text), len(self.text), "")]:
            texts += [self.text[done:a], by]
            starts += [self.start[done:a], np.full(len(by), self.start[a] if a < len(self.start) else 0)]
            ends += [self.end[done:a], np.full(len(by), self.end[b - 1] if b else 0)]
            news += [self.new[done:a], np.ones(len(by), bool)]
            if by == "" and b > a:                       # what vanished belongs to its neighbours
                if len(news[-2]):
                    news[-2] = np.append(news[-2][:-1], True)
            done = b
        self.text = "".join(texts)
        self.start, self.end, self.new = (np.concatenate(x) for x in (starts, ends, news))

    def source(self, a: int, b: int) -> Span | None:
        """Source span of normalised [a, b) if it holds a rewritten character."""
        return (int(self.start[a]), int(self.end[b - 1])) if self.new[a:b].any() else None


def look_alikes(m: Mapped) -> None:
    edits = [(x.start(), x.end(), "" if x.group() in INVISIBLE else x.group().translate(LOOK_ALIKES)) for x in _ODD.finditer(m.text)]
    m.replace(edits)


def spelled_digits(m: Mapped) -> None:
    m.replace([(x.start(), x.end(), ("+" if x["plus"] else "") + "".join(DIGITS[d.lower()] for d in _ONE_DIGIT.findall(
        m.text, x.end("plus") if x["plus"] else x.start(), x.end()))) for x in _SPELLED.finditer(m.text)])


def written_signs(m: Mapped) -> None:
    edits = []
    for x in _ADDRESS.finditer(m.text):
        dots = [d for d in _WRITTEN_DOT.finditer(m.text, x.start("host"), x.end("host"))]
        if _BARE_AT.fullmatch(x["at"]) and not dots:
            continue
        if x["at"] != "@":
            edits.append((*x.span("at"), "@"))
        edits += [(*d.span(), ".") for d in dots]
    m.replace(edits)
    m.replace([(*d.span(), ".") for d in _LOCAL_DOT.finditer(m.text)])
    m.replace([(*d.span(), ".") for x in _NUMBER_DOTS.finditer(m.text) for d in _WRITTEN_DOT.finditer(m.text, x.start(), x.end())])


def normalised(text: str) -> Mapped | None:
    """The normalised text, or None where nothing looks disguised."""
    odd = not text.isascii() and _ODD.search(text)
    if not odd and not _HINT.search(text):
        return None
    m = Mapped(text)
    for transducer in (look_alikes, spelled_digits, written_signs):
        transducer(m)
    return m


def all_spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, base and added spans), by kind as listed, then start."""
    base = base_spans(text)
    m = normalised(text)
    if m is None or m.text == text:
        return base, base
    added = []
    for kind, a, b in base_spans(m.text):
        span = m.source(a, b)
        if span and not any(k == kind and s < span[1] and span[0] < e for k, s, e in base):
            added.append((kind, *span))
    return base, sorted(base + added, key=lambda x: (KINDS.index(x[0]), x[1]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a document: doc_id, the base spans' counts by kind, base and
    spans (kind:start:end, joined by commas; spans also holds the added ones)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [all_spans(x or "") for x in batch.column("text").to_pylist()]
            counts = [pa.array([sum(k == kind for k, _, _ in base) for base, _ in found], pa.int64()) for kind in KINDS]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *counts, pa.array([joined(b) for b, _ in found], pa.string()),
                 pa.array([joined(s) for _, s in found], pa.string())],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base", "spans"])

    df = id_and_text(docs, id_col, text_col)
    return df.mapInArrow(run, f"doc_id {dict(df.dtypes)['doc_id']}, " + ", ".join(f"n_{k} long" for k in KINDS)
                         + ", base string, spans string")
