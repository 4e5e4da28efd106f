"""Personal data by offset-preserving deobfuscation.

A text is searched as it is, then once more after transducers have rewritten homoglyphs,
spelled digits and at/dot disguises. Each character of the rewritten text knows the source
characters that it stands for, so a match there becomes a span of the source. Spans of the
plain search stay; the second search adds those that overlap none of its kind.

Every search is linear in the text: e-mail addresses are found from their ``@``, internet
addresses from whole chains of numbers, and a text without any sign of a disguise is not
rewritten.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import column, prepare, texts_of, tidied

KINDS = ("email", "ip", "card", "phone")

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGIT = re.compile(r"[0-9]")
# A run of digits is tried from its beginning only: what follows it does not depend on the start.
CHAIN = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    at = text.find("@")
    while at >= 0:
        end = at
        domain = DOMAIN.match(text, at + 1) if at > done and text[at - 1] in LOCAL else None
        if domain:
            lo = at
            while lo > done and text[lo - 1] in LOCAL:
                lo -= 1
            end = domain.end()
            yield lo, end
            done = end
        at = text.find("@", max(end, at + 1))


def addresses(text: str) -> Iterator[tuple[int, int]]:
    for chain in CHAIN.finditer(text):
        at = [chain.start()]
        at += [chain.start() + i + 1 for i, c in enumerate(chain.group()) if c == "."]
        ends = [x - 1 for x in at[1:]] + [chain.end()]
        for i in range(0, len(at) - 3, 4):
            parts = [text[a:b] for a, b in zip(at[i : i + 4], ends[i : i + 4])]
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts):
                yield at[i], ends[i + 3]


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(text):
        if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
            yield m.span()


def identifiers(text: str) -> list[tuple[str, int, int]]:
    """Leftmost, non-overlapping matches of each kind; those that fail its rule are dropped."""
    out = [("email", *s) for s in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        out += [("ip", *s) for s in addresses(text)] if "." in text else []
        out += [("card", *s) for s in cards(text)]
        out += [("phone", *s) for s in phones(text)] if "+" in text else []
    return out


# Letters of other scripts that look like ASCII letters; fixed values.
LOOK_ALIKES = dict(zip("АВЕЅІЈКМНОРСТУХавеѕіјкмнорстухһԁԛԝ", "ABESIJKMHOPCTYXabesijkmhopctyxhdqw"))
LOOK_ALIKES |= dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧονικρ", "ABEZHIKMNOPTYXovikp"))
LOOK_ALIKES |= {chr(0xFEE0 + c): chr(c) for c in range(0x21, 0x7F)}
LOOK_ALIKES |= {"　": " ", " ": " ", "․": ".", "。": ".", "﹒": ".", "﹫": "@"}
LOOK_ALIKES |= dict.fromkeys("‐‑‒–−", "-")
LOOK_ALIKES |= {chr(zero + d): str(d) for zero in (0x0660, 0x06F0, 0x0966) for d in range(10)}
LOOK_ALIKES |= dict.fromkeys("​‌‍⁠﻿­", "")

# Spelled digits; fixed values.
DIGIT_WORDS = {
    w: str(i % 10)
    for words in (
        "zero one two three four five six seven eight nine",
        "zéro un deux trois quatre cinq six sept huit neuf",
        "null eins zwei drei vier fünf sechs sieben acht neun",
        "cero uno dos tres cuatro cinco seis siete ocho nueve",
    )
    for i, w in enumerate(words.split())
}
AT_WORDS, DOT_WORDS, PLUS_WORDS = "at|arroba|ät|chez", "dot|punkt|point|punto", "plus|más"

_digit = "(?:" + "|".join(sorted(DIGIT_WORDS, key=len, reverse=True)) + ")"
_gap = r"[\s,-]+"
_link = rf"{_gap}(?:(?:{DOT_WORDS}){_gap})?"
# Three spelled digits at least; what is between them is kept only if it is a dot.
SPELLED = re.compile(rf"(?<!\w)(?:(?:{PLUS_WORDS}){_gap})?{_digit}(?:{_link}{_digit}){{2,}}(?!\w)", re.I)
SPELLED_PART = re.compile(rf"(?P<digit>{_digit}(?!\w))|(?P<dot>{_gap}(?:{DOT_WORDS}){_gap})|(?P<plus>(?:{PLUS_WORDS}){_gap})|(?P<gap>{_gap})", re.I)
# White space before a sign is looked at from its beginning only, so a long run is read once.
_blank = r"(?:(?<!\s)\s+|)"
AT_SIGN = re.compile(
    rf"{_blank}[\[({{<]\s*(?:{AT_WORDS}|@)\s*[\])}}>]\s*"
    rf"|(?<!\s)\s+(?:{AT_WORDS})\s+(?=[A-Za-z0-9-]+(?:\s+(?:{DOT_WORDS})\s+|\s*[\[({{<]\s*(?:{DOT_WORDS}|\.)\s*[\])}}>]\s*)[A-Za-z0-9])"
    r"|(?<=\w)\s+@\s*(?=\w)|(?<=\w)@\s+(?=[A-Za-z0-9-]+\s*[.\[({<])",
    re.I,
)
DOT_SIGN = re.compile(
    rf"{_blank}[\[({{<]\s*(?:{DOT_WORDS}|\.)\s*[\])}}>]\s*|(?<=\w)\s+(?:{DOT_WORDS})\s+(?=\w)", re.I
)
STRANGE = re.compile("[" + "".join(map(re.escape, LOOK_ALIKES)) + "]")
BRACKETED = re.compile(rf"[\[({{<]\s*(?:{AT_WORDS}|{DOT_WORDS}|@|\.)\s*[\])}}>]", re.I)
# AT_SIGN and DOT_SIGN match nothing without one of these or a bracketed sign.
SIGNS = re.compile(rf"\s(?:(?:{DOT_WORDS})\s|@)|@\s", re.I)


class Rewritten:
    """A text with, for each character, the source characters that it stands for."""

    def __init__(self, text: str):
        self.text = text
        self.lo = np.arange(len(text), dtype=np.int64)
        self.hi = self.lo + 1
        self.new = np.zeros(len(text), bool)

    def replace(self, edits: list[tuple[int, int, str]]) -> None:
        """Put strings in place of ascending, non-overlapping ranges."""
        if not edits:
            return
        texts, los, his, news, at = [], [], [], [], 0
        for a, b, s in [*edits, (len(self.text), len(self.text), "")]:
            texts.append(self.text[at:a])
            los.append(self.lo[at:a])
            his.append(self.hi[at:a])
            news.append(self.new[at:a])
            if s:
                texts.append(s)
                los.append(np.full(len(s), self.lo[a]))
                his.append(np.full(len(s), self.hi[b - 1]))
                news.append(np.ones(len(s), bool))
            at = b
        self.text = "".join(texts)
        self.lo, self.hi, self.new = map(np.concatenate, (los, his, news))

    def source(self, a: int, b: int) -> tuple[int, int]:
        return int(self.lo[a]), int(self.hi[b - 1])


def spelled_digits(text: str) -> list[tuple[int, int, str]]:
    edits = []
    for run in SPELLED.finditer(text):
        for m in SPELLED_PART.finditer(text, run.start(), run.end()):
            kind = m.lastgroup
            word = m.group().lower()
            edits.append((*m.span(), {"digit": DIGIT_WORDS.get(word, ""), "dot": ".", "plus": "+", "gap": ""}[kind]))
    return edits


def disguised(text: str) -> Rewritten | None:
    """The text after all transducers; None if it has no sign of a disguise."""
    strange = not text.isascii() and STRANGE.search(text)
    if not (strange or SPELLED.search(text) or BRACKETED.search(text) or SIGNS.search(text)):
        return None
    out = Rewritten(text)
    if strange:
        out.replace([(m.start(), m.end(), LOOK_ALIKES[m.group()]) for m in STRANGE.finditer(out.text)])
    out.replace(spelled_digits(out.text))
    out.replace([(m.start(), m.end(), "@") for m in AT_SIGN.finditer(out.text)])
    out.replace([(m.start(), m.end(), ".") for m in DOT_SIGN.finditer(out.text)])
    return out if out.new.any() or len(out.text) != len(text) else None


def spans_of(text: str) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, plain) by start, then kind as listed; code points, end exclusive."""
    plain = identifiers(text)
    out = [(*s, True) for s in plain]
    hidden = disguised(text)
    if hidden is not None:
        changed = np.concatenate([[0], np.cumsum(hidden.new)])
        removed = hidden.hi[:-1] != hidden.lo[1:]
        jumps = np.concatenate([[0], np.cumsum(removed), [int(removed.sum())]])
        for kind, a, b in identifiers(hidden.text):
            if changed[b] == changed[a] and jumps[b - 1] == jumps[a]:
                continue
            lo, hi = hidden.source(a, b)
            if not any(k == kind and x < hi and lo < y for k, x, y in plain):
                out.append((kind, lo, hi, False))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


SPANS = "array<struct<kind:string,start:int,end:int,plain:boolean>>"


def personal_data(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans): a row for each row of ``docs``, with all its spans.

    ``plain`` marks spans found without rewriting. Null and empty texts have no spans, null
    ids stay null, repeated rows are answered one by one, other columns are not read.
    """
    prepare(docs.sparkSession)
    kind = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("plain", pa.bool_())])
    )

    @tidied
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("kind", "start", "end", "plain")
        for batch in batches:
            found = [[dict(zip(names, s)) for s in spans_of(t)] for t in texts_of(batch)]
            ids = pa.array(column(batch, "id"), pa.int64())
            yield pa.RecordBatch.from_arrays([ids, pa.array(found, kind)], ["doc_id", "spans"])

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(find, f"doc_id long, spans {SPANS}")


def redacted_text(text: str) -> str:
    """The text with each span, or run of overlapping spans, replaced by its first kind."""
    out, done = [], 0
    for kind, lo, hi, _ in spans_of(text):
        if lo >= done:
            out += [text[done:lo], f"[{kind.upper()}]"]
        done = max(done, hi)
    return "".join(out) + text[done:]


def redacted(docs: DataFrame, *, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """The rows of ``docs`` with personal data replaced; all columns stay, in their order.

    ``length_col``, if named, is set to the new text's number of code points. Null texts
    stay null and keep their length.
    """
    prepare(docs.sparkSession)
    schema = docs.schema
    at = schema.names.index(text_col)
    length_at = schema.names.index(length_col) if length_col else None

    @tidied
    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if t is None else redacted_text(t) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.types[at])
            if length_at is not None:
                old = batch.column(length_at).to_pylist()
                columns[length_at] = pa.array(
                    [n if t is None else len(t) for t, n in zip(texts, old)], batch.schema.types[length_at]
                )
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(change, schema)
