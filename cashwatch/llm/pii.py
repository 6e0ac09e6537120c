"""Personal data: patterns propose spans, checksums confirm them, context moves the score.

Defined cases: a null text is an empty one; long runs of digits or letters are scanned in
linear time; repeated rows have equal spans; an empty table gives an empty result; columns
other than `doc_id` and `text` are ignored by `find_pii` and passed through by `redacted`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Base kinds in order, then the kinds this method adds.
BASE = ["email", "ip", "card", "phone"]
KINDS = [*BASE, "iban", "ssn"]
TAGS = {kind: f"[{kind.upper()}]" for kind in KINDS}

_AT_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
# A match starts with its digit run; starting later in the run cannot succeed either.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

CONTEXT_REACH = 40
CONTEXT_STEP = 0.3
THRESHOLD = 0.6
# Score without context, and the words nearby that raise it.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.4}
CONTEXT = {
    "email": re.compile(r"(?i)\b(?:e-?mail|contact|write)\b"),
    "ip": re.compile(r"(?i)\b(?:ip|host|server|address|login)\b"),
    "card": re.compile(r"(?i)\b(?:card|visa|mastercard|payment|credit)\b"),
    "phone": re.compile(r"(?i)\b(?:phone|tel|call|mobile|fax)\b"),
    "iban": re.compile(r"(?i)\b(?:iban|account|bank|transfer)\b"),
    "ssn": re.compile(r"(?i)\b(?:ssn|social|security)\b"),
}


class Span(NamedTuple):
    start: int
    place: int  # of the kind in KINDS
    end: int
    score: float
    kind: str


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def iban_valid(text: str) -> bool:
    """The mod-97 check over the rearranged characters, letters as numbers from 10."""
    code = text.replace(" ", "")
    if not 15 <= len(code) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def _octet(part: str) -> bool:
    part = part.lstrip("0") or "0"
    return len(part) <= 3 and int(part) <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @ and domain the local part is the run before it, up to the match before."""
    last = 0
    for m in _AT_DOMAIN.finditer(text):
        at = m.start()
        start = at
        while start > last:  # in steps, so that a long run is not copied for every address
            low = max(last, start - 64)
            piece = text[low:start]
            run = _LOCAL_END.search(piece)
            if run is None:
                break
            start = low + run.start()
            if run.start() > 0:
                break
        if start < at:
            yield start, m.end()
            last = m.end()


def _confirmed(text: str) -> Iterator[tuple[str, int, int]]:
    if "@" in text:
        for start, end in _emails(text):
            yield "email", start, end
    for m in _IP.finditer(text):
        if all(map(_octet, m[0].split("."))):
            yield "ip", m.start(), m.end()
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield "card", m.start(), m.end()
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                yield "phone", m.start(), m.end()
    for m in _IBAN.finditer(text):
        if iban_valid(m[0]):
            yield "iban", m.start(), m.end()
    for m in _SSN.finditer(text):
        if m[0][:3] not in ("000", "666") and m[0][0] != "9" and m[0][4:6] != "00" and m[0][7:] != "0000":
            yield "ssn", m.start(), m.end()


def spans_of(text: str | None) -> list[Span]:
    """Confirmed spans by start and kind. Base kinds always stay; an added kind needs a
    score of at least `THRESHOLD`."""
    out = []
    text = text or ""
    for kind, start, end in _confirmed(text):
        around = text[max(0, start - CONTEXT_REACH) : start] + "\n" + text[end : end + CONTEXT_REACH]
        score = min(1.0, SCORES[kind] + (CONTEXT_STEP if CONTEXT[kind].search(around) else 0.0))
        if kind in BASE or score >= THRESHOLD:
            out.append(Span(start, KINDS.index(kind), end, round(score, 2), kind))
    return sorted(out)


def redact(text: str | None) -> str | None:
    """The text with each span replaced by its kind's tag; of overlapping spans the first,
    or the longest of those that start together, gives the tag and all their text goes."""
    if not text:
        return text
    out, at, cover = [], 0, 0
    for s in sorted(spans_of(text), key=lambda s: (s.start, -s.end)):
        if s.start >= cover:
            out += [text[at : s.start], TAGS[s.kind]]
        cover = max(cover, s.end)
        at = cover
    return "".join([*out, text[at:]])


_SPANS = "array<struct<start:int,place:int,end:int,score:double,kind:string>>"
_ARROW_SPANS = pa.list_(
    pa.struct([("start", pa.int32()), ("place", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("kind", pa.string())])
)


def find_pii(docs: DataFrame) -> DataFrame:
    """`doc_id, spans` of every row; offsets are code points, ends exclusive."""
    rows = docs.select("doc_id", "text")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[s._asdict() for s in spans_of(t.as_py())] for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, _ARROW_SPANS)], names=["doc_id", "spans"]
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(find, f"doc_id {kind}, spans {_SPANS}")


def redacted(docs: DataFrame) -> DataFrame:
    """`docs` with personal data in `text` replaced by tags; `n_chars` follows the text."""
    names = docs.columns

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            text = pa.array([redact(t.as_py()) for t in batch.column(at)], pa.string())
            yield batch.set_column(at, "text", text)

    out = docs.mapInArrow(mask, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in names else out
