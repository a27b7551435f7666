"""Personal data: expressions propose spans, checksums confirm them, context adjusts the score.

Searches start at the rare character a span must have (@, +, a digit), so every
text is scanned in linear time whatever it holds.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame


class Span(NamedTuple):
    kind: str
    start: int  # code points, end exclusive
    end: int
    score: float


BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "ssn", "mac")
KINDS = BASE_KINDS + ADDED_KINDS

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A match can only begin where a run of digits does, and a run is taken whole.
_IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_MAC = re.compile(r"(?<![0-9A-Fa-f:-])[0-9A-Fa-f]{2}([:-])[0-9A-Fa-f]{2}(?:\1[0-9A-Fa-f]{2}){4}(?![0-9A-Fa-f:-])")

# Score of a proposed span, and what a confirmed checksum and a context word add.
PROPOSED = {"email": 0.8, "ip": 0.6, "card": 0.3, "phone": 0.5, "iban": 0.3, "ssn": 0.3, "mac": 0.6}
CHECKSUM_ADDS = 0.5
CONTEXT_ADDS = 0.2
# Added kinds are reported from this score on; base kinds always.
REPORTED = 0.5
CONTEXT_CHARS = 48
CONTEXT = {
    "email": ("mail", "contact", "write to"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "credit", "visa", "payment", "karte", "carte", "tarjeta"),
    "phone": ("phone", "call", "tel", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social", "security"),
    "mac": ("mac", "device", "hardware"),
}
_CONTEXT = {kind: re.compile(r"\b(?:" + "|".join(words) + ")", re.I) for kind, words in CONTEXT.items()}


def luhn(digits: str) -> bool:
    """Doubling every second digit from the right, the digit sums add up to a multiple of ten."""
    values = [int(d) for d in reversed(digits)]
    return sum(values[::2] + [2 * v - 9 * (v > 4) for v in values[1::2]]) % 10 == 0


def mod_97(code: str) -> bool:
    """The account number check: the first four characters go last, letters count from 10, the rest is 1."""
    moved = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """One span for each @ with a local part before it and a dotted domain behind it."""
    done = 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > done and (text[begin - 1].isascii() and (text[begin - 1].isalnum() or text[begin - 1] in "._%+-")):
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            yield begin, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def find_spans(text: str) -> list[Span]:
    """All spans of a text, by kind as in KINDS, then by start."""
    proposed: list[tuple[str, int, int, bool]] = [("email", a, b, False) for a, b in _emails(text)]
    if "." in text:
        for m in _IP.finditer(text):
            if all(_small(p) for p in m[0].split(".")):
                proposed.append(("ip", m.start(), m.end(), False))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(digits := _digits(m[0])) <= 19 and luhn(digits):
            proposed.append(("card", m.start(), m.end(), True))
    at = text.find("+")
    while at >= 0:
        if m := _PHONE.match(text, at):
            if 9 <= len(_digits(m[0])) <= 15:
                proposed.append(("phone", m.start(), m.end(), False))
            at = text.find("+", m.end())
        else:
            at = text.find("+", at + 1)
    for m in _IBAN.finditer(text):
        code = m[0].replace(" ", "")
        if 15 <= len(code) <= 34 and mod_97(code):
            proposed.append(("iban", m.start(), m.end(), True))
    if "-" in text:
        for m in _SSN.finditer(text):
            if m[1] not in ("000", "666") and m[1] < "900" and m[2] != "00" and m[3] != "0000":
                proposed.append(("ssn", m.start(), m.end(), False))
    if ":" in text or "-" in text:
        proposed += [("mac", m.start(), m.end(), False) for m in _MAC.finditer(text)]

    spans = []
    for kind, start, end, confirmed in proposed:
        near = _CONTEXT[kind].search(text, max(0, start - CONTEXT_CHARS), start) or _CONTEXT[kind].search(text, end, end + CONTEXT_CHARS)
        score = min(1.0, PROPOSED[kind] + CHECKSUM_ADDS * confirmed + CONTEXT_ADDS * bool(near))
        if kind in BASE_KINDS or score >= REPORTED:
            spans.append(Span(kind, start, end, round(score, 3)))
    return sorted(spans, key=lambda s: (KINDS.index(s.kind), s.start))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def scan_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans, score) for every row, without a shuffle.

    Email, address, card and phone spans are the leftmost non-overlapping matches
    of their kind that pass their check; account numbers (mod 97), social security
    and hardware numbers are added from a score of REPORTED on.  ``score`` is the
    greatest of a span, 0 without spans.  Null counts as empty; repeated rows and
    null ids give a row each; other columns are not read.
    """
    schema = (
        f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_email long, n_ip long, n_card long, n_phone long,"
        " base_sha256 string, spans string, score double"
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[] for _ in BASE_KINDS]
            digests, joins, scores = [], [], []
            for text in batch.column(1):
                spans = find_spans(text.as_py() or "")
                base = [s for s in spans if s.kind in BASE_KINDS]
                for kind, count in zip(BASE_KINDS, counts):
                    count.append(sum(s.kind == kind for s in base))
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                joins.append(joined(spans))
                scores.append(max((s.score for s in spans), default=0.0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(digests, pa.string()),
                 pa.array(joins, pa.string()), pa.array(scores, pa.float64())],
                [id_col, *[f"n_{k}" for k in BASE_KINDS], "base_sha256", "spans", "score"],
            )

    return docs.select(id_col, text_col).mapInArrow(scan, schema)
