"""Personal data: patterns propose spans, checksums confirm them, context adjusts scores."""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")
# Score a confirmed span starts with; a context word nearby adds CONTEXT.
START = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.3}
CONTEXT, REACH = 0.3, 60
REPORT = 0.5

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DIGIT = re.compile("[0-9]")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=[ A-Z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_NOT_DIGIT = re.compile("[^0-9]")

# Characters of an account number, by country.
IBAN_LENGTHS = {
    "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20,
    "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IT": 27,
    "LT": 20, "LU": 20, "LV": 21, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24,
    "SE": 24, "SI": 19, "SK": 24,
}
# Words that speak for a kind when they stand close by.
CONTEXT_WORDS = {
    "email": ("mail", "contact", "kontakt", "correo", "courriel"),
    "ip": ("ip", "address", "server", "host", "adresse"),
    "card": ("card", "visa", "mastercard", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "telefon", "fax"),
    "iban": ("iban", "account", "konto", "compte", "cuenta", "bank"),
    "ssn": ("ssn", "social security", "tax id"),
}
_NEAR = {
    kind: re.compile(r"\b(?:" + "|".join(words) + r")", re.IGNORECASE)
    for kind, words in CONTEXT_WORDS.items()
}

Span = tuple[str, int, int, float]


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        value = int(d) * (1 + k % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def mod97(account: str) -> bool:
    turned = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    # Walks back from each @, so a long run of letters costs one pass.
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        tail = _DOMAIN.match(text, at + 1) if start < at else None
        if tail:
            yield start, tail.end()
        floor = tail.end() if tail else at + 1
        at = text.find("@", floor)


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            yield m.span()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    for m in _IBAN.finditer(text):
        left = IBAN_LENGTHS.get(m[0][:2], 0)
        if not left:
            continue
        kept, i = [], m.start()
        while i < len(text) and len(kept) < left:
            c = text[i]
            if c.isascii() and (c.isdigit() or c.isupper()):
                kept.append(c)
            elif c != " " or text[i - 1] == " ":
                break
            i += 1
        if len(kept) == left and not text[i : i + 1].isalnum() and mod97("".join(kept)):
            yield m.start(), i


def _scored(text: str, kind: str, start: int, end: int) -> Span:
    near = text[max(0, start - REACH) : start] + " " + text[end : end + REACH]
    score = START[kind] + (CONTEXT if _NEAR[kind].search(near) else 0.0)
    return kind, start, end, min(score, 1.0)


def find_spans(text: str) -> list[Span]:
    """Confirmed spans ``(kind, start, end, score)`` in code points, by start and kind.

    Spans of the base kinds stay whatever their score; others need ``REPORT``.
    """
    found = []
    if "@" in text:
        found += [_scored(text, "email", *s) for s in _emails(text)]
    if _DIGIT.search(text):
        found += [_scored(text, "ip", *s) for s in _ips(text)]
        found += [_scored(text, "card", *s) for s in _cards(text)]
        if "+" in text:
            found += [_scored(text, "phone", *s) for s in _phones(text)]
        found += [_scored(text, "iban", *s) for s in _ibans(text)]
        found += [_scored(text, "ssn", *m.span()) for m in _SSN.finditer(text)]
    found = [s for s in found if s[0] in BASE_KINDS or s[3] >= REPORT]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def redact(text: str, spans: list[Span]) -> str:
    """Replaces spans by their kind; spans that overlap become one, named by the first."""
    out, at, k = [], 0, 0
    while k < len(spans):
        kind, start, end, _ = spans[k]
        k += 1
        while k < len(spans) and spans[k][1] < end:
            end = max(end, spans[k][2])
            k += 1
        out += [text[at:start], f"<{kind.upper()}>"]
        at = end
    return "".join([*out, text[at:]])


def listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end, _ in spans)


REPORT_COLUMNS = (
    *((f"n_{kind}", pa.int64()) for kind in KINDS),
    ("base_sha256", pa.string()),
    ("spans", pa.string()),
    ("top_score", pa.float64()),
)


def _report(text: str) -> tuple:
    spans = find_spans(text)
    base = listed([s for s in spans if s[0] in BASE_KINDS])
    return (
        *(sum(s[0] == kind for s in spans) for kind in KINDS),
        sha256(base.encode()).hexdigest(),
        listed(spans),
        max((s[3] for s in spans), default=None),
    )


def pii_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts by kind, a digest of the base spans, all spans and the best score, per row.

    A null text counts as empty; ids may be null or repeat, each row gets its own report.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_report(text.as_py() or "") for text in batch.column(1)]
            columns = zip(*rows) if rows else [()] * len(REPORT_COLUMNS)
            arrays = [pa.array(list(c), t) for c, (_, t) in zip(columns, REPORT_COLUMNS)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *arrays], [id_col, *(n for n, _ in REPORT_COLUMNS)]
            )

    kinds = {pa.int64(): "bigint", pa.string(): "string", pa.float64(): "double"}
    rows = docs.select(id_col, text_col)
    schema = ", ".join(f"{n} {kinds[t]}" for n, t in REPORT_COLUMNS)
    id_type = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {id_type}, {schema}")


def redacted(text_col: str = "text"):
    """Column expression: the text with personal data replaced; null stays null."""

    @F.arrow_udf("string")
    def run(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts:
            value = text.as_py()
            out.append(value if value is None else redact(value, find_spans(value)))
        return pa.array(out, pa.string())

    return run(F.col(text_col))
