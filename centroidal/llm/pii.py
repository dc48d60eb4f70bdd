"""Personal data: regular expressions propose spans, checksums (Luhn, mod-97) and digit rules confirm
them, context words near a span adjust its score.

Base kinds (email, ip, card, phone) follow the contract exactly: leftmost non-overlapping per kind,
failing matches dropped without retry. The method adds ``iban`` (of its country's length, mod-97) and ``ssn`` (only
with a context word near). Spans are code points, end exclusive. Null or empty text: no spans. All scans
are linear in the text: e-mails are read outwards from each ``@``, numbers only inside clusters of
number characters, so long runs of one character cost no more than others.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from centroidal.llm.frames import map_batches

# --- fixed values: the contract's patterns and order of kinds ---
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_CLUSTER = re.compile(r"[+0-9][\x20().0-9+-]*")
#: The lengths of account numbers by country.
IBAN_LENGTHS = {code[:2]: int(code[2:]) for code in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 FK18 FO18 "
    "FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 "
    "ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 "
    "ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30").split()}
_IBAN = {country: re.compile(rf"{country}[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}(?![A-Za-z0-9])") for country, n in IBAN_LENGTHS.items()}
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

#: Words that raise a kind's score when they stand within CONTEXT_CHARS before or after a span.
CONTEXT = {
    "email": ("mail", "contact", "write"), "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "credit", "payment"), "phone": ("phone", "call", "tel", "mobile"),
    "iban": ("iban", "bank", "account"), "ssn": ("ssn", "social", "security"),
}
CONTEXT_CHARS = 40
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.85, "phone": 0.75, "iban": 0.9, "ssn": 0.5}
CONTEXT_GAIN = 0.5


def luhn(digits: str) -> bool:
    """Luhn checksum of a digit string."""
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """IBAN checksum: the moved and spelled-out number leaves 1 modulo 97."""
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str):
    after, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > after and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            after = m.end()
        at = text.find("@", max(at + 1, after))


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def find_spans(text: str | None) -> list[tuple[int, int, int]]:
    """Confirmed spans ``(start, kind number, end)``, sorted."""
    if not text:
        return []
    spans = [(s, 0, e) for s, e in _emails(text)]
    for c in _CLUSTER.finditer(text):
        a, b = c.span()
        if a >= 2 and "A" <= text[a - 1] <= "Z" and "A" <= text[a - 2] <= "Z":
            country = text[a - 2:a]
            m = country in _IBAN and _IBAN[country].match(text, a - 2)
            if m and (a == 2 or not text[a - 3].isalnum()) and mod97(m[0].replace(" ", "")):
                spans.append((a - 2, 4, m.end()))
        if b - a < 7:
            continue
        for m in _IP.finditer(text, a, b):
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m[0].split("."))):
                spans.append((m.start(), 1, m.end()))
        if b - a < 9:
            continue
        for m in _CARD.finditer(text, a, b):
            if m.end() - m.start() >= 12 and 12 <= len(d := _digits(m[0])) <= 19 and luhn(d):
                spans.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(text, a, b):
            if 9 <= len(_digits(m[0])) <= 15:
                spans.append((m.start(), 3, m.end()))
        for m in _SSN.finditer(text, a, b):
            if near(text, m.start(), m.end(), "ssn"):
                spans.append((m.start(), 5, m.end()))
    return sorted(spans)


def near(text: str, start: int, end: int, kind: str) -> bool:
    """Whether a context word of the kind stands near the span."""
    around = f"{text[max(0, start - CONTEXT_CHARS):start]} {text[end:end + CONTEXT_CHARS]}".lower()
    words = set(re.findall(r"[a-z]+", around))
    return any(w in words for w in CONTEXT[kind])


def span_score(text: str, start: int, kind: int, end: int) -> float:
    """The kind's prior, moved towards 1 by a context word."""
    p = PRIOR[KINDS[kind]]
    return p + (1 - p) * CONTEXT_GAIN * near(text, start, end, KINDS[kind])


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _row(text: str | None) -> tuple:
    spans = find_spans(text)
    base = [x for x in spans if x[1] < 4]
    counts = [sum(1 for x in base if x[1] == k) for k in range(4)]
    score = max((span_score(text, *x) for x in spans), default=0.0)
    return (*counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans), score)


_OUT = [("n_email", pa.int64()), ("n_ip", pa.int64()), ("n_card", pa.int64()), ("n_phone", pa.int64()),
        ("base_sha256", pa.string()), ("spans", pa.string()), ("score", pa.float64())]


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of personal data in every whole text: ``id_col, n_email, n_ip, n_card, n_phone,
    base_sha256, spans, score`` (score: the surest span's, 0 without spans); one row per input row."""
    kept = docs.select(id_col, text_col)

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = list(zip(*map(_row, b.column(1).to_pylist())))
        return pa.RecordBatch.from_arrays(
            [b.column(0), *(pa.array(col, kind) for col, (_, kind) in zip(rows, _OUT))],
            names=[id_col, *(n for n, _ in _OUT)])

    return map_batches(kept, batch, f"`{id_col}` {kept.schema[0].dataType.simpleString()}, n_email long, n_ip long, "
                                    "n_card long, n_phone long, base_sha256 string, spans string, score double")


def redact(text: str | None) -> str | None:
    """The text with every span replaced by its kind in brackets; of overlapping spans the first, then
    the longest, stands, and what it covers is removed with it."""
    spans = find_spans(text)
    if not spans:
        return text
    out, at, ends = [], 0, 0
    for start, kind, end in sorted(spans, key=lambda x: (x[0], -x[2], x[1])):
        if start >= ends:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = ends = max(ends, end)
    return "".join(out) + text[at:]


def redact_docs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text_col`` replaced by placeholders such as ``[EMAIL]``; all
    rows and columns stay, null texts stay null."""
    at = docs.columns.index(text_col)

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = b.column(at)
        return b.set_column(at, b.schema.field(at), pa.array([redact(t) for t in texts.to_pylist()], texts.type))

    return map_batches(docs, batch, docs.schema)
