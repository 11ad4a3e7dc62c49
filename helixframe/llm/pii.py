"""Personal data: expressions propose spans, checksums confirm them, context words adjust a score.

``find_pii`` returns every span of every text; ``redact_pii`` replaces them. Both scan whole texts once,
in time linear in their length, and need no shuffle.

Words near a span raise its score or, if they tell of something else (a version, an order number), lower it.
The base kinds (email, ip, card, phone) are always reported, whatever their score; the added ones (iban, ssn,
secret) from LEAST_SCORE on. What confirms: Luhn for cards, country's length and mod-97 for IBANs, letters
mixed with digits for secrets.

Defined results: a null or empty text has no spans (and stays null when redacted); repeated rows are
handled independently; other columns are never looked at, so clashing names do no harm; an empty table
gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import slices, text_rows

#: The kinds in their order of output; the first four are the base kinds.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "secret")

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NUMBER = re.compile(r"[0-9][0-9. -]*")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?= ?[A-Z0-9])")
_SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
_ASSIGNED = re.compile(r"[:=]")
_SECRET_NAME = re.compile(r"(?:api[_-]?key|access[_-]?key|secret[_-]?key|private[_-]?key|client[_-]?secret|secret|token|passwd|password)[\"']?\s{0,8}$", re.IGNORECASE)
_SECRET_VALUE = re.compile(r"\s{0,8}[\"']?([A-Za-z0-9+/_=.-]{12,})")
_KEY_FORMS = re.compile(r"(?:AKIA|ASIA)[A-Z0-9]{16}|gh[opsur]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}|-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----")
_WORD = re.compile(r"\w+")

#: The length of each country's IBAN.
IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22,
    "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28,
    "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27,
    "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24,
    "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}

#: Words near a span that make its kind likelier.
CONTEXT = {
    "email": {"email", "mail", "contact", "correo", "courriel"},
    "ip": {"ip", "address", "host", "server", "adresse"},
    "card": {"card", "visa", "mastercard", "credit", "karte", "carte", "tarjeta"},
    "phone": {"phone", "call", "tel", "telefon", "telephone", "mobile"},
    "iban": {"iban", "account", "bank", "konto", "compte", "cuenta"},
    "ssn": {"ssn", "social", "security"},
    "secret": {"secret", "credential", "credentials", "password", "private", "auth"},
}
#: Words near a span that make its kind less likely.
AGAINST = {
    "email": {"example", "noreply"},
    "ip": {"version", "release", "section", "chapter", "build"},
    "card": {"isbn", "order", "invoice", "serial", "tracking"},
    "phone": {"isbn", "order", "invoice", "serial", "sum"},
    "iban": {"example", "sample"},
    "ssn": {"part", "serial", "order", "model", "isbn", "zip"},
    "secret": {"example", "checksum", "commit", "placeholder"},
}
#: Score of a proposal before checksum and context; what a checksum adds; what context adds or takes.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.5, "phone": 0.6, "iban": 0.4, "ssn": 0.3, "secret": 0.4}
CHECKSUM_BONUS, CONTEXT_BONUS, CONTEXT_CHARS = 0.4, 0.3, 48
#: Added kinds are reported from this score on; base kinds always are.
LEAST_SCORE = 0.6


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last, at = 0, text.find("@")
    while at >= 0:
        left = text[last:at]
        start = last + len(left.rstrip(_LOCAL))
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            last = m.end()
        else:
            last = at + 1  # a local part can't hold the sign itself
        at = text.find("@", last)


def _ips(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    for m in _DOTTED.finditer(text, start, end):
        parts = m[0].split(".")
        at = m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            length = sum(map(len, four)) + 3
            values = [p.lstrip("0") or "0" for p in four]  # a number may have any number of leading zeros
            if all(len(v) <= 3 and int(v) <= 255 for v in values):
                yield at, at + length
            at += length + 1


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """By country: so many letters and digits, single blanks between them or not, no letter or digit after them."""
    last = 0
    for m in _IBAN.finditer(text):
        n, at = IBAN_LENGTH.get(m[0][:2], 0), m.end()
        if m.start() < last or not n:
            continue
        taken = [m[0]]
        while len(taken) + 3 < n and at < len(text):
            at += text[at] == " "
            if at >= len(text) or not ("0" <= text[at] <= "9" or "A" <= text[at] <= "Z"):
                break
            taken.append(text[at])
            at += 1
        if len(taken) + 3 == n and not (at < len(text) and text[at].isalnum()) and mod97("".join(taken)):
            yield m.start(), at
            last = at


def _mixed(value: str) -> bool:
    """Whether a value looks drawn by chance: letters and digits, both more than once."""
    digits, letters = sum(c.isdigit() for c in value), sum(c.isalpha() for c in value)
    return digits > 1 and letters > 1


def _secrets(text: str) -> list[tuple[int, int, float]]:
    """Values given to names of secrets, and known forms of keys; in order, without overlap."""
    found = [(*m.span(), CHECKSUM_BONUS) for m in _KEY_FORMS.finditer(text) if not m.start() or not text[m.start() - 1].isalnum()]
    for m in _ASSIGNED.finditer(text):
        if _SECRET_NAME.search(text, max(0, m.start() - 32), m.start()):
            value = _SECRET_VALUE.match(text, m.end())
            if value:
                found.append((*value.span(1), CHECKSUM_BONUS if _mixed(value[1]) else 0.0))
    out: list[tuple[int, int, float]] = []
    for f in sorted(found):
        if not out or f[0] >= out[-1][1]:
            out.append(f)
    return out


def _near(text: str, kind: str, start: int, end: int) -> float:
    around = set(_WORD.findall((text[max(0, start - CONTEXT_CHARS) : start] + " " + text[end : end + CONTEXT_CHARS]).lower()))
    return CONTEXT_BONUS * (bool(CONTEXT[kind] & around) - bool(AGAINST[kind] & around))


def spans_of(text: str | None) -> list[Span]:
    """All spans by kind as in KINDS, then by start; offsets are code points, the end exclusive."""
    if not text:
        return []
    found: list[tuple[str, int, int, float]] = [("email", a, b, 0.0) for a, b in _emails(text)]
    ips, cards, phones, ssns = [], [], [], []
    # One pass over runs of digits and separators serves three kinds: each of their matches lies within one.
    for run in _NUMBER.finditer(text):
        a, b = run.span()
        if b - a < 7:
            continue
        ips += [("ip", s, e, 0.0) for s, e in _ips(text, a, b)]
        for m in _DIGITS.finditer(text, a, b):
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                cards.append(("card", *m.span(), CHECKSUM_BONUS))
        ssns += [("ssn", *m.span(), 0.0) for m in _SSN.finditer(text, a, b)]
    at = text.find("+")
    while at >= 0:
        m = _PHONE.match(text, at)
        if m and 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            phones.append(("phone", *m.span(), 0.0))
        at = text.find("+", m.end() if m else at + 1)
    found += ips + cards + phones
    found += [("iban", a, b, CHECKSUM_BONUS) for a, b in _ibans(text)]
    found += ssns
    found += [("secret", a, b, more) for a, b, more in _secrets(text)]
    out = [Span(k, a, b, round(min(1.0, max(0.0, PRIOR[k] + more + _near(text, k, a, b))), 6)) for k, a, b, more in found]
    return [s for s in out if s.kind in BASE_KINDS or s.score >= LEAST_SCORE]


def redacted(text: str | None, spans: list[Span]) -> str | None:
    """The text with each span, or run of overlapping spans, replaced by the name of its first kind."""
    if not text or not spans:
        return text
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s.start, -s.end)):
        if s.start >= at:
            out += [text[at : s.start], f"[{s.kind.upper()}]"]
        at = max(at, s.end)
    return "".join(out) + text[at:]


def find_pii(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: the key and ``spans``, an array of kind, start, end, score."""
    schema = f"`{key}` bigint, spans array<struct<kind:string,start:bigint,end:bigint,score:double>>"
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts in text_rows(batches, key, text):
            spans = [[s._asdict() for s in spans_of(t)] for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(spans, pa.list_(item))], [key, "spans"])

    return df.select(F.col(key).cast("bigint").alias(key), text).mapInArrow(scan, schema)


def pii_digest(df: DataFrame) -> DataFrame:
    """The digest of each document: counts of base kinds, hash of base spans, all spans, their number and scores as text."""

    def of(*kinds: str):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    def named(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    counts = [F.size(of(kind)).cast("bigint").alias(f"n_{kind}") for kind in BASE_KINDS]
    scores = F.array_join(F.transform("spans", lambda s: F.format_number(s["score"], 2)), ",").alias("scores")
    return find_pii(df).select("doc_id", *counts, F.sha2(named(of(*BASE_KINDS)), 256).alias("base_sha256"), named(F.col("spans")).alias("spans"), F.size("spans").cast("bigint").alias("n_spans"), scores)


def redact_pii(df: DataFrame, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """``df`` with every span of ``text`` replaced by its kind; ``n_chars`` follows the new text."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            where = part.schema.get_field_index(text)
            new = [redacted(t, spans_of(t)) for t in part.column(where).to_pylist()]
            columns = list(part.columns)
            columns[where] = pa.array(new, part.schema.field(where).type)
            if n_chars in part.schema.names:
                k = part.schema.get_field_index(n_chars)
                old = part.column(k).to_pylist()
                columns[k] = pa.array([o if n is None else len(n) for o, n in zip(old, new, strict=True)], part.schema.field(k).type)
            yield pa.RecordBatch.from_arrays(columns, part.schema.names)

    return df.mapInArrow(scan, df.schema)
