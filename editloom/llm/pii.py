"""Personal data in texts: regular expressions propose, checksums confirm, context words adjust the score.

Four kinds have fixed rules and always count: email, ip, card (Luhn), phone. Further kinds count if their score reaches
THRESHOLD: iban (mod-97), secret (key = value, key prefixes), ssn, short card numbers and local phone numbers, which need a
context word in the WINDOW characters before or after. A further span that touches a fixed one is left out.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, texts

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "secret", "ssn", "card_short", "phone_local")
THRESHOLD, WINDOW = 0.5, 40

AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
CHAIN = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NUMBER = re.compile(r"[0-9]+")
DIGIT = re.compile(r"[0-9]")

IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
#: characters of an account number by country; others take all that follows
IBAN_SIZE = {k[:2]: int(k[2:]) for k in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 "
    "KZ20 LB28 LC32 LI21 LT20 LU20 LV21 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20"
).split()}
SECRET_VALUE = re.compile(r"(?<![A-Za-z0-9])(?i:api[_-]?key|access[_-]?key|secret(?:[_-]?key)?|auth[_-]?token|token|passw(?:or)?d|pwd)[ ]?[=:][ ]?[\"']?([A-Za-z0-9+/_.-]{8,})")
SECRET_PREFIX = re.compile(r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])|(?<![A-Za-z0-9])gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
LOCAL_PHONE = re.compile(r"(?<![0-9+])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])")
CONTEXT = {
    "iban": re.compile(r"(?i)\b(?:iban|bic|swift|bank|konto|compte|cuenta|account)\b"),
    "secret": re.compile(r"(?i)\b(?:key|secret|token|password|credential|auth)"),
    "ssn": re.compile(r"(?i)\b(?:ssn|social security|tax ?id)\b"),
    "card_short": re.compile(r"(?i)\b(?:card|visa|amex|mastercard|carte|karte|tarjeta|cvv|cvc)\b"),
    "phone_local": re.compile(r"(?i)\b(?:phone|tel|telephone|call|fax|mobile|cell|telefon|handy|téléphone|teléfono|móvil)\b"),
}
AGAINST = re.compile(r"(?i)\b(?:version|isbn|issn|order|invoice|build|revision|example|sample|doi)\b")
PRIOR = {"iban": 0.6, "secret": 0.5, "ssn": 0.2, "card_short": 0.3, "phone_local": 0.3}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i & 1:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    s = iban.replace(" ", "")
    if not 15 <= len(s) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    last = 0
    for m in AT.finditer(text):
        at = start = m.start()
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < at:
            last = m.end()
            yield start, last


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Runs of four dotted numbers, leftmost first; a chain of eight holds two."""
    for m in CHAIN.finditer(text):
        parts = m.group().split(".")
        if len(parts) < 4:
            continue
        at = m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in four):
                yield at, end
            at = end + 1


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        out += [("ip", a, b) for a, b in addresses(text)] if "." in text else []
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = m.group().replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and luhn(digits):
                    out.append(("card", m.start(), m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 8 <= sum(map(len, NUMBER.findall(m.group()))) <= 15:
                    out.append(("phone", m.start(), m.end()))
    return out


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """Account numbers that pass their checksum, cut to their country's size: capitals that follow do not belong to them."""
    m = IBAN.search(text)
    while m:
        start, end = m.span()
        own = [i for i in range(start, end) if text[i] != " "]
        size = IBAN_SIZE.get(text[start : start + 2], len(own))
        if size <= len(own):
            end = own[size - 1] + 1
            if not text[end : end + 1].isalnum() and mod97(text[start:end]):
                yield start, end
                m = IBAN.search(text, end)
                continue
        m = IBAN.search(text, start + 4)


def proposed(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(kind, start, end, whether a checksum confirms it) of the kinds that are scored."""
    if DIGIT.search(text):
        for a, b in ibans(text):
            yield "iban", a, b, True
        for m in SSN.finditer(text):
            a, b, c = m.group().split("-")
            if a not in ("000", "666") and a < "900" and b != "00" and c != "0000":
                yield "ssn", m.start(), m.end(), False
        for m in CARD.finditer(text):
            if 13 <= m.end() - m.start() <= 29:
                digits = m.group().replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 15 and luhn(digits):
                    yield "card_short", m.start(), m.end(), True
        for m in LOCAL_PHONE.finditer(text):
            yield "phone_local", m.start(), m.end(), False
    for m in SECRET_PREFIX.finditer(text):
        yield "secret", m.start(), m.end(), True
    if "=" in text or ":" in text:
        for m in SECRET_VALUE.finditer(text):
            v = m.group(1)
            if DIGIT.search(v) and any(c.isalpha() for c in v):
                yield "secret", m.start(1), m.end(1), True


class Taken:
    """Disjoint spans in order; overlapping ones of different fixed kinds are joined."""

    def __init__(self, spans):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, b in sorted(spans):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def touches(self, a: int, b: int) -> bool:
        k = bisect_left(self.starts, b)
        return k > 0 and self.ends[k - 1] > a

    def add(self, a: int, b: int) -> None:
        k = bisect_left(self.starts, a)
        self.starts.insert(k, a)
        self.ends.insert(k, b)


def score(kind: str, text: str, start: int, end: int, confirmed: bool) -> float:
    near = text[max(0, start - WINDOW) : start] + " " + text[end : end + WINDOW]
    s = PRIOR[kind] + 0.1 * confirmed
    s += 0.3 if CONTEXT[kind].search(near) else 0
    s -= 0.2 if AGAINST.search(near) else 0
    return round(min(1.0, max(0.0, s)), 3)


def find(text: str) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) in code points, by kind as in KINDS, then start."""
    fixed = base_spans(text)
    out = [(k, a, b, 1.0) for k, a, b in fixed]
    taken = Taken((a, b) for _, a, b in fixed)
    for kind, a, b, confirmed in sorted(proposed(text), key=lambda x: (KINDS.index(x[0]), x[1])):
        if taken.touches(a, b):
            continue
        s = score(kind, text, a, b, confirmed)
        if s >= THRESHOLD:
            out.append((kind, a, b, s))
            taken.add(a, b)
    return sorted(out, key=lambda x: (KINDS.index(x[0]), x[1]))


def redact(text: str, spans: list[tuple[str, int, int, float]]) -> str:
    """Each run of overlapping spans becomes the upper-case name of its first kind in angle brackets."""
    out, at = [], 0
    for kind, a, b, _ in sorted(spans, key=lambda x: (x[1], -x[2])):
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = b
    return "".join(out) + text[at:] if out else text


SPAN = "array<struct<kind:string,start:int,end:int,score:double>>"
SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, spans and the redacted text of every document.

    Null texts count as empty: no spans; texts of any length are searched whole. Every row gives a row, repeated ones and
    those without a doc_id too; of spans that overlap the earlier, then the longer one names what is redacted. An empty
    table gives no rows. Columns beside doc_id and text are not read, so none can clash.
    """

    def block(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = batch.column("text").to_pylist()
        spans = [find(x) for x in rows]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([[{"kind": k, "start": a, "end": b, "score": s} for k, a, b, s in x] for x in spans], SPAN_TYPE), pa.array([redact(x, s) for x, s in zip(rows, spans, strict=True)], pa.string())],
            ["doc_id", "spans", "redacted"],
        )

    return map_arrow(texts(docs), block, f"doc_id long, spans {SPAN}, redacted string")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the fixed kinds, the sha256 of their spans, and all spans as a string; a text without spans has the
    sha256 of nothing and an empty string. Rows as in find_pii."""
    line = lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])
    base = F.filter("spans", lambda x: x["kind"].isin(*BASE))
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return find_pii(docs).select(
        "doc_id", *(count(k) for k in BASE), F.sha2(F.array_join(F.transform(base, line), ","), 256).alias("base_sha256"), F.array_join(F.transform("spans", line), ",").alias("spans")
    )
