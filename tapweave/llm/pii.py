"""Personal data: patterns propose spans, validators confirm them, context adjusts the score.

Base kinds are email, ip, card and phone; their matches that pass their check
(address parts, length and Luhn sum, number of digits) are always reported.
Further kinds need evidence: iban (mod-97 sum), ssn (number ranges), tel (local
telephone numbers), key (access keys of known shapes) and secret (assigned values
whose characters are as mixed as random ones) start from a prior, gain by a passed
check and by words like "iban", "call" or "password" shortly before the span, lose
by words like "order" or "version", and are reported from ``threshold`` on, unless
a base span covers part of them. The score of every span is reported with it.

Each text is scanned once from end to end in time linear in its length: an email
is found from its ``@``, and runs of digits are matched without stepping back.

Defined results: a null text counts as empty; an empty text has no spans; spans
of one kind never overlap; offsets count code points, ends are exclusive;
repeated rows get equal results; an empty table gives no rows; other columns are
passed through.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values ------------------------------------------------------------
BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn", "tel", "key", "secret")
CONTEXT = {
    "email": ("mail", "e-mail", "email", "contact", "write"),
    "ip": ("ip", "address", "host", "server", "login"),
    "card": ("card", "visa", "credit", "debit", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "konto", "cuenta", "compte"),
    "ssn": ("ssn", "social", "security"),
    "tel": ("phone", "tel", "call", "mobile", "fax", "telefon"),
    "key": ("key", "access", "aws", "token"),
    "secret": ("password", "passwd", "pwd", "secret", "token", "key", "apikey", "credential", "auth", "bearer"),
}
AGAINST = ("order", "invoice", "version", "isbn", "page", "serial", "item")
PRIOR = {"email": 0.8, "ip": 0.5, "card": 0.4, "phone": 0.6, "iban": 0.3, "ssn": 0.35, "tel": 0.35, "key": 0.6, "secret": 0.2}
CHECKED = {"email": 0.0, "ip": 0.2, "card": 0.4, "phone": 0.1, "iban": 0.5, "ssn": 0.1, "tel": 0.0, "key": 0.1, "secret": 0.2}
NEAR, FAR_OFF = 0.25, -0.2  # what a word for or against adds
# characters of an international account number by country
IBAN_SIZES = {
    code: size
    for size, codes in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
        26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
        30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for code in codes.split()
}
# -----------------------------------------------------------------------------

_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# only looks ahead, so that every start is proposed; what follows a number may be in capitals too
_IBAN = re.compile(r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})(?![A-Za-z0-9]))")
_SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_TEL = re.compile(r"(?<![0-9+(])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])")
# access keys whose issuers document their shape, and the head of a private key
_KEY = re.compile(r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}+)(?![A-Za-z0-9])|-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----")
_ASSIGNED = re.compile(r"[=:][ \t]*+[\"']?([A-Za-z0-9+/_.~-]{12,}+)")
_WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)?")


@dataclass(frozen=True)
class PiiParams:
    """``window``: characters before a span that are searched for context words; ``least_bits``: entropy of a secret's characters."""

    threshold: float = 0.6
    window: int = 48
    least_bits: float = 2.6


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    end: int
    score: float
    base: bool


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        value = int(d) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def mod97(code: str) -> bool:
    """International account numbers: letters count from 10, the remainder must be 1."""
    moved = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _digits(found: str) -> str:
    return "".join(c for c in found if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local part, @ and dotted domain."""
    spans, free = [], 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            spans.append((start, m.end()))
            free = m.end()
    return spans


def _base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    cards = [m.span() for m in _CARD.finditer(text)]
    cards = [(s, e) for s, e in cards if e - s >= 13]
    cards = [(s, e) for s, e in cards if 13 <= len(d := _digits(text[s:e])) <= 19 and luhn(d)]
    return {
        "email": emails(text) if "@" in text else [],
        "ip": [m.span() for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))],
        "card": cards,
        "phone": [m.span() for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15] if "+" in text else [],
    }


def ibans(text: str) -> list[tuple[int, int]]:
    """Leftmost account numbers that end with a group and have the country's size; between them the longest of countries not listed."""
    proposed = [(m.start(), m[1]) for m in _IBAN.finditer(text)]
    found: list[tuple[int, int]] = []
    for listed in (True, False):
        bounds = [*found, (len(text), len(text))]
        free = k = 0
        for start, run in proposed:
            while bounds[k][1] <= start:
                k += 1
            size = IBAN_SIZES.get(run[:2])
            if start < free or start >= bounds[k][0] or listed != bool(size):
                continue
            groups = run.split(" ")
            for n in range(len(groups), 0, -1):
                code = "".join(groups[:n])
                end = start + len(code) + n - 1
                if end <= bounds[k][0] and (len(code) == size if size else len(code) >= 15) and mod97(code):
                    found.append((start, end))
                    free = end
                    break
    return sorted(found)


def entropy(text: str) -> float:
    """Bits per character."""
    n = len(text)
    return -sum(k / n * math.log2(k / n) for k in Counter(text).values()) if n else 0.0


def _secret_ok(value: str, params: "PiiParams") -> bool:
    """Letters and digits, and as many bits per character as random text of that length has at least."""
    kinds = any(c.isdigit() for c in value) + any(c.isalpha() for c in value)
    return kinds == 2 and entropy(value) >= params.least_bits


def _ssn_ok(m: re.Match) -> bool:
    return m[1] not in ("000", "666") and m[1] < "900" and m[2] != "00" and m[3] != "0000"


def spans(text: str | None, params: PiiParams = PiiParams()) -> list[Span]:
    """All reported spans of a text, by kind as listed, then start."""
    text = text or ""
    base = _base_spans(text)
    taken = sorted(s for found in base.values() for s in found)
    starts, reached = [a for a, _ in taken], list(accumulate((b for _, b in taken), max))

    def covered(start: int, end: int) -> bool:
        before = bisect_left(starts, end)
        return before > 0 and reached[before - 1] > start

    def score(kind: str, start: int) -> float:
        words = {w.lower() for w in _WORD.findall(text[max(0, start - params.window) : start])}
        value = PRIOR[kind] + CHECKED[kind]
        value += NEAR * bool(words.intersection(CONTEXT[kind])) + FAR_OFF * bool(words.intersection(AGAINST))
        return round(min(1.0, max(0.0, value)), 3)

    out = [Span(k, s, e, score(k, s), True) for k in BASE for s, e in base[k]]
    proposed = {
        "iban": ibans(text),
        "ssn": [m.span() for m in _SSN.finditer(text) if _ssn_ok(m)],
        "tel": [m.span() for m in _TEL.finditer(text)],
        "key": [m.span() for m in _KEY.finditer(text)],
        "secret": [m.span(1) for m in _ASSIGNED.finditer(text) if _secret_ok(m[1], params)],
    }
    for kind in ADDED:
        for s, e in proposed[kind]:
            value = score(kind, s)
            if value >= params.threshold and not covered(s, e):
                out.append(Span(kind, s, e, value, False))
    return out


FOUND = "array<struct<kind:string,start:int,`end`:int,score:double,base:boolean>>"


def with_spans(docs: DataFrame, params: PiiParams = PiiParams()) -> DataFrame:
    """Add ``pii``: the reported spans with their scores."""

    @F.pandas_udf(FOUND)
    def find(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([[vars(s) for s in spans(t, params)] for t in batch], index=batch.index, dtype=object)

    return docs.withColumn("pii", find("text"))


def digested(found: DataFrame) -> DataFrame:
    """Counts by base kind, the digest of the base spans, the list of all spans and that of their scores, from ``pii``."""
    shown = F.transform("pii", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    base = F.transform(
        F.filter("pii", lambda s: s["base"]),
        lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
    )

    def count(kind: str):
        return F.size(F.filter("pii", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *(count(k) for k in BASE),
        F.sha2(F.concat_ws(",", base).cast("binary"), 256).alias("base_sha256"),
        F.concat_ws(",", shown).alias("spans"),
        F.concat_ws(",", F.transform("pii", lambda s: F.format_string("%.3f", s["score"]))).alias("scores"),
    )
