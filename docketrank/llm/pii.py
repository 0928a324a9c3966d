"""Personal data: patterns propose spans, checksums confirm them, words around adjust a score."""

from __future__ import annotations

import re
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

# Kinds in the order of listing; those after phone are the method's own.
KINDS = ("email", "ip", "card", "phone", "iban", "secret")

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A run of digits starts a match only at its start, and is never given back: what follows it
# decides, so other starts fail alike. This keeps long runs of digits linear.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SECRET = re.compile(
    r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}(?![A-Za-z0-9])"
    r"|(?i:password|passwd|secret|token|api[_-]?key)\s{0,2}[=:]\s{0,2}[\"']?[A-Za-z0-9_/+.-]{8,}+)"
)

# Score before context, and words near a span that raise it. A span matches a full pattern (and its
# checksum, where there is one), so it stays whatever its score.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "secret": 0.6}
CONTEXT = {
    "email": ("mail", "contact", "write", "address"),
    "ip": ("ip", "host", "server", "address", "login"),
    "card": ("card", "visa", "credit", "debit", "payment"),
    "phone": ("call", "phone", "tel", "mobile", "fax"),
    "iban": ("iban", "bank", "account", "konto", "transfer"),
    "secret": ("key", "password", "token", "secret", "login"),
}
# Words that lower the score of every kind.
AGAINST = ("example", "version", "isbn", "order", "serial", "sample")
NEAR, RAISE, LOWER = 40, 0.15, 0.3
_WORD = re.compile(r"[a-z]+")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    """The checksum of payment cards."""
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def mod97(code: str) -> bool:
    """The checksum of bank account numbers."""
    turned = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _small(part: str) -> bool:
    value = part.lstrip("0")
    return len(value) <= 3 and int(value or "0") <= 255


def _emails(text: str):
    """Every match holds an @ with a local part before it; so the @ signs are gone through."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        at = text.find("@", max(free, at + 1))


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _proposed(text: str):
    if "@" in text:
        yield from (("email", a, b) for a, b in _emails(text))
    for found in _IP.finditer(text):
        if all(map(_small, found[0].split("."))):
            yield "ip", found.start(), found.end()
    for found in _CARD.finditer(text):
        if found.end() - found.start() >= 12 and 12 <= len(digits := _digits(found[0])) <= 19 and luhn(digits):
            yield "card", found.start(), found.end()
    if "+" in text:
        for found in _PHONE.finditer(text):
            if 9 <= len(_digits(found[0])) <= 15:
                yield "phone", found.start(), found.end()
    for found in _IBAN.finditer(text):
        code = found[0].replace(" ", "")
        if 15 <= len(code) <= 34 and mod97(code):
            yield "iban", found.start(), found.end()
    for found in _SECRET.finditer(text):
        yield "secret", found.start(), found.end()


def _score(text: str, kind: str, start: int, end: int) -> float:
    around = (text[max(0, start - NEAR) : start] + " " + text[end : end + NEAR]).lower()
    words = set(_WORD.findall(around))
    if kind == "secret":
        words.update(_WORD.findall(text[start : start + 16].lower()))
    score = PRIOR[kind] + RAISE * any(w in words for w in CONTEXT[kind]) - LOWER * any(w in words for w in AGAINST)
    return round(min(1.0, max(0.0, score)), 3)


def find_spans(text: str | None) -> list[Span]:
    """Spans of a text by start and kind; offsets count code points, ends are exclusive."""
    if not text:
        return []
    spans = [Span(kind, start, end, _score(text, kind, start, end)) for kind, start, end in _proposed(text)]
    return sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind)))


def mask(text: str | None) -> str | None:
    """The text with every span replaced by its kind, NULL where nothing changes.

    Spans of several kinds that overlap become one replacement, named after the first.
    """
    spans = find_spans(text)
    if not spans:
        return None
    out, upto = [], 0
    for at, span in enumerate(spans):
        if at and span.start < upto:
            upto = max(upto, span.end)
            continue
        out += [text[upto : span.start], f"<{span.kind.upper()}>"]
        upto = span.end
    return "".join([*out, text[upto:]])


def _spans(texts: pd.Series) -> pd.Series:
    return pd.Series([[span._asdict() for span in find_spans(text)] for text in texts], dtype=object)


def _masked(texts: pd.Series) -> pd.Series:
    return pd.Series([mask(text) for text in texts], dtype=object)


# Not "deterministic" to the optimizer, else each use of a result would run a function again.


def personal_data(text: Column) -> Column:
    """Spans (kind, start, end, score) of a text column; an empty list for NULL and empty texts.

    The work is row by row: nothing is shuffled, repeated rows get equal spans, and texts of any
    length take time in proportion to it.
    """
    kind = "array<struct<kind:string,start:long,end:long,score:double>>"
    return F.pandas_udf(_spans, kind).asNondeterministic()(text)


def mask_personal_data(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The same rows and columns with personal data masked and the length counted anew.

    A NULL text stays NULL and keeps its count, as do texts without personal data.
    """
    mask = F.pandas_udf(_masked, "string").asNondeterministic()(F.col(text))
    both = docs.select(F.struct("*").alias("row"), mask.alias("masked"))
    masked, before = F.col("masked"), F.col(f"row.`{n_chars}`")
    changed = {
        text: F.coalesce(masked, F.col(f"row.`{text}`")),
        n_chars: F.when(masked.isNull(), before).otherwise(F.length(masked).cast("long")),
    }
    return both.select(*(changed.get(name, F.col(f"row.`{name}`")).alias(name) for name in docs.columns))
