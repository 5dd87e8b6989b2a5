"""Patterns of personal data: the base spans, and what a span of each kind must hold."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

KINDS = ("email", "ip", "card", "phone")

#: A plausible span of any kind holds a digit, an at sign or a spelled-out one.
ANCHOR = re.compile(r"[0-9@]| (?=at )")
_DIGIT = re.compile(r"[0-9]")

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

Span = tuple[int, int, int]


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def is_ip(text: str) -> bool:
    parts = [p.lstrip("0") for p in text.split(".")]
    return len(parts) == 4 and all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def is_card(text: str) -> bool:
    digits = digits_of(text)
    return 14 <= len(digits) <= 19 and luhn(digits)


def is_phone(text: str) -> bool:
    return 10 <= len(digits_of(text)) <= 15


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each at sign back over the local part and forward over the domain, in linear time."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and _LOCAL.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) of all base matches, leftmost and non-overlapping per kind."""
    found: list[Span] = []
    if "@" in text:
        found += [(s, e, 0) for s, e in _emails(text)]
    if not _DIGIT.search(text):
        return found
    if "." in text:
        found += [(m.start(), m.end(), 1) for m in _IP.finditer(text) if is_ip(m[0])]
    found += [(m.start(), m.end(), 2) for m in _CARD.finditer(text) if is_card(m[0])]
    if "+" in text:
        found += [(m.start(), m.end(), 3) for m in _PHONE.finditer(text) if is_phone(m[0])]
    return sorted(found, key=lambda s: (s[0], s[2], s[1]))


def plausible(text: str, kind: int) -> bool:
    """What a span found without a pattern must hold to count."""
    if kind == 0:
        return bool(re.search(r"\S *(?:@| at ) *\S+ *(?:\.| dot ) *[A-Za-z]", text)) and "\n" not in text
    if kind == 1:
        return is_ip(text)
    if kind == 2:
        return is_card(text) and not re.search(r"[^0-9 .-]", text)
    return is_phone(text) and not re.search(r"[^0-9 ().+/-]", text) and not digits_of(text) == text


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in sorted(spans, key=lambda s: (s[0], s[2], s[1])))


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
