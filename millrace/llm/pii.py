"""Personal data: patterns propose spans, validators confirm them, nearby words adjust a score.

Validators are Luhn for cards, mod-97 for account numbers, digit counts and part sizes. The
score starts from the kind, rises with a word for the kind within ``NEAR`` characters before the
span, and falls with a word that speaks against it (such as "version" before four numbers). Base
kinds stay whatever the score; kinds of the method need ``THRESHOLD``.

Null and empty texts have no span. Every pattern moves forward in the text, so the work is in
proportion to it.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from itertools import accumulate

from pyspark.sql import DataFrame

from millrace.llm.spans import Span, add_spans

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "national_id", "account")
THRESHOLD = 0.5
NEAR = 48

# The patterns of the contract. The local part of an address is the run before
# its @; runs of digits are taken whole, which finds the same matches without trying again.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=\x20?[A-Z0-9])")
# How many characters an account number has, by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28,
    "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18,
    "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22,
    "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15,
    "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24, "SI": 19,
    "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}
NATIONAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
ACCOUNT = re.compile(r"(?<![0-9A-Za-z.])[0-9]{8,12}(?![0-9A-Za-z.])")

START = {
    "email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.7, "iban": 0.8, "national_id": 0.45,
    "account": 0.2,
}
FOR = {
    "email": re.compile(r"(?ai:mail|contact|kontakt|correo|courriel)"),
    "ip": re.compile(r"(?ai:\bip\b|address|host|server|adresse|direcci)"),
    "card": re.compile(r"(?ai:card|visa|credit|karte|tarjeta|carte)"),
    "phone": re.compile(r"(?ai:phone|call|tel\b|tel\.|mobile|fax|anruf|llam|appel)"),
    "iban": re.compile(r"(?ai:iban|account|konto|cuenta|compte)"),
    "national_id": re.compile(r"(?ai:ssn|social|security|insurance|seguro)"),
    "account": re.compile(r"(?ai:account|iban|konto|cuenta|compte|customer\x20number)"),
}
AGAINST = re.compile(r"(?ai:\b(?:version|release|isbn|chapter|section|invoice|order|page|part\x20number)s?\b)")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def mod_97(code: str) -> bool:
    code = code.replace(" ", "")
    rest = 0
    for c in code[4:] + code[:4]:
        value = int(c, 36)
        rest = (rest * (10 if value < 10 else 100) + value) % 97
    return rest == 1


def small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def score(text: str, kind: str, start: int) -> float:
    """Of the words before a span, the nearest ``NEAR`` characters count."""
    before = text[max(0, start - NEAR) : start]
    worth = START[kind]
    if FOR[kind].search(before):
        worth += 0.35
    if AGAINST.search(before):
        worth -= 0.3
    return round(min(1.0, max(0.0, worth)), 4)


def emails(text: str):
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            last = domain.end()
            yield start, last
        at = text.find("@", max(at + 1, last))


def ibans(text: str):
    """Account numbers: as many characters as the country has, in groups or not, with a good checksum."""
    at = 0
    while m := IBAN.search(text, at):
        at = m.end()
        length = IBAN_LENGTHS.get(m[0][:2])
        end, left = m.end(), (length or 0) - 4
        while left > 0 and end < len(text):
            blank = text[end] == " "
            c = text[end + blank : end + blank + 1]
            if not (c.isascii() and (c.isdigit() or c.isupper())):
                break
            end, left = end + blank + 1, left - 1
        follows = text[end : end + 1]
        if length and not left and not (follows.isascii() and follows.isalnum()) and mod_97(text[m.start() : end]):
            yield m.start(), end
            at = end


def base_matches(text: str):
    """(kind, start, end) of the base kinds."""
    for start, end in emails(text):
        yield "email", start, end
    for m in IP.finditer(text):
        if all(small(p) for p in m[0].split(".")):
            yield "ip", m.start(), m.end()
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield "card", m.start(), m.end()
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                yield "phone", m.start(), m.end()


def max_end(reached: int, span: tuple[int, int]) -> int:
    return max(reached, span[1])


def find_pii(text: str) -> list[Span]:
    spans: list[Span] = [
        (kind, start, end, True, score(text, kind, start)) for kind, start, end in base_matches(text)
    ]
    starts = sorted(s[1] for s in spans)
    reached = list(accumulate(sorted((s[1], s[2]) for s in spans), max_end, initial=0))

    def add(kind: str, start: int, end: int) -> None:
        """A span of the method, unless a base span overlaps it."""
        worth = score(text, kind, start)
        if worth >= THRESHOLD and reached[bisect_left(starts, end)] <= start:
            spans.append((kind, start, end, False, worth))

    for start, end in ibans(text):
        add("iban", start, end)
    for m in NATIONAL.finditer(text):
        if m[0][:3] not in ("000", "666") and m[0][0] != "9" and m[0][4:6] != "00" and m[0][7:] != "0000":
            add("national_id", m.start(), m.end())
    for m in ACCOUNT.finditer(text):
        add("account", m.start(), m.end())
    return spans


def scan_pii(frame: DataFrame, text: str = "text") -> DataFrame:
    """``frame`` with ``spans`` of personal data in the whole of ``text``."""
    return add_spans(frame, text, find_pii, KINDS)
