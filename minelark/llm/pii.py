"""Personal data: patterns propose spans, checksums confirm them, words nearby move the score."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from minelark.llm.texts import slices, whole, with_columns

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn", "local_phone")
NEARBY = 48
ACCEPT = 0.6

# The patterns take each run of digits or name characters as a whole, so that no text costs more than its length.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+)-])(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9-])")

# Score of a span by its form alone, and what a passed checksum adds.
FORM = {"email": 0.9, "ip": 0.6, "card": 0.4, "phone": 0.7, "iban": 0.4, "ssn": 0.3, "local_phone": 0.3}
CHECKED = {"card": 0.4, "iban": 0.5}
NEAR, AGAINST = 0.35, -0.25
# fixed values: words that speak for a kind, and words that speak against personal data
FOR = {
    "email": "mail email contact write",
    "ip": "ip address host server login client",
    "card": "card visa mastercard amex credit debit payment",
    "phone": "phone tel call mobile fax telefon teléfono téléphone",
    "iban": "iban bank account konto cuenta compte transfer",
    "ssn": "ssn social security taxpayer",
    "local_phone": "phone tel call mobile fax telefon teléfono téléphone",
}
ODD = "version example sample test dummy isbn order invoice page"
_WORD = re.compile(r"[^\W\d_]+")
_FOR = {kind: frozenset(listed.split()) for kind, listed in FOR.items()}
_ODD = frozenset(ODD.split())


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each @ and its domain, with all name characters before it that no earlier span took."""
    taken = 0
    for m in _DOMAIN.finditer(text):
        name = text[taken : m.start()]
        start = m.start() - (len(name) - len(name.rstrip(_LOCAL)))
        if start < m.start():
            taken = m.end()
            yield start, taken


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans by the base rules."""
    found = [("email", *span) for span in emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = digits_of(m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 10 <= len(digits_of(m[0])) <= 15:
            found.append(("phone", *m.span()))
    return found


def proposed(text: str) -> list[tuple[str, int, int]]:
    """Spans of further kinds; those with a checksum have passed it."""
    found = []
    for m in _IBAN.finditer(text):
        value = m[0]
        while len(value) >= 15 and not mod97(value.replace(" ", "")):
            value = value.rpartition(" ")[0]  # capitals behind the number
        if len(value) >= 15:
            found.append(("iban", m.start(), m.start() + len(value)))
    found += [("ssn", *m.span()) for m in _SSN.finditer(text) if m[0][:3] not in ("000", "666") and m[0] < "9"]
    return found + [("local_phone", *m.span()) for m in _LOCAL_PHONE.finditer(text)]


def score(text: str, kind: str, start: int, end: int) -> float:
    """By the form, the checksum and the words within ``NEARBY`` characters."""
    around = f"{text[max(0, start - NEARBY):start]} {text[end:end + NEARBY]}".lower()
    near = set(_WORD.findall(around))
    value = FORM[kind] + CHECKED.get(kind, 0) + NEAR * bool(near & _FOR[kind]) + AGAINST * bool(near & _ODD)
    return round(min(1.0, max(0.0, value)), 2)


def find(text: str | None) -> list[dict]:
    """All spans: those of the base rules, and proposed ones whose score reaches ``ACCEPT``."""
    text = text or ""
    spans = [(True, *span, score(text, *span)) for span in base_spans(text)]
    further = [(False, *span, score(text, *span)) for span in proposed(text)]
    spans += [span for span in further if span[4] >= ACCEPT]
    return [dict(zip(("base", "kind", "start", "end", "score"), span)) for span in spans]


FOUND = "array<struct<base:boolean,kind:string,start:int,end:int,score:double>>"
_FOUND = pa.list_(pa.struct([
    ("base", pa.bool_()), ("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()),
]))


def pii_spans(text: Column) -> Column:
    """The spans of a text, with their scores; bounded by the text itself."""

    @arrow_udf(FOUND)
    def scan(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array([find(text) for texts in slices(column) for text in texts], _FOUND)

    return scan(text)


def find_pii(docs: DataFrame) -> DataFrame:
    """Add ``pii``: the spans of personal data, in code points, end exclusive, each with a kind and a score.

    Base spans (email, IP address, card, international phone number) are always there; IBANs, social security
    numbers and local phone numbers only with a score of ``ACCEPT`` or more. The column replaces one of this name. Null
    text counts as empty: no spans. Repeated rows are each searched. Nothing is shuffled.
    """
    return with_columns(docs, {"pii": pii_spans(whole(F.col("text")))})
