"""Personal data in whole texts: expressions propose spans, checksums confirm them, words nearby move their score.

Base kinds (``email``, ``ip``, ``card``, ``phone``) are found leftmost and without overlaps, each kind by
itself; a match that fails its check (parts up to 255, Luhn, number of digits) is dropped. They stay in the
result whatever their score. Kinds of the method's own are kept when their score reaches ``KEEP`` and they
overlap no base span:

    iban         two letters, check digits, up to 30 letters or digits in blocks; mod 97 must be 1
    card_short   13 to 15 digits that pass Luhn
    ssn          three, two and four digits with dashes, of a range that is given out
    phone_local  (ddd) ddd-dddd, or ddd-ddd-dddd

A score starts from how telling the shape is, rises where the checksum holds and where a word of the kind
stands within ``NEAR`` characters, and falls where a word tells of something else (orders, versions, parts).

The expressions are written so that a text of any length takes time in proportion: an address is grown to
the left of its ``@``, dotted numbers are split at their dots, digits are taken in whole runs.

Null texts count as empty: no spans, the digest of nothing. Rows stay one to one, repeated and null ids too.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, steps

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "card_short", "ssn", "phone_local")
FOUND = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, scores string"
)
KEEP = 0.5
NEAR = 48
SHIFT = 0.25
#: How telling a shape is by itself, and with its check passed.
SHAPE = {
    "email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.7, "iban": 0.7, "card_short": 0.3, "ssn": 0.3, "phone_local": 0.5,
}
DASHED_LOCAL = 0.3
#: Words that speak for a kind, and words that speak against any number.
FOR = {
    "email": {"email", "mail", "contact", "write"},
    "ip": {"ip", "address", "host", "server", "login"},
    "card": {"card", "visa", "mastercard", "credit", "debit", "pay", "payment"},
    "phone": {"phone", "tel", "telephone", "call", "mobile", "fax", "contact"},
    "iban": {"iban", "account", "bank", "transfer", "konto", "cuenta", "compte"},
    "card_short": {"card", "amex", "american", "express", "diners", "credit", "debit", "pay", "payment"},
    "ssn": {"ssn", "social", "security"},
    "phone_local": {"phone", "tel", "telephone", "call", "mobile", "fax", "contact", "telefon", "teléfono"},
}
AGAINST = {"order", "invoice", "version", "isbn", "part", "serial", "tracking", "model", "sku"}

LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9][0-9.]*")
DIGITS = re.compile(r"[0-9]+(?:[ -][0-9]+)*")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?")
SSN = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}")
AREA = re.compile(r"\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}")
DASHED = re.compile(r"[0-9]{3}-[0-9]{3}-[0-9]{4}")
WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    end: int
    score: float

    def text(self) -> str:
        return f"{self.kind}:{self.start}:{self.end}"


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def mod_97(account: str) -> bool:
    """Whether the check digits of an account number hold: letters count as 10 to 35, the first four go last."""
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The leftmost start of a match at an ``@`` is that of the run before it, cut by the match before."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and LOCAL.match(text, start - 1):
            start -= 1
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            done = found.end()
            yield start, done
        else:
            done = max(done, at)  # nothing before this sign can belong to a later match
        at = text.find("@", max(done, at + 1))


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Four numbers joined by dots; of more in a row each four from the left are one match."""
    for run in DOTTED.finditer(text):
        if run.end() - run.start() < 7:
            continue
        start, parts = run.start(), []
        for part in run.group().split("."):
            parts = [*parts, part] if part else []
            end = start + len(part)
            if len(parts) == 4:
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in parts):
                    yield end - sum(map(len, parts)) - 3, end
                parts = []
            start = end + 1


def numbers(text: str) -> list[tuple[int, int, str]]:
    """Runs of digits with single spaces or dashes between, of 13 to 19 digits."""
    out = []
    for m in DIGITS.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(digits := _digits(m.group())) <= 19:
            out.append((m.start(), m.end(), digits))
    return out


def phones(text: str) -> Iterator[tuple[int, int]]:
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(_digits(m.group())) <= 15:
                yield m.span()


def accounts(text: str) -> Iterator[tuple[int, int]]:
    """Account numbers whose check holds; a block too many at the end (a word behind the number) is given back."""
    for m in IBAN.finditer(text):
        start, end = m.span()
        if start and text[start - 1].isalnum():
            continue
        while end - start >= 15:
            number = text[start:end].replace(" ", "")
            if len(number) <= 34 and not text[end : end + 1].isalnum() and len(number) >= 15 and mod_97(number):
                yield start, end
                break
            end = text.rfind(" ", start, end)


def _bounded(text: str, start: int, end: int) -> bool:
    """Whether no digit or dash touches the span."""
    before, after = text[start - 1] if start else " ", text[end] if end < len(text) else " "
    return before not in "0123456789-+" and after not in "0123456789-"


def proposals(text: str, runs: list[tuple[int, int, str]]) -> Iterator[tuple[str, int, int, float]]:
    """Spans of the method's own kinds that pass their checks, with the score of their shape."""
    for start, end in accounts(text):
        yield "iban", start, end, SHAPE["iban"]
    for start, end, digits in runs:
        if len(digits) < 16 and luhn(digits):
            yield "card_short", start, end, SHAPE["card_short"]
    for m in SSN.finditer(text):
        area, group, serial = m.group().split("-")
        given_out = area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"
        if given_out and _bounded(text, *m.span()):
            yield "ssn", *m.span(), SHAPE["ssn"]
    for m in AREA.finditer(text):
        if _bounded(text, *m.span()):
            yield "phone_local", *m.span(), SHAPE["phone_local"]
    for m in DASHED.finditer(text):
        if _bounded(text, *m.span()):
            yield "phone_local", *m.span(), DASHED_LOCAL


def score(text: str, kind: str, start: int, end: int, shape: float) -> float:
    """The shape's score, moved by the words around the span."""
    around = text[max(0, start - NEAR) : start] + " " + text[end : end + NEAR]
    words = set(WORD.findall(around.lower()))
    moved = shape + SHIFT * bool(words & FOR[kind]) - SHIFT * bool(words & AGAINST)
    return round(min(1.0, max(0.0, moved)), 2)


def scan(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans by kind and start, and those that the method adds."""
    runs = numbers(text)
    found = {
        "email": list(emails(text)), "ip": list(addresses(text)),
        "card": [(s, e) for s, e, d in runs if len(d) >= 16 and luhn(d)], "phone": list(phones(text)),
    }
    base = [Span(k, s, e, score(text, k, s, e, SHAPE[k])) for k in BASE for s, e in found[k]]
    added: list[Span] = []
    own_places: list[tuple[int, int]] = []
    taken = [*found.values(), own_places]
    for kind, start, end, shape in sorted(proposals(text, runs), key=lambda p: (ADDED.index(p[0]), p[1], -p[2])):
        own = score(text, kind, start, end, shape)
        if own >= KEEP and not any(_overlaps(places, start, end) for places in taken):
            added.append(Span(kind, start, end, own))
            bisect.insort(own_places, (start, end))
    return base, added


def _overlaps(spans: list[tuple[int, int]], start: int, end: int) -> bool:
    """Whether a span meets one of a sorted list whose spans do not overlap each other."""
    at = bisect.bisect_left(spans, (end, end))
    return at > 0 and spans[at - 1][1] > start


def find(docs: DataFrame) -> DataFrame:
    """``FOUND``: counts and digest of the base spans, all spans (kind:start:end) and their scores, by row."""
    ship(docs.sparkSession)
    names = [c.split()[0] for c in FOUND.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, "text"):
                rows = []
                for text in part.column("text").to_pylist():
                    base, added = scan(text or "")
                    spans = ",".join(s.text() for s in base)
                    rows.append((
                        *(sum(s.kind == k for s in base) for k in BASE), hashlib.sha256(spans.encode()).hexdigest(),
                        ",".join(s.text() for s in (*base, *added)), ",".join(f"{s.score:.2f}" for s in (*base, *added)),
                    ))
                columns = [list(c) for c in zip(*rows, strict=True)]
                types = [pa.int64()] * 4 + [pa.string()] * 3
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=names
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, FOUND)
