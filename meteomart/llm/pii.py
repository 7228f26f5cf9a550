"""Personal data: proposed by patterns, confirmed by checksums, scored by context words.

Each kind has a pattern that proposes spans, a validator that confirms them
(octets at most 255, Luhn, ISO 13616 mod-97, digit counts) and a base score;
words of the kind within ``WINDOW`` characters before the span raise the score,
and words that speak of something else lower it.  The four base kinds (email,
ip, card, phone) always stay, whatever their score; spans of the added kinds
(iban, key, ssn, secret) stay when their score reaches ``THRESHOLD``.

The proposals are found in time linear in the text, also in a run of millions
of digits: the address is anchored at each ``@`` and the dotted numbers are cut
into fours, which gives the leftmost non-overlapping matches of the patterns.

Defined results.  Null or empty text: no span, all counts 0.  Null id: kept,
with the counts of its text.  Repeated rows: one result each.  Empty table: no
rows.  Other columns are ignored by ``find`` and kept by ``redact``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + ("iban", "key", "ssn", "secret")
WINDOW = 40
THRESHOLD = 0.6

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHAR = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_NUMBER = re.compile(r"[0-9]")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}\b")
_KEY = re.compile(r"\bAKIA[A-Z0-9]{16}\b")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
# A value of 12 characters or more, with a digit, given to a name that speaks of a secret.
_SECRET = re.compile(r"\b(?:password|passwd|secret|token|api_?key) ?= ?[\"']?((?=[A-Za-z_/+-]*[0-9])[A-Za-z0-9_/+-]{12,})", re.I)

# Context words by kind: they raise or lower the score of a nearby span.
RAISE = {
    "email": ("mail", "contact", "write"), "ip": ("host", "server", "address", "ip"),
    "card": ("card", "visa", "payment", "credit"), "phone": ("phone", "call", "tel", "fax"),
    "iban": ("iban", "account", "bank", "konto", "cuenta", "compte"),
    "key": ("key", "access", "secret", "token"), "ssn": ("ssn", "social", "security"),
    "secret": ("password", "login", "credentials"),
}
LOWER = {
    "email": ("example",), "ip": ("version", "release"), "card": ("isbn", "order", "serial"),
    "phone": ("fig", "eq"), "iban": ("part",), "key": (), "ssn": ("part", "model", "serial"),
    "secret": ("example",),
}
# A confirmed checksum speaks for itself; nine digits without one need context.
PRIOR = {"email": 0.9, "ip": 0.7, "card": 0.9, "phone": 0.7, "iban": 0.9, "key": 0.8, "ssn": 0.4, "secret": 0.8}
_WORD = re.compile(r"[a-z]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL_CHAR:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            last = m.end()
        at = text.find("@", max(at + 1, last))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _DOTTED.finditer(text):
        start, parts = m.start(), m.group().split(".")
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield start, end
            start = end + 1


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 8 <= sum(map(m.group().count, "0123456789")) <= 15:
            yield m.span()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    for m in _IBAN.finditer(text):
        if mod97(m.group().replace(" ", "")):
            yield m.span()


def score(kind: str, text: str, start: int) -> float:
    """The kind's prior, moved by the context words before the span."""
    near = set(_WORD.findall(text[max(0, start - WINDOW):start].lower()))
    raised, lowered = any(w in near for w in RAISE[kind]), any(w in near for w in LOWER[kind])
    return min(1.0, max(0.0, PRIOR[kind] + 0.3 * raised - 0.3 * lowered))


def spans(text: str) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) in code points, by kind as in KINDS, then start."""
    found: list[tuple[str, int, int, float]] = []
    digit = _NUMBER.search(text) is not None
    if "@" in text:
        found += [("email", a, b, score("email", text, a)) for a, b in _emails(text)]
    if digit:
        for kind, propose in (("ip", _ips), ("card", _cards)):
            found += [(kind, a, b, score(kind, text, a)) for a, b in propose(text)]
        if "+" in text:
            found += [("phone", a, b, score("phone", text, a)) for a, b in _phones(text)]
        added = [("iban", a, b) for a, b in _ibans(text)]
        if "AKIA" in text:
            added += [("key", *m.span()) for m in _KEY.finditer(text)]
        added += [("ssn", *m.span()) for m in _SSN.finditer(text)]
        if "=" in text:
            added += [("secret", *m.span(1)) for m in _SECRET.finditer(text)]
        scored = ((k, a, b, score(k, text, a)) for k, a, b in added)
        found += [s for s in scored if s[3] >= THRESHOLD]
    return found


def joined(found: list[tuple[str, int, int, float]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b, _ in found)


def find(docs: DataFrame) -> DataFrame:
    """Counts, digest and spans of every row of ``docs`` (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: dict[str, list] = {c: [] for c in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "scores")}
            for value in b.column(1):
                found = spans(value.as_py() or "")
                base = [s for s in found if s[0] in BASE_KINDS]
                for k in BASE_KINDS:
                    out[f"n_{k}"].append(sum(s[0] == k for s in base))
                out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
                out["spans"].append(joined(found))
                out["scores"].append([s[3] for s in found])
            yield pa.RecordBatch.from_arrays([b.column(0)] + [
                pa.array(v, pa.int64() if c.startswith("n_") else pa.list_(pa.float64()) if c == "scores" else pa.string())
                for c, v in out.items()], ["doc_id", *out])
    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
             "spans string, scores array<double>")


def masked(text: str) -> str:
    """The text with every span replaced by its kind in brackets."""
    found = sorted(spans(text), key=lambda s: (s[1], -s[2]))
    parts, last = [], 0
    for kind, start, end, _ in found:
        if start >= last:
            parts += [text[last:start], f"[{kind.upper()}]"]
        last = max(last, end)
    return "".join([*parts, text[last:]]) if found else text


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with the spans masked in ``text`` and ``n_chars`` (if any) brought up to date."""
    names = docs.columns
    at, count = names.index("text"), names.index("n_chars") if "n_chars" in names else -1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            old = b.column(at)
            new = pa.array([None if (t := v.as_py()) is None else masked(t) for v in old], old.type)
            columns = list(b.columns)
            columns[at] = new
            if count >= 0:
                kind = columns[count].type
                size = pc.utf8_length(new.fill_null("")).cast(kind)
                columns[count] = pc.if_else(pc.fill_null(pc.equal(old, new), True), columns[count], size)
            yield pa.RecordBatch.from_arrays(columns, schema=b.schema)
    return docs.mapInArrow(run, docs.schema)
