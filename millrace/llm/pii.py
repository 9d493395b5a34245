"""Personal data: patterns propose spans, checksums confirm them, context words move their score.

Kinds with a fixed meaning (``BASE``): ``email``, ``ip`` (each part at most 255), ``card`` (13 to 19 digits passing
Luhn) and ``phone`` (``+`` and 9 to 15 digits). Their confirmed spans always stay. The further kinds ``iban`` (length
of its country, mod-97) and ``ssn`` (three groups of digits) stay if their score reaches the threshold and no base span overlaps them.

Every proposal is made in time linear in the text, also on very long runs of digits or letters. Null and empty texts
have no spans; repeated rows are judged one by one; an empty table gives an empty result. Offsets are code points, end
exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import partial

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn")
#: Score of a confirmed span without context, and what a context word before or after it adds.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "ssn": 0.3}
BOOST = 0.3
THRESHOLD = 0.5
#: Code points looked at on either side of a span.
REACH = 40
#: Words that speak for a kind, and words that speak against any (examples, software versions).
CONTEXT = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "address", "host", "server"),
    "card": ("card", "credit", "visa", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "bank", "account", "konto"),
    "ssn": ("ssn", "social", "security"),
}
AGAINST = frozenset(("version", "example", "isbn", "release"))
_FOR = {kind: frozenset(words) for kind, words in CONTEXT.items()}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
#: Characters of an IBAN by country (ISO 13616).
_IBAN_SIZE = {code[:2]: int(code[2:]) for code in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 "
    "FI18 FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 "
    "LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 "
    "RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30").split()}
_IBAN_HEAD = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?= ?[A-Z0-9])")
_IBAN_REST = {n: re.compile(f"(?: ?[A-Z0-9]){{{n - 4}}}(?![A-Za-z0-9])") for n in set(_IBAN_SIZE.values())}
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_WORD = re.compile(r"[a-z]+")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def mod97(code: str) -> bool:
    code = code.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def emails(text: str) -> Iterator[Span]:
    """Each ``@`` with the longest local part before it and a dotted domain behind it."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield "email", start, found.end()
            free = found.end()
        at = text.find("@", max(at + 1, free))
        # The characters before the last "@" cannot be part of a later local part.
        free = max(free, text.rfind("@", free, at) + 1) if at >= 0 else free


def addresses(text: str) -> Iterator[Span]:
    """Groups of four parts from the left of each dotted run of numbers."""
    for run in _DOTTED.finditer(text):
        parts, at = run.group().split("."), run.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k: k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield "ip", at, end
            at = end + 1


def cards(text: str) -> Iterator[Span]:
    for run in _DIGITS.finditer(text):
        if run.end() - run.start() >= 13:
            digits = run.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield "card", run.start(), run.end()


def phones(text: str) -> Iterator[Span]:
    if "+" in text:
        for run in _PHONE.finditer(text):
            if 9 <= sum(map(run.group().count, "0123456789")) <= 15:
                yield "phone", run.start(), run.end()


def ibans(text: str) -> Iterator[Span]:
    """Codes of their country's length, whatever follows them, then other whole runs of groups that pass mod-97."""
    heads, found = [*_IBAN_HEAD.finditer(text)], [(0, 0)]
    for head in heads:
        size = _IBAN_SIZE.get(head.group()[:2])
        run = _IBAN_REST[size].match(text, head.end()) if size and head.start() >= found[-1][1] else None
        if run and mod97(text[head.start(): run.end()]):
            found.append((head.start(), run.end()))
    others = [run.span() for (_, a), (b, _) in zip(found, [*found[1:], (len(text), 0)], strict=True) if heads
              for run in _IBAN.finditer(text, a, b) if mod97(run.group())]
    for span in sorted(found[1:] + others):
        yield "iban", *span


def numbers(text: str) -> Iterator[Span]:
    for run in _SSN.finditer(text):
        area, group, serial = run.group().split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield "ssn", run.start(), run.end()


def score(text: str, span: Span) -> float:
    """Base score of the kind, moved by the words near the span."""
    kind, start, end = span
    near = set(_WORD.findall(text[max(0, start - REACH): start].lower()))
    near.update(_WORD.findall(text[end: end + REACH].lower()))
    return SCORES[kind] + BOOST * (bool(near & _FOR[kind]) - bool(near & AGAINST))


def spans(text: str | None, threshold: float = THRESHOLD) -> list[tuple[str, int, int, float]]:
    """All spans (kind, start, end, score) by kind, then start."""
    if not text:
        return []
    base = [s for find in (emails, addresses, cards, phones) for s in find(text)]
    out = [(*s, score(text, s)) for s in base]
    for find in (ibans, numbers):
        for s in find(text):
            if all(s[2] <= b[1] or b[2] <= s[1] for b in base) and (worth := score(text, s)) >= threshold:
                out.append((*s, worth))
    return out


def redacted(text: str | None, threshold: float = THRESHOLD) -> str | None:
    """The text with each span, or run of overlapping spans, replaced by its first kind in brackets."""
    found = sorted((s, e, k) for k, s, e, _ in spans(text, threshold))
    if not found:
        return text
    out, at = [], 0
    for start, end, kind in found:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _listed(found: list) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e, *_ in found)


def _batches(batches: Iterator[pa.RecordBatch], row: Callable, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [row(t) for t in batch.column(1).to_pylist()]
        columns = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(list(schema)[1:])]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema=pa.schema(
            [schema.field(0).with_type(batch.schema.field(0).type), *list(schema)[1:]]))


def find_pii(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """key, spans array<struct<kind, start, end, score>>."""
    kind = docs.schema[key].dataType.simpleString()
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
    schema = pa.schema([(key, pa.null()), ("spans", pa.list_(item))])

    def row(t: str | None) -> tuple:
        return ([dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in spans(t, threshold)],)

    return docs.select(key, text).mapInArrow(
        partial(_batches, row=row, schema=schema),
        f"`{key}` {kind}, spans array<struct<kind:string,start:bigint,end:bigint,score:double>>")


def redact(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The same rows and columns with personal data in ``text`` replaced."""

    @F.pandas_udf("string")
    def clean(column: pd.Series) -> pd.Series:
        return column.map(lambda t: redacted(t, threshold), na_action="ignore")

    return docs.withColumn(text, clean(F.col(text)))


def digest(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, a hash of their spans, and all spans as text, per document."""
    counts = [(f"n_{k}", pa.int64()) for k in BASE]
    schema = pa.schema([("doc_id", pa.int64()), *counts, ("base_sha256", pa.string()), ("spans", pa.string())])

    def row(t: str | None) -> tuple:
        found = spans(t)
        base = [s for s in found if s[0] in BASE]
        kinds = [s[0] for s in base]
        return (*map(kinds.count, BASE), hashlib.sha256(_listed(base).encode()).hexdigest(), _listed(found))

    return docs.select("doc_id", "text").mapInArrow(
        partial(_batches, row=row, schema=schema),
        "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string")
