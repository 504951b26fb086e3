"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust their scores."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidewatch.llm.text import slices

# The kinds in their order, and what the contract's patterns are.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits that fails from its first digit fails from its others too, so starts within a run are not tried.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=\x20?[A-Z0-9])")
_IBAN_BODY = re.compile(r"(?:\x20?[A-Z0-9]){11,30}")
_BORDER = re.compile(r"(?<=[A-Z0-9])(?![A-Za-z0-9])")
# Characters of a country's account numbers without blanks; of other countries 15 to 34 are tried.
IBAN_LENGTHS = {country: int(length) for length, countries in (line.split(":") for line in (
    "15:NO", "16:BE", "18:DK FI FO GL NL", "19:MK SI", "20:AT BA EE KZ LT LU XK", "21:CH HR LI LV", "22:BG BH DE GB GE IE ME RS VA",
    "23:AE GI IL IQ TL", "24:AD CZ ES MD PK RO SA SE SK TN VG", "25:PT", "26:IS TR", "27:FR GR IT MC MR SM",
    "28:AL AZ BY CY DO GT HU LB PL SV", "29:BR PS QA UA", "30:JO KW MU", "31:MT SC", "32:LC")) for country in countries.split()}
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_DIGIT = re.compile(r"[0-9]")
NEAR = 40  # characters before a span in which a word counts as nearby
THRESHOLD = 0.5  # of kinds beyond the base
# Plain score of a kind whose pattern and checksum hold, and words that raise it.
SCORES = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.7, "iban": 0.8, "ssn": 0.4}
CONTEXT = {
    "email": ("mail", "contact", "correo"), "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "credit", "karte", "carte", "tarjeta"), "phone": ("call", "phone", "tel", "mobile", "fax"),
    "iban": ("iban", "bank", "account", "konto", "compte", "cuenta"), "ssn": ("ssn", "social", "security"),
}
_CONTEXT = {kind: re.compile("|".join(words)) for kind, words in CONTEXT.items()}
AGAINST = re.compile("version|order|invoice|isbn|example|test")
RAISE, LOWER = 0.2, 0.2


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for place, c in enumerate(reversed(digits)):
        value = int(c) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def mod97(text: str) -> bool:
    """The check of account numbers: the first four characters moved to the end, letters as two digits."""
    plain = text.replace(" ", "")
    remainder = 0
    for c in plain[4:] + plain[:4]:
        value = int(c, 36)
        remainder = (remainder * (100 if value > 9 else 10) + value) % 97
    return remainder == 1


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches from left to right, found from their @ signs, so that long runs without one cost nothing."""
    done, sign = 0, text.find("@")
    while sign >= 0:
        start = sign
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _EMAIL.match(text, start) if start < sign else None
        if match:
            yield match.span()
            done = match.end()
        else:
            done = sign
        sign = text.find("@", max(done, sign + 1))


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """Account numbers from left to right, without the capitals and digits that may follow after a blank.

    Of a country's length if it is known, else up to the last border of a token that passes the check.
    """
    done = 0
    for match in _IBAN.finditer(text):
        start = match.start()
        body = _IBAN_BODY.match(text, match.end()) if start >= done else None
        if not body:
            continue
        length = IBAN_LENGTHS.get(text[start:start + 2])
        for border in reversed([m.start() for m in _BORDER.finditer(text, match.end() + 1, body.end() + 1)]):
            number = text[start:border]
            size = len(number) - number.count(" ")
            if border <= body.end() and (size == length if length else size >= 15) and mod97(number):
                yield start, border
                done = border
                break


def _found(pattern: re.Pattern, holds: Callable[[str], bool]) -> Callable[[str], Iterator[tuple[int, int]]]:
    return lambda text: (m.span() for m in pattern.finditer(text) if holds(m.group()))


FINDERS = {
    "email": emails,
    "ip": _found(_IP, lambda s: all(map(_small, s.split(".")))),
    "card": _found(_CARD, lambda s: 12 <= len(d := _digits(s)) <= 19 and luhn(d)),
    "phone": _found(_PHONE, lambda s: 9 <= len(_digits(s)) <= 15),
    "iban": ibans,
    "ssn": _found(_SSN, lambda s: s[:3] not in ("000", "666") and s[4:6] != "00" and s[7:] != "0000"),
}


def find_spans(text: str) -> list[tuple[str, int, int, float]]:
    """``(kind, start, end, score)`` by start, then by kind; places are code points.  Base kinds stay whatever their score."""
    found = []
    kinds = KINDS if _DIGIT.search(text) else ("email",)
    for order, kind in enumerate(kinds):
        for start, end in FINDERS[kind](text):
            before = text[max(0, start - NEAR):start].lower()
            score = SCORES[kind] + (RAISE if _CONTEXT[kind].search(before) else 0) - (LOWER if AGAINST.search(before) else 0)
            if kind in BASE or score >= THRESHOLD:
                found.append((start, order, kind, end, min(max(score, 0.0), 1.0)))
    return [(kind, start, end, score) for start, _, kind, end, score in sorted(found)]


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                     T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())])
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def _finder(position: int, redact: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(first, len(offsets) - 1) for whole in batches for first, _, offsets in slices(whole.column(position))):
            spans, texts = [], []
            for text in batch.column(position).to_pylist():
                found = find_spans(text) if text else []
                spans.append([dict(zip(SPAN.names, s)) for s in found])
                if redact:
                    texts.append(redacted(text, found))
            columns = batch.columns
            if redact:
                columns[position] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, _ARROW_SPANS)], [*batch.schema.names, "_tw_spans"])
    return run


def redacted(text: str | None, spans: list[tuple[str, int, int, float]]) -> str | None:
    """``text`` with a mark in place of each span; spans that overlap share the mark of the first."""
    if not spans:
        return text
    out, at = [], 0
    for kind, start, end, _ in spans:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def with_spans(documents: DataFrame, redact: bool = False) -> DataFrame:
    """``documents`` with ``_tw_spans``, found in the whole of ``text`` (null: none), and the text redacted if wanted."""
    schema = T.StructType([*documents.schema.fields, T.StructField("_tw_spans", T.ArrayType(SPAN))])
    return documents.mapInArrow(_finder(documents.columns.index("text"), redact), schema)


def _joined(spans: Column) -> Column:
    parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.concat_ws(",", parts)


def op4_pii(documents: DataFrame) -> DataFrame:
    """Counts and digests of each document's spans; a document without any has counts 0 and empty strings."""
    found = with_spans(documents.select("doc_id", "text"))
    base = F.filter("_tw_spans", lambda s: s["kind"].isin(*BASE))

    def count(kind: str) -> Column:
        return F.size(F.filter("_tw_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, BASE), F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
                        _joined(F.col("_tw_spans")).alias("spans"))
