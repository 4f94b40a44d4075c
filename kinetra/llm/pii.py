"""Personal data by anchor expansion.

An Aho-Corasick automaton finds at-signs, digits, plus signs, schemes and
identifier cues in one pass over a text; a deterministic parser of each kind
expands the anchor to the left and right and validates the boundary.  Offsets
are code points, ends are exclusive.

Kinds: ``email``, ``ip``, ``card`` and ``phone`` follow the fixed definitions
of the query's contract (leftmost, non-overlapping per kind); ``url`` and
``account`` are added by the method: an address after a scheme, and the value
after an identifier cue.  What a cue announces is validated by its kind: an IBAN
by length and remainder 97, a social security number by its parts, an account by 6
to 17 digits (grouped by single spaces or hyphens), a passport by letters and
digits; these need no sign between cue and value.  Other values need one (``:``,
``=``, ``#``, "no", "number") and a digit.

Defined cases: a null or empty text has no spans; texts of any length are read
whole; of overlapping candidates of a kind the leftmost counts; repeated rows are
scored each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("url", "account")
KINDS = BASE_KINDS + ADDED_KINDS

# Schemes and identifier cues.
SCHEMES = ("http://", "https://", "ftp://", "mailto:")
CUES = ("iban", "account", "acct", "passport", "ssn", "api_key", "token", "secret", "password")

SCHEMA = "spans array<struct<kind:string,start:int,end:int>>"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = frozenset("0123456789")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_QUAD = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_DIGIT_CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])*")
_PHONE_RUN = re.compile(r"[ ().0-9-]*")
_URL_REST = re.compile(r"[^\s<>\"']+")
_LEAD = r"(?:\s*(?:no\.?|nr\.?|number)(?![A-Za-z]))?\s*[:=#]?\s*[\"']?(?<!\w)"
_SIGNED = re.compile(r"\s*(?:(?:no\.?|nr\.?|number)\s*[:=#]?|[:=#])\s*[\"']?([A-Za-z0-9][A-Za-z0-9_-]{5,})")
_IBAN = re.compile(_LEAD + r"([A-Za-z]{2}[0-9]{2}(?: ?[A-Za-z0-9]){11,50})")
_SSN = re.compile(_LEAD + r"((?!000|666|9)[0-9]{3}([- ]?)(?!00)[0-9]{2}\2(?!0000)[0-9]{4})(?![\w-])")
_ACCOUNT = re.compile(_LEAD + r"([0-9](?:[ -]?[0-9]){5,16})(?![\w-])")
_PASSPORT = re.compile(_LEAD + r"([A-Za-z]{0,2}[0-9]{6,9})(?![\w-])")
_WORD = re.compile(r"\w")


@functools.cache
def _automaton():
    import ahocorasick
    found = ahocorasick.Automaton()
    for s in (*SCHEMES, *(s.upper() for s in SCHEMES)):
        found.add_word(s, ("url", len(s)))
    for c in CUES:
        for s in {c, c.upper(), c.capitalize()}:
            found.add_word(s, ("account", len(s)))
    for d in "0123456789":
        found.add_word(d, ("digit", 1))
    found.add_word("@", ("at", 1))
    found.add_word("+", ("plus", 1))
    found.make_automaton()
    return found


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d)
        if i % 2:
            n = n * 2 - 9 if n > 4 else n * 2
        total += n
    return total % 10 == 0


def _email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    left = at
    while left > floor and text[left - 1] in _LOCAL:
        left -= 1
    if left == at:
        return None
    domain = _DOMAIN.match(text, at + 1)
    return (left, domain.end()) if domain else None


def _phone(text: str, plus: int) -> int | None:
    """End of ``+`` digit, at least one more phone character, digit."""
    if text[plus + 1:plus + 2] not in _DIGITS:
        return None
    run = _PHONE_RUN.match(text, plus + 2).end()
    while run > plus + 3 and text[run - 1] not in _DIGITS:
        run -= 1
    return run if run > plus + 3 and text[run - 1] in _DIGITS else None


def _iban(text: str, at: int) -> tuple[int, int] | None:
    """The longest run of groups after ``at`` that is a valid IBAN."""
    chain = _IBAN.match(text, at)
    if not chain:
        return None
    start, end = chain.span(1)
    while end > start:
        value = text[start:end].replace(" ", "").upper()
        if len(value) < 15:
            return None
        if len(value) <= 34 and not _WORD.match(text[end:end + 1]):
            moved = value[4:] + value[:4]
            if int("".join(str(int(c, 36)) for c in moved)) % 97 == 1:
                return start, end
        end = max(text.rfind(" ", start, end), start)
    return None


def _announced(cue: str, text: str, at: int) -> tuple[int, int] | None:
    """The span of the value that ``cue``, which ends at ``at``, announces."""
    if cue == "iban":
        return _iban(text, at)
    if cue == "ssn":
        found = _SSN.match(text, at)
        return found.span(1) if found else None
    shape = {"account": _ACCOUNT, "acct": _ACCOUNT, "passport": _PASSPORT}.get(cue)
    found = shape and shape.match(text, at)
    if not found:
        found = _SIGNED.match(text, at)
        if not found or not any(c in _DIGITS for c in found.group(1)):
            return None
    return found.span(1)


def find_spans(text: str | None) -> list[tuple[str, int, int]]:
    """All spans of a text, by kind in the order of KINDS, then start."""
    if not text:
        return []
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    past = dict.fromkeys(KINDS, 0)  # where the search of a kind goes on
    for last, (anchor, size) in _automaton().iter(text):
        first = last - size + 1
        if anchor == "digit":
            if first >= past["ip"]:
                before = text[first - 1] if first > past["ip"] else ""
                if before not in _DIGITS:
                    quad = _QUAD.match(text, first)
                    if quad:
                        past["ip"] = quad.end()
                        if all(len(p.lstrip("0")) < 4 and int(p) < 256
                               for p in quad.group().split(".")):
                            out["ip"].append(quad.span())
            if first >= past["card"]:
                chain = _DIGIT_CHAIN.match(text, first)
                past["card"] = chain.end()
                digits = re.sub("[ -]", "", chain.group())
                if 16 <= len(digits) <= 19 and _luhn(digits):
                    out["card"].append(chain.span())
        elif anchor == "at":
            if first >= past["email"] and (span := _email(text, first, past["email"])):
                past["email"] = span[1]
                out["email"].append(span)
        elif anchor == "plus":
            if first >= past["phone"] and (end := _phone(text, first)):
                past["phone"] = end
                if 8 <= sum(c in _DIGITS for c in text[first:end]) <= 15:
                    out["phone"].append((first, end))
        elif anchor == "url":
            rest = _URL_REST.match(text, last + 1)
            if first >= past["url"] and rest:
                end = rest.end() - (len(rest.group()) - len(rest.group().rstrip(".,;:!?)]}")))
                if end > last + 1:
                    past["url"] = end
                    out["url"].append((first, end))
        elif first >= past["account"] and not (first and _WORD.match(text[first - 1])):
            if span := _announced(text[first:last + 1].lower(), text, last + 1):
                past["account"] = span[1]
                out["account"].append(span)
    return [(k, a, b) for k in KINDS for a, b in out[k]]


def find_pii(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, spans) per row; every row of ``docs`` gives one row."""
    kind = docs.schema[key].dataType

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()),
                                    ("end", pa.int32())]))
        for b in batches:
            found = [[{"kind": k, "start": s, "end": e} for k, s, e in find_spans(t.as_py())]
                     for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, spans)],
                                             names=["key", "spans"])

    out = docs.select(docs[key].alias("key"), docs[text].cast("string").alias("text"))
    return out.mapInArrow(scan, f"key {kind.simpleString()}, {SCHEMA}").withColumnRenamed("key", key)


def report(docs: DataFrame) -> DataFrame:
    """Counts and digests per document (the query's columns)."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for t in b.column(1):
                spans = find_spans(t.as_py())
                spelled = [f"{k}:{s}:{e}" for k, s, e in spans]
                counts = [sum(k == kind for k, _, _ in spans) for kind in BASE_KINDS]
                base = ",".join(spelled[:sum(counts)])
                rows.append((*counts, hashlib.sha256(base.encode()).hexdigest(),
                             ",".join(spelled)))
            cols = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, pa.int64()) for c in cols[:4]),
                 *(pa.array(c, pa.string()) for c in cols[4:])],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return docs.select("doc_id", "text").mapInArrow(
        scan, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
              "base_sha256 string, spans string")


def masked(text: str | None) -> str | None:
    """``text`` with every span replaced by its kind; overlapping spans merge
    and take the kind of the first."""
    spans = sorted(find_spans(text), key=lambda s: (s[1], -s[2]))
    if not spans:
        return text
    out, at, i = [], 0, 0
    while i < len(spans):
        kind, start, end = spans[i]
        i += 1
        while i < len(spans) and spans[i][1] < end:
            end = max(end, spans[i][2])
            i += 1
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with personal data masked in ``text``; other columns stay as
    they are, and rows without spans are unchanged."""
    names, schema = docs.columns, docs.schema
    at = names.index(text)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = pa.array([masked(t.as_py()) for t in b.column(at)], b.schema.field(at).type)
            yield b.set_column(at, b.schema.field(at), col)

    return docs.mapInArrow(scan, schema)
