"""Anchor expansion against the regular expressions of the contract."""

from __future__ import annotations

import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from kinetra.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    s = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        s += v - 9 if v > 9 else v
    return s % 10 == 0


def keep(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def plain(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "")
            if keep(k, m.group())]


def base(text):
    return [s for s in pii.find_spans(text) if s[0] in pii.BASE_KINDS]


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="a1+@.-() \n0259é_%", max_size=60))
def test_short_alphabet(text):
    assert base(text) == plain(text)


def test_many_random_texts():
    r = random.Random(7)
    parts = ["4111 1111 1111 1111", "4111-1111-1111-1112", "+49 (30) 1234-567", "+1", "a.b@c.de", "@", "x@y",
             "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "0001.2.3.004", "é", " ", "-", ".", "\n", "378282246310005",
             "6011000990139424", "a@b@c.dd", "++12345678", "+123456789012345678", "http://h.org/x?y=1.", "IBAN: DE44",
             "account no. 12345678", "token = \"1beb58b8\"", "https://", "٣٤٥", "１２３４"]
    for _ in range(3000):
        text = "".join(r.choices(parts, k=r.randint(1, 12)))
        assert base(text) == plain(text), text


def test_added_kinds_and_masking():
    text = "see https://ex.org/a?b=1, mail a.b@c.de; account no. 12345678 end"
    assert [(k, text[a:b]) for k, a, b in pii.find_spans(text)] == [
        ("email", "a.b@c.de"), ("url", "https://ex.org/a?b=1"), ("account", "12345678")]
    assert pii.masked(text) == "see [URL], mail [EMAIL]; account no. [ACCOUNT] end"
    assert pii.masked("mailto:a.b@c.de!") == "[URL]!"
    for clean in ("", None, "plain words only", "a @ b", "accounting 2024", "tokens and secrets"):
        assert pii.masked(clean) == clean


def test_announced_values():
    def accounts(text):
        return [text[a:b] for k, a, b in pii.find_spans(text) if k == "account"]

    for text, value in (
            ("IBAN DE89370400440532013000", "DE89370400440532013000"),
            ("IBAN: DE89 3704 0044 0532 0130 00 BIC COBADEFF", "DE89 3704 0044 0532 0130 00"),
            ("iban: gb82 west 1234 5698 7654 32.", "gb82 west 1234 5698 7654 32"),
            ("account number: 12345678", "12345678"), ("Account 1234 5678 90, paid", "1234 5678 90"),
            ("acct #AB-12345", "AB-12345"), ("ssn 123-45-6789", "123-45-6789"), ("SSN: 123456789", "123456789"),
            ("passport no. C01234567", "C01234567"), ('token = "1beb58b8"', "1beb58b8")):
        assert accounts(text) == [value], text
    for clean in ("IBAN DE88370400440532013000", "IBAN: DE89 3704", "ssn 000-12-3456", "ssn 123-45-67890",
                  "ssn 666-45-6789", "account 2024", "accounts 12345678", "account12345678", "passport of 2024",
                  "token 12345678", "iban " + "A" * 40, "IBAN: DE89370400440532013000X"):
        assert accounts(clean) == [], clean


def test_report_and_redact(spark):
    rows = [(1, "a.b@c.de and 10.0.0.1", "x", 3), (1, "a.b@c.de and 10.0.0.1", "x", 3), (2, None, None, None),
            (3, "", "y", 0), (None, "+49 30 1234567", "z", 1), (4, "x" * 200_000 + " a@b.cc", "w", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string, key long")
    got = {(r.doc_id, r.spans): r for r in pii.report(df).collect()}
    assert set(got) == {(1, "email:0:8,ip:13:21"), (2, ""), (3, ""), (None, "phone:0:14"), (4, "email:200001:200007")}
    r = got[1, "email:0:8,ip:13:21"]
    assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == (1, 1, 0, 0)
    assert r.base_sha256 == hashlib.sha256(b"email:0:8,ip:13:21").hexdigest()
    assert got[2, ""].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pii.report(df).count() == len(rows) and pii.report(df.limit(0)).count() == 0
    out = pii.redact(df)
    assert out.schema == df.schema
    assert {r.text for r in out.collect()} == {"[EMAIL] and [IP]", None, "", "[PHONE]", "x" * 200_000 + " [EMAIL]"}
    assert {len(r.spans) for r in pii.find_pii(df).collect()} == {0, 1, 2}
