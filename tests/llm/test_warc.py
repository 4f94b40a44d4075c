"""WARC archives: round trip against a plain computation."""

from __future__ import annotations

import base64
import hashlib

import pytest

from kinetra.llm import warc

HOSTILE = ["x" * 50 + warc.MAGIC + "WARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" + "y" * 30,
           warc.MAGIC, warc.MAGIC * 3 + "end", "\r\n\r\n" + warc.MAGIC + "\r\n\r\n", "", None,
           "café  <html>\n</html>", "z" * 20000]


def expected(rows, least=0):
    sha = {i: hashlib.sha1((h or "").encode()).digest() for i, _, h in rows}
    size = {i: len((h or "").encode()) for i, _, h in rows}
    first = {}
    for i, _, _ in rows:
        if size[i] >= least:
            first[sha[i]] = min(first.get(sha[i], i), i)
    out = []
    for i, _, _ in rows:
        f = first.get(sha[i], i)
        revisit = size[i] >= least and f != i
        out.append((i, size[i], base64.b32encode(sha[i]).decode(),
                    "revisit" if revisit else "response", f if revisit else None))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())


@pytest.mark.parametrize("split", ["128m", "300"])
def test_round_trip(spark, split):
    rows = [(7 * n + k, f"http://h/{n}\r\nX: y" if k else None, h)
            for n in range(6) for k, h in enumerate(HOSTILE[: 7 if n % 2 else 8])]
    rows = list({r[0]: r for r in rows}.values())
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    path = warc.scratch_path(spark, "warc-test")
    warc.write_archives(pages.withColumn("file", pages.page_id).withColumn("at", pages.page_id), path)
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        assert got(warc.read_archives(spark, path)) == expected(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_least_and_empty(spark):
    rows = [(1, "u", "aa"), (2, "u", "aa"), (3, None, "b" * 9), (4, None, "b" * 9), (5, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert got(warc.round_trip(pages, 5)) == expected(rows, 5)
    assert got(warc.round_trip(pages.limit(0))) == []


def test_repeated_rows_are_all_responses(spark):
    rows = [(1, "u", "same"), (1, "v", "same"), (2, "u", "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert [(r[0], r[3]) for r in got(warc.round_trip(pages))] == [
        (1, "response"), (1, "response"), (2, "revisit")]


def test_payloads_of_any_bytes(spark):
    raw = [(1, b"\xff\xfe<html>"), (2, b"ok"), (3, b"\xff\xfe<html>"), (4, b"\xc3" + warc.MAGIC.encode() + b"\x80\x00"),
           (5, b"\xed\xa0\x80"), (6, None)]
    pages = spark.createDataFrame([(i, "h\xe9" if i % 2 else None, h) for i, h in raw],
                                  "page_id long, url string, html binary")
    for rows in (pages, pages.withColumn("html", pages.html.cast("string")).withColumn(
            "url", warc.F.lit(b"http://\xff\n/x").cast("string"))):
        found = {r.page_id: r for r in warc.round_trip(rows).collect()}
        assert len(found) == len(raw)
        for i, h in raw:
            r = found[i]
            assert r.payload_bytes == len(h or b"") and r.payload_digest == warc.base32_sha1(h or b"")
            assert (r.record_type, r.refers_to) == (("revisit", 1) if i == 3 else ("response", None))
