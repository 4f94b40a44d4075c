"""WARC archives: written by Spark's text sink, read back by verified chains.

Writing: one record per page, closed by the blank lines that Spark's text sink
writes as its line separator.  Of records with equal payloads the one with the
smallest page_id is a ``response``, the others are ``revisit`` records that
name it and carry no payload.

Reading: Spark's text source, with the version line as separator, splits
archives of any size into segments, each preceded by the magic ``WARC/1.0``.
Every segment is a *candidate*: a task parses its header and emits its offset
and the offset of its successor.  A payload may hold the magic itself, so a
candidate counts only if the chain of successors from the file's start reaches
it.  Chains are followed inside each block by its task; across blocks pointer
jumping doubles the distance per round, so the rounds grow with the logarithm
of the blocks of a file.  Records cut by a magic inside their payload are put
together from their segments and digested then.

Defined cases: a null html is an empty payload; bytes that are not UTF-8 are
kept as they are; null urls have no target line;
line breaks in a url become spaces; rows with an equal payload that share the
smallest page_id are all responses; other columns are ignored; an empty table
gives no rows.  Where a chain breaks (a truncated file), the records before
the break are returned.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinetra.session import materialize, scratch_path

MAGIC = "WARC/1.0\r\n"
CLOSE = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(page_id, url: bytes | None, payload: bytes, refers_to) -> bytes:
    revisit = refers_to is not None
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}{CLOSE}"
            ).encode()
    lines = [f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
             "WARC-Date: 2024-01-01T00:00:00Z",
             f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}"]
    if revisit:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    size = len(http) + (0 if revisit else len(payload))
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {size}"]
    head = [line.encode() for line in lines]
    if url is not None:
        head.insert(4, b"WARC-Target-URI: " + b" ".join(url.splitlines()))
    return MAGIC.encode() + b"\r\n".join(head) + CLOSE.encode() + http + (b"" if revisit else payload)


def write_archives(pages: DataFrame, path: str, least: int = 0) -> None:
    """Write the pages as WARC files; payloads of fewer than ``least`` bytes
    are never revisits.  Only ids and digests are shuffled."""
    own = pages.select("page_id", F.col("url").cast("binary").alias("url"), F.coalesce(F.col("html").cast("binary"),
                                                    F.lit("").cast("binary")).alias("payload"))
    own = own.withColumn("sha", F.sha1("payload")).withColumn("bytes", F.length("payload"))
    ids = materialize(own.filter(F.col("bytes") >= least).select("page_id", "sha", "bytes"),
                      "payload-ids")
    first = ids.groupBy("sha", "bytes").agg(F.min("page_id").alias("refers_to"),
                                            F.count(F.lit(1)).alias("n")).filter("n > 1")
    # no row here for a first page; Spark sizes this table before it joins the payloads
    revisits = materialize(ids.join(first, ["sha", "bytes"])
                           .filter("page_id > refers_to OR page_id IS NULL")
                           .select("page_id", "sha", "refers_to").distinct(), "revisits")
    marked = own.join(revisits.withColumnRenamed("page_id", "id").withColumnRenamed("sha", "s"),
                      F.col("page_id").eqNullSafe(F.col("id")) & (F.col("sha") == F.col("s")),
                      "left").select("page_id", "url", "payload", "refers_to")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, urls, payloads, refers = (c for c in b.columns)
            yield pa.RecordBatch.from_arrays([pa.array(
                [_record(i.as_py(), u.as_py(), p.as_py(), r.as_py())
                 for i, u, p, r in zip(ids, urls, payloads, refers)], pa.binary())], ["value"])

    # the cast to text keeps the bytes, whatever they are
    marked.mapInArrow(build, "value binary").select(F.col("value").cast("string").alias("value")).write.option("lineSep", CLOSE).text(path)


SEGMENT = ("file string, block long, at long, size long, succ long, leaves long, page_id long, "
           "payload_bytes long, payload_digest string, record_type string, refers_to long, "
           "whole boolean")


def _page_of(value: bytes | None) -> int | None:
    inner = (value or b"").removeprefix(b"<urn:page:").removesuffix(b">")
    return int(inner) if inner else None


def _fields(head: bytes) -> dict[bytes, bytes]:
    pairs = (line.partition(b":") for line in head.split(b"\r\n"))
    return {k.strip().lower(): v.strip() for k, sep, v in pairs if sep}


def parse_segment(data: bytes) -> dict | None:
    """The record that begins with ``data`` (after the magic), as far as it
    can be told; None where there is no header."""
    end = data.find(b"\r\n\r\n")
    if end < 0:
        return None
    head = _fields(data[:end])
    length = head.get(b"content-length", b"")
    if not length.isdigit():
        return None
    try:
        found = {"succ": end + 4 + int(length) + 4, "page_id": _page_of(head.get(b"warc-record-id")),
                 "record_type": head.get(b"warc-type", b"").decode("ascii", "replace"),
                 "refers_to": _page_of(head.get(b"warc-refers-to")),
                 "whole": end + 8 + int(length) <= len(data), "payload_bytes": None,
                 "payload_digest": None}
    except ValueError:
        return None
    if found["whole"]:
        block = data[end + 4:end + 4 + int(length)]
        http, _, payload = block.partition(b"\r\n\r\n")
        if found["record_type"] == "revisit":
            size = _fields(http).get(b"content-length", b"")
            found["payload_bytes"] = int(size) if size.isdigit() else None
            found["payload_digest"] = head.get(b"warc-payload-digest", b"").decode(
                "ascii", "replace").removeprefix("sha1:")
        else:
            found["payload_bytes"], found["payload_digest"] = len(payload), base32_sha1(payload)
    return found


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("data"))


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """Candidates with offsets counted from the first segment of their block;
    ``leaves`` is where the chain from a candidate leaves the block."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in SEGMENT.split(", ")]
        kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
        types = [kinds[f.split()[1]] for f in SEGMENT.split(", ")]

        def done(rows):
            leaves = {}
            for r in reversed(rows):
                leaves[r["at"]] = leaves.get(r["succ"], r["succ"])
                r["leaves"] = leaves[r["at"]]
            return pa.RecordBatch.from_arrays(
                [pa.array([r[n] for r in rows], t) for n, t in zip(names, types)], names)

        here, at, rows = None, 0, []
        for b in batches:
            for file, block, data in zip(*(c for c in b.columns)):
                where, body = (file.as_py(), block.as_py()), data.as_py()
                if where != here:
                    if rows:
                        yield done(rows)
                    here, at, rows = where, 0, []
                found = parse_segment(body) or dict.fromkeys(
                    ("succ", "page_id", "record_type", "refers_to", "whole", "payload_bytes",
                     "payload_digest"))
                if found["succ"] is not None:
                    found["succ"] += at + len(MAGIC)
                rows.append(found | {"file": where[0], "block": where[1], "at": at,
                                     "size": len(body) + len(MAGIC)})
                at += len(body) + len(MAGIC)
        if rows:
            yield done(rows)

    return _lines(spark, path).mapInArrow(scan, SEGMENT)


def _walk(pdf: pd.DataFrame) -> pd.DataFrame:
    """The candidates of one block that the chain from its entry meets."""
    row = {at: i for i, at in enumerate(pdf["at"])}
    succ, at, keep = pdf["succ"].tolist(), pdf["entry"].iloc[0], []
    while at in row:
        keep.append(row[at])
        at = succ[row[at]]
    return pdf.iloc[keep].drop(columns=["entry"])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every
    record that the chains from the starts of the files reach."""
    found = materialize(_segments(spark, path), "segments")
    sizes = found.groupBy("file", "block").agg(F.sum("size").alias("bytes"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)
    bases = sizes.select("file", "block", F.coalesce(F.sum("bytes").over(earlier), F.lit(0))
                         .alias("base"))
    # positions are those after the magic; the first of a file is text before any magic
    placed = found.join(bases, ["file", "block"])
    for c in ("at", "succ", "leaves"):
        placed = placed.withColumn(c, F.col(c) + F.col("base"))
    placed = materialize(placed.filter(F.col("at") >= len(MAGIC)).drop("base"), "candidates")

    start = placed.select("file").distinct().withColumn("at", F.lit(len(MAGIC)).cast("long"))
    entries = placed.select("file", F.col("leaves").alias("at")).unionByName(start).distinct()
    jump = materialize(placed.join(entries, ["file", "at"], "left_semi")
                       .select("file", "at", "leaves"), "jumps")
    reached, n = start, -1
    while True:
        step = reached.join(jump, ["file", "at"]).select("file", F.col("leaves").alias("at"))
        reached = materialize(reached.unionByName(step).distinct(), "reached")
        before, n = n, reached.count()
        if n == before:
            break
        later = jump.select("file", F.col("at").alias("leaves"), F.col("leaves").alias("next"))
        jump = materialize(jump.join(later, ["file", "leaves"])
                           .select("file", "at", F.col("next").alias("leaves")), "jumps")
    # a chain enters a block once: at the least of the block's reached candidates
    entry = placed.join(reached, ["file", "at"], "left_semi").groupBy("file", "block").agg(
        F.min("at").alias("entry"))
    true = materialize(placed.join(entry, ["file", "block"]).groupBy("file", "block")
                       .applyInPandas(_walk, placed.schema), "records")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    cut = true.filter("NOT whole")
    if cut.isEmpty():
        return true.select(*columns)
    return true.filter("whole").select(*columns).unionByName(
        _joined(spark, path, placed, true, bases).select(*columns))


def _joined(spark: SparkSession, path: str, placed: DataFrame, true: DataFrame,
            bases: DataFrame) -> DataFrame:
    """Records whose payload holds the magic, put together from their segments."""
    marks = true.select("file", "at", "succ", F.col("whole").alias("own_whole"))
    so_far = Window.partitionBy("file").orderBy("at")
    owned = placed.select("file", "block", "at").join(marks, ["file", "at"], "left").select(
        "file", "block", "at",
        F.last(F.when(F.col("succ").isNotNull(), F.struct(
            F.col("at").alias("owner"), F.col("succ").alias("until"),
            F.col("own_whole").alias("own_whole"))), ignorenulls=True).over(so_far).alias("o"))
    parts = owned.filter("NOT o.own_whole AND at < o.until").select(
        "file", "block", "at", F.col("o.owner").alias("owner"))

    def bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, at = None, 0
        for b in batches:
            out = []
            for file, block, data in zip(*(c for c in b.columns)):
                where, body = (file.as_py(), block.as_py()), data.as_py()
                if where != here:
                    here, at = where, 0
                out.append(at)
                at += len(body) + len(MAGIC)
            yield b.append_column("local", pa.array(out, pa.int64()))

    schema = "file string, block long, data binary, local long"
    placed_bodies = _lines(spark, path).mapInArrow(bodies, schema).join(
        bases, ["file", "block"]).select("file", "block", (F.col("local") + F.col("base")).alias("at"),
                                         "data")

    def assemble(pdf: pd.DataFrame) -> pd.DataFrame:
        whole = MAGIC.encode().join(pdf.sort_values("at")["data"])
        return pd.DataFrame([parse_segment(whole)]).drop(columns=["succ", "whole"])

    return placed_bodies.join(parts, ["file", "block", "at"]).groupBy("file", "owner").applyInPandas(
        assemble, "page_id long, payload_bytes long, payload_digest string, record_type string, "
                  "refers_to long")


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write ``pages`` as archives on shared storage and read them back."""
    path = scratch_path(pages.sparkSession, "warc")
    write_archives(pages, path, least)
    return read_archives(pages.sparkSession, path)
