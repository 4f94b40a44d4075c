"""Sequence packing by non-negative least squares.

Documents are tokenised and cut at multiples of the window; what is left of
each (1 .. window-1 ids) is packed by patterns.  A pattern is a shallow
combination of lengths that fills the window exactly (one, two or three
pieces).  Repeat counts solve ``min |A x - h|, x >= 0`` against the histogram
``h`` of lengths; they are rounded down and made feasible; the rest takes
combinations that it still holds, and what no combination fills is packed
greedily (longest first, then the longest that fits).

Only the histogram (at most ``window`` counts) and the plan (patterns and
their repeat counts) are on the driver; both are bounded by the window, not by
the data.  Pieces find their place by (length, rank within the length): ranks
are a running number inside the task that made the piece plus the count of
equal lengths in earlier tasks, so no length is ever sorted in one task.

Ids are those of the ``tokenizers`` library.  For speed, a text is split at
isolated spaces, where this vocabulary's pre-tokeniser always cuts, and the
ids of each part are kept in a bounded table; texts with other white space
beside a space, characters beyond the Latin blocks or special strings take the
library itself.

Defined cases: a null or empty text is one piece holding id 0; repeated rows
(also of one doc_id) are packed each; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import functools
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinetra.session import materialize

WINDOW = 1024
#: Parts whose ids a task keeps; a part is some 10 characters.
KEPT_PARTS = 400_000
END_ID = b"\0\0\0\0"

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "part int, rank_in_part long")


def vocabulary(name: str = "byte_bpe_50k") -> tuple[str, str]:
    """Paths of the public vocabulary for tokenizers and for tiktoken."""
    import public_tokenizers
    return public_tokenizers.path(f"{name}.json"), public_tokenizers.path(f"{name}.tiktoken")


@functools.cache
def library(json_path: str):
    """The tokenizer itself; a task loads it when a text asks for it."""
    from tokenizers import Tokenizer
    return Tokenizer.from_file(json_path)


def special_strings(json_path: str) -> tuple[str, ...]:
    return tuple(t.content for t in library(json_path).get_added_tokens_decoder().values())


@functools.cache
def encoder(json_path: str, ranks_path: str, special: tuple[str, ...] | None = None):
    """A function text -> ids as little-endian unsigned 32-bit bytes."""
    import base64
    import re

    import public_tokenizers
    import tiktoken

    special = special_strings(json_path) if special is None else special
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    parts = tiktoken.Encoding("parts", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                              special_tokens={})
    beyond_latin = re.compile("[^\0-ɏ‐-‧]").search
    known: dict[str, bytes] = {}

    def by_library(text: str) -> bytes:
        return np.array(library(json_path).encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def part_ids(part: str, lead: str) -> bytes | None:
        if not part or part[0].isspace() or part[-1].isspace() or beyond_latin(part):
            return None
        return array("I", parts.encode_ordinary(lead + part)).tobytes()

    def encode(text: str) -> bytes:
        if not text:
            return b""
        if any(s in text for s in special):
            return by_library(text)
        first, *rest = text.split(" ")
        head = part_ids(first, "")
        if head is None:
            return by_library(text)
        out = list(map(known.get, rest))
        if None in out:
            if len(known) > KEPT_PARTS:
                known.clear()
            for part in dict.fromkeys(rest):
                if part not in known:
                    ids = part_ids(part, " ")
                    if ids is None:
                        return by_library(text)
                    known[part] = ids
            out = list(map(known.get, rest))
        return head + b"".join(out)

    return encode


def cut(docs: DataFrame, window: int = WINDOW, vocab: tuple[str, str] | None = None) -> DataFrame:
    """Pieces of every document, with the number of equal lengths before each
    within its task."""
    json_path, ranks_path = vocab or vocabulary()
    special = special_strings(json_path)

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(json_path, ranks_path, special)
        part = TaskContext.get().partitionId()
        seen = [0] * (window + 1)
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = encode(text.as_py() or "") + END_ID
                total = len(ids) // 4
                for start in range(0, total, window):
                    size = min(window, total - start)
                    rows.append((doc_id, start, size, zlib.crc32(ids[4 * start:4 * (start + size)]),
                                 total, part, seen[size]))
                    seen[size] += 1
            cols = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32() if i == 5 else pa.int64()) for i, c in enumerate(cols)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part",
                       "rank_in_part"])

    return docs.select("doc_id", "text").mapInArrow(tokenise, PIECES)


def nnls(rows: np.ndarray, target: np.ndarray, steps: int = 300) -> np.ndarray:
    """``argmin |A x - target|, x >= 0`` where column j of A counts the lengths
    in ``rows[j]`` (0: none): accelerated projected gradient on the sparse A,
    columns scaled to unit length."""
    n = len(target)
    scale = np.sqrt([(np.bincount(r[r > 0]) ** 2).sum() for r in rows])

    def times(x):  # A x
        out = np.zeros(n)
        for k in range(rows.shape[1]):
            out += np.bincount(rows[:, k], x / scale, n)
        out[0] = 0
        return out

    def back(y):  # A' y
        y = y.copy()
        y[0] = 0
        return y[rows].sum(1) / scale

    v = np.ones(len(rows))
    for _ in range(12):  # largest eigenvalue of A'A
        v = back(times(v))
        size = np.linalg.norm(v)
        v /= size
    x = z = np.zeros(len(rows))
    t = 1.0
    for _ in range(steps):
        new = np.maximum(0.0, z - back(times(z) - target) / (1.05 * size))
        nt = (1 + (1 + 4 * t * t) ** 0.5) / 2
        z = new + (t - 1) / nt * (new - x)
        x, t = new, nt
    return x / scale


def shallow_combinations(hist: np.ndarray, window: int) -> np.ndarray:
    """Pairs and triples of present lengths that fill the window, as rows of
    three lengths (0: none)."""
    have = np.flatnonzero(hist[:window])
    a, b = np.meshgrid(have, have, indexing="ij")
    a, b = a[a <= b], b[a <= b]
    c = window - a - b
    fits = (c == 0) | ((c >= b) & (hist[np.clip(c, 0, window)] > 0))
    return np.stack([a, b, c], 1)[fits]


def plan(hist: np.ndarray, window: int = WINDOW) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, repeats) that use every length of the histogram
    exactly as often as it occurs."""
    left = hist.astype(np.int64).copy()
    out: list[tuple[tuple[int, ...], int]] = []

    def take(lengths: tuple[int, ...], repeats: int) -> None:
        for k in lengths:
            left[k] -= repeats
        out.append((lengths, repeats))

    if left[window]:
        take((window,), int(left[window]))
    rows = shallow_combinations(left, window)
    if len(rows):
        x = nnls(rows, left.astype(float))
        order = np.argsort(-x, kind="stable")
        # rounded down first; what is then left takes the combinations that it
        # still holds, the most wanted first
        for least in (1, 0):
            have = left.tolist()
            for j in order.tolist():
                wanted = int(x[j] + 1e-6) if least else 1
                if not wanted:
                    break
                lengths = [k for k in rows[j].tolist() if k]
                if not all(map(have.__getitem__, lengths)):
                    continue
                repeats = min(have[k] // lengths.count(k) for k in lengths)
                repeats = min(wanted, repeats) if least else repeats
                if repeats:
                    take(tuple(lengths), repeats)
                    for k in lengths:
                        have[k] -= repeats
    # residuals: longest first, then the longest that still fits
    while left.any():
        room, lengths = window, []
        counts = left.copy()
        while True:
            have = np.flatnonzero(counts[:room + 1])
            if not len(have):
                break
            lengths.append(int(have[-1]))
            counts[have[-1]] -= 1
            room -= int(have[-1])
            if not room:
                break
        need = np.bincount(lengths, minlength=window + 1)
        take(tuple(lengths), int((left[need > 0] // need[need > 0]).min()))
    return out


@dataclass
class Places:
    """For each length, the ranks at which another pattern slot begins."""

    first_rank: list[np.ndarray]
    sequence: list[np.ndarray]
    offset: list[np.ndarray]
    sequences: int


def places(patterns: list[tuple[tuple[int, ...], int]], window: int = WINDOW) -> Places:
    slots: list[list[tuple[int, int, int]]] = [[] for _ in range(window + 1)]
    used, base = [0] * (window + 1), 0
    for lengths, repeats in patterns:
        at = 0
        for k in lengths:
            slots[k].append((used[k], base, at))
            used[k] += repeats
            at += k
        base += repeats
    cols = [np.array(s, np.int64).reshape(-1, 3) for s in slots]
    return Places([c[:, 0] for c in cols], [c[:, 1] for c in cols], [c[:, 2] for c in cols], base)


def pack(docs: DataFrame, window: int = WINDOW, vocab: tuple[str, str] | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset."""
    spark = docs.sparkSession
    pieces = materialize(cut(docs, window, vocab), "pieces")
    counts = materialize(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")),
                         "piece-lengths")
    hist = np.zeros(window + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # <= window rows
        hist[row["length"]] = row["n"]
    where = spark.sparkContext.broadcast(places(plan(hist, window), window))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    before = counts.select("part", "length",
                           F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = pieces.join(before, ["part", "length"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("before") + F.col("rank_in_part")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = where.value
        for b in batches:
            size, rank = b.column(2).to_numpy(), b.column(5).to_numpy()
            seq, off = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            for k in np.unique(size):
                rows = np.flatnonzero(size == k)
                slot = np.searchsorted(p.first_rank[k], rank[rows], "right") - 1
                seq[rows] = p.sequence[k][slot] + rank[rows] - p.first_rank[k][slot]
                off[rows] = p.offset[k][slot]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(seq), pa.array(off)],
                                             names=[*b.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(place, "doc_id long, start long, length long, ids_crc32 long, "
                                    "doc_tokens long, sequence_id long, offset long")
