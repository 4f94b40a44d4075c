"""Repeated byte strings by suffix sorting of content-defined shards.

Every byte is removed that is covered by a string of ``length`` bytes which
starts anywhere else in the corpus as well.

1. *Shards.*  The minimiser of a window of ``length`` bytes is its k-gram of
   least hash (leftmost of equals), so equal windows have equal minimisers at
   equal offsets.  Consecutive windows with one minimiser form a run of at
   most ``length - k + 1`` windows.  Only runs whose minimiser occurs
   elsewhere can repeat anything; this loses no window and drops most text.
2. *Equal runs* (same minimiser and 64-bit hash of their whole text) repeat
   each other; they are counted, and one of each goes on.
3. *Suffix sorting.*  The remaining runs, sorted by minimiser, pass through a
   task in shards of whole minimiser groups.  A shard's suffixes are sorted by
   induced sorting: positions where the text begins to rise are sorted first
   (their substrings are named and ranked on the shorter string of names),
   and all others are induced from them through one queue per byte value.
   Neighbours in the sorted order whose common prefix has ``length`` bytes
   (compared exactly) are repeated windows.  Spark's sort is the disk-backed
   part: a task holds one shard of at most ``shard_bytes`` at a time, or one
   larger group, and positions take four bytes.
4. A minimiser whose runs exceed ``group_bytes`` would fill a task by itself;
   its windows are counted by 128-bit hashes instead, spread over all tasks.

Defined cases: null and empty texts have no bytes; texts below ``length`` lose
nothing; repeated rows are documents of their own, so they repeat each other;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinetra.session import materialize

LENGTH, GRAM = 400, 50
SHARD_BYTES, GROUP_BYTES = 2 << 20, 4 << 20
SEGMENT = 1 << 20                # window starts that are hashed at once
_POSITION = np.uint64((1 << 24) - 1)

#: Odd multipliers of the rolling hashes, and of the final mixing.
BASE, BASE2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
MIX = np.uint64(0xD6E8FEB86659FD93)


# ---------------------------------------------------------------- rolling hash

def _powers(n: int, base: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    have = 1
    while have < n:
        k = min(have, n - have)
        out[have:have + k] = out[:k] * np.uint64(pow(base, have, 1 << 64))
        have += k
    return out


class Rolling:
    """Hashes of substrings: prefix sums of ``byte * base**i`` modulo 2**64,
    shifted back by the inverse power."""

    def __init__(self, base: int = BASE):
        self.base, self.up, self.down = base, np.ones(1, np.uint64), np.ones(1, np.uint64)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        if len(self.up) < len(data) + 1:
            n = max(1 << 16, 2 * len(data) + 1)
            self.up, self.down = _powers(n, self.base), _powers(n, pow(self.base, -1, 1 << 64))
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:len(data)], out=out[1:])
        return out

    def of(self, prefix: np.ndarray, start: np.ndarray, size) -> np.ndarray:
        x = (prefix[start + size] - prefix[start]) * self.down[start]
        x ^= x >> np.uint64(32)
        x *= MIX
        return x ^ (x >> np.uint64(29))


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    n = len(x) - w + 1
    pad = np.full(-len(x) % w, np.iinfo(np.uint64).max, np.uint64)
    rows = np.concatenate([x, pad]).reshape(-1, w)
    ahead = np.minimum.accumulate(rows, 1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1:w - 1 + n])


def runs_of(data: np.ndarray, roll: Rolling, length: int, gram: int
            ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, windows, minimiser hash, hash of the run's text) of each run."""
    out = []
    for at in range(0, len(data) - length + 1, SEGMENT):
        part = data[at:at + SEGMENT + length - 1]
        prefix = roll.prefix(part)
        grams = roll.of(prefix, np.arange(len(part) - gram + 1), gram)
        key = (grams & ~_POSITION) | np.arange(len(grams), dtype=np.uint64)
        where = (_sliding_min(key, length - gram + 1) & _POSITION).astype(np.int64)
        first = np.flatnonzero(np.r_[True, where[1:] != where[:-1]])
        size = np.diff(np.r_[first, len(where)])
        out.append((first + at, size, grams[where[first]],
                    roll.of(prefix, first, size + length - 1)))
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64),) * 4


# ------------------------------------------------------------- induced sorting

def _rising(s: np.ndarray) -> np.ndarray:
    """Whether each suffix is less than the next one; the last counts as rising."""
    n = len(s)
    change = np.where(s[:-1] != s[1:], np.arange(n - 1, dtype=np.int32), np.int32(n))
    change = np.minimum.accumulate(change[::-1])[::-1]
    return np.r_[s[change] < s[change + 1], True]


def _induce(s: np.ndarray, rising: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """All suffixes in order, from the order of the ``seeds`` (positions where
    the text begins to rise): queues by first symbol take each suffix from its
    successor, falling ones upwards, then rising ones downwards."""
    top = int(s.max()) + 1
    by_char = np.split(seeds[np.argsort(s[seeds], kind="stable")],
                       np.cumsum(np.bincount(s[seeds], minlength=top))[:-1])
    falls: list[list[np.ndarray]] = [[] for _ in range(top)]
    rises: list[list[np.ndarray]] = [[] for _ in range(top)]

    def spread(at: np.ndarray, queues: list[list[np.ndarray]], kind: bool) -> None:
        before = at[at > 0] - 1
        before = before[rising[before] == kind]
        if len(before):
            char = s[before]
            order = np.argsort(char, kind="stable")
            before, char = before[order], char[order]
            cuts = np.flatnonzero(char[1:] != char[:-1]) + 1
            for group in np.split(before, cuts):
                queues[s[group[0]]].append(group)

    for c in range(top):
        for group in falls[c]:          # grows while it is read
            spread(group, falls, False)
        spread(by_char[c], falls, False)
    for c in range(top - 1, -1, -1):
        for group in rises[c]:
            spread(group, rises, True)
        for group in reversed(falls[c]):
            spread(group[::-1], rises, True)
    rises[0].append(np.array([len(s) - 1], seeds.dtype))
    return np.concatenate([part for c in range(top)
                           for part in (*falls[c], *(g[::-1] for g in reversed(rises[c])))])


def suffix_array(s: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of ``s`` (its last symbol, 0, is the only one) in order of
    their first ``depth`` symbols at least."""
    rising = _rising(s)
    seeds = np.flatnonzero(np.r_[False, rising[1:] & ~rising[:-1]]).astype(np.int32)
    if len(seeds) > 1:
        by_substring = _induce(s, rising, seeds)
        is_seed = np.zeros(len(s), bool)
        is_seed[seeds] = True
        ordered = by_substring[is_seed[by_substring]]
        del by_substring, is_seed
        until = np.zeros(len(s), np.int32)
        until[seeds] = np.r_[seeds[1:], seeds[-1]]
        size = until[ordered] - ordered + 1
        del until
        new = np.r_[True, size[1:] != size[:-1]]
        open_, step = np.flatnonzero(~new), 0
        while len(open_):
            a, b = ordered[open_ - 1] + step, ordered[open_] + step
            differ = s[a] != s[b]
            new[open_[differ]] = True
            step += 1
            open_ = open_[~differ & (size[open_] > step)]
        name = np.zeros(len(s), np.int32)
        name[ordered] = np.cumsum(new) - 1
        rank, span = name[seeds].astype(np.int64), 1
        del name, ordered, size, new
        while rank.max() + 1 < len(rank) and span * 2 <= depth + 2:   # a name spans two symbols or more
            later = np.r_[rank[span:] + 1, np.zeros(min(span, len(rank)), np.int64)]
            rank = np.unique(rank * (len(rank) + 1) + later, return_inverse=True)[1]
            span *= 2
        seeds = seeds[np.argsort(rank, kind="stable")]
    return _induce(s, rising, seeds)


def repeated_windows(texts: list[bytes], length: int) -> list[np.ndarray]:
    """For each text the window starts whose ``length`` bytes occur at another
    start as well, in the same or another of the texts."""
    size = np.array([len(t) for t in texts])
    start = np.r_[0, np.cumsum(size + 1)]
    joined = np.frombuffer(b"\0".join([*texts, b""]), np.uint8)
    s = joined.astype(np.int16) + 2
    s[start[1:] - 1] = 1                                 # between texts
    order = suffix_array(np.r_[s, np.int16(0)], length)
    own = np.zeros(len(s) + 1, bool)
    for a, n in zip(start, size):
        own[a:a + max(0, n - length + 1)] = True
    order = order[own[order]]
    # common prefix of neighbours, eight bytes at a time, as far as it is whole
    padded = np.r_[joined, np.zeros(8, np.uint8)]
    words = np.ndarray(len(joined) + 1, np.uint64, padded, strides=(1,))
    a, b = order[:-1], order[1:]
    same = np.arange(len(a), dtype=np.int32)
    steps = [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]
    for k in steps:
        same = same[words[a[same] + k] == words[b[same] + k]]
        if not len(same):
            break
    hit = np.zeros(len(own), bool)
    hit[a[same]] = hit[b[same]] = True
    return [np.flatnonzero(hit[x:x + n]) for x, n in zip(start, size)]


# ------------------------------------------------------------------- in Spark

def _located(docs: DataFrame) -> DataFrame:
    """doc_id, data (UTF-8), and the row's place in its file as its identity."""
    try:
        docs.select("_metadata.row_index")
    except AnalysisException:            # not read from Parquet
        docs = materialize(docs.select("doc_id", "text"), "texts")
    return docs.select("doc_id", F.xxhash64("_metadata.file_path").alias("fid"),
                       F.col("_metadata.row_index").alias("row"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("data"))


def _ranges(hits: np.ndarray) -> list[tuple[int, int]]:
    """Sorted starts as (first, how many) of consecutive ones."""
    cuts = np.flatnonzero(np.diff(hits) != 1) + 1
    return [(int(g[0]), len(g)) for g in np.split(hits, cuts) if len(g)]


RUN = "fid long, row long, start long, wins long, m long, h long"
RANGE = "fid long, row long, start long, wins long"


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names)


def runs(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll = Rolling()
        for b in batches:
            parts = []
            for fid, row, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                start, wins, m, h = runs_of(np.frombuffer(data.as_py(), np.uint8), roll, length, gram)
                parts.append((np.full(len(start), fid), np.full(len(start), row), start, wins,
                              m.view(np.int64), h.view(np.int64)))
            if parts:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in zip(*parts)],
                    [f.split()[0] for f in RUN.split(", ")])

    return docs.filter(F.length("data") >= length).select("fid", "row", "data").mapInArrow(scan, RUN)


def _texts(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The text of each wanted run (m, fid, row, start, wins)."""
    listed = wanted.groupBy("fid", "row").agg(F.collect_list(F.struct("m", "start", "wins")).alias("r"))
    return docs.join(listed, ["fid", "row"]).select("fid", "row", "data", F.explode("r").alias("r")).select(
        "r.m", "fid", "row", "r.start", "r.wins",
        F.substring("data", F.col("r.start").cast("int") + 1,
                    (F.col("r.wins") + length - 1).cast("int")).alias("data"))


def shards(rows: Iterator[tuple[int, tuple]], shard_bytes: int) -> Iterator[list[tuple]]:
    """Rows (m, (.., text)) sorted by m, in lists of whole groups of one m: of at most
    ``shard_bytes`` of text, or of one group."""
    held: list[tuple] = []               # whole groups, then from ``first`` on the last one
    size, first, first_size, last = 0, 0, 0, None
    for m, row in rows:
        if m != last:
            first, first_size, last = len(held), size, m
        if first and size + len(row[-1]) > shard_bytes:
            yield held[:first]
            held, size, first, first_size = held[first:], size - first_size, 0, 0
        held.append(row)
        size += len(row[-1])
    if held:
        yield held


def _sorted_shards(texts: DataFrame, length: int, shard_bytes: int) -> DataFrame:
    """Ranges of repeated windows by suffix sorting, shard by shard."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in shards(((m, (fid, row, start, data)) for b in batches for m, fid, row, start, data in zip(
                *(b.column(i).to_pylist() for i in (0, 1, 2, 3, 5)))), shard_bytes):
            out = []
            for (fid, row, start, _), hits in zip(held, repeated_windows([x[3] for x in held], length)):
                out += [(fid, row, start + a, n) for a, n in _ranges(hits)]
            yield _batch(out, ["fid", "row", "start", "wins"])

    return texts.repartition("m").sortWithinPartitions("m").mapInArrow(scan, RANGE)


def _counted_windows(texts: DataFrame, length: int) -> DataFrame:
    """Ranges of repeated windows by counting window hashes."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = Rolling(BASE), Rolling(BASE2)
        for b in batches:
            parts = []
            for fid, row, start, data in zip(*(b.column(i).to_pylist() for i in (1, 2, 3, 5))):
                x = np.frombuffer(data, np.uint8)
                at = np.arange(len(x) - length + 1)
                parts.append((np.full(len(at), fid), np.full(len(at), row), at + start,
                              one.of(one.prefix(x), at, length).view(np.int64),
                              two.of(two.prefix(x), at, length).view(np.int64)))
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)],
                                                 ["fid", "row", "start", "a", "b"])

    windows = materialize(texts.mapInArrow(scan, "fid long, row long, start long, a long, b long"),
                          "window-hashes")
    often = windows.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return windows.join(often, ["a", "b"]).select("fid", "row", "start", F.lit(1).cast("long").alias("wins"))


def repeated(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES,
             group_bytes: int = GROUP_BYTES) -> tuple[DataFrame, DataFrame]:
    """(located documents, ranges of repeated windows)."""
    own = _located(docs)
    every = materialize(runs(own, length, gram), "runs")
    often = materialize(every.groupBy("m").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("m"),
                        "shared-minimisers")
    shared = materialize(every.join(often, "m", "left_semi"), "shared-runs")
    spans = materialize(shared.groupBy("m", "h", "wins").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("fid", "row", "start")).alias("at")), "run-texts")
    copies = spans.filter("n > 1").select("m", "h", "wins")
    whole = shared.join(copies, ["m", "h", "wins"], "left_semi").select("fid", "row", "start", "wins")

    # groups that hold a run of its own kind, one of each kind of their runs
    groups = materialize(spans.groupBy("m").agg(
        F.sum(F.when(F.col("n") == 1, 1).otherwise(0)).alias("single"), F.count(F.lit(1)).alias("kinds"),
        F.sum(F.col("wins") + length - 1).alias("bytes")).filter("single > 0 AND kinds > 1")
        .select("m", (F.col("bytes") > group_bytes).alias("large")), "groups")
    wanted = spans.join(groups, "m").select("m", "at.fid", "at.row", "at.start", "wins", "large")
    texts = materialize(_texts(own, wanted.filter("NOT large"), length), "run-bytes")
    found = whole.unionByName(materialize(_sorted_shards(texts, length, shard_bytes), "repeats"))
    if not groups.filter("large").isEmpty():
        found = found.unionByName(_counted_windows(_texts(own, wanted.filter("large"), length), length))
    return own, found


def removed_spans(ranges: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal (start, end) covered by windows that start in the ranges."""
    out: list[list[int]] = []
    for start, n in sorted(ranges):
        end = start + n - 1 + length
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, length: int = LENGTH, **how) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256,
    kept (the remaining bytes)."""
    own, found = repeated(docs, length, **how)
    listed = found.groupBy("fid", "row").agg(F.collect_list(F.struct("start", "wins")).alias("r"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for data, r in zip(b.column(1), b.column(2)):
                data = data.as_py()
                spans = removed_spans([(x["start"], x["wins"]) for x in r.as_py() or ()], length)
                kept = b"".join(data[a:z] for a, z in zip([0, *(e for _, e in spans)],
                                                          [*(s for s, _ in spans), len(data)]))
                rows.append((len(data), len(data) - len(kept), len(spans),
                             hashlib.sha256(kept).hexdigest(), kept))
            cols = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, t) for c, t in zip(cols, (
                    pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())))],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    kind = own.schema["doc_id"].dataType.simpleString()
    return own.join(listed, ["fid", "row"], "left").select("doc_id", "data", "r").mapInArrow(
        cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
