"""Language-model scoring by prediction by partial matching.

The model is a trie of byte contexts up to ``order`` bytes: for each context
the symbols that followed it in the training texts and how often.  A symbol
is coded in the longest known context that has seen it.  A context with ``D``
symbols seen ``T`` times in all gives symbol ``s`` the probability
``n(s) / (T + D)`` and the escape to the next shorter one ``D / (T + D)``
(escape estimation C); after an escape the symbols of the longer context are
excluded from all counts.  Below the empty context every symbol not seen is
equally likely.  Texts end with a symbol of their own, so the scores are log10
probabilities of whole texts.  Texts are UTF-8 with A-Z lower-cased.

How it is spread: a *block* is a run of rows of one file, so many that it holds
``BLOCK_BYTES`` of text at the corpus' mean length.  It is told by file and row
number alone, so it is the same in every scan, however the files are split.  Tasks
emit the distinct words and contexts of their blocks with the training counts; Spark
sums them over all blocks, gives every distinct context-and-symbol its log
probability (a join per trie level, only for what had to escape), and sends
each block the words and contexts it holds.  A task then scores a block's
texts, one batch at a time, and one block after the other.  Nothing is broadcast
whose size grows with the corpus, and memory follows the size of a block.

Defined cases: null and empty texts hold only the end; repeated rows are
counted and scored each; a null doc_id counts as training; with no training
rows every symbol is equally likely and no token is known; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinetra.session import materialize

ORDER = 4
END, START, SYMBOL_BITS = 256, 257, 9
SYMBOLS = 257                  # bytes and the end
CHUNK_BYTES = 1 << 20          # texts counted at once
ROWS_AT_ONCE = 64              # texts scored at once
KEPT_WORDS = 200_000           # distinct words a task gathers before it emits them
BLOCK_BYTES = 8 << 20          # text of a block at the mean length
MOST_TASKS = 50_000            # beyond them a task scores several blocks in turn

COUNTS = "block long, word binary, code long, n long"


def held_out() -> Column:
    """Rows that are never learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False))


def codes(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """(code of each symbol under its ``order`` predecessors, texts' ends)."""
    size = np.array([len(t) + 1 for t in texts], np.int64)
    ends = np.cumsum(size)
    if not texts:
        return np.zeros(0, np.int64), ends
    gap = bytes(order)
    run = np.frombuffer(b"".join([x for t in texts for x in (gap, t, b"\0")]), np.uint8).astype(np.int64)
    last = np.cumsum(size + order) - 1
    own = np.ones(len(run), bool)           # symbols that are predicted
    for j in range(order):
        at = last - size - j
        run[at], own[at] = START, False
    run[last] = END
    # the symbol of each place and, shifted in from behind it, those before
    out = run.copy()
    for j in range(1, order + 1):
        out[j:] |= run[:-j] << (SYMBOL_BITS * j)
    return out[own], ends


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([p[0] for p in parts])
    n = np.concatenate([p[1] for p in parts])
    u, at = np.unique(keys, return_inverse=True)
    return u, np.bincount(at, n, len(u)).astype(np.int64)


class _Block:
    """Counts of one block while its texts pass."""

    def __init__(self, block: int, order: int):
        self.block, self.order = block, order
        self.words: Counter = Counter()
        self.seen: set[bytes] = set()
        self.grams: list[tuple[np.ndarray, np.ndarray]] = []
        self.texts: dict[bool, list[bytes]] = {True: [], False: []}
        self.bytes = 0

    def add(self, text: bytes, train: bool) -> None:
        tokens = text.split()
        tokens.append(b"")                   # the end; no word is empty
        (self.words if train else self.seen).update(tokens)
        self.texts[train].append(text)
        self.bytes += len(text)
        if self.bytes > CHUNK_BYTES:
            self.count()

    def count(self) -> None:
        for train, texts in self.texts.items():
            if texts:
                u, n = np.unique(codes(texts, self.order)[0], return_counts=True)
                self.grams.append((u, n if train else np.zeros(len(n), np.int64)))
                texts.clear()
        self.bytes = 0
        if len(self.grams) > 16:
            self.grams = [_merge(self.grams)]

    def full(self) -> bool:
        return len(self.words) + len(self.seen) > KEPT_WORDS

    def rows(self) -> Iterator[pa.RecordBatch]:
        self.count()
        words = [*self.words, *(self.seen - self.words.keys())]
        n = [*self.words.values(), *[0] * (len(words) - len(self.words))]
        yield self._batch(words, [None] * len(words), n)
        if self.grams:
            u, n = _merge(self.grams)
            yield self._batch([None] * len(u), u, n)
        self.words, self.seen, self.grams = Counter(), set(), []

    def _batch(self, words, grams, n) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(words), self.block, np.int64)), pa.array(words, pa.binary()),
             pa.array(grams, pa.int64()), pa.array(n, pa.int64())], ["block", "word", "code", "n"])


def _blocks(docs: DataFrame) -> tuple[DataFrame, int]:
    """(block, doc_id, held_out, text (UTF-8)) and the number of tasks to score them."""
    try:
        docs.select("_metadata.row_index")
    except AnalysisException:                # rows without numbers
        docs = materialize(docs.select("doc_id", "text"), "texts")
    size = docs.agg(F.count(F.lit(1)).alias("rows"),
                    F.coalesce(F.sum(F.octet_length(F.col("text").cast("string"))), F.lit(0)).alias("bytes")).first()
    rows = max(1, BLOCK_BYTES * size.rows // max(1, size.bytes))
    tasks = min(MOST_TASKS, max(1, -(-size.bytes // BLOCK_BYTES)))
    return docs.select(F.xxhash64("_metadata.file_path", F.floor(F.col("_metadata.row_index") / rows)).alias("block"),
                       "doc_id", held_out().alias("held_out"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text")), tasks


def count(blocks: DataFrame, order: int) -> DataFrame:
    """Distinct words and codes of each block with their training counts (a block
    of many words, or one cut by a split, emits some of them more than once)."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Block | None = None
        for b in batches:
            for block, out, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                if now is None or block != now.block or now.full():
                    if now:
                        yield from now.rows()
                    now = _Block(block, order)
                now.add(text.as_py().lower(), not out)  # of bytes: A-Z only
        if now:
            yield from now.rows()

    return blocks.select("block", "held_out", "text").mapInArrow(scan, COUNTS)


def _mask(symbols: int) -> int:
    return (1 << (SYMBOL_BITS * symbols)) - 1


def _low(c: Column, symbols: int) -> Column:
    return c.bitwiseAND(F.lit(_mask(symbols)).cast("long"))


def _bounded(table: DataFrame, symbols: int) -> DataFrame:
    """A table keyed by so many symbols: of one or two there are at most
    258**2 (a few MB), which every task may hold, so common short contexts
    are not dealt to one task."""
    return F.broadcast(table) if symbols <= 2 else table


def log_probabilities(grams: DataFrame, order: int) -> DataFrame:
    """(code, logp) of every code of ``grams`` (code, n: training count)."""
    context = F.shiftright("code", SYMBOL_BITS).alias("ctx")
    seen = grams.filter("n > 0")
    by_order, nodes = {order: seen}, {}
    for j in range(order, -1, -1):
        if j < order:
            by_order[j] = materialize(by_order[j + 1].groupBy(_low(F.col("code"), j + 1).alias("code"))
                                      .agg(F.sum("n").alias("n")), "grams")
        nodes[j] = by_order[j].groupBy(context).agg(F.sum("n").alias("t"),
                                                    F.count(F.lit(1)).alias("d"))
    root = nodes[0].agg(F.coalesce(F.sum("t"), F.lit(0)).alias("t"),
                        F.coalesce(F.sum("d"), F.lit(0)).alias("d")).first()

    at = grams.select("code", "n", context).join(nodes[order], "ctx", "left")
    escape = F.when(F.col("t").isNull(), 0.0).otherwise(F.log10(F.col("d") / (F.col("t") + F.col("d"))))
    at = materialize(at.select(
        "code", F.when(F.col("n") > 0, F.log10(F.col("n") / (F.col("t") + F.col("d")))).alias("logp"),
        escape.alias("spent"), F.col("t").isNotNull().alias("known")), "probabilities")
    done = [at.filter("logp IS NOT NULL").select("code", "logp")]
    rest = at.filter("logp IS NULL").select("code", "spent", "known")
    for j in range(order - 1, -1, -1):
        # what the longer context has seen is excluded here
        longer = rest.filter("known").select(
            _low(F.shiftright("code", SYMBOL_BITS), j + 1).alias("ctx")).distinct()
        below = by_order[j].select(F.col("code").alias("low"), F.col("n").alias("m"))
        out = by_order[j + 1].withColumn("ctx", context).join(longer, "ctx", "left_semi").withColumn(
            "low", _low(F.col("code"), j + 1)).join(below, "low").groupBy(F.col("ctx").alias("lctx")).agg(
            F.sum("m").alias("xt"), F.count(F.lit(1)).alias("xd"))
        step = rest.withColumn("lctx", F.when(F.col("known"), _low(
            F.shiftright("code", SYMBOL_BITS), j + 1))).join(_bounded(out, j + 1), "lctx", "left").withColumn(
            "low", _low(F.col("code"), j + 1)).join(_bounded(below, j + 1), "low", "left")
        if j:
            step = step.withColumn("ctx", _low(F.shiftright("code", SYMBOL_BITS), j)).join(
                _bounded(nodes[j], j), "ctx", "left")
        else:
            step = step.withColumn("t", F.lit(root.t or None).cast("long")).withColumn(
                "d", F.lit(root.d or None).cast("long"))
        t = F.col("t") - F.coalesce("xt", F.lit(0))
        d = F.col("d") - F.coalesce("xd", F.lit(0))
        spent = F.col("spent") + F.when(F.col("t").isNull() | (d == 0), 0.0).otherwise(F.log10(d / (t + d)))
        step = materialize(step.select(
            "code", F.when(F.col("m").isNotNull(), F.col("spent") + F.log10(F.col("m") / (t + d))).alias("logp"),
            spent.alias("spent"), F.col("t").isNotNull().alias("known")), "probabilities")
        done.append(step.filter("logp IS NOT NULL").select("code", "logp"))
        rest = step.filter("logp IS NULL").select("code", "spent", "known")
    done.append(rest.select("code", (F.col("spent") - math.log10(max(1, SYMBOLS - root.d))).alias("logp")))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


class Table:
    """A block's codes and their values, by the upper bits of a multiplied code: the
    codes of a bucket lie together, most buckets hold one or none."""

    def __init__(self, keys: np.ndarray, vals: np.ndarray):
        self.shift = np.uint64(64 - max(1, len(keys).bit_length()))
        bucket = self._bucket(keys)
        order = np.argsort(bucket).astype(np.int32)
        self.keys, self.vals = keys[order], vals[order]
        size = np.bincount(bucket, minlength=1 << (64 - int(self.shift))).astype(np.int32)
        self.starts = np.cumsum(size, dtype=np.int32) - size

    def _bucket(self, codes: np.ndarray) -> np.ndarray:
        return ((codes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.uint32)

    def of(self, codes: np.ndarray) -> np.ndarray:
        """Values of codes that are all in the table."""
        at = self.starts[self._bucket(codes)]
        todo = np.flatnonzero(self.keys[at] != codes)
        while len(todo):
            at[todo] += 1
            todo = todo[self.keys[at[todo]] != codes[todo]]
        return self.vals[at]


OUT = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
       "base_score double, score double")


def _sums(texts: list[bytes], logs: Table, order: int) -> Iterator[float]:
    """Sum of the symbols' logarithms of each text, some texts at a time."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size > CHUNK_BYTES or i == len(texts) - 1:
            found, ends = codes(texts[first:i + 1], order)
            yield from np.add.reduceat(logs.of(found), np.r_[0, ends[:-1]]).tolist()
            first, size = i + 1, 0


def _scored(part: pa.RecordBatch, logs: Table, order: int) -> Iterator[tuple]:
    """(text, sum of logarithms, doc_id, held_out) of the texts of a batch, a few
    texts in memory at a time."""
    for i in range(0, len(part), ROWS_AT_ONCE):
        few = part.slice(i, ROWS_AT_ONCE)
        texts = [t.as_py().lower() for t in few.column(2)]
        yield from zip(texts, _sums(texts, logs, order), few.column(3).to_pylist(), few.column(5).to_pylist())


def score(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    blocks, tasks = _blocks(docs)
    counts = materialize(count(blocks, order), "block-counts")

    # a word occurs in each block a few times at most, so no group is hot
    words = materialize(counts.filter("word IS NOT NULL").select(
        "block", "word", F.sum("n").over(Window.partitionBy("word")).alias("c"),
        F.row_number().over(Window.partitionBy("word").orderBy("block")).alias("k"),
        "n").filter("c > 0"), "words")
    totals = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
                       F.coalesce(F.sum(F.when(F.col("k") == 1, 1)), F.lit(0)).alias("v")).first()
    n_all, v_all = totals.n, totals.v

    grams = materialize(counts.filter("code IS NOT NULL").groupBy("code").agg(F.sum("n").alias("n")),
                        "grams")
    logp = materialize(log_probabilities(grams, order), "log-probabilities")
    own = counts.filter("code IS NOT NULL").select("block", "code").join(logp, "code")

    null = F.lit(None)
    parts = [words.select("block", F.lit(0).alias("kind"), "word", F.col("c").alias("num"),
                          null.cast("double").alias("logp"), null.cast("boolean").alias("held_out")),
             own.select("block", F.lit(1).alias("kind"), null.cast("binary").alias("word"),
                        F.col("code").alias("num"), "logp", null.cast("boolean").alias("held_out")),
             blocks.select("block", F.lit(2).alias("kind"), F.col("text").alias("word"),
                           F.col("doc_id").alias("num"), null.cast("double").alias("logp"), "held_out")]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, known, parts, logs = None, {}, [], None
        share = math.log10(n_all + 0.5 * (v_all + 1))
        for b in batches:
            block, kind = b.column(0).to_numpy(), b.column(1).to_numpy()
            out = []
            edges = np.flatnonzero(np.r_[True, (block[1:] != block[:-1]) | (kind[1:] != kind[:-1]), True])
            for lo, hi in zip(edges[:-1], edges[1:]):
                part = b.slice(lo, hi - lo)
                if block[lo] != now:
                    now, known, parts = block[lo], {}, []
                if kind[lo] == 0:
                    known.update(zip(part.column(2).to_pylist(), part.column(3).to_pylist()))
                elif kind[lo] == 1:
                    parts.append((part.column(3).to_numpy(), part.column(4).to_numpy()))
                else:
                    if parts:
                        logs, parts = Table(*(np.concatenate(x) for x in zip(*parts))), []
                    for text, logp, doc, held in _scored(part, logs, order):
                        tokens = text.split()
                        tokens.append(b"")
                        c = np.fromiter(map(known.get, tokens, repeat(0)), np.int64, len(tokens))
                        base = float(np.log10(c + 0.5).sum()) - len(tokens) * share
                        out.append((doc, held, len(tokens), int((c > 0).sum()), n_all, base, logp))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (
                        pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(),
                        pa.float64()))],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return rows.repartition(tasks, "block").sortWithinPartitions("block", "kind").mapInArrow(run, OUT)
