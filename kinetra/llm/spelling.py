"""Spelling variant grouping: words one edit apart, by Bloom-guided neighbourhoods.

Two words are near if they differ by exactly one inserted, deleted or replaced code
point.  Every word generates its edits and asks, before anything is shuffled, whether
such a word can exist:

1. ``vocabulary`` counts the words (one pass over the texts, partial aggregates).
2. The vocabulary's blocked Bloom filters: one for each word length, of blocks of eight
   lanes of 32 bits; a word sets one bit in each lane of one block.  They are built by a
   grouped ``bit_or`` and broadcast.  A filter set holds ``WORDS_PER_ROUND`` words at
   most, 16 MB whatever the table holds; a larger vocabulary is cut by hash into slices,
   and each slice is a round of its own, so the false positives do not grow.
3. ``positives``: a task makes the edits of its words as arrays of hashes -- each
   deletion, asked of the filter of length - 1, and each replacement by a higher code
   point, asked of the filter of the same length.  That is every pair once: an insertion
   is the other word's deletion.  Only edits whose eight bits are all set leave the task.
4. They are joined with the vocabulary by the word itself, which drops the false ones.
5. A word's form is the near word of the largest count if that is twice its own; forms
   grow along a chain, so following them ends.  Roots by pointer jumping, as joins.

Hashes are polynomials of the code points modulo 2^64, so that an edit's hash follows
from those of the parts around it, with a finishing mix.

Defined cases: a null text has no words; a null doc_id is written as nothing before the
colon; equal rows count each.  Ties between forms go to the first in code-point order.
An empty table gives no rows.  Texts are cut whole, by one expression a row, however
long; a word of 100,000 letters is a word, its edits are made in chunks.  Other columns
are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinetra.session import materialize

RUNS = "([A-Za-z\\u00C0-\\u00FF]+)"
# The rules for words.
DROP_ONE_IN = 97
LEAST_LENGTH = 5
LEAST_COUNT = 3
FORM_TIMES = 2

#: Words of a round's filters and bits of a filter for each of them (16 MB a round).
WORDS_PER_ROUND = 8 << 20
BITS = 16
LANES = 8
BLOCK_BITS = LANES * 32
#: Most edits that a task holds at once.
EDITS_AT_ONCE = 1 << 21
#: Words a task takes.
WORDS_PER_TASK = 50_000

#: Base of the polynomial (odd, so that it has an inverse modulo 2^64).
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def lower_az(c: Column) -> Column:
    upper = "".join(map(chr, range(65, 91)))
    return F.translate(c, upper, upper.lower())


def words_of(docs: DataFrame) -> DataFrame:
    """(word): every run of the texts, some with a code point dropped by their hash."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(
        F.col("text").cast("string"), F.lit(RUNS), F.lit(1))).alias("run"))
    runs = runs.select("doc_id", lower_az(F.col("run")).alias("run"))
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
                .cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    return runs.withColumn("h", h).select(F.when(
        F.col("h") % DROP_ONE_IN == 0,
        F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run"))))
        .otherwise(F.col("run")).alias("word"))


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n), written once."""
    return materialize(words_of(docs).filter(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST_COUNT), "vocabulary")


def _mix(h: np.ndarray) -> np.ndarray:
    """Finish of a hash: every bit of the input reaches every bit of the output."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(length: int) -> np.ndarray:
    out = np.empty(length + 1, np.uint64)
    out[0] = 1
    if length:
        out[1:] = np.uint64(BASE)
    return np.multiply.accumulate(out)


def _codes(words: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), length).astype(
        np.uint64)


def hashes(codes: np.ndarray) -> np.ndarray:
    """Finished hashes of words of one length (rows of code points)."""
    return _mix((codes * _powers(codes.shape[1])[:-1]).sum(1, dtype=np.uint64))


def _slice_of(h: np.ndarray, slices: int) -> np.ndarray:
    """The round of a hash, from its low bits and apart from its block."""
    return (h & np.uint64(0xFFFF)) % np.uint64(slices)


def _block_of(h: np.ndarray, n_blocks: int) -> np.ndarray:
    return (((h >> np.uint64(32)) * np.uint64(n_blocks)) >> np.uint64(32)).astype(np.int64)


#: An odd multiplier for each lane.
SALTS = _mix(np.arange(1, LANES + 1, dtype=np.uint64)) | np.uint64(1)


def _lane_bits(h: np.ndarray, lane: int) -> np.ndarray:
    """The word's bit in a lane: the five upper bits of a product of its hash."""
    return np.uint32(1) << ((h * SALTS[lane]) >> np.uint64(59)).astype(np.uint32)


class Filters:
    """Blocked Bloom filters by word length."""

    def __init__(self, n_blocks: dict[int, int], slices: int, turn: int):
        self.n_blocks, self.slices, self.turn = n_blocks, slices, turn
        self.lanes: dict[int, np.ndarray] = {}

    def fill(self, blocks: pa.Table) -> None:
        """From rows of ``BITS_SCHEMA``, one for a block at most."""
        length, block = (blocks.column(c).to_numpy() for c in ("length", "block"))
        bits = np.stack([blocks.column(f"l{i}").to_numpy() for i in range(LANES)], 1).astype(np.uint32)
        for n, size in self.n_blocks.items():
            mine = length == n
            self.lanes[n] = np.zeros((size, LANES), np.uint32)
            self.lanes[n][block[mine]] = bits[mine]

    def holds(self, length: int, h: np.ndarray) -> np.ndarray:
        """Indices into ``h`` of the hashes that may be words of ``length``."""
        found = np.flatnonzero(_slice_of(h, self.slices) == self.turn) if self.slices > 1 else np.arange(len(h))
        if length not in self.lanes:
            return found[:0]
        lanes = self.lanes[length]
        block = _block_of(h[found], len(lanes))
        for lane in range(LANES):
            hit = (lanes[block, lane] & _lane_bits(h[found], lane)) != 0
            found, block = found[hit], block[hit]
        return found


def _bits_of(n_blocks: dict[int, int], slices: int, turn: int):
    """Rows (length, block, one bit for each lane) of the words of a round."""
    def bits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for length, group in batch.groupby(batch["word"].str.len()):
                h = hashes(_codes(group["word"].tolist(), int(length)))
                h = h[_slice_of(h, slices) == turn]
                yield pd.DataFrame({"length": np.full(len(h), length, np.int32),
                                    "block": _block_of(h, n_blocks[int(length)]),
                                    **{f"l{i}": _lane_bits(h, i).astype(np.int64) for i in range(LANES)}})
    return bits


BITS_SCHEMA = "length int, block long, " + ", ".join(f"l{i} long" for i in range(LANES))


def build_filters(words: DataFrame, per_length: dict[int, int], slices: int, turn: int) -> Filters:
    n_blocks = {length: max(1, math.ceil(n / slices * BITS / BLOCK_BITS)) for length, n in per_length.items()}
    filters = Filters(n_blocks, slices, turn)
    rows = words.select("word").mapInPandas(_bits_of(n_blocks, slices, turn), BITS_SCHEMA).groupBy(
        "length", "block").agg(*[F.bit_or(f"l{i}").alias(f"l{i}") for i in range(LANES)])
    filters.fill(rows.toArrow())        # a row for each block, see WORDS_PER_ROUND
    return filters


def edits(words: list[str], length: int, alphabet: np.ndarray, filters: Filters) -> Iterator[tuple[int, str]]:
    """(index of the word, edit) for the edits that the filters let pass."""
    codes = _codes(words, length)
    power = _powers(length)
    terms = codes * power[:-1]
    whole = terms.sum(1, dtype=np.uint64)
    before = np.cumsum(terms, axis=1, dtype=np.uint64)          # up to and with i
    # a deletion: the part before i, and the part behind it one power lower
    rest = (whole[:, None] - before) * np.uint64(INVERSE)
    h = _mix(before - terms + rest)
    # of a run of equal letters only the last is deleted: the others give the same word
    last = np.ones(codes.shape, bool)
    last[:, :-1] = codes[:, :-1] != codes[:, 1:]
    w, i = np.nonzero(last)
    for x in filters.holds(length - 1, h[w, i]):
        word = words[w[x]]
        yield int(w[x]), word[:i[x]] + word[i[x] + 1:]
    for at in range(length):
        change = (alphabet[None, :] - codes[:, at, None]) * power[at]
        w, a = np.nonzero(alphabet[None, :] > codes[:, at, None])
        for x in filters.holds(length, _mix(whole[w] + change[w, a])):
            word = words[w[x]]
            yield int(w[x]), word[:at] + chr(int(alphabet[a[x]])) + word[at + 1:]


def positives(words: DataFrame, alphabet: list[int], filters: Filters) -> DataFrame:
    """(word, n, edit) that pass the filters of this round."""
    sent = words.sparkSession.sparkContext.broadcast(filters)
    letters = np.array(sorted(alphabet), np.uint64)

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for length, group in batch.groupby(batch["word"].str.len()):
                words, counts, length = group["word"].tolist(), group["n"].to_numpy(), int(length)
                step = max(1, EDITS_AT_ONCE // (length + len(letters)))
                for at in range(0, len(words), step):
                    found = list(edits(words[at:at + step], length, letters, sent.value))
                    yield pd.DataFrame({"word": pd.Series([words[at + w] for w, _ in found], dtype="string"),
                                        "n": counts[[at + w for w, _ in found]],
                                        "edit": pd.Series([e for _, e in found], dtype="string")})

    return words.mapInPandas(probe, "word string, n long, edit string")


def near_pairs(words: DataFrame, words_per_round: int = WORDS_PER_ROUND) -> DataFrame:
    """(a, a_n, b, b_n): every pair of near words of the vocabulary, once."""
    spark = words.sparkSession
    per_length = {r.length: r.n for r in words.groupBy(F.length("word").alias("length")).agg(
        F.count(F.lit(1)).alias("n")).collect()}
    total = sum(per_length.values())
    if not total:
        return spark.createDataFrame([], "a string, a_n long, b string, b_n long")
    letters = words.select(F.explode(F.split("word", "")).alias("c")).filter("c <> ''").distinct()
    alphabet = [ord(r.c) for r in letters.collect()]        # letters of the pattern of runs
    slices = math.ceil(total / words_per_round)
    tasks = max(1, math.ceil(total / WORDS_PER_TASK))
    asked = words.repartition(max(tasks, spark.sparkContext.defaultParallelism), "word")
    rounds = [materialize(positives(asked, alphabet, build_filters(words, per_length, slices, turn)), "positives")
              for turn in range(slices)]
    known = words.select(F.col("word").alias("edit"), F.col("n").alias("b_n"))
    return reduce(DataFrame.unionByName, rounds).join(known, "edit").select(
        F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("edit").alias("b"), "b_n")


def follow(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): forms followed to the last, by pointer jumping."""
    roots = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        up = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = materialize(roots.join(up, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if stepped.filter("moved").isEmpty():
            return stepped.drop("moved")
        roots = stepped.drop("moved")


def variants(docs: DataFrame, words_per_round: int = WORDS_PER_ROUND) -> DataFrame:
    """One row per word: word, n, n_near, form, form_n, root."""
    words = vocabulary(docs)
    pairs = materialize(near_pairs(words, words_per_round), "near-words")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("b_n").alias("a_n"),
                                          F.col("a").alias("b"), F.col("a_n").alias("b_n")))
    best = both.groupBy("a").agg(F.count(F.lit(1)).alias("n_near"),
                                 F.min(F.struct((-F.col("b_n")).alias("k"), F.col("b"))).alias("best"))
    known = materialize(words.join(best.withColumnRenamed("a", "word"), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.k") >= FORM_TIMES * F.col("n"), F.col("best.b")).alias("form"),
        F.when(-F.col("best.k") >= FORM_TIMES * F.col("n"), -F.col("best.k")).alias("form_n")), "known-words")
    roots = follow(known.filter("form IS NOT NULL"))
    return known.join(roots, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
