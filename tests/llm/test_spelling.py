"""Variants against comparing every pair of words; filters against sets."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from kinetra.llm import spelling

SCHEMA = "doc_id long, text string, word string, n int, form string"
SYLLABLES = ["ba", "re", "ti", "lo", "mu", "né", "ü", "s", "×", "st"]


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near_of = {w: [x for x in words if near(w, x)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near_of[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return {(w, n, len(near_of[w]), form[w], words[form[w]] if form[w] else None, root(w))
            for w, n in words.items()}


def rows_of(case):
    rnd = random.Random(3)
    stems = ["".join(rnd.choice(SYLLABLES) for _ in range(rnd.randint(2, 5))) for _ in range(60)]

    def word():
        w = rnd.choice(stems[:rnd.randint(1, 60)])
        if rnd.random() < 0.3:      # one or two edits of a small kind, so that they come again
            for _ in range(rnd.randint(1, 2)):
                i = rnd.randrange(len(w)) if w else 0
                w = rnd.choice([w[:i] + w[i + 1:], w[:i] + "a" + w[i:], w[:i] + "z" + w[i + 1:]])
        return w.upper() if rnd.random() < 0.1 else w
    rows = [(i, " ".join(word() for _ in range(rnd.randint(0, 60)))) for i in range(150)]
    rows += [(1000 + i, "chain " * 60 + "chains " * 20 + "chainss " * 6) for i in range(2)]
    if case == "nulls":
        rows += [(None, None), (None, "stone stone stone stones"), (None, ""), (7, None)] + rows[:30]
        rows += [(5, "stone, stones; STONES! İstone stones1stone")] * 4
    elif case == "hot":
        rows += [(i, "common commons comon") for i in range(2000)]
    return rows


@pytest.mark.parametrize("case", ["plain", "nulls", "hot"])
def test_against_brute_force(spark, case):
    rows = rows_of(case)
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    got = {tuple(r) for r in spelling.variants(docs).select(
        "word", "n", "n_near", "form", "form_n", "root").collect()}
    want = brute(rows)
    assert got == want
    assert any(w[3] for w in want) and any(w[5] not in (w[0], w[3]) for w in want)   # chains occur


@pytest.mark.parametrize("per_round", [7, 40])
def test_rounds_give_the_same(spark, per_round):
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows_of("plain")], SCHEMA)
    got = {tuple(r) for r in spelling.variants(docs, words_per_round=per_round).collect()}
    assert got == {tuple(r) for r in spelling.variants(docs).collect()}


def test_empty_and_wordless(spark):
    for rows in ([], [(1, None, "", 0, "")], [(1, "a b c 12345", "", 0, "")] * 5):
        assert spelling.variants(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_very_long_word_and_text(spark):
    long = "ab" * 1500
    rows = [(i, f"{long} {long[:-1]} " + "filler " * 50_000) for i in range(3)]
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    assert {tuple(r) for r in spelling.variants(docs).collect()} == brute(rows)


def test_filters_lose_nothing_and_pass_little():
    rnd = random.Random(5)
    words = list({"".join(rnd.choice("abcdefghij") for _ in range(7)) for _ in range(20_000)})
    n_blocks = {7: len(words) * spelling.BITS // spelling.BLOCK_BITS}
    filters = spelling.Filters(n_blocks, 1, 0)
    h = spelling.hashes(spelling._codes(words, 7))
    block = spelling._block_of(h, n_blocks[7])
    lanes = np.zeros((n_blocks[7], spelling.LANES), np.uint32)
    for i in range(spelling.LANES):
        np.bitwise_or.at(lanes[:, i], block, spelling._lane_bits(h, i))
    filters.fill(pa.table({"length": np.full(len(lanes), 7), "block": np.arange(len(lanes)),
                           **{f"l{i}": lanes[:, i].astype(np.int64) for i in range(spelling.LANES)}}))
    assert len(filters.holds(7, h)) == len(words)
    others = list({"".join(rnd.choice("klmnop") for _ in range(7)) for _ in range(50_000)})
    passed = filters.holds(7, spelling.hashes(spelling._codes(others, 7)))
    assert len(passed) < 0.005 * len(others)
    assert len(filters.holds(6, h)) == 0
