"""Packing: exact cover of all ids, little padding, the library's ids."""

from __future__ import annotations

import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from kinetra.llm import packing

LIB = Tokenizer.from_file(packing.vocabulary()[0])
ENCODE = packing.encoder(*packing.vocabulary())
WORDS = ["the", "don't", "café", "naïve", "x1", "日本", "\n", "3.14", "'s", "Über", "tion,", "🙂", "Ж"]


def ids(text):
    return LIB.encode(text or "", add_special_tokens=False).ids + [0]


def test_ids_are_the_librarys():
    r = random.Random(1)
    texts = ["", " ", "  a", "a ", "a  b", "a\n b", "a \tb", "x<|endoftext|>y z", "a  b", " ", "​ x",
             "a\x1c b", "A\x85 b", "ﬁ ﬂ", "٣ ٤", "'s 's 'll", "don 't"]
    texts += [" ".join(r.choices(WORDS, k=r.randint(1, 30))) for _ in range(300)]
    texts += ["".join(r.choices([*WORDS, " ", "  "], k=r.randint(1, 30))) for _ in range(300)]
    for t in texts:
        assert np.frombuffer(ENCODE(t), "<u4").tolist() == ids(t)[:-1], t


def check(rows, docs, window):
    want = sorted((i, len(ids(t))) for i, t in docs)
    got = sorted((r.doc_id, r.doc_tokens) for r in rows if r.start == 0)
    assert got == want
    by_text = {i: ids(t) for i, t in docs}
    for r in rows:
        part = by_text[r.doc_id][r.start:r.start + r.length]
        assert len(part) == r.length
        assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
    seq = {}
    for r in rows:
        seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in seq.values():
        at = 0
        for off, n in sorted(parts):
            assert off == at
            at += n
        assert at <= window
    assert sum(r.length for r in rows) == sum(n for _, n in want)
    return len(seq)


def first_fit(lengths, window):
    """Sequences that first-fit decreasing needs for the same pieces."""
    room = []
    for k in sorted(lengths, reverse=True):
        for i, r in enumerate(room):
            if r >= k:
                room[i] -= k
                break
        else:
            room.append(window - k)
    return len(room)


def test_pack(spark):
    r = random.Random(2)
    docs = [(i, " ".join(r.choices(WORDS, k=r.choice([0, 3, 20, 20, 200, 900])))) for i in range(400)]
    docs += [(1000, None), (1001, ""), (1002, "word " * 30_000)]
    df = spark.createDataFrame([(*d, 9) for d in docs], "doc_id long, text string, length int").repartition(5)
    rows = packing.pack(df).collect()
    n = check(rows, docs, 1024)
    assert n <= first_fit([x.length for x in rows], 1024)
    assert packing.pack(df.limit(0)).count() == 0


def test_repeated_rows_are_packed_each(spark):
    docs = [(1, "a b c"), (1, "a b c"), (2, "a")]
    rows = packing.pack(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.length) for r in rows) == [(1, 4), (1, 4), (2, 2)]
    assert len({(r.sequence_id, r.offset) for r in rows}) == 3


def test_plan_uses_each_length_as_often_as_it_occurs():
    rng = np.random.default_rng(3)
    for hist in (rng.poisson(40, 65), np.eye(65, dtype=int)[33] * 1000, np.zeros(65, int),
                 rng.poisson(1, 65) * (np.arange(65) > 40)):
        hist = hist.copy()
        hist[0] = 0
        used = np.zeros(65, int)
        for lengths, n in packing.plan(hist, 64):
            assert sum(lengths) <= 64 and n > 0
            for k in lengths:
                used[k] += n
        assert (used == hist).all()


def test_nnls_solves_a_known_system():
    rows = np.array([[1, 3, 0], [2, 2, 0], [1, 1, 2]])
    target = np.array([0, 5 + 2 * 4, 2 * 3 + 4, 5], float)
    x = packing.nnls(rows, target, 3000)
    assert np.allclose(x, [5, 3, 4], atol=0.02)
