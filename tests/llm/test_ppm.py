"""The language model against a plain trie, symbol by symbol."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import pytest

from kinetra.llm import ppm


def plain(rows, order):
    """Scores by walking the trie with explicit exclusion sets."""
    low = lambda t: (t or "").encode().lower()
    out = lambda i: zlib.crc32(str(i).encode()) % 5 == 1 if i is not None else False
    trie = defaultdict(Counter)
    words = Counter()
    for i, t in rows:
        if not out(i):
            words.update([*low(t).split(), b""])
            run = [257] * order + list(low(t)) + [256]
            for p in range(order, len(run)):
                for j in range(order + 1):
                    trie[tuple(run[p - j:p])][run[p]] += 1
    n, v = words.total(), len(words)
    got = []
    for i, t in rows:
        run = [257] * order + list(low(t)) + [256]
        total = 0.0
        for p in range(order, len(run)):
            gone = set()
            for j in range(order, -1, -1):
                node = trie.get(tuple(run[p - j:p]))
                if node is None:
                    continue
                open_ = {s: c for s, c in node.items() if s not in gone}
                size = sum(open_.values()) + len(open_)
                if run[p] in open_:
                    total += math.log10(open_[run[p]] / size)
                    break
                if open_:
                    total += math.log10(len(open_) / size)
                gone = set(node)
            else:
                total += math.log10(1 / max(1, 257 - len(gone)))
        tokens = [*low(t).split(), b""]
        got.append((i, out(i), len(tokens), sum(words[w] > 0 for w in tokens), n,
                    sum(math.log10((words[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens), total))
    return got


def corpus():
    r = random.Random(8)
    syl = ["ba", "lo", "ri", "Té", "un", "x", "ß", ",", "\n", "日"]
    rows = [(i, " ".join("".join(r.choices(syl, k=r.randint(1, 4))) for _ in range(r.randint(0, 60))))
            for i in range(120)]
    return [*rows, (200, None), (201, ""), (202, "\t "), (203, "QQQ ~~ 0123"), (None, "ba lo"),
            (3, rows[3][1]), (204, "ba " * 3000), (206, "zzz zzz"), (208, "ẞİ \x00\x7f")]


@pytest.mark.parametrize("order", [2, 4])
def test_against_plain_trie(spark, order):
    rows = corpus()
    df = spark.createDataFrame([(*r, 5, "b") for r in rows],
                               "doc_id long, text string, code int, block string").repartition(3)
    key = lambda r: (r[0] is None, r[0] or 0, r[6])
    got = sorted(map(tuple, ppm.score(df, order).collect()), key=key)
    want = sorted(plain(rows, order), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], abs=1e-7) and g[6] == pytest.approx(w[6], abs=1e-7), w[0]


def test_without_training_rows(spark):
    out = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1][:3]
    df = spark.createDataFrame([(i, "ab") for i in out], "doc_id long, text string")
    rows = ppm.score(df).collect()
    assert {(r.n_known, r.train_tokens, round(r.score, 9)) for r in rows} == {
        (0, 0, round(-3 * math.log10(257), 9))}
    assert ppm.score(df.limit(0)).count() == 0
