"""Decontamination against all windows of all texts, one by one."""

from __future__ import annotations

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from kinetra.llm import decontam as dc

WORDS = [f"w{i}" for i in range(400)]


def toks(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def shingles(w):
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def brute(docs, items):
    """Best similarity of each document and item over all windows."""
    out = {}
    for d, t in docs:
        w = toks(t)
        for i, it in items:
            iw = toks(it)
            if not iw or not w:
                continue
            n = len(iw)
            s = shingles(iw)
            best = 0
            for p in range(max(1, len(w) - n + 1)):
                x = shingles(w[p:p + n])
                best = max(best, (x & s).total() / (x | s).total())
            if best >= 0.8:
                out[d, i] = max(best, out.get((d, i), 0))
    return out


def corpus():
    r = random.Random(3)
    items = [(i, " ".join(r.choices(WORDS, k=r.randint(12, 60)))) for i in range(12)]
    items += [(20, "one two three"), (21, ""), (22, None), (23, "a b " * 20), (24, items[0][1])]
    docs = [(k, " ".join(r.choices(WORDS, k=r.randint(0, 120)))) for k in range(20)]
    for k in range(20, 60):
        _, it = items[k % 12]
        w = it.split()
        if k >= 40:
            w[r.randrange(len(w))] = "changed"
        if k >= 50:
            w.insert(r.randrange(len(w)), "more")
        around = r.choices(WORDS, k=r.randint(0, 40))
        cut = r.randint(0, len(around))
        docs.append((k, ", ".join([*around[:cut], *w, *around[cut:]]).upper() if k % 2 else
                     " ".join([*around[:cut], *w, *around[cut:]])))
    docs += [(100, None), (101, ""), (102, "One, two; three!"), (103, "a b " * 300), (104, "b a " * 9),
             (5, docs[25][1]), (105, items[1][1] + " x " + items[2][1] + " y " + items[1][1])]
    return docs, items


def test_against_brute_force(spark):
    docs, items = corpus()
    d = spark.createDataFrame([(*x, "e", 0) for x in docs], "doc_id long, text string, item string, size int")
    b = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, doc_id int")
    rows = dc.find_leaks(d, b).collect()
    got = {}
    for r in rows:
        got[r.doc_id, r.item_id] = max(r.similarity, got.get((r.doc_id, r.item_id), 0))
    want = brute(docs, items)
    assert {k: round(v, 9) for k, v in got.items()} == {k: round(v, 9) for k, v in want.items()}
    kept = [r.doc_id for r in dc.decontaminate(d, b).collect()]
    assert sorted(kept) == sorted(k for k, _ in docs if k not in {x for x, _ in want})


def test_multi_index_finds_all_within_radius(spark):
    r = random.Random(4)
    base = [r.getrandbits(64) for _ in range(8)]
    near = [(i, b ^ sum(1 << x for x in r.sample(range(64), k))) for i, b in enumerate(base)
            for k in (0, 7, 15)]
    sign = lambda x: x - (1 << 64) if x >> 63 else x
    items = spark.createDataFrame([(i, 9, sign(b)) for i, b in enumerate(base)], "item int, size int, fp long")
    index = dc.variants(items, dc.BLOCKS, dc.RADIUS)
    probe = spark.createDataFrame([(i, sign(f)) for i, f in near], "of int, w long").withColumn(
        "p", F.explode(F.array(*[F.struct(F.lit(b).alias("block"), v.alias("value"))
                                 for b, v in enumerate(dc._blocks(F.col("w"), dc.BLOCKS))])))
    hit = probe.join(index, (F.col("p.block") == index.block) & (F.col("p.value") == index.value)
                     & (F.col("of") == index["item"])).select("of", "w").distinct()
    assert hit.count() == len(set(near))


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert dc.find_leaks(none, items).count() == 0
    some = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    assert dc.find_leaks(some, items.limit(0)).count() == 0
    assert dc.find_leaks(some, items).count() == 1


def test_simhash(spark):
    r = random.Random(9)
    rows = [([r.getrandbits(64) - (1 << 63) for _ in range(n)],) for n in (1, 2, 3, 36)] + [([7, 7, -1],)]
    got = [x[0] for x in spark.createDataFrame(rows, "h array<long>").select(dc.simhash(F.col("h"))).collect()]
    want = [sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) for h, in rows]
    assert [g % (1 << 64) for g in got] == want


def test_short_items_inside_longer_texts(spark):
    items = [(1, "one two three"), (2, "Single"), (3, "four, words; in line"), (4, "w1 w2"), (5, "w1 w2 w3 w4 w5 w6")]
    docs = [(1, "some text that counts one, two; THREE and goes on"), (2, "one two four three"), (3, "a single"),
            (4, "single"), (5, "w1 w2 w3 w4 w5 w6 w1 w2"), (6, "four words in line"), (None, "four words in"),
            (7, ""), (8, None), (9, "one two"), (10, "one two three")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    rows = dc.find_leaks(d, b).collect()
    assert {(r.doc_id, r.item_id): r.similarity for r in rows} == brute(docs, items)
    assert sorted((r.start_word, r.n_words) for r in rows if r.doc_id == 5) == [(0, 2), (0, 6), (6, 2)]
    assert {r.doc_id for r in dc.decontaminate(d, b).collect()} == {2, None, 7, 8, 9}


def test_scripts_without_spaces(spark):
    long, short = "\u4eca\u65e5\u306f\u3068\u3066\u3082\u826f\u3044\u5929\u6c17\u3067\u3059", "\u6771\u4eac\u90fd"
    b = spark.createDataFrame([(1, long), (2, short)], "item_id long, text string")
    d = spark.createDataFrame([(1, "\u524d" * 9 + long + "\u5f8c" * 9), (2, "\u5927" + short + "\u5e81"),
                               (3, "\u5927\u5e81\u6771\u4eac"), (4, "plain")], "doc_id long, text string")
    got = {(r.doc_id, r.item_id, r.start_word, r.n_words) for r in dc.find_leaks(d, b).filter("similarity = 1").collect()}
    assert got == {(1, 1, 9, len(long)), (2, 2, 1, 3)}
