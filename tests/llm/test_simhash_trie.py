"""SimHash and its trie join against brute force."""

from __future__ import annotations

import numpy as np
import xxhash

from kinetra.llm import simhash_trie as st
from kinetra.llm.components import components


def slow_fingerprint(text):
    words, w = [], ""
    for c in (text or ""):
        c = c.lower() if "A" <= c <= "Z" else c
        if c in " \t\n\x0b\x0c\r":
            words, w = words + [w] if w else words, ""
        else:
            w += c
    words += [w] if w else []
    if not words:
        return 0
    sh = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(ids, fps, radius=3):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i in range(len(fps)):
        least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return [least[find(i)] for i in range(len(fps))]


def test_fingerprints():
    for t in ["", None, "  \n", "One", "a B c", "a b c d", "x y x y x y x y", "É é ẞ ß İ A", "w " * 700,
              "a b c d"]:
        assert st.fingerprint(t.encode() if t is not None else None) == slow_fingerprint(t), t


def dense(rng, n):
    """Random values and balls of values around some of them."""
    base = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = list(base[: n // 3])
    while len(out) < n:
        v = int(out[rng.integers(0, 6)])
        for b in rng.integers(0, 64, rng.integers(1, 5)):
            v ^= 1 << int(b)
        out.append(v)
    return [int(x) for x in {0, *map(int, out)}]


def check(spark, fps, **how):
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in fps]
    links = st.near_links(spark.createDataFrame(signed, "fp long").repartition(4), **how)
    comp = {r.node: r.component for r in components(links).collect()}
    got = [comp.get(s[0], s[0]) for s in signed]
    want = slow_components([s[0] for s in signed], fps, how.get("radius", 3))
    assert got == want


def test_links(spark):
    rng = np.random.default_rng(1)
    check(spark, dense(rng, 600))


def test_split_of_large_tries(spark):
    rng = np.random.default_rng(2)
    check(spark, dense(rng, 400), leaf_rows=10)


def test_components_long_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(0, 200)] + [(500, i) for i in range(501, 700)] + [(9000, 9000)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "x long, y long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{i: 500 for i in range(500, 700)}}
    assert components(spark.createDataFrame([], "x long, y long")).count() == 0


def test_documents(spark):
    texts = [(1, "a b c d e f g h"), (2, "A  b c d e f g h"), (3, None), (4, ""), (5, "\t"),
             (6, "something else entirely " * 50), (7, "something else entirely " * 51), (9, "solo"),
             (9, "solo"), (None, "a b c d e f g h")]
    docs = spark.createDataFrame([(*t, "x", 1) for t in texts],
                                 "doc_id long, text string, fp string, root int")
    rows = st.near_duplicates(docs).select("doc_id", "component_id", st.hexadecimal(
        st.F.col("fp")).alias("h")).collect()
    fps = [slow_fingerprint(t) for _, t in texts]
    want = slow_components([10**9 if i is None else i for i, _ in texts], fps)
    assert sorted((r.doc_id or 10**9, r.component_id, r.h) for r in rows) == sorted(
        (i or 10**9, c, f"{f:016x}") for (i, _), c, f in zip(texts, want, fps))
    assert st.near_duplicates(docs.limit(0)).count() == 0
