"""Embedding links against brute force."""

from __future__ import annotations

import numpy as np

from kinetra.llm import hnsw


def brute(rows):
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)
          for _, v in rows]
    n, root = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
                a, b = a / abs(a).max(), b / abs(b).max()
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.9:
                    n[i] += 1
                    n[j] += 1
                    x, y = find(i), find(j)
                    root[max(x, y)] = min(x, y)
    least = {}
    for i, (k, _) in enumerate(rows):
        least[find(i)] = min(k, least.get(find(i), k))
    return sorted((k, n[i], least[find(i)], k == least[find(i)]) for i, (k, _) in enumerate(rows))


def test_against_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((500, 24))
    cluster = base[0] + 0.15 * rng.standard_normal((200, 24))
    pairs = base[100:160] + 0.3 * rng.standard_normal((60, 24))
    vecs = [v.astype(np.float32).tolist() for v in np.concatenate([base, cluster, pairs, base[:30]])]
    vecs += [[0.0] * 24, None, [], [1.0, None] + [0.0] * 22, [float("nan")] * 24, [float("inf")] * 24,
             [1.0, 2.0], [2.0, 4.0], [1e-30] * 24, [3e30] * 24, [1.0]]
    ids = rng.permutation(len(vecs)).tolist()
    rows = list(zip(ids, vecs))
    df = spark.createDataFrame([(i, v, 7, "x") for i, v in rows],
                               "vec_id long, embedding array<float>, cid int, root string").repartition(3)
    got = sorted(tuple(r) for r in hnsw.near_duplicates(df, shards=3, blocks=2).collect())
    want = brute(rows)
    found = sum(r[1] for r in got) / sum(r[1] for r in want)
    assert 0.97 <= found <= 1.0
    assert all(g[1] <= w[1] for g, w in zip(got, want))
    assert sum(g == w for g, w in zip(got, want)) >= 0.97 * len(want)
    assert hnsw.near_duplicates(df.limit(0)).count() == 0


def test_repeated_rows(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in hnsw.near_duplicates(df, shards=2, blocks=2).collect())
    assert got == [(1, 1, 1, True), (1, 1, 1, True), (2, 0, 2, True), (3, 0, 3, True)]


def test_beam_widens_for_a_group_larger_than_the_beam():
    rng = np.random.default_rng(6)
    v = hnsw.unit(np.concatenate([rng.standard_normal((600, 16)),
                                  1 + 0.05 * rng.standard_normal((400, 16))]).astype(np.float32))
    graph, order = hnsw.build(v, 0, 0.9)
    q, r = graph.near(v[-400:], 0.9)
    true = int((v[-400:] @ v.T >= 0.9).sum())
    assert true >= 400 * 400 and len(q) >= 0.99 * true


def test_tasks_grow_in_number_and_not_in_size(spark):
    rng = np.random.default_rng(7)
    base = rng.standard_normal((300, 8)).astype(np.float32)
    vecs = np.concatenate([base, base[:40] + 0.01]).astype(np.float32).tolist() + [[1.0, 2.0], [3.0, 6.1]]
    rows = list(enumerate(vecs))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    each = 8 * 8 + 144                                # bytes of a vector
    _, known = hnsw.classes(df, "vec_id", "embedding")
    dealt = {r.dim: (r.shards, r.blocks) for r in hnsw.deal(known, task_bytes=25 * each).collect()}
    assert dealt == {8: (14, 14), 2: (8, 8)}
    assert {r.shards for r in hnsw.deal(known).collect()} == {hnsw.SHARDS}
    got = sorted(tuple(r) for r in hnsw.near_duplicates(df, task_bytes=25 * each).collect())
    assert got == brute(rows)


def test_a_shard_that_fails_its_audit_is_searched_whole(monkeypatch):
    rng = np.random.default_rng(8)
    v = hnsw.unit(np.repeat(rng.standard_normal((60, 12)), 5, 0).astype(np.float32)
                  + 0.02 * rng.standard_normal((300, 12)).astype(np.float32))
    monkeypatch.setattr(hnsw, "_diverse", lambda sim, ids, vec, m: np.full((len(ids), m), -1))  # no links at all
    graph, order = hnsw.build(v, 0, 0.9)
    assert graph.exact and graph.beam >= len(v)
    q, r = graph.near(v, 0.9)
    want = np.argwhere(v @ v[order].T >= 0.9)
    assert sorted(zip(q.tolist(), r.tolist())) == sorted(map(tuple, want.tolist()))
