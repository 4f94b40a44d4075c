"""Embedding near-duplicates by hierarchical navigable small-world graphs.

Equal vectors are one class; classes are dealt to ``shards`` by hash and one
task builds the graph of a shard.  Its beam width starts at ``BEAM`` and is
doubled until an audit passes: vectors turned away from stored ones to a
cosine of exactly the threshold must find them again in at least ``RECALL`` of
the cases, and stored vectors the neighbours that brute force over the shard
finds.  A shard that fails its audit even with a beam as wide as itself (rows that no
link reaches) is searched by brute force in blocks.  Then every class queries every shard (a grid of query blocks and
shards, each a task).  A query whose whole beam lies above the threshold is
repeated with twice the beam, so a group larger than the beam is found whole.
What comes near the threshold is verified by cosine in double precision and
counted and united in the task; what tasks have united meets in ``components``.

Memory of a task: one shard's graph (vectors in single precision and as given,
32 links a vector) and one block of queries.  ``deal`` derives shards and
blocks of each dimension from its count of classes, so that either stays near
``TASK_BYTES``: a larger table makes more tasks, not larger ones.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components link with nothing; vectors of different length are not compared; of equal
vectors none is first (each counts the others, the least id names them);
repeated rows count as vectors of their own; extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinetra.llm.components import components, flatten, unite
from kinetra.session import materialize

THRESHOLD = 0.9
#: Least number of shards and blocks of a dimension, and bytes of either (51,000
#: vectors of 64 single-precision components).
SHARDS = BLOCKS = 8
TASK_BYTES = 32 << 20
DEGREE, BUILD_BEAM, BEAM = 16, 48, 48
RECALL, AUDIT = 0.98, 200
BATCH, EXPAND, ENTRIES = 256, 4, 4
#: Single precision finds candidates, double precision decides.
SLACK = 1e-4


def _dots(q: np.ndarray, vec: np.ndarray, ids: np.ndarray) -> np.ndarray:
    return np.matmul(vec[ids], q[:, :, None])[:, :, 0]


def _diverse(sim: np.ndarray, ids: np.ndarray, vec: np.ndarray, m: int) -> np.ndarray:
    """Up to ``m`` of each row's candidates (-1: none): the nearest ones that
    are nearer to the row than to one already taken, then the nearest others."""
    order = np.argsort(-sim, 1, kind="stable")
    sim, ids = np.take_along_axis(sim, order, 1), np.take_along_axis(ids, order, 1)
    valid = ids >= 0
    near = vec[np.maximum(ids, 0)]
    between = np.matmul(near, near.transpose(0, 2, 1))
    taken = np.zeros(ids.shape, bool)
    for c in range(ids.shape[1]):
        closest = np.where(taken, between[:, c], -2.0).max(1)
        taken[:, c] = valid[:, c] & (sim[:, c] > closest) & (taken.sum(1) < m)
    rank = np.argsort(np.where(taken, 0, np.where(valid, 1, 2)), 1, kind="stable")[:, :m]
    out = np.take_along_axis(ids, rank, 1)
    return np.pad(out, ((0, 0), (0, m - out.shape[1])), constant_values=-1)


@dataclass
class Layer:
    """One level: its vectors in the order they are inserted, and their links."""

    ids: np.ndarray                 # row of the shard
    vec: np.ndarray
    links: np.ndarray
    size: int = 0

    def search(self, q: np.ndarray, entry: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, similarities) of the beam of each query, -1 where it is not full."""
        n = len(q)
        ids = np.full((n, beam), -1, np.int64)
        sim = np.full((n, beam), -2.0, np.float32)
        done = np.ones((n, beam), bool)
        seen = np.zeros((n, self.size), bool)
        fresh = entry
        alive = np.arange(n)
        while len(alive):
            ok = fresh >= 0
            safe = np.maximum(fresh, 0)
            ok &= ~seen[alive[:, None], safe]
            # of repeats within a row the first counts
            order = np.argsort(safe, 1, kind="stable")
            s = np.take_along_axis(safe, order, 1)
            again = np.zeros(s.shape, bool)
            again[:, 1:] = s[:, 1:] == s[:, :-1]
            repeated = np.empty_like(again)
            np.put_along_axis(repeated, order, again, 1)
            row, col = np.nonzero(ok & ~repeated)
            at = safe[row, col]
            seen[alive[row], at] = True
            new = np.full(fresh.shape, -2.0, np.float32)
            new[row, col] = np.einsum("nd,nd->n", q[alive[row]], self.vec[at])
            both_sim = np.concatenate([sim[alive], new], 1)
            both_ids = np.concatenate([ids[alive], np.where(new > -2, fresh, -1)], 1)
            both_done = np.concatenate([done[alive], new <= -2], 1)
            best = np.argsort(-both_sim, 1, kind="stable")[:, :beam]
            sim[alive] = np.take_along_axis(both_sim, best, 1)
            ids[alive] = np.take_along_axis(both_ids, best, 1)
            done[alive] = np.take_along_axis(both_done, best, 1)
            alive = alive[~done[alive].all(1)]
            if not len(alive):
                break
            first = np.argsort(done[alive], 1, kind="stable")[:, :EXPAND]
            rows = alive[:, None]
            usable = ~done[rows, first]
            from_ = np.where(usable, ids[rows, first], 0)
            done[rows, first] = True
            fresh = np.where(usable[:, :, None], self.links[from_], -1).reshape(len(alive), -1)
        return ids, sim

    def insert(self, new: np.ndarray, entry: np.ndarray, degree: int) -> None:
        """Link rows ``new`` (the next in order) with what is there and each other."""
        q = self.vec[new]
        own = q @ q.T
        np.fill_diagonal(own, -2)
        own_ids = np.where(own > -2, new[None, :], -1)
        if len(new) > BUILD_BEAM:
            top = np.argpartition(-own, BUILD_BEAM, 1)[:, :BUILD_BEAM]
            own, own_ids = np.take_along_axis(own, top, 1), np.take_along_axis(own_ids, top, 1)
        if self.size:
            ids, sim = self.search(q, entry, BUILD_BEAM)
            own, own_ids = np.concatenate([sim, own], 1), np.concatenate([ids, own_ids], 1)
        chosen = _diverse(own, own_ids, self.vec, degree)
        self.links[new, :degree] = chosen
        self.size = int(new[-1]) + 1
        row, col = np.nonzero(chosen >= 0)
        to, frm = chosen[row, col], new[row]
        order = np.lexsort((-np.einsum("nd,nd->n", self.vec[to], self.vec[frm]), to))
        to, frm = to[order], frm[order]
        nodes, start, count = np.unique(to, return_index=True, return_counts=True)
        cap = self.links.shape[1]
        extra = np.full((len(nodes), min(cap, int(count.max(initial=1)))), -1, np.int64)
        place = np.arange(len(to)) - np.repeat(start, count)
        fits = place < extra.shape[1]
        extra[np.repeat(np.arange(len(nodes)), count)[fits], place[fits]] = frm[fits]
        known = self.links[nodes]
        extra[(extra[:, :, None] == known[:, None, :]).any(2)] = -1
        cand = np.concatenate([known, extra], 1)
        for i in range(0, len(nodes), BATCH):
            c, at = cand[i:i + BATCH], nodes[i:i + BATCH]
            s = np.where(c >= 0, _dots(self.vec[at], self.vec, np.maximum(c, 0)), -2)
            self.links[at] = _diverse(s, c, self.vec, cap)


@dataclass
class Graph:
    layers: list[Layer] = field(default_factory=list)   # the lowest is the last
    beam: int = BEAM
    exact: bool = False             # links do not reach every row: compare with all

    def enter(self, q: np.ndarray, down_to: int) -> np.ndarray:
        """Entry rows for layer ``down_to`` by descent from the top."""
        entry = np.zeros((len(q), 1), np.int64)
        for k in range(down_to):
            ids, _ = self.layers[k].search(q, entry, 2 * ENTRIES)
            ids = ids[:, :ENTRIES]
            # a row of a layer is also a row of the next, at the same place
            entry = ids
        return entry

    def near(self, q: np.ndarray, least: float, beam: int | None = None
             ) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) pairs of similarity ``least`` or more."""
        out_q, out_r = [], []
        base = self.layers[-1]
        if self.exact:
            batch = max(16, min(BATCH, (1 << 22) // max(base.size, 1)))
            for i in range(0, len(q), batch):
                row, col = np.nonzero(q[i:i + batch] @ base.vec.T >= least)
                out_q.append(row + i)
                out_r.append(col)
            return np.concatenate(out_q or [np.zeros(0, int)]), np.concatenate(out_r or [np.zeros(0, int)])
        todo, beam = np.arange(len(q)), beam or self.beam
        while len(todo):
            beam = min(beam, base.size)
            batch = max(16, min(BATCH, (1 << 22) // max(base.size, 32 * beam)))
            full = []
            for i in range(0, len(todo), batch):
                t = todo[i:i + batch]
                ids, sim = base.search(q[t], self.enter(q[t], len(self.layers) - 1), beam)
                hit = (sim >= least) & (ids >= 0)
                again = hit.all(1) & (beam < base.size)
                full.append(t[again])
                row, col = np.nonzero(hit & ~again[:, None])
                out_q.append(t[row])
                out_r.append(ids[row, col])
            todo, beam = np.concatenate(full), beam * 2
        return np.concatenate(out_q or [np.zeros(0, int)]), np.concatenate(out_r or [np.zeros(0, int)])


def unit(vec: np.ndarray) -> np.ndarray:
    v = vec.astype(np.float64)
    v /= np.abs(v).max(1, keepdims=True)
    return (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)


def build(vec: np.ndarray, seed: int, least: float, degree: int = DEGREE) -> tuple[Graph, np.ndarray]:
    """The graph over unit vectors and the order in which it holds them."""
    rng = np.random.default_rng(seed)
    level = (-np.log(1 - rng.random(len(vec))) / np.log(degree)).astype(int)
    order = np.argsort(-level, kind="stable")   # rows of upper layers come first in all layers
    vec, level = vec[order], level[order]
    graph = Graph()
    for k in range(int(level.max()), -1, -1):
        n = int((level >= k).sum())
        layer = Layer(np.arange(n), vec[:n], np.full((n, degree * (1 if k else 2)), -1, np.int32))
        graph.layers.append(layer)
        done = 0
        while done < n:
            new = np.arange(done, min(n, done + max(32, min(BATCH, done))))
            entry = graph.enter(vec[new], len(graph.layers) - 1)
            entry = np.where(entry < done, entry, 0)
            layer.insert(new, entry, degree)
            done += len(new)
    while (recall := audit(graph, vec, rng, least)) < RECALL and graph.beam < len(vec):
        graph.beam *= 2
    graph.exact = recall < RECALL
    return graph, order


def audit(graph: Graph, vec: np.ndarray, rng: np.random.Generator, least: float) -> float:
    """Least recall of two probes: turned vectors, and stored ones by brute force."""
    pick = rng.choice(len(vec), min(AUDIT, len(vec)), replace=False)
    v = vec[pick]
    away = rng.standard_normal(v.shape).astype(np.float32)
    away -= (away * v).sum(1, keepdims=True) * v
    away /= np.maximum(np.linalg.norm(away, axis=1, keepdims=True), 1e-12)
    turned = least * v + (1 - least * least) ** 0.5 * away
    q, r = graph.near(turned, least - SLACK)
    found = np.isin(np.arange(len(pick)), q[r == pick[q]]).mean()
    q, r = graph.near(v, least)
    got = len(q)
    true = int((v @ vec.T >= least).sum())
    return float(min(found, got / max(true, 1)))


def _verified(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a, b = a.astype(np.float64), b.astype(np.float64)
    a /= np.abs(a).max(1, keepdims=True)
    b /= np.abs(b).max(1, keepdims=True)
    dot = np.einsum("nd,nd->n", a, b)
    return dot / np.sqrt(np.einsum("nd,nd->n", a, a) * np.einsum("nd,nd->n", b, b))


def classes(vectors: DataFrame, key: str, value: str) -> tuple[DataFrame, DataFrame]:
    """Rows (key, cid; null for vectors that link with nothing) and classes
    (cid, v, dim, n) of equal vectors."""
    v = F.col(value)
    fit = F.coalesce((F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (
        F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(key).alias("id"), F.when(fit, v).alias("v"))
    known = materialize(rows.filter("v IS NOT NULL").groupBy("v").agg(F.count(F.lit(1)).alias("n"))
                        .select(F.monotonically_increasing_id().alias("cid"), "v",
                                F.size("v").alias("dim"), "n"), "vector-classes")
    ids = rows.filter("v IS NOT NULL").join(known.select("cid", "v"), "v").select("id", "cid")
    return materialize(ids.unionByName(rows.filter("v IS NULL").select(
        "id", F.lit(None).cast("long").alias("cid"))), "vector-ids"), known


def deal(known: DataFrame, shards: int | None = None, blocks: int | None = None,
         task_bytes: int = TASK_BYTES) -> DataFrame:
    """(dim, shards, blocks, tasks) of each dimension of the classes; what is
    not given follows from the count of its classes.  ``tasks`` counts full
    ones, so that many small dimensions share theirs."""
    value = known.schema["v"].dataType.elementType
    each = F.col("dim").cast("long") * (4 + (4 if isinstance(value, T.FloatType) else 8)) + 144
    full = F.ceil(F.col("n") * each / F.lit(task_bytes))
    count = [F.lit(given) if given else F.greatest(full, F.lit(least))
             for given, least in ((shards, SHARDS), (blocks, BLOCKS))]
    return known.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).select(
        "dim", count[0].cast("long").alias("shards"), count[1].cast("long").alias("blocks"),
        (full * full).cast("long").alias("tasks"))


def links(known: DataFrame, threshold: float = THRESHOLD, shards: int | None = None,
          blocks: int | None = None, task_bytes: int = TASK_BYTES) -> tuple[DataFrame, DataFrame]:
    """What the classes of cosine ``threshold`` or more amount to: (a, b)
    links that join all of them, at most one per class and task, and (cid,
    others) with the number of vectors that each class links with.  A task
    counts and unites what it finds; pairs do not leave it."""
    sizes = materialize(deal(known, shards, blocks, task_bytes), "dealing")
    total = sizes.agg(F.max("shards").alias("shards"), F.sum("tasks").alias("tasks"),
                      F.max(F.col("shards") * F.col("blocks")).alias("most")).first()
    builds = max(total.shards or 1, round((total.tasks or 1) ** 0.5))
    tasks = max(total.most or 1, total.tasks or 1)
    sized = known.join(sizes.select("dim", "shards", "blocks"), "dim")
    dealt = sized.select("cid", "v", "dim", "n", "blocks",
                         F.expr("pmod(xxhash64(cid), shards)").alias("shard"))

    def graphs(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("cid", ignore_index=True)
        vec = np.stack(pdf["v"].to_numpy())
        graph, order = build(unit(vec), int(pdf["shard"].iloc[0]), threshold)
        data = pickle.dumps((graph, pdf["cid"].to_numpy()[order], vec[order],
                             pdf["n"].to_numpy()[order]), protocol=5)
        return pd.DataFrame({"dim": pdf["dim"].iloc[:1], "shard": pdf["shard"].iloc[:1],
                             "blocks": pdf["blocks"].iloc[:1], "graph": [data]})

    built = materialize(dealt.repartition(builds, "dim", "shard").groupBy("dim", "shard").applyInPandas(
        graphs, "dim int, shard long, blocks long, graph binary"), "graphs")
    block = F.explode(F.expr("sequence(0L, blocks - 1)")).alias("block")
    queries = sized.select("cid", "v", "dim", F.expr("pmod(xxhash64(cid, 1), blocks)").alias("block"),
                           F.explode(F.expr("sequence(0L, shards - 1)")).alias("shard")
                           ).repartition(tasks, "dim", "shard", "block")
    served = built.select("dim", "shard", "graph", block).repartition(tasks, "dim", "shard", "block")

    def search(q: pd.DataFrame, g: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(g):
            return pd.DataFrame({"a": [], "b": [], "others": []}, dtype="Int64")
        graph, cids, vec, weight = pickle.loads(g["graph"].iloc[0])
        own, raw = q["cid"].to_numpy(), np.stack(q["v"].to_numpy())
        others = np.zeros(len(own), np.int64)
        label = np.arange(len(own) + len(cids))          # queries, then the shard's rows
        for k in range(0, len(own), BATCH):
            i, j = graph.near(unit(raw[k:k + BATCH]), threshold - SLACK)
            i = i + k
            keep = own[i] != cids[j]
            i, j = i[keep], j[keep]
            true = _verified(raw[i], vec[j]) >= threshold
            i, j = i[true], j[true]
            np.add.at(others, i, weight[j])
            unite(label, i, len(own) + j)
        flatten(label)
        name = np.concatenate([own, cids])
        moved = np.flatnonzero(label != np.arange(len(label)))
        some = np.flatnonzero(others)
        return pd.concat([
            pd.DataFrame({"a": name[moved], "b": name[label[moved]]}, dtype="Int64"),
            pd.DataFrame({"a": own[some], "others": others[some]}, dtype="Int64")])[["a", "b", "others"]]

    found = materialize(queries.groupBy("dim", "shard", "block").cogroup(
        served.groupBy("dim", "shard", "block")).applyInPandas(search, "a long, b long, others long"),
        "vector-links")
    counts = found.filter("others IS NOT NULL").groupBy(F.col("a").alias("cid")).agg(
        F.sum("others").alias("others"))
    return found.filter("b IS NOT NULL AND a <> b").select("a", "b"), counts


def near_duplicates(vectors: DataFrame, key: str = "vec_id", value: str = "embedding",
                    threshold: float = THRESHOLD, shards: int | None = None,
                    blocks: int | None = None, task_bytes: int = TASK_BYTES) -> DataFrame:
    """One row per vector: key, n_links, component_id, kept."""
    ids, known = classes(vectors, key, value)
    found, others = links(known, threshold, shards, blocks, task_bytes)
    comp = components(found).withColumnRenamed("node", "cid")
    table = materialize(known.select("cid", "n").join(others, "cid", "left").join(comp, "cid", "left").select(
        "cid", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
        F.coalesce("component", "cid").alias("root")), "class-links")
    rows = ids.join(table, "cid", "left")
    least = materialize(rows.filter("root IS NOT NULL").groupBy("root").agg(F.min("id").alias("least")),
                        "component-ids")
    return rows.join(least, "root", "left").select(
        F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("least", "id").alias("component_id")).withColumn(
        "kept", F.col(key).eqNullSafe(F.col("component_id")))
