"""Resharding by minimum-cost flow: from the sizes of the old shards and the
capacities of the new ones, the block transfers that move the fewest bytes, and a
rewrite of the shards that they affect.

1. One pass over the texts measures the rows.  Rows of an old shard are dealt into
   blocks by a hash of their place in the input (file and row number); an old shard
   has blocks in proportion to its bytes.  Only the blocks' sizes reach the driver:
   ``new shards x (BLOCKS + 1) + 1`` rows of four numbers at most (6,169 for 24
   shards), whatever the table holds.
2. The law is ``bytes``: every new shard may take an even share.  A block above the
   share of what is left (one huge text) gets a shard of its own, and the others share
   the rest.
3. ``min_cost_flow`` ships the old shards' bytes to the capacities; a byte that
   stays in the shard of its number costs nothing, any other byte 1 (or the
   caller's price).  The flow says how many bytes go from i to j.
4. Blocks realise the flow: within an old shard the largest block goes where the most
   of the flow is still open.  Blocks do not divide, so shards end a part of a block
   off; while the fullest shard holds a block that is smaller than its lead over the
   emptiest one, that block goes there.
5. A shard is rewritten only if a block leaves it or comes to it: its rows are shuffled
   once, by (shard, part of the shard), and written below ``shard=<n>``.  Other
   shards keep their files and are read where they are.

A hot source, key or group of copies does not matter: places are hashed, not values.

Defined cases: a null text is empty (size 8, the overhead alone).  Null ids, equal rows
and ties are rows like others, each with a place of its own.  The rows' columns are kept
together in the struct ``doc``, so no name clashes.  A null old shard, or one that is not
a new shard's number, is dissolved: all its blocks move.  An empty table gives an empty
result.  Very long texts: a text above the even share fills a shard of its own.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinetra.session import materialize, scratch_path

#: Blocks for every new shard.
BLOCKS = 256
#: Bytes that a row takes besides its text.
OVERHEAD = 8
#: Bytes of one written part of a shard, and its least number of parts.
PART_BYTES = 128 << 20
LEAST_PARTS = 4
#: The old shard of rows that had none of the new numbers.
DISSOLVED = -1


def min_cost_flow(supply: list[int], capacity: list[int], price: np.ndarray) -> np.ndarray:
    """Flow (old x new, whole bytes) that ships all of ``supply`` within ``capacity`` at
    the least total of flow x price.  Successive shortest paths with potentials; both
    sides are shards, so the network is small.  Ties take the lowest numbers."""
    m, n = price.shape
    if sum(supply) > sum(capacity):
        raise ValueError("the new shards cannot hold the old ones")
    flow = np.zeros((m, n), np.int64)
    left, room = list(map(int, supply)), list(map(int, capacity))
    up, down = np.zeros(m), np.zeros(n)              # potentials of old and new shards
    for i in range(m):
        while left[i]:
            # Dijkstra over reduced prices: old -> new at price, new -> old back along flow
            dist_old, dist_new = np.full(m, np.inf), np.full(n, np.inf)
            from_old, from_new = np.full(n, -1), np.full(m, -1)
            dist_old[i] = 0.0
            queue, done = [(0.0, 0, i)], set()
            end = -1
            while queue:
                d, side, node = heapq.heappop(queue)
                if (side, node) in done:
                    continue
                done.add((side, node))
                if side == 0:
                    near = d + price[node] + up[node] - down
                    for j in np.flatnonzero(near < dist_new - 1e-9):
                        dist_new[j], from_old[j] = near[j], node
                        heapq.heappush(queue, (float(near[j]), 1, int(j)))
                else:
                    if room[node]:
                        end = node
                        break
                    for k in np.flatnonzero(flow[:, node]):
                        back = d - price[k, node] - up[k] + down[node]
                        if back < dist_old[k] - 1e-9:
                            dist_old[k], from_new[k] = back, node
                            heapq.heappush(queue, (float(back), 0, int(k)))
            path, j = [], end
            while True:
                k = int(from_old[j])
                path.append((k, j))
                if k == i:
                    break
                j = int(from_new[k])
                path.append((k, j))
            amount = min([left[i], room[end], *[int(flow[e]) for e in path[1::2]]])
            for step, e in enumerate(path):
                flow[e] += amount if step % 2 == 0 else -amount
            left[i] -= amount
            room[end] -= amount
            reach = dist_new[end]
            up += np.minimum(dist_old, reach)
            down += np.minimum(dist_new, reach)
    return flow


def stay_free(old: list[int], n: int) -> np.ndarray:
    """Price of a byte from each old shard to each new one: 0 for staying, else 1."""
    return (np.asarray(old)[:, None] != np.arange(n)).astype(float)


def deal_blocks(blocks: list[tuple[int, int, int]], n: int,
                price: Callable[[list[int], int], np.ndarray] = stay_free) -> list[int]:
    """The new shard of every block (old shard, number, bytes)."""
    size = np.array([b[2] for b in blocks], np.int64)
    target = np.full(len(blocks), -1)
    load = np.zeros(n, np.int64)
    # one huge block after the other takes a shard of its own
    free, rest = list(range(n)), int(size.sum())
    for x in np.argsort(-size, kind="stable"):
        if len(free) < 2 or size[x] * len(free) <= rest:
            break
        j = blocks[x][0] if blocks[x][0] in free else free[0]
        target[x], load[j] = j, size[x]
        free.remove(j)
        rest -= int(size[x])
    open_ = np.flatnonzero(target < 0)
    olds = sorted({blocks[x][0] for x in open_})
    row = {o: i for i, o in enumerate(olds)}
    supply = np.zeros(len(olds), np.int64)
    for x in open_:
        supply[row[blocks[x][0]]] += size[x]
    share = [0] * n
    for k, j in enumerate(free):
        share[j] = rest // len(free) + (k < rest % len(free))
    wanted = min_cost_flow(supply.tolist(), share, price(olds, n)) if len(olds) else None
    for x in sorted(open_, key=lambda x: (-size[x], blocks[x][:2])):
        i = row[blocks[x][0]]
        j = int(np.argmax(wanted[i]))
        wanted[i, j] -= size[x]
        target[x], load[j] = j, load[j] + size[x]
    _even_out(size, target, load)
    return target.tolist()


def _even_out(size: np.ndarray, target: np.ndarray, load: np.ndarray) -> None:
    """Move blocks from the fullest shard that can give to the emptiest one, the
    largest that lessens their difference, until none does."""
    inside = [sorted(((int(size[x]), int(x)) for x in np.flatnonzero(target == j))) for j in range(len(load))]
    while True:
        lo = int(np.argmin(load))
        for hi in np.argsort(-load, kind="stable"):
            lead = int(load[hi] - load[lo])
            fit = next((b for b in reversed(inside[hi]) if 0 < b[0] < lead), None)
            if fit:
                break
        else:
            return
        inside[hi].remove(fit)
        inside[lo].append(fit)
        inside[lo].sort()
        target[fit[1]] = lo
        load[hi] -= fit[0]
        load[lo] += fit[0]


def _placed(docs: DataFrame, old: Column, n: int) -> DataFrame:
    """doc (all columns), old (number of the shard so far) and the row's place."""
    try:
        docs.select("_metadata.row_index")
    except AnalysisException:            # not read from Parquet
        docs = materialize(docs, "rows")
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                       F.when((old >= 0) & (old < n), old.cast("int")).otherwise(DISSOLVED).alias("old"),
                       F.xxhash64("_metadata.file_path").alias("file"),
                       F.col("_metadata.row_index").alias("row"))


def text_bytes(doc: str = "doc") -> Column:
    return F.coalesce(F.col(f"{doc}.text").cast("string"), F.lit("")).cast("binary")


PLAN = "old int, block int, shard int, first long, moved boolean, part_count int"


def plan(blocks: DataFrame, n: int) -> list[tuple]:
    """Rows of ``PLAN`` for the measured blocks (old, block, bytes, n_rows).  ``first``
    is the slot of the block's first row: blocks of a shard follow each other."""
    rows = sorted((r.old, r.block, r.bytes, r.n_rows) for r in blocks.collect())
    target = deal_blocks([r[:3] for r in rows], n)
    filled, load = [0] * n, [0] * n
    for r, shard in zip(rows, target):
        load[shard] += r[2]
    out = []
    for (old, block, _, n_rows), shard in zip(rows, target):
        out.append((old, block, shard, filled[shard], old != shard,
                    max(LEAST_PARTS, -(-load[shard] // PART_BYTES))))
        filled[shard] += n_rows
    return out


def reshard(docs: DataFrame, old: Column, n: int, path: str | None = None) -> DataFrame:
    """Deal ``docs`` (with a text column), now in the shards ``old``, to ``n`` shards of
    near equal bytes and write the affected ones below ``path``.

    Returns doc (struct of the row's columns), size (UTF-8 bytes of the text and the
    overhead), text_crc32, old, shard, slot (gapless from 0 in each shard) and moved;
    rows of rewritten shards are read back from ``path``."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "shards")
    size = F.octet_length(text_bytes()).cast("long") + OVERHEAD
    rows = _placed(docs, old, n)
    measured = materialize(rows.select("old", "file", "row", size.alias("size")), "row-sizes")
    of_old = {r.old: r.bytes for r in measured.groupBy("old").agg(F.sum("size").alias("bytes")).collect()}
    even = max(1, -(-sum(of_old.values()) // (n * BLOCKS)))         # bytes of a block
    n_blocks = F.lit([-(-of_old.get(o, 0) // even) for o in range(DISSOLVED, n)])
    block = F.pmod(F.xxhash64("file", "row"), F.get(n_blocks, F.col("old") - DISSOLVED)).cast("int")
    moves = plan(measured.groupBy("old", block.alias("block")).agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n_rows")), n)

    # one row a block, see above for their number
    dealt = rows.withColumn("block", block).join(
        F.broadcast(spark.createDataFrame(moves, PLAN)), ["old", "block"])
    within = Window.partitionBy("shard", "part", "old", "block").orderBy("file", "row")
    placed = dealt.withColumn("part", F.pmod("block", "part_count")).repartition("shard", "part").select(
        "doc", "old", "shard", (F.col("first") + F.row_number().over(within) - 1).alias("slot"), "moved")
    touched = sorted({s for r in moves if r[4] for s in (r[0], r[2]) if s != DISSOLVED})
    affected = F.col("shard").isin(touched)
    placed.filter(affected).write.partitionBy("shard").parquet(path)
    every = spark.read.schema(placed.schema).parquet(path).select(placed.columns)
    if len(touched) < n:
        every = every.unionByName(placed.filter(~affected))
    return every.select("doc", size.alias("size"), F.crc32(text_bytes()).alias("text_crc32"),
                        "old", "shard", "slot", "moved")
