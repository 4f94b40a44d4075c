"""SimHash near-duplicates by a self-join of binary tries.

Fingerprints within ``radius`` bits are found by walking pairs of trie nodes
together: a pair carries the bits in which its two prefixes differ, its four
child pairs add one where the next bits differ, and a pair over the budget is
dropped with everything below it.

The tries are dealt out by exact prefixes: with ``radius + 1`` blocks of bits,
two fingerprints within the radius agree in at least one whole block.  Each
block leads one trie (the bits are rotated to begin with it); its value names
the subtrie, which one task walks.  A subtrie of more than ``leaf_rows``
fingerprints is first split by ``split_bits`` more bits into pairs of child
tries with what is left of the budget, again and again, so a bucket that holds
a third of all fingerprints becomes many tasks.  A task unites what it links
and emits at most one link per fingerprint, never the pairs of a group.

Defined cases: a null, empty or blank text has fingerprint zero; repeated
rows and equal fingerprints are linked; extra columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinetra.llm.components import components, flatten, unite
from kinetra.session import materialize

BITS = 64
SHINGLE, RADIUS, SEED = 3, 3, 42
#: Fingerprints of a subtrie that one task walks whole.
LEAF_ROWS = 20_000
SPLIT_BITS = 4
#: Node pairs that are expanded at once, and below which pairs are compared directly.
FRONTIER, DIRECT = 200_000, 8

_BIT_OF_BYTE = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_LANE = (np.arange(8) * 256).astype(np.int64)


def fingerprint(text: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of the word shingles of a UTF-8 text (A-Z lower-cased;
    words end at ASCII white space)."""
    from xxhash import xxh64_intdigest

    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxh64_intdigest(b" ".join(words), seed)
    shifted = [words[i:] for i in range(shingle)]
    hashes = np.fromiter((xxh64_intdigest(b" ".join(s), seed) for s in zip(*shifted)),
                         np.uint64, len(words) - shingle + 1)
    lanes = hashes.view(np.uint8).reshape(-1, 8) + _LANE
    counts = np.bincount(lanes.ravel(), minlength=2048).reshape(8, 256) @ _BIT_OF_BYTE
    bits = (counts.ravel() * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text",
                 shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(key, fp) per row; fp is the fingerprint's 64 bits as a signed long."""
    kind = docs.schema[key].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle, seed) for t in b.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))],
                                             names=[key, "fp"])

    return docs.select(key, F.col(text).cast("string").cast("binary").alias("t")).mapInArrow(
        scan, f"`{key}` {kind}, fp long")


def walk(fps: np.ndarray, left: np.ndarray, right: np.ndarray, budget: np.ndarray,
         first_bit: int) -> np.ndarray:
    """Roots after linking, for each row of ``fps`` (sorted within each node),
    over node pairs: ``left`` and ``right`` are [n, 2] row ranges, ``budget``
    the bits that may still differ.  Bits are walked from ``first_bit`` (counted
    from the top) on."""
    label = np.arange(len(fps))
    stack = [(first_bit, left, right, budget)]
    while stack:
        bit, l, r, k = stack.pop()
        if len(k) > FRONTIER:
            half = len(k) // 2
            stack += [(bit, l[half:], r[half:], k[half:]), (bit, l[:half], r[:half], k[:half])]
            continue
        small = ((l[:, 1] - l[:, 0]) * (r[:, 1] - r[:, 0]) <= DIRECT) | (bit >= BITS)
        if small.any():
            n_r = (r[small, 1] - r[small, 0])
            n = (l[small, 1] - l[small, 0]) * n_r
            pair = np.repeat(np.arange(len(n)), n)
            within = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)
            a = l[small, 0][pair] + within // n_r[pair]
            b = r[small, 0][pair] + within % n_r[pair]
            near = (a < b) & (np.bitwise_count(_low_bits(fps[a] ^ fps[b], bit)) <= k[small][pair])
            unite(label, a[near], b[near])
            l, r, k = l[~small], r[~small], k[~small]
        if not len(k):
            continue
        ones = np.concatenate([[0], np.cumsum((fps >> np.uint64(BITS - 1 - bit)) & np.uint64(1))]
                              ).astype(np.int64)
        lm = l[:, 1] - (ones[l[:, 1]] - ones[l[:, 0]])
        rm = r[:, 1] - (ones[r[:, 1]] - ones[r[:, 0]])
        l0, l1 = np.stack([l[:, 0], lm], 1), np.stack([lm, l[:, 1]], 1)
        r0, r1 = np.stack([r[:, 0], rm], 1), np.stack([rm, r[:, 1]], 1)
        same = l[:, 0] == r[:, 0]
        nl = np.concatenate([l0, l1, l0, l1[~same]])
        nr = np.concatenate([r0, r1, r1, r0[~same]])
        nk = np.concatenate([k, k, k - 1, k[~same] - 1])
        live = (nk >= 0) & (nl[:, 1] > nl[:, 0]) & (nr[:, 1] > nr[:, 0])
        # a node beside itself is linked by what lies below; one row has nothing to link
        live &= ~((nl[:, 0] == nr[:, 0]) & (nl[:, 1] - nl[:, 0] == 1))
        stack.append((bit + 1, nl[live], nr[live], nk[live]))
    flatten(label)
    return label


def _low_bits(x: np.ndarray, bit: int) -> np.ndarray:
    return x if bit == 0 else (x & np.uint64((1 << (BITS - bit)) - 1)) if bit < BITS else x * np.uint64(0)


def _rotate(c: Column, bits: int) -> Column:
    return c if not bits else F.shiftleft(c, bits).bitwiseOR(F.shiftrightunsigned(c, BITS - bits))


def _prefix(c: Column, bits: int) -> Column:
    return F.shiftrightunsigned(c, BITS - bits)


def _walk_partition(first_bit: int):
    """Walk all node pairs of a partition: rows (trie, node, side, fp, budget)
    where ``side`` is 0 (self pair), 1 or 2."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frames = [b.to_pandas() for b in batches]
        if not frames:
            return
        rows = pd.concat(frames, ignore_index=True)
        rows["u"] = rows["fp"].to_numpy().view(np.uint64)
        rows = rows.sort_values(["trie", "node", "side", "u"], ignore_index=True)
        fps = rows["u"].to_numpy()
        key = rows[["trie", "node", "side"]]
        starts = np.flatnonzero(np.r_[True, (key.iloc[1:].to_numpy() != key.iloc[:-1].to_numpy()
                                             ).any(1)]) if len(rows) else np.zeros(0, int)
        ends = np.r_[starts[1:], len(rows)]
        node = key.iloc[starts]
        side, budget = node["side"].to_numpy(), rows["budget"].to_numpy()[starts]
        ranges = np.stack([starts, ends], 1)
        same_pair = np.r_[(node[["trie", "node"]].iloc[1:].to_numpy()
                           == node[["trie", "node"]].iloc[:-1].to_numpy()).all(1), False]
        own, two = side == 0, (side == 1) & same_pair
        nxt = np.minimum(np.arange(len(starts)) + 1, max(len(starts) - 1, 0))
        left = np.concatenate([ranges[own], ranges[two]])
        right = np.concatenate([ranges[own], ranges[nxt[two]]])
        roots = walk(fps, left, right, np.concatenate([budget[own], budget[two]]), first_bit)
        moved = np.flatnonzero(roots != np.arange(len(rows)))
        trie = rows["trie"].to_numpy()[moved]
        out = pd.DataFrame({"trie": trie, "a": fps[moved].view(np.int64),
                            "b": fps[roots[moved]].view(np.int64)}).drop_duplicates()
        yield pa.RecordBatch.from_pandas(out, preserve_index=False)
    return run


def near_links(fps: DataFrame, radius: int = RADIUS, leaf_rows: int = LEAF_ROWS,
               split_bits: int = SPLIT_BITS) -> DataFrame:
    """(a, b) links that join all distinct values of ``fps`` (column fp) lying
    within ``radius`` bits of each other, directly or through others."""
    blocks = radius + 1
    width = BITS // blocks
    tries = F.explode(F.array(*[F.struct(
        F.lit(t).alias("trie"), _rotate(F.col("fp"), t * width).alias("fp"))
        for t in range(blocks)]))
    first = fps.select(tries.alias("t")).select("t.trie", "t.fp")
    nodes = materialize(first.select("trie", _prefix(F.col("fp"), width).cast("string").alias("node"),
                                     F.lit(0).alias("side"), "fp", F.lit(radius).alias("budget")),
                        "trie")
    bit, links = width, []
    while True:
        large = materialize(nodes.groupBy("trie", "node").agg(F.count(F.lit(1)).alias("n"))
                            .filter(F.col("n") > leaf_rows).select("trie", "node"), "large-tries")
        last = large.isEmpty() or bit + split_bits > BITS
        leaves = nodes if last else nodes.join(large, ["trie", "node"], "left_anti")
        found = leaves.repartition("trie", "node").mapInArrow(
            _walk_partition(bit), "trie int, a long, b long")
        links.append(materialize(found, "trie-links"))
        if last:
            break
        nodes = materialize(_split(nodes.join(large, ["trie", "node"]), bit, split_bits), "trie")
        bit += split_bits
    out = links[0]
    for more in links[1:]:
        out = out.unionByName(more)
    back = [F.when(F.col("trie") == t, F.struct(*[_rotate(F.col(c), (BITS - t * width) % BITS)
                                                  .alias(c) for c in ("a", "b")]))
            for t in range(blocks)]
    return out.select(F.coalesce(*back).alias("l")).select("l.a", "l.b").distinct()


def _split(nodes: DataFrame, bit: int, split_bits: int) -> DataFrame:
    """Child pairs of node pairs: each row goes to the pairs of its child with
    the children whose prefixes the budget still allows."""
    size = 1 << split_bits
    child = F.shiftrightunsigned(F.col("fp"), BITS - bit - split_bits).bitwiseAND(F.lit(size - 1))
    other = nodes.withColumn("child", child.cast("int")).withColumn(
        "other", F.explode(F.expr(f"sequence(0, {size - 1})")))
    differ = F.bit_count(F.col("child").bitwiseXOR(F.col("other")))
    other = other.withColumn("budget", F.col("budget") - differ.cast("int")).filter("budget >= 0")
    # the pair is named by (left child, right child); of a self pair left <= right
    is_left = (F.col("side") == 1) | ((F.col("side") == 0) & (F.col("child") <= F.col("other")))
    lo = F.when(is_left, F.col("child")).otherwise(F.col("other"))
    hi = F.when(is_left, F.col("other")).otherwise(F.col("child"))
    side = F.when((F.col("side") == 0) & (F.col("child") == F.col("other")), 0).when(
        is_left, 1).otherwise(2)
    return other.select("trie", F.concat_ws("/", "node", lo, hi).alias("node"),
                        side.cast("int").alias("side"), "fp", "budget")


def _grouped(own: DataFrame, pick: Column, radius: int) -> DataFrame:
    """``own`` (with fp) and ``component_id``: the least ``pick`` reachable by links."""
    least = materialize(own.groupBy("fp").agg(F.min(pick).alias("first")), "classes")
    linked = components(near_links(least.select("fp"), radius))
    roots = least.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("root"))
    roots = materialize(roots, "roots")
    ids = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = materialize(roots.join(ids, "root").select("fp", "component_id"), "components")
    return own.join(by_fp, "fp")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp, component_id: the least doc_id reachable by links."""
    own = materialize(fingerprints(docs, shingle=shingle), "fingerprints")
    return _grouped(own, F.col("doc_id"), radius).select("doc_id", "fp", "component_id")


def hexadecimal(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each group: the one of least doc_id (a null one
    comes last), of these the one of least text hash.  Rows are told apart by
    doc_id and a 64-bit hash of the text, so unlike texts that share a doc_id,
    or have none, are documents of their own; of equal rows one stays."""
    tid = F.xxhash64("text")
    row = docs.select(F.struct("doc_id", tid.alias("tid")).alias("row"), "text")
    own = materialize(fingerprints(row, "row", shingle=shingle).select("row.doc_id", "row.tid", "fp"),
                      "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tid")
    found = materialize(_grouped(own, order, radius).groupBy("doc_id", "tid").agg(
        F.count(F.lit(1)).alias("n"),
        F.max((order != F.col("component_id")).cast("int")).alias("copy")), "groups")
    gone = found.filter("copy = 1").select(F.col("doc_id").alias("id"), "tid")
    often = found.filter("copy = 0 AND n > 1").select(F.col("doc_id").alias("id"), "tid")

    def without(rows: DataFrame, ids: DataFrame, how: str) -> DataFrame:
        return rows.join(ids, rows["doc_id"].eqNullSafe(ids["id"]) & (tid == ids["tid"]), how)

    # by shuffle at every size: the copies of a corpus fit no broadcast
    firsts = without(docs, gone.hint("merge"), "left_anti")
    name = max(docs.columns, key=len) + "_hash"           # no column of the table
    return without(firsts, often, "left_anti").unionByName(
        without(firsts, often, "left_semi").withColumn(name, tid)
        .dropDuplicates(["doc_id", name]).drop(name))
