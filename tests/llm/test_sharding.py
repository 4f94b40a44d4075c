"""Resharding: the flow against all flows, the laws of the result, files left alone."""

from __future__ import annotations

import itertools
import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinetra.llm import sharding

SCHEMA = "doc_id long, text string, source string, shard int, slot string, doc int, file long"


def flows(supply, capacity):
    """Every way to ship the supply within the capacities."""
    def rows(amount, room):
        if not room:
            return [()] if amount == 0 else []
        return [(x, *r) for x in range(min(amount, room[0]) + 1) for r in rows(amount - x, room[1:])]
    for ways in itertools.product(*[rows(s, capacity) for s in supply]):
        if all(sum(c) <= r for c, r in zip(zip(*ways), capacity)):
            yield np.array(ways)


@pytest.mark.parametrize("seed", range(12))
def test_flow_is_the_cheapest(seed):
    rnd = random.Random(seed)
    supply = [rnd.randint(0, 4) for _ in range(3)]
    capacity = [rnd.randint(0, 4) for _ in range(3)]
    capacity[0] += max(0, sum(supply) - sum(capacity))
    price = sharding.stay_free([0, 1, 2], 3) if seed % 2 else np.array(
        [[rnd.randint(0, 5) for _ in range(3)] for _ in range(3)], float)
    got = sharding.min_cost_flow(supply, capacity, price)
    assert got.min() >= 0 and list(got.sum(1)) == supply and all(got.sum(0) <= capacity)
    assert (got * price).sum() == min((f * price).sum() for f in flows(supply, capacity))


def test_flow_that_does_not_fit():
    with pytest.raises(ValueError):
        sharding.min_cost_flow([5], [2, 2], np.zeros((1, 2)))


def test_blocks_move_the_fewest_bytes():
    rnd = random.Random(1)
    blocks = [(o, b, rnd.randint(80, 120)) for o in range(4) for b in range([400, 40, 10, 150][o])]
    target = sharding.deal_blocks(blocks, 6)
    load = [0] * 6
    moved = 0
    for (o, _, size), j in zip(blocks, target):
        load[j] += size
        moved += size * (o != j)
    share = sum(b[2] for b in blocks) / 6
    kept = sum(min(share, sum(b[2] for b in blocks if b[0] == o)) for o in range(4))
    assert max(load) - min(load) < 120
    assert moved <= sum(load) - kept + 20 * 120        # the optimum of divisible bytes and some blocks


def rows_of(case):
    rnd = random.Random(7)
    text = lambda: " ".join("x" * rnd.randint(1, 9) for _ in range(rnd.randint(0, 60)))
    rows = [(i, text(), f"s{i % 9 if i % 3 else 0}", i, "slot", -i, 1) for i in range(600)]
    if case == "nulls":
        rows += [(None, None, None, None, None, None, None)] * 50 + rows[:100] + [(1, "", "s1", 1, "", 1, 1)] * 99
        rows += [(None, "é" * 40, None, None, None, None, None)] * 50
    elif case == "huge":
        rows += [(-1, "y" * 400_000, "s1", 0, "", 0, 0), (-2, "z" * 300_000, "s2", 0, "", 0, 0)]
    elif case == "hot":
        rows += [(9, "the same text in most of the rows", "s0", 1, "", 1, 1)] * 1200
    elif case == "empty":
        rows = []
    elif case == "few":
        rows = rows[:5]
    return rows


@pytest.mark.parametrize("case", ["plain", "nulls", "huge", "hot", "empty", "few"])
def test_laws(spark, case):
    rows = rows_of(case)
    by_source = F.crc32(F.coalesce("source", F.lit("")).cast("binary")) % 16
    got = sharding.reshard(spark.createDataFrame(rows, SCHEMA), by_source, 24).collect()
    assert sorted((tuple(r.doc) for r in got), key=repr) == sorted(rows, key=repr)
    shards = {j: [r for r in got if r.shard == j] for j in range(24)}
    assert sum(map(len, shards.values())) == len(rows)
    load = []
    for mine in shards.values():
        assert sorted(r.slot for r in mine) == list(range(len(mine)))
        load.append(sum(r.size for r in mine))
    for r in got:
        data = (r.doc.text or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 8, zlib.crc32(data))
        old = zlib.crc32((r.doc.source or "").encode()) % 16
        assert (r.old, r.moved) == (old, old != r.shard)
    if case in ("plain", "nulls", "hot"):
        assert max(load) - min(load) < 0.02 * sum(load) / 24 + max(r.size for r in got)
    if case == "huge":      # two shards of one text each, the others even
        load.sort()
        assert load[-2] < 301_000 and load[21] - load[0] < 800


def test_old_numbers_outside_are_dissolved(spark):
    df = spark.createDataFrame([(i, "text " * 9, "s", 0, "", 0, 0) for i in range(300)], SCHEMA)
    old = F.when(F.col("doc_id") % 3 == 0, 7).when(F.col("doc_id") % 3 == 1, F.col("doc_id") % 4)
    got = sharding.reshard(df, old.cast("int"), 4).collect()
    assert {r.old for r in got} == {-1, 0, 1, 2, 3}
    assert all(r.moved for r in got if r.old == -1) and not any(r.moved for r in got if r.old >= 0)
    assert {sum(r.shard == j for r in got) for j in range(4)} == {75}


def test_shards_that_fit_keep_their_files(spark, tmp_dir):
    """Three of four shards trade rows, the last one is as it should be."""
    rows, number = [], 0
    for shard, n in enumerate([150, 50, 100, 100]):
        for _ in range(n):
            rows.append((number, "t" * 92, str(shard), 0, "", 0, 0))
            number += 1
    path = os.path.join(tmp_dir, "out")
    got = sharding.reshard(spark.createDataFrame(rows, SCHEMA), F.col("source").cast("int"), 4, path).collect()
    assert sorted(r.doc.doc_id for r in got) == list(range(400))
    assert sorted(d for d in os.listdir(path) if d.startswith("shard=")) == ["shard=0", "shard=1"]
    assert sum(r.moved for r in got) == 50
    assert [sorted(r.slot for r in got if r.shard == j) for j in range(4)] == [list(range(100))] * 4


def test_nothing_to_move(spark, tmp_dir):
    rows = [(i, "t" * 92, str(i % 4), 0, "", 0, 0) for i in range(80)]
    got = sharding.reshard(spark.createDataFrame(rows, SCHEMA), F.col("source").cast("int"), 4,
                           os.path.join(tmp_dir, "none")).collect()
    assert not any(r.moved for r in got) and len(got) == 80
