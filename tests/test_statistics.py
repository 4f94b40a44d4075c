"""Order statistics without moving rows, mergeable speed partials."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinetra.functions import order_statistics
from kinetra.operators import incremental, marts, speed_partials
from kinetra.plans.registry import events_wh

SF = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")


def percentile(values, p):
    """Spark's order (NaN last), linear interpolation."""
    values = sorted(values, key=lambda v: (math.isnan(v), v))
    h = p * (len(values) - 1)
    lo, hi = values[math.floor(h)], values[math.ceil(h)]
    return lo if lo == hi or h == math.floor(h) else lo + (h - math.floor(h)) * (hi - lo)


def groups(case):
    rnd = random.Random(4)
    if case == "continuous":
        return {g: [rnd.gauss(10 * i, 3) for _ in range(4000 - 900 * i)] for i, g in enumerate("abc")}
    if case == "ties":
        return {g: [float(rnd.randint(0, 5)) for _ in range(3000)] for g in "ab"} | {"c": [7.0]}
    return {"a": [NAN] * 900 + [rnd.random() for _ in range(100)], "b": [INF] * 60 + [-INF] * 60 + [1.0, 2.0],
            "c": [NAN, NAN], "d": [rnd.random() for _ in range(1000)] + [NAN] * 60}


@pytest.mark.parametrize("limit", [order_statistics.LIMIT, 20])
@pytest.mark.parametrize("case", ["continuous", "ties", "numbers that are none"])
def test_percentiles_without_moving_rows(spark, case, limit):
    data = groups(case)
    rows, owners = [], {}
    for g, values in data.items():
        for i, v in enumerate(values):
            owner = f"{g}{i % 17}"
            owners[owner] = g
            rows.append((owner, v))
    rows += [("nobody", 1.0)] * 50          # an owner without group
    values = spark.createDataFrame(rows, "_owner string, _v double").repartition(4)
    stats = spark.createDataFrame([(g, v) for g, vs in data.items() for v in vs], "_group string, v double").groupBy(
        "_group").agg(F.count("v").alias("m"), F.kll_sketch_agg_double("v", F.lit(1000)).alias("sketch"))
    probs = {"p0": 0.0, "p5": 0.05, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    got = order_statistics.percentiles(values, spark.createDataFrame(list(owners.items()), "_owner string, _group string"),
                                       stats, probs, limit)
    assert set(got) == set(data)
    for g, vs in data.items():
        for name, p in probs.items():
            np.testing.assert_equal(got[g][name], percentile(vs, p))


def speeds(spark):
    rnd = random.Random(2)
    rows = [("f%d" % (t % 3), f"t{t}", None if rnd.random() < 0.1 else 1e6 + rnd.gauss(0, 1e-2) * t)
            for t in range(40) for _ in range(rnd.randint(0, 30))]
    rows += [("f0", "quiet", None)] * 5
    fct = spark.createDataFrame(rows, "source_file string, track_sk string, speed_kmh double")
    dim = spark.createDataFrame([(f"t{t}", ["car", "bus", None][t % 3 if t % 7 else 2]) for t in range(40)]
                                + [("quiet", "quiet")], "track_sk string, vehicle_type_sk string")
    return fct, dim


def test_merged_moments_equal_those_of_the_rows(spark):
    """Speeds far from zero and close together, where sums of squares would fail."""
    fct, dim = speeds(spark)
    got = {r.vehicle_type_sk: r for r in speed_partials.of_types(fct, dim).collect()}
    want = fct.join(dim, "track_sk").filter("vehicle_type_sk IS NOT NULL").groupBy("vehicle_type_sk").agg(
        F.count(F.lit(1)).alias("n"), F.count("speed_kmh").alias("m"), F.avg("speed_kmh").alias("mean"),
        (F.var_samp("speed_kmh") * (F.count("speed_kmh") - 1)).alias("m2"),
        F.min("speed_kmh").alias("low"), F.max("speed_kmh").alias("high")).collect()
    assert len(got) == len(want) == 3
    for w in want:
        g = got[w.vehicle_type_sk]
        assert (g.n, g.m, g.low, g.high) == (w.n, w.m, w.low, w.high)
        if w.m:
            assert g["mean"] == pytest.approx(w["mean"], rel=1e-14) and g.m2 == pytest.approx(w.m2, rel=1e-6)
        else:
            assert g["mean"] is None


def test_stored_partials_follow_the_touched_files(spark, tmp_dir):
    fct, dim = speeds(spark)
    path = f"{tmp_dir}/partials"
    files = fct.select("source_file").distinct()
    speed_partials.refresh(spark, path, fct.filter("source_file <> 'f2'"), dim, files.filter("source_file <> 'f2'"))
    changed = fct.withColumn("speed_kmh", F.when(F.col("source_file") == "f1", F.col("speed_kmh") + 5)
                             .otherwise(F.col("speed_kmh")))
    speed_partials.refresh(spark, path, changed, dim, files.filter("source_file <> 'f0'"))
    stats = lambda df: sorted((r.vehicle_type_sk, r.n, r.m, r["mean"] and round(r["mean"], 6), r.low, r.high)
                              for r in df.collect())
    assert stats(speed_partials.of_stored(speed_partials.stored(spark, path))) == stats(
        speed_partials.of_types(changed, dim))
    # a file that loses its typed tracks loses its partials
    speed_partials.refresh(spark, path, changed, dim.filter("false"), files)
    assert speed_partials.of_stored(speed_partials.stored(spark, path)).isEmpty()


def test_refresh_reads_touched_partitions_only(spark, tmp_dir):
    """Partitions of untouched files are broken on purpose: reading them would fail."""
    import glob
    w = events_wh(spark, SF)
    path = f"{tmp_dir}/fact"
    incremental.merge_into(spark, path, w.fct_points)
    files = spark.createDataFrame([("part1",)], "source_file string")
    for other in glob.glob(f"{path}/source_file=part[02]/*.parquet"):
        with open(other, "wb") as fh:
            fh.write(b"not parquet")
    speed_partials.refresh(spark, f"{tmp_dir}/partials", incremental.read_table(spark, path), w.dim_track, files)
    assert {r.source_file for r in speed_partials.stored(spark, f"{tmp_dir}/partials").collect()} == {"part1"}


def test_merge_reads_touched_partitions_only(spark, tmp_dir):
    import glob
    w = events_wh(spark, SF)
    path = f"{tmp_dir}/fact"
    incremental.merge_into(spark, path, w.fct_points)
    for other in glob.glob(f"{path}/source_file=part[02]/*.parquet"):
        with open(other, "wb") as fh:
            fh.write(b"not parquet")
    part = w.fct_points.filter("source_file = 'part1'")
    incremental.merge_into(spark, path, part.filter("frame_idx = 0").withColumn("speed_kmh", F.lit(-1.0)))
    got = incremental.read_table(spark, path).filter("source_file = 'part1'")
    assert got.count() == part.count()
    assert got.filter("speed_kmh = -1").count() == part.filter("frame_idx = 0").count()


def test_frames_do_not_move_for_the_statistics(spark):
    """Partials per track: the scan and its partial aggregate come before any exchange."""
    w = events_wh(spark, SF)
    p = speed_partials.per_track(w.speeds)._jdf.queryExecution().executedPlan().toString()
    assert p.index("partial_count(1)") > p.index("Exchange hashpartitioning(track_sk")   # printed from the top
    assert p.count("Exchange") == 1
    assert marts.agg_speed_by_vehicle_type(w.speeds, w.dim_track, w.dim_vehicle_type).count() == 6
