"""Model semantics: deltas, buckets, distance, dims, aggregates, percentiles."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from kinetra.functions.columns import haversine_m, speed_bucket, surrogate_key
from kinetra.functions.quantiles import exact_percentiles
from kinetra.operators.sequence import with_ordinal, with_predecessor
from kinetra.plans.warehouse import Warehouse
from kinetra.schemas import TRACKS, TRAJECTORY_POINTS

T0 = dt.datetime(2024, 1, 1)


def raw(spark, tracks, points):
    t = spark.createDataFrame([(f, i, v, d, s, T0) for f, i, v, d, s in tracks], TRACKS)
    p = spark.createDataFrame(
        [(f, i, k, la, lo, sp, 0.0, 0.0, ts, T0) for f, i, k, la, lo, sp, ts in points],
        TRAJECTORY_POINTS)
    return t, p


def test_first_frame_deltas_null_and_gap_pairs(spark):
    t, p = raw(spark, [("f", 1, "Car", 1.0, 1.0)],
               [("f", 1, 0, 37.9, 23.7, 5.0, 0.0), ("f", 1, 2, 37.91, 23.7, 7.0, 0.08)])
    w = Warehouse(t, p)
    r = w.points_with_deltas.orderBy("frame_idx").collect()
    assert r[0].delta_time_sec is None and r[0].delta_speed_kmh is None and r[0].delta_distance_m is None
    assert r[1].prev_speed_kmh == 5.0 and r[1].delta_speed_kmh == 2.0
    assert r[1].delta_distance_m == pytest.approx(0.01 * 6371000 * math.pi / 180)


def test_speed_bucket_edges(spark):
    vals = [0.99, 1.0, 9.99, 10.0, 49.99, 50.0, None, float("nan"), -1.0]
    df = spark.createDataFrame([(v,) for v in vals], "s double")
    got = [r.b for r in df.select(speed_bucket("s").alias("b")).collect()]
    assert got == ["STOPPED", "SLOW", "SLOW", "NORMAL", "NORMAL", "FAST", "FAST", "FAST", "STOPPED"]


def test_haversine_same_point_and_one_degree(spark):
    df = spark.createDataFrame([(37.9, 23.7, 37.9, 23.7), (0.0, 0.0, 1.0, 0.0),
                                (None, None, 1.0, 0.0)], "a double, b double, c double, d double")
    got = [r.x for r in df.select(haversine_m("a", "b", "c", "d").alias("x")).collect()]
    assert got[0] == 0.0
    assert got[1] == pytest.approx(111194.93, abs=0.01)
    assert got[2] is None


def test_surrogate_key_null_token(spark):
    df = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    keys = [r.k for r in df.select(surrogate_key("x", "y").alias("k")).collect()]
    assert keys[0] != keys[1] and all(len(k) == 32 for k in keys)


def test_track_without_frames_and_null_type(spark):
    t, p = raw(spark, [("f", 1, "Car", 1.0, 1.0), ("f", 2, None, 2.0, 2.0), ("f", 3, "Bus", 3.0, 3.0)],
               [("f", 1, 0, 37.9, 23.7, 5.0, 0.0), ("f", 2, 0, 37.9, 23.7, 6.0, 0.0)])
    w = Warehouse(t, p)
    d = {r.track_id: r for r in w.dim_track.collect()}
    assert d[3].point_count is None and d[3].duration_sec is None
    assert d[2].vehicle_type_sk is None
    agg = w.agg_speed_by_vehicle_type.collect()
    assert [r.vehicle_type_name for r in agg] == ["Car"]
    assert agg[0].stddev_speed_kmh is None and agg[0].observation_count == 1


def single_task_percentiles(df, probs):
    """Spark's own exact percentile, which takes a group whole."""
    out = df.groupBy("g").agg(F.percentile("v", F.array(*map(F.lit, probs.values()))).alias("p"))
    return {r.g: dict(zip(probs, r.p)) for r in out.collect()}


def same_percentiles(df, probs, cuts):
    want = single_task_percentiles(df, probs)
    got = {r.g: r for r in exact_percentiles(df, ["g"], "v", probs, cuts=cuts).collect()}
    assert set(want) == set(got)
    for g in want:
        for k in probs:
            assert got[g][k] == pytest.approx(want[g][k], abs=1e-9), (g, k)


def test_percentiles_1_2_4(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 4.0), ("a", None)], "g string, v double")
    r = exact_percentiles(df, ["g"], "v", {"p50": 0.5, "p95": 0.95}).first()
    assert r.p50 == 2.0 and r.p95 == pytest.approx(3.8)


@pytest.mark.parametrize("cuts", [1, 7, 255])
def test_percentiles_match_single_task(spark, cuts):
    df = spark.range(0, 20000).select(
        (F.col("id") % 3).alias("g"),
        F.when(F.col("id") % 7 == 0, F.lit(5.0)).otherwise((F.col("id") * 7919 % 1000) / 10.0).alias("v"))
    same_percentiles(df, {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.95, "e": 1.0}, cuts)


def test_percentiles_of_infinities_and_nan(spark):
    inf, nan = float("inf"), float("nan")
    rows = [("i", inf), ("i", inf), ("i", 1.0), ("m", -inf), ("m", 0.0), ("m", 2.0), ("n", nan), ("n", nan),
            ("n", 3.0), ("o", inf)]
    got = {r.g: (r.p50, r.p95) for r in exact_percentiles(
        spark.createDataFrame(rows, "g string, v double"), ["g"], "v", {"p50": 0.5, "p95": 0.95}).collect()}
    assert got["i"] == (inf, inf) and got["o"] == (inf, inf)
    assert got["m"] == (0.0, pytest.approx(1.8))
    assert math.isnan(got["n"][0]) and math.isnan(got["n"][1])


def test_chunked_predecessor_equals_window(spark):
    df = spark.range(0, 5000).select(
        (F.col("id") % 4).alias("g"), (F.col("id") * 3).alias("o"), (F.col("id") * 1.5).alias("v"))
    df = df.filter(F.col("o") % 5 != 0)  # gaps in the ordering key
    plain = df.withColumn("prev_v", F.lag("v").over(Window.partitionBy("g").orderBy("o")))
    chunked = with_predecessor(df, ["g"], "o", ["v"], chunk_size=16)
    a = sorted(tuple(r) for r in plain.select("g", "o", "prev_v").collect())
    b = sorted(tuple(r) for r in chunked.select("g", "o", "prev_v").collect())
    assert a == b


def test_chunked_ordinal_equals_row_number(spark):
    df = spark.range(0, 3000).select((F.col("id") % 5).alias("g"),
                                     ((F.col("id") * 7919) % 3001).alias("o"))
    got = with_ordinal(df, ["g"], ["o"], chunk=F.floor(F.col("o") / 97), name="k")
    want = df.withColumn("k", (F.row_number().over(Window.partitionBy("g").orderBy("o")) - 1).cast("int"))
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in want.collect())


def test_fact_chunked_equals_plain_on_events(spark):
    sf = "/root/testdata/sf0.001"
    plain = Warehouse.from_events(spark, sf, chunk_size=1 << 30).fct_points
    chunked = Warehouse.from_events(spark, sf, chunk_size=16).fct_points

    def view(df):
        return sorted(tuple(r) for r in df.select(
            "trajectory_point_sk", F.col("delta_time_sec").isNull().alias("prev_null"),
            "delta_time_sec", "delta_speed_kmh", F.round("delta_distance_m", 6).alias("d")).collect())
    assert view(plain) == view(chunked)


def test_percentiles_hot_group(spark):
    # one group holds ~90% of the rows, with many repeated values
    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 10 == 0, F.col("id") % 7).otherwise(F.lit(99)).alias("g"),
        ((F.col("id") * 31) % 997 / 7.0).alias("v"))
    same_percentiles(df, {"p05": 0.05, "p50": 0.5, "p95": 0.95}, 31)


def test_nothing_runs_before_a_model_is_asked_for(spark):
    w = Warehouse.from_events(spark, "/root/testdata/sf0.001")
    spark.sparkContext.setJobGroup("lazy", "models are plans")
    for model in (w.dim_track, w.fct_points, w.points_with_deltas, w.track_kinematics):
        assert model.columns
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("lazy")) == []
    spark.sparkContext.setJobGroup("", "")
