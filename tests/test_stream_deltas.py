"""Deltas of a stream: late and repeated frames, NULL beside NaN, restarts."""

from __future__ import annotations

from kinetra.operators.trajectory import points_with_deltas
from kinetra.streaming import deltas

SCHEMA = ("trajectory_point_sk string, track_sk string, frame_idx int, speed_kmh double, "
          "seconds_since_start double, latitude double, longitude double")


def test_late_frames_and_restarts(spark, tmp_dir):
    def arrive(*frames):
        df = spark.createDataFrame([(f"{t}-{i}", t, i, v, i / 25, 37.9, 23.7 + i / 1000) for t, i, v in frames], SCHEMA)
        df.write.mode("append").parquet(f"{tmp_dir}/in")
        deltas.run_deltas(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/checkpoint", df.schema)

    arrive(("a", 0, 1.0), ("a", 2, 3.0), ("a", 1, None), ("b", 0, float("nan")))
    arrive(("a", 5, 8.0), ("b", 3, 4.0), ("c", 7, 1.0))
    arrive(("a", 4, 9.0), ("a", 6, 9.0), ("a", 6, 9.0), ("b", 3, 1.0))       # 4, 3 and the second 6 are late
    got = {(r.track_sk, r.frame_idx, r.late): (str(r.prev_speed_kmh), str(r.delta_speed_kmh))
           for r in spark.read.parquet(f"{tmp_dir}/out").collect()}
    none = ("None", "None")
    assert got == {
        ("a", 0, False): none, ("a", 1, False): ("1.0", "None"), ("a", 2, False): none,
        ("a", 5, False): ("3.0", "5.0"), ("a", 4, True): none, ("a", 6, False): ("8.0", "1.0"),
        ("a", 6, True): none, ("b", 0, False): none, ("b", 3, False): ("nan", "nan"), ("b", 3, True): none,
        ("c", 7, False): none}


def test_in_order_stream_equals_batch(spark, tmp_dir):
    frames = [(f"{t}-{i}", t, i, float(i * i % 11), i / 25, 37.9 + i / 1e4, 23.7) for t in "xyz" for i in range(0, 90, 3)]
    df = spark.createDataFrame(frames, SCHEMA)
    for low, high in ((0, 30), (30, 31), (31, 90)):
        df.filter(f"frame_idx >= {low} AND frame_idx < {high}").write.mode("append").parquet(f"{tmp_dir}/in")
        deltas.run_deltas(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/checkpoint", df.schema)
    got = spark.read.parquet(f"{tmp_dir}/out")
    assert not got.filter("late").count()
    want = points_with_deltas(df)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
