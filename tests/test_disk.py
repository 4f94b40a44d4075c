"""What loads, merges, transforms and checks leave on disk, and how often rows move."""

from __future__ import annotations

import glob
import os
import time
import uuid

import pytest
from conftest import HEADER, write_text
from pyspark.sql import functions as F

from kinetra import session
from kinetra.operators import incremental, load, marts, quality, sequence, staging, trajectory
from kinetra.session import materialize, scratch_released
from kinetra.sources import ragged, testdata
from kinetra.streaming import ingest

SF = "/root/testdata/sf0.001"
BLOCK = "37.9; 23.7; {}; 0; 0; {}; "


@pytest.fixture
def left(tmp_dir, monkeypatch):
    """Names of the scratch tables that are there, in a folder of the test's own."""
    monkeypatch.setattr(session, "scratch_path", lambda _, name: f"file://{tmp_dir}/scratch/{name}-{uuid.uuid4().hex}")
    return lambda: {os.path.basename(p).rsplit("-", 1)[0] for p in glob.glob(f"{tmp_dir}/scratch/*")}


def shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*")}


def loaded(spark, root, files):
    """A raw layer of ``files``: {name: {track: frames}}."""
    for name, tracks in files.items():
        write_text(f"{root}/src", name, HEADER + "".join(
            f"{t}; Car; 1.0; 1.0; " + "".join(BLOCK.format(5 + i, i) for i in range(n)) + "\n"
            for t, n in tracks.items()))
        load.load_batch(ragged.read_ragged(spark, f"{root}/src", name), f"{root}/raw")
    return staging.stg_points(load.read_raw(spark, f"{root}/raw", "trajectory_points"))


def rows(df):
    return sorted((tuple(r) for r in df.select(*marts.FACT_COLUMNS).collect()), key=repr)


def test_a_written_table_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "kept")
    until = time.time() + 20          # they are deleted in the background
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before


def test_scratch_goes_with_its_block(spark, left):
    with scratch_released(spark):
        materialize(spark.range(3), "inner")
        kept = materialize(spark.range(3), "outer", keep=True)
        assert left() == {"inner", "outer"}
    assert left() == {"outer"} and kept.count() == 3
    with pytest.raises(ValueError), scratch_released(spark):
        materialize(spark.range(3), "failed")
        raise ValueError
    assert left() == {"outer"}


def test_loads_merges_and_checks_leave_no_scratch(spark, tmp_dir, left):
    pts = loaded(spark, tmp_dir, {"a.csv": {1: 3, 2: 2}})
    for _ in range(2):
        incremental.merge_into(spark, f"{tmp_dir}/fct", marts.fct_points(trajectory.points_with_deltas(pts)))
    got = quality.evaluate({"stg_points": pts}, tests={"not_null", "between", "unique"})
    assert got.count() == len([c for c in quality.CHECKS if c.model == "stg_points"]) - 1
    assert left() == {"touched", "checks"}


def test_files_new_to_the_fact_are_written_once(spark, tmp_dir, monkeypatch):
    pts = loaded(spark, tmp_dir, {"a.csv": {1: 3}, "b.csv": {1: 2, 2: 4}, "c.csv": {7: 1}})
    merged = []
    monkeypatch.setattr(incremental, "_merge_staged", lambda *a, f=incremental._merge_staged: merged.append(1) or f(*a))
    path, want = f"{tmp_dir}/fct", marts.fct_points(trajectory.points_with_deltas(pts))

    def merge(batch):
        touched = incremental.merge_into(spark, path, batch, in_order=True)
        return sorted(r.source_file for r in touched.collect())

    some = lambda *files: pts.filter(F.col("source_file").isin(*files))
    fact_of = lambda df: marts.fct_points(trajectory.points_with_deltas(df, in_order=True))
    assert merge(fact_of(some("a.csv"))) == ["a.csv"]
    assert merge(fact_of(some("b.csv", "c.csv"))) == ["b.csv", "c.csv"] and not merged
    assert rows(incremental.read_table(spark, path)) == rows(want)
    # a batch with a file that is there is merged, and its rows win
    again = fact_of(some("b.csv")).withColumn("speed_kmh", F.lit(-1.0))
    assert merge(again) == ["b.csv"] and merged
    got = incremental.read_table(spark, path)
    assert got.count() == want.count() and got.filter("speed_kmh = -1").count() == 6
    # a repeated key is an error before anything is published
    for at in (path, f"{tmp_dir}/none"):
        with pytest.raises(incremental.DuplicateKeyError):
            incremental.merge_into(spark, at, fact_of(some("a.csv").unionByName(some("a.csv"))), in_order=True)
    assert incremental.read_table(spark, path).count() == want.count() and not os.path.exists(f"{tmp_dir}/none")
    assert not glob.glob(f"{tmp_dir}/*.batch-*")


def test_refresh_of_part_of_a_file_keeps_to_its_tracks(spark, tmp_dir):
    pts = loaded(spark, tmp_dir, {"a.csv": {1: 3, 2: 2}, "b.csv": {1: 1}})
    tracks = lambda *keys: spark.createDataFrame(keys, "source_file string, track_id int")
    some = incremental.rows_of_tracks(pts, tracks(("a.csv", 2)), in_order=True)
    assert {(r.source_file, r.track_id) for r in some.collect()} == {("a.csv", 2)}
    whole = incremental.rows_of_tracks(pts, tracks(("a.csv", 1), ("a.csv", 2)), in_order=True)
    assert rows(whole) == rows(marts.fct_points(trajectory.points_with_deltas(pts.filter("source_file = 'a.csv'"))))
    plan = whole._jdf.queryExecution().optimizedPlan().toString()
    assert "track_id" not in "".join(x for x in plan.splitlines() if "LeftSemi" in x)      # chosen by file


def test_stream_batches_of_new_files_are_not_merged(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(incremental, "_merge_staged", lambda *a: pytest.fail("merged"))
    for n in "ab":
        write_text(f"{tmp_dir}/src", f"{n}.csv", HEADER + "1; Car; 1.0; 1.0; " + BLOCK.format(1, 0) + BLOCK.format(2, 1) + "\n")
        ingest.load_epoch(ragged.read_lines(spark, f"{tmp_dir}/src", f"{n}.csv"), ord(n), f"{tmp_dir}/raw", refresh_fact=True)
    fact = incremental.read_table(spark, f"{tmp_dir}/raw/fct_trajectory_points")
    assert sorted((r.source_file, r.frame_idx, r.delta_speed_kmh) for r in fact.collect()) == [
        ("a.csv", 0, None), ("a.csv", 1, 1.0), ("b.csv", 0, None), ("b.csv", 1, 1.0)]


@pytest.mark.parametrize("few", [1_000_000, 0])
def test_predecessors_in_order_equal_a_window(spark, monkeypatch, few):
    monkeypatch.setattr(sequence, "FEW_CHUNKS", few)
    df = spark.createDataFrame(
        [(f"f{g % 3}", g, i, float(i * g)) for g in range(1, 8) for i in range(0, 40 * g, 1 + g % 4)]
        + [("f9", 1, None, 7.0), ("f9", 1, 5, 8.0), ("f9", 2, None, 9.0), (None, 1, 3, 1.0), (None, 1, 4, 2.0)],
        "f string, g int, o int, v double").repartition(5)
    from pyspark.sql import Window
    want = df.withColumn("prev_v", F.lag("v").over(Window.partitionBy("f", "g").orderBy("o")))
    for in_order in (False, True):
        got = sequence.with_predecessor(df, ["f", "g"], "o", ["v"], chunk_size=16, in_order=in_order)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    files = got.select("f", F.spark_partition_id().alias("p")).distinct().groupBy("p").agg(
        F.min("f").alias("low"), F.max("f").alias("high")).orderBy("p").collect()
    assert all(a.high <= b.low for a, b in zip(files[1:], files[2:]))


def test_frames_move_once_for_the_fact(spark, tmp_dir):
    loaded(spark, tmp_dir, {"a.csv": {1: 3, 2: 2}})
    pts = staging.stg_points(load.stored(spark, f"{tmp_dir}/raw", "trajectory_points"))
    for df, moved in ((trajectory.points_with_deltas(pts, in_order=True), "rangepartitioning(source_file"),
                      (trajectory.points_with_deltas(pts).select("trajectory_point_sk", "speed_bucket"), None)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines = [x for x in plan.splitlines() if "Exchange" in x and "BroadcastExchange" not in x]
        assert len(lines) == (1 if moved else 0) and all(moved in x for x in lines)


def test_orders_and_items_move_once_for_the_files(spark):
    plan = testdata.ragged_lines(spark, SF, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_more_row_wise_checks_than_bits(spark):
    n = 2 * quality.BITS + 5
    df = spark.createDataFrame([tuple(None if (i + r) % 3 == 0 else i for i in range(n)) for r in range(2)],
                               ", ".join(f"c{i} int" for i in range(n)))
    checks = [quality.Check("m", f"c{i}", "not_null") for i in range(n)]
    got = {r.column_name: r.failures for r in quality.evaluate({"m": df}, checks=checks).collect()}
    assert got == {f"c{i}": sum((i + r) % 3 == 0 for r in range(2)) for i in range(n)}
