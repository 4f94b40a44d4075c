"""Idempotent load, counts, delete, incremental merge, streaming ingest."""

from __future__ import annotations

import datetime as dt
import os
import shutil

import pytest
from conftest import FIXTURES, HEADER, write_text

from kinetra.operators import incremental, load, quality, staging
from kinetra.sources import ragged
from kinetra.streaming import ingest


def sample(spark):
    return ragged.read_ragged(spark, FIXTURES, "evening_drive.csv")


def test_load_counts_and_idempotence(spark, tmp_dir):
    c1 = load.load_batch(sample(spark), tmp_dir)
    assert (c1.tracks_loaded, c1.points_loaded, c1.tracks_inserted, c1.points_inserted) == (5, 11, 4, 10)
    c2 = load.load_batch(sample(spark), tmp_dir)
    assert (c2.tracks_loaded, c2.points_loaded, c2.tracks_inserted, c2.points_inserted) == (5, 11, 0, 0)
    t = load.read_raw(spark, tmp_dir, "tracks")
    p = load.read_raw(spark, tmp_dir, "trajectory_points")
    assert (t.count(), p.count()) == (4, 10)
    # one loaded_at per load, the same for both tables
    assert t.select("loaded_at").distinct().count() == 1
    assert t.select("loaded_at").first()[0] == p.select("loaded_at").first()[0]


def test_strict_mode_rejects_before_writing(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    write_text(src, "bad.csv", HEADER + "1; Car; 1.0; 1.0; 1; 1; 1; 1; 1; 1;\n2; Car; 1.0;\n")
    with pytest.raises(load.RejectedLinesError):
        load.load_batch(ragged.read_ragged(spark, src, "bad.csv"), os.path.join(tmp_dir, "raw"))
    assert not os.path.exists(os.path.join(tmp_dir, "raw", "tracks"))
    c = load.load_batch(ragged.read_ragged(spark, src, "bad.csv"), os.path.join(tmp_dir, "raw"),
                        mode="permissive")
    assert (c.tracks_inserted, c.rejected_lines) == (1, 1)


def test_file_mode_skips_failed_file(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    write_text(src, "good.csv", HEADER + "1; Car; 1.0; 1.0; 1; 1; 1; 1; 1; 1;\n")
    write_text(src, "bad.csv", HEADER + "1; Car; 1.0; 1.0; 1; 1; 1; 1; 1; 1;\n2; Car;\n")
    c = load.load_batch(ragged.read_ragged(spark, src, "*.csv"), os.path.join(tmp_dir, "raw"), mode="file")
    files = {r[0] for r in load.read_raw(spark, os.path.join(tmp_dir, "raw"), "tracks")
             .select("source_file").collect()}
    assert files == {"good.csv"} and c.tracks_inserted == 1


def test_empty_load_gate(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    write_text(src, "e.csv", HEADER)
    with pytest.raises(load.EmptyLoadError):
        load.load_batch(ragged.read_ragged(spark, src, "e.csv"), os.path.join(tmp_dir, "raw"))


def test_delete_source_file(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    write_text(src, "a.csv", HEADER + "1; Car; 1.0; 1.0; 1; 1; 1; 1; 1; 1;\n")
    write_text(src, "b.csv", HEADER + "1; Car; 2.0; 1.0; 1; 1; 1; 1; 1; 1;\n")
    root = os.path.join(tmp_dir, "raw")
    load.load_batch(ragged.read_ragged(spark, src, "*.csv"), root)
    load.delete_source_file(spark, root, "a.csv")
    assert [r[0] for r in load.read_raw(spark, root, "tracks").select("source_file").collect()] == ["b.csv"]
    assert load.read_raw(spark, root, "trajectory_points").count() == 1


def _fact_rows(spark, root):
    pts = staging.stg_points(load.read_raw(spark, root, "trajectory_points"))
    return pts


def test_incremental_merge_replay_and_new_file(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    root = os.path.join(tmp_dir, "raw")
    write_text(src, "a.csv", HEADER + "1; Car; 1.0; 1.0; 37.9; 23.7; 5; 0; 0; 0; 37.9; 23.7; 6; 0; 0; 1;\n")
    load.load_batch(ragged.read_ragged(spark, src, "a.csv"), root, loaded_at=dt.datetime(2024, 1, 1))
    fact = os.path.join(tmp_dir, "fct")
    mark = incremental.high_water_mark(None)
    incremental.merge_into(spark, fact, incremental.new_fact_rows(_fact_rows(spark, root), mark))
    first = sorted(tuple(r) for r in spark.read.parquet(fact).collect())
    # replay: nothing newer than the mark
    mark = incremental.high_water_mark(spark.read.parquet(fact))
    new = incremental.new_fact_rows(_fact_rows(spark, root), mark)
    assert new.count() == 0
    # a new file: only its rows are added
    write_text(src, "b.csv", HEADER + "2; Bus; 1.0; 1.0; 37.9; 23.7; 7; 0; 0; 0;\n")
    load.load_batch(ragged.read_ragged(spark, src, "b.csv"), root, loaded_at=dt.datetime(2024, 1, 2))
    new = incremental.new_fact_rows(_fact_rows(spark, root), mark)
    assert [r.track_id for r in new.collect()] == [2]
    incremental.merge_into(spark, fact, new)
    after = spark.read.parquet(fact)
    assert after.count() == 3
    assert sorted(tuple(r) for r in after.filter("track_id = 1").select(*spark.read.parquet(fact).columns)
                  .collect()) == first


def test_merge_updates_and_duplicate_keys(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    a = spark.createDataFrame([("k1", "f", 1.0), ("k2", "f", 2.0)], "trajectory_point_sk string, source_file string, x double")
    incremental.merge_into(spark, path, a)
    b = spark.createDataFrame([("k2", "f", None), ("k3", "g", 3.0)], "trajectory_point_sk string, source_file string, x double")
    incremental.merge_into(spark, path, b)
    got = {r.trajectory_point_sk: r.x for r in spark.read.parquet(path).collect()}
    assert got == {"k1": 1.0, "k2": None, "k3": 3.0}  # a new NULL wins (whole-row update)
    dup = spark.createDataFrame([("k1", "f", 1.0), ("k1", "f", 2.0)], "trajectory_point_sk string, source_file string, x double")
    with pytest.raises(incremental.DuplicateKeyError):
        incremental.merge_into(spark, path, dup)


def test_merge_schema_sync(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    a = spark.createDataFrame([("k1", "f", 1.0, True)], "trajectory_point_sk string, source_file string, x double, old boolean")
    incremental.merge_into(spark, path, a)
    b = spark.createDataFrame([("k2", "f", 2.0, "n")], "trajectory_point_sk string, source_file string, x double, new string")
    incremental.merge_into(spark, path, b)
    t = incremental.read_table(spark, path)
    assert set(t.columns) == {"trajectory_point_sk", "source_file", "x", "new"}
    got = {r.trajectory_point_sk: (r.x, r.new) for r in t.collect()}
    assert got == {"k1": (1.0, None), "k2": (2.0, "n")}


def test_stream_ingest_new_files_once(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    root = os.path.join(tmp_dir, "raw")
    ckpt = os.path.join(tmp_dir, "ckpt")
    shutil.copy(os.path.join(FIXTURES, "evening_drive.csv"), os.path.join(os.makedirs(src) or src, "s1.csv"))
    ingest.run_ragged_ingest(spark, src, root, ckpt, glob="*.csv", refresh_fact=True)
    assert load.read_raw(spark, root, "trajectory_points").count() == 10
    write_text(src, "s2.csv", HEADER + "4; Taxi; 1.0; 1.0; 37.9; 23.7; 5; 0; 0; 0;\n")
    ingest.run_ragged_ingest(spark, src, root, ckpt, glob="*.csv", refresh_fact=True)
    t = load.read_raw(spark, root, "tracks")
    assert t.count() == 5
    assert incremental.read_table(spark, os.path.join(root, "fct_trajectory_points")).count() == 11


def test_transform_run_history_and_gate(spark, tmp_dir):
    from kinetra.plans.warehouse import run_transform
    root = os.path.join(tmp_dir, "raw")
    out = os.path.join(tmp_dir, "wh")
    load.load_batch(sample(spark), root, loaded_at=dt.datetime(2024, 1, 1, 12))
    now = dt.datetime(2024, 1, 2)
    w, res = run_transform(spark, root, out, "run-1", as_of=now, gate=False)
    # the track without frames has no point count
    assert res.count() == 71
    assert [(r.model, r.column_name) for r in res.filter("status = 'fail'").collect()] == [
        ("dim_track", "point_count")]
    history = quality.run_history(spark, out).collect()
    assert {(r.model, r.status, r.gate) for r in history} == {
        (m, "success", "fail") for m in ("track_kinematics", "dim_vehicle_type", "dim_track",
                                         "fct_trajectory_points", "agg_speed_by_vehicle_type")}
    assert {r.model: r.row_count for r in history}["fct_trajectory_points"] == 10
    assert incremental.read_table(spark, os.path.join(out, "fct_trajectory_points")).count() == 10
    # same raw data again: fact unchanged, history grows by one run
    run_transform(spark, root, out, "run-2", as_of=now, gate=False)
    assert incremental.read_table(spark, os.path.join(out, "fct_trajectory_points")).count() == 10
    assert spark.read.parquet(os.path.join(out, "_check_history")).select("run_id").distinct().count() == 2
    # stale sources stop the run
    with pytest.raises(RuntimeError):
        run_transform(spark, root, out, "run-3", as_of=dt.datetime(2024, 2, 1))
    # a failing error-level check raises after the writes
    src = os.path.join(tmp_dir, "src")
    write_text(src, "z.csv", HEADER + "9; Boat; 1.0; 1.0; 37.95; 23.75; 5; 0; 0; 0;\n")
    load.load_batch(ragged.read_ragged(spark, src, "z.csv"), root, loaded_at=dt.datetime(2024, 1, 1, 13))
    with pytest.raises(AssertionError):
        run_transform(spark, root, out, "run-4", as_of=now)


def test_late_committed_load_skipped_by_cutoff_found_by_key(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    root = os.path.join(tmp_dir, "raw")
    fact = os.path.join(tmp_dir, "fct")
    write_text(src, "a.csv", HEADER + "1; Car; 1.0; 1.0; 37.9; 23.7; 5; 0; 0; 0;\n")
    load.load_batch(ragged.read_ragged(spark, src, "a.csv"), root, loaded_at=dt.datetime(2024, 1, 1, 10))
    incremental.merge_into(spark, fact, incremental.new_fact_rows(_fact_rows(spark, root),
                                                                  incremental.FLOOR_MARK))
    # a load that began earlier (stamped 09:00) but committed after the run
    write_text(src, "b.csv", HEADER + "2; Bus; 1.0; 1.0; 37.9; 23.7; 7; 0; 0; 0;\n")
    load.load_batch(ragged.read_ragged(spark, src, "b.csv"), root, loaded_at=dt.datetime(2024, 1, 1, 9))
    mark = incremental.high_water_mark(spark.read.parquet(fact))
    assert incremental.new_fact_rows(_fact_rows(spark, root), mark).count() == 0
    safe = incremental.new_fact_rows_by_key(_fact_rows(spark, root), spark.read.parquet(fact))
    assert [r.track_id for r in safe.collect()] == [2]
    incremental.merge_into(spark, fact, safe)
    assert spark.read.parquet(fact).count() == 2


def test_load_duplicate_track_lines_and_extra_frames_later(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    root = os.path.join(tmp_dir, "raw")
    write_text(src, "d.csv", HEADER
               + "7; Car; 10.0; 1.0; 1; 1; 1; 1; 1; 1;\n"
               + "8; Bus; 5.0; 1.0; 4; 4; 4; 4; 4; 4;\n"
               + "7; Bus; 20.0; 2.0; 2; 2; 2; 2; 2; 2; 3; 3; 3; 3; 3; 3;\n")
    c = load.load_batch(ragged.read_ragged(spark, src, "d.csv"), root)
    assert (c.tracks_loaded, c.points_loaded, c.tracks_inserted, c.points_inserted) == (3, 4, 2, 3)
    t = {r.track_id: (r.vehicle_type, r.traveled_d) for r in load.read_raw(spark, root, "tracks").collect()}
    assert t == {7: ("Car", 10.0), 8: ("Bus", 5.0)}
    p = sorted((r.track_id, r.frame_idx, r.speed) for r in
               load.read_raw(spark, root, "trajectory_points").collect())
    assert p == [(7, 0, 1.0), (7, 1, 3.0), (8, 0, 4.0)]
    # same file name again with a longer track 8: only its new frame is added
    write_text(src, "d.csv", HEADER + "8; Bus; 5.0; 1.0; 9; 9; 9; 9; 9; 9; 5; 5; 5; 5; 5; 5;\n")
    c2 = load.load_batch(ragged.read_ragged(spark, src, "d.csv"), root)
    assert (c2.tracks_inserted, c2.points_inserted) == (0, 1)
    p = sorted((r.track_id, r.frame_idx, r.speed) for r in
               load.read_raw(spark, root, "trajectory_points").collect())
    assert p == [(7, 0, 1.0), (7, 1, 3.0), (8, 0, 4.0), (8, 1, 5.0)]


def test_existing_keys_read_prunes_partitions(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    root = os.path.join(tmp_dir, "raw")
    write_text(src, "a.csv", HEADER + "1; Car; 1.0; 1.0; 1; 1; 1; 1; 1; 1;\n")
    write_text(src, "b.csv", HEADER + "2; Car; 1.0; 1.0; 1; 1; 1; 1; 1; 1;\n")
    load.load_batch(ragged.read_ragged(spark, src, "*.csv"), root)
    files = load.stored(spark, root, "tracks").filter("track_id = 2").select("source_file")
    keys = load.existing_keys(spark, root, "trajectory_points", ["source_file", "track_id"], files)
    assert "dynamicpruning" in keys._jdf.queryExecution().executedPlan().toString()
    assert [r.track_id for r in keys.collect()] == [2]


def test_incremental_scan_prunes_files(spark, tmp_dir):
    root = os.path.join(tmp_dir, "raw")
    src = os.path.join(tmp_dir, "src")
    write_text(src, "a.csv", HEADER + "1; Car; 1.0; 1.0; 37.9; 23.7; 5; 0; 0; 0;\n")
    load.load_batch(ragged.read_ragged(spark, src, "a.csv"), root, loaded_at=dt.datetime(2024, 1, 1))
    write_text(src, "b.csv", HEADER + "2; Car; 1.0; 1.0; 37.9; 23.7; 5; 0; 0; 0;\n")
    load.load_batch(ragged.read_ragged(spark, src, "b.csv"), root, loaded_at=dt.datetime(2024, 1, 3))
    new = incremental.new_fact_rows(_fact_rows(spark, root), dt.datetime(2024, 1, 2))
    assert "dynamicpruning" in new._jdf.queryExecution().executedPlan().toString()
    assert [r.track_id for r in new.collect()] == [2]


def test_digit_file_names_stay_apart(spark, tmp_dir):
    src, root = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "raw")
    old = spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled")
    spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "true")
    try:
        for name in ("20181024", "020181024"):
            write_text(src, name, HEADER + "1; Car; 1.0; 1.0; 37.9; 23.7; 5; 0; 0; 0;\n")
            c = load.load_batch(ragged.read_ragged(spark, src, name), root)
            assert (c.tracks_inserted, c.points_inserted) == (1, 1)
        fact = os.path.join(tmp_dir, "fct")
        incremental.merge_into(spark, fact, incremental.new_fact_rows(_fact_rows(spark, root),
                                                                      incremental.FLOOR_MARK))
        assert incremental.read_table(spark, fact).count() == 2
    finally:
        spark.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", old)


def test_rejects_are_kept_once_and_deleted_with_the_file(spark, tmp_dir):
    src, root = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "raw")
    write_text(src, "r.csv", HEADER + "1; Car; 1.0; 1.0; 37.9; 23.7; 5; 0; 0; 0;\nbad;\nbad;\nworse; 1;\n")
    for _ in range(2):
        load.load_batch(ragged.read_ragged(spark, src, "r.csv"), root, mode="permissive")
    got = sorted((r.line, r.n_lines) for r in load.read_raw(spark, root, "rejects").collect())
    assert got == [("bad;", 2), ("worse; 1;", 1)]
    load.delete_source_file(spark, root, "r.csv")
    assert load.read_raw(spark, root, "rejects").count() == 0


def test_half_a_load_shows_no_points(spark, tmp_dir, monkeypatch):
    root = os.path.join(tmp_dir, "raw")
    assert load.read_raw(spark, root, "tracks").count() == 0     # fresh root: empty tables
    assert load.read_raw(spark, root, "trajectory_points").columns == load.POINT_COLS

    def stop(*_):
        raise KeyboardInterrupt
    monkeypatch.setattr(load, "insert_if_absent", stop)
    with pytest.raises(KeyboardInterrupt):
        load.load_batch(sample(spark), root)
    assert load.stored(spark, root, "trajectory_points").count() == 10
    assert load.read_raw(spark, root, "trajectory_points").count() == 0
    monkeypatch.undo()
    load.load_batch(sample(spark), root)
    assert load.read_raw(spark, root, "trajectory_points").count() == 10


def test_schema_sync_keeps_files_and_takes_empty_batches(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    row = "trajectory_point_sk string, source_file string, x int"
    incremental.merge_into(spark, path, spark.createDataFrame([("k1", "f", 1), ("k2", "g", 2)], row))
    before = sorted(os.listdir(os.path.join(path, "source_file=f")))
    more = row + ", note string"
    incremental.merge_into(spark, path, spark.createDataFrame([], more))
    assert incremental.read_table(spark, path).columns[-1] == "note"
    incremental.merge_into(spark, path, spark.createDataFrame([("k2", "g", 5, "n")], more))
    assert sorted(os.listdir(os.path.join(path, "source_file=f"))) == before
    wider = spark.createDataFrame([("k3", "g", "seven", "n")], more.replace("x int", "x string"))
    incremental.merge_into(spark, path, wider)
    got = {r.trajectory_point_sk: (r.x, r.note) for r in incremental.read_table(spark, path).collect()}
    assert got == {"k1": ("1", None), "k2": ("5", "n"), "k3": ("seven", "n")}


def test_a_column_that_comes_back_has_lost_its_values(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    cols = "trajectory_point_sk string, source_file string, note string"
    merge = lambda rows, schema: incremental.merge_into(
        spark, path, spark.createDataFrame(rows, schema))
    merge([("a", "f", "old")], cols)
    merge([("b", "g")], "trajectory_point_sk string, source_file string")
    merge([("c", "h", "new")], cols)
    got = {r.trajectory_point_sk: r.note for r in incremental.read_table(spark, path).collect()}
    assert got == {"a": None, "b": None, "c": "new"}


def test_refresh_follows_the_batch_and_not_the_clock(spark, tmp_dir):
    """Two batches of one load time, one of an earlier time, and a replayed epoch."""
    src, root = f"{tmp_dir}/in", f"{tmp_dir}/raw"
    row = "{}; Car; 10; 5; " + "37.9; 23.7; 5; 0; 0; 0.0; 37.9; 23.7; 6; 0; 0; 0.04\n"
    for name, track in (("a.csv", 1), ("b.csv", 2), ("c.csv", 3)):
        write_text(src, name, HEADER + row.format(track))
    at = dt.datetime(2024, 5, 1)
    facts = lambda: sorted((r.source_file, r.frame_idx) for r in incremental.read_table(
        spark, f"{root}/fct_trajectory_points").collect())
    for epoch, name, stamp in ((0, "a.csv", at), (1, "b.csv", at), (1, "b.csv", at),
                               (2, "c.csv", at - dt.timedelta(hours=1))):
        ingest.load_epoch(ragged.read_lines(spark, src, name), epoch, root, loaded_at=stamp, refresh_fact=True)
    assert facts() == [(f, i) for f in ("a.csv", "b.csv", "c.csv") for i in (0, 1)]
    # an epoch that was loaded but not merged goes with the next one
    write_text(src, "d.csv", HEADER + row.format(4))
    lines = ragged.read_lines(spark, src, "d.csv")
    ragged.RaggedBatch(ragged.parse(lines)).tracks.select("source_file", "track_id").write.parquet(
        f"{root}/{ingest.LEDGER}/epoch=3")
    load.load_batch(ragged.RaggedBatch(ragged.parse(lines)), root, loaded_at=at)
    write_text(src, "e.csv", HEADER + row.format(5))
    ingest.load_epoch(ragged.read_lines(spark, src, "e.csv"), 4, root, loaded_at=at, refresh_fact=True)
    assert facts() == [(f"{f}.csv", i) for f in "abcde" for i in (0, 1)]
    assert not os.path.exists(f"{root}/{ingest.LEDGER}/epoch=4")


def test_digest_finds_a_missing_frame_beside_a_stale_one(spark):
    frames = lambda *idx: spark.createDataFrame([(i,) for i in idx], "frame_idx int").agg(
        incremental.frame_digest().alias("d")).first().d
    assert frames(0, 1, 2) == frames(2, 0, 1)
    others = [frames(0, 1, 3), frames(0, 1, 1), frames(0, 0, 0), frames(0, 1), frames(0, 1, 2, 2), frames(1, 1, 1)]
    assert frames(0, 1, 2) not in others and len(set(others)) == len(others)


def test_paths_without_scheme_belong_to_the_default_file_system(spark, tmp_dir):
    from kinetra.session import path_exists
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    old = conf.get("fs.defaultFS")
    conf.set("fs.viewfs.mounttable.kt.link./data", f"file://{tmp_dir}")
    try:
        conf.set("fs.defaultFS", "viewfs://kt/")
        for expected in ((4, 10), (0, 0)):
            c = load.load_batch(ragged.read_ragged(spark, f"file://{FIXTURES}", "evening_drive.csv"), "/data/raw")
            assert (c.tracks_inserted, c.points_inserted) == expected
        assert path_exists(spark, "/data/raw/tracks") and not path_exists(spark, "/data/none")
    finally:
        conf.set("fs.defaultFS", old)


def test_a_cluster_needs_a_shared_checkpoint_folder():
    from types import SimpleNamespace

    from kinetra.session import ensure_checkpoint_dir
    bare = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(
        master="yarn", getCheckpointDir=lambda: None))
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(bare)


def test_a_crowded_file_is_written_by_several_tasks(spark, tmp_dir, monkeypatch):
    """Whatever AQE splits: one file's rows, first merged and then merged again."""
    from kinetra import session
    monkeypatch.setattr(session, "ROWS_PER_TASK", 100)
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    path = os.path.join(tmp_dir, "t")
    rows = spark.range(1000).selectExpr("concat('k', id) AS trajectory_point_sk", "if(id < 10, NULL, 'f') AS source_file",
                                        "id AS x")
    for df in (rows.filter("x < 900"), rows):
        spark.conf.set(coalesce, "false")
        try:
            incremental.merge_into(spark, path, df)
        finally:
            spark.conf.unset(coalesce)
        assert len([f for f in os.listdir(f"{path}/source_file=f") if f.endswith(".parquet")]) > 1
    assert sorted(map(tuple, spark.read.parquet(path).select("x", "source_file").collect())) == [
        (i, None if i < 10 else "f") for i in range(1000)]


def test_equal_hashes_are_no_duplicates(spark, monkeypatch):
    rows = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    monkeypatch.setattr(incremental.F, "xxhash64", lambda *_: incremental.F.lit(1).cast("long"))
    assert not incremental.holds_twice(rows, "k")
    assert incremental.holds_twice(rows.unionByName(rows.limit(1)), "k")
    assert incremental.holds_twice(rows.unionByName(rows.filter("k IS NULL")), "k")


def test_only_repeated_tracks_are_aggregated(spark, monkeypatch):
    """First row per key, as an aggregate over all frames gives it, with few and with many tracks."""
    batch = ragged.RaggedBatch(sample(spark).slim().parsed)
    want = sorted(map(str, load.first_wins(batch.points, load.POINT_KEY).collect()))
    given = []
    monkeypatch.setattr(load, "first_wins", lambda df, *a, f=load.first_wins: given.append(df.count()) or f(df, *a))
    for few in (10, 0):
        monkeypatch.setattr(load, "FEW_TRACKS", few)
        got = load.distinct_points(batch)
        assert sorted(map(str, got.select(*load.first_wins(batch.points, load.POINT_KEY).columns).collect())) == want
    assert given[0] < batch.points.count()


def test_stored_tracks_are_told_without_their_frames(spark, tmp_dir, monkeypatch):
    """A second load of the same lines neither unnests nor joins frames of stored tracks."""
    appended = []
    append = load._append
    monkeypatch.setattr(load, "_append", lambda rows, root, name, *a, **k: appended.append(name) or append(
        rows, root, name, *a, **k))
    load.load_batch(sample(spark), tmp_dir)
    assert sorted(appended) == ["tracks", "trajectory_points", "trajectory_points"]
    appended.clear()
    assert load.load_batch(sample(spark), tmp_dir).points_inserted == 0
    assert sorted(appended) == ["tracks", "trajectory_points"]


@pytest.mark.parametrize("few", [1_000_000, 0, 2])
def test_missing_frames_of_stored_tracks_are_added(spark, tmp_dir, monkeypatch, few):
    monkeypatch.setattr(load, "FEW_TRACKS", few)
    block = "1; 1; {}; 1; 1; 1; "
    lines = {1: 3, 2: 64, 3: 65, 4: 130, 5: 0, 6: 70, 7: 2, 8: 63, 9: 5}    # track: frames

    def batch(n, more=()):
        text = HEADER + "".join(f"{t}; Car; 1.0; 1.0; " + "".join(block.format(i) for i in range(k)) + "\n"
                                for t, k in [*n.items(), *more])
        write_text(os.path.join(tmp_dir, "src"), "a.csv", text)
        return ragged.read_ragged(spark, os.path.join(tmp_dir, "src"), "a.csv")

    root = os.path.join(tmp_dir, "raw")
    load.load_batch(batch({1: 2, 2: 63, 3: 64, 4: 130, 5: 0, 6: 80, 8: 63}), root)
    # stored frames 1 of track 4 and 69 of track 6 get lost, 100 rows repeat
    kept = spark.createDataFrame(load.stored(spark, root, "trajectory_points").filter(
        "NOT (track_id = 4 AND frame_idx = 1) AND NOT (track_id = 6 AND frame_idx = 69)").collect(), load.SCHEMAS[
            "trajectory_points"])
    shutil.rmtree(os.path.join(root, "trajectory_points"))
    load._append(kept.unionByName(kept.filter("track_id = 4 AND frame_idx >= 30")), root, "trajectory_points")
    old = {(r.track_id, r.frame_idx) for r in kept.collect()}
    more = [(7, 4), (2, 10)]                                   # tracks on several lines
    want = {(t, i) for t, k in [*lines.items(), *more] for i in range(k)} - old
    got = load.load_batch(batch(lines, more), root)
    assert got.points_inserted == len(want) == 1 + 1 + 1 + 1 + 1 + 4 + 5
    now = load.stored(spark, root, "trajectory_points")
    assert {(r.track_id, r.frame_idx) for r in now.collect()} == old | want
    assert now.count() == len(old) + 100 + len(want)
    assert load.load_batch(batch(lines, more), root).points_inserted == 0
