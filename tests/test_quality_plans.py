"""Data-quality checks, freshness, and plan shapes."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kinetra.operators import quality
from kinetra.plans.registry import QUERIES, events_wh, ragged_batch

SF = "/root/testdata/sf0.001"


def test_declared_checks_count():
    c = Counter(ch.test for ch in quality.CHECKS)
    assert len(quality.CHECKS) == 69
    assert c == {"not_null": 44, "unique": 10, "between": 8, "relationships": 4, "accepted_values": 3}


def test_accepted_values_null_passes_and_counts_distinct(spark):
    df = spark.createDataFrame([("Car",), (None,), ("Boat",), ("Boat",), ("Tram",)], "vehicle_type string")
    res = quality.evaluate({"stg_tracks": df}, tests={"accepted_values"}).first()
    assert res.failures == 2 and res.status == "fail"


def test_each_model_is_read_once(spark, monkeypatch):
    """One scan per model, however many checks of however many kinds name it."""
    from kinetra.plans.registry import flawed_ragged_wh
    seen = {}
    monkeypatch.setattr(quality, "materialize", lambda df, name: seen.setdefault(name, df))
    models = flawed_ragged_wh(spark, SF).models()
    quality.evaluate(models)
    p = seen["check-values"]._jdf.queryExecution().optimizedPlan().toString()
    assert p.count("Relation [") == sum(m._jdf.queryExecution().optimizedPlan().toString().count("Relation [")
                                        for m in models.values())
    assert p.count("Aggregate [id") == 1


def test_checks_observed_at_the_write_equal_a_scan(spark):
    """Every row-wise check of every model, from the metrics of one run's writes."""
    from kinetra.operators.observed import Observed
    from kinetra.plans.registry import flawed_ragged_wh
    seen = Observed()
    models = flawed_ragged_wh(spark, SF, seen).models()
    got = sorted(map(tuple, seen.results(spark).collect()))
    assert len(got) == 52 and {"pass", "fail"} <= {r[5] for r in got}
    assert got == sorted(map(tuple, quality.evaluate(models, tests=set(quality.ROW_WISE)).collect()))


def test_observed_metrics_sit_in_the_writing_stage(spark, tmp_dir):
    """Above the shuffle of a partitioned write, and once for an empty table."""
    from kinetra.operators.observed import Observed
    from kinetra.session import for_partitioned_write, replace_table
    df = spark.createDataFrame([("f", 1, None, 1.0, 2.0, None)] * 3,
                               "source_file string, track_id int, vehicle_type string, traveled_d double, "
                               "avg_speed double, loaded_at timestamp")
    seen = Observed()
    p = seen.watch("raw_tracks")(for_partitioned_write(df))._jdf.queryExecution().optimizedPlan().toString()
    assert p.index("CollectMetrics") < p.index("RebalancePartitions")
    for rows, n in ((df, 3), (df.limit(0), 0)):
        seen = Observed(tests={"not_null"})
        out = replace_table(rows, f"file://{tmp_dir}/raw_tracks", "source_file", seen.watch("raw_tracks"))
        assert out.columns == df.columns and out.count() == n
        failed = {(r.model, r.column_name): r.failures for r in seen.results(spark).collect()}
        assert failed["raw_tracks", "loaded_at"] == n and failed["stg_tracks", "vehicle_type"] == n
        assert failed["stg_tracks", "track_sk"] == failed["raw_tracks", "track_id"] == 0


def test_warn_severity(spark):
    df = spark.createDataFrame([(20.0,)], "lon_acceleration_ms2 double")
    checks = [c for c in quality.CHECKS if c.column == "lon_acceleration_ms2"]
    r = quality.evaluate({"stg_points": df}, checks=checks).first()
    assert (r.failures, r.severity, r.status) == (1, "warn", "warn")


@pytest.mark.parametrize("hours,status", [(23, "pass"), (25, "warn"), (73, "error")])
def test_freshness(spark, hours, status):
    now = dt.datetime(2024, 3, 1, 12, 0, 0)
    df = spark.createDataFrame([(now - dt.timedelta(hours=hours),)], "loaded_at timestamp_ntz")
    assert quality.freshness({"t": df}, now).first().status == status


def test_gate_raises_on_error_failures(spark):
    df = spark.createDataFrame([(None,)], "source_file string")
    res = quality.evaluate({"raw_tracks": df}, checks=[quality.CHECKS[0]])
    with pytest.raises(AssertionError):
        quality.gate(res)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_parse_tokenises_once(spark):
    for key in ("ragged_unnest", "ragged_headers", "ragged_rejects"):
        p = plan(QUERIES[key](spark, SF))
        assert p.count("split(") == 1, key


def test_lags_share_one_window(spark):
    from conftest import FIXTURES

    from kinetra.operators.staging import stg_points
    from kinetra.operators.trajectory import points_with_deltas
    from kinetra.sources import ragged
    pts = ragged.read_ragged(spark, FIXTURES, "evening_drive.csv").points.withColumn(
        "loaded_at", F.current_timestamp())
    # windows per (track, chunk), on the main and the carry side, plus the
    # small window over one row per chunk
    p = plan(points_with_deltas(stg_points(pts)))
    assert p.count("Window [") == 3


def test_type_dimension_broadcast(spark):
    w = events_wh(spark, SF)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(w.dim_track)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "BroadcastHashJoin" in p


def test_incremental_semi_join_below_window(spark):
    from kinetra.operators import incremental
    w = events_wh(spark, SF)
    df = incremental.new_fact_rows(w.stg_points, dt.datetime(2024, 1, 20))
    txt = df._jdf.queryExecution().optimizedPlan().toString()
    assert txt.index("Window") < txt.index("LeftSemi")  # semi join sits below (printed later)


def test_scan_prunes_columns(spark):
    df = QUERIES["density_grid"](spark, SF)
    p = plan(df)
    import re
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", p)
    assert schemas and all("event_type" not in x for x in schemas)
    assert any("props:string" in x and "value:double" in x for x in schemas)


def test_entry_runs(spark):
    import __spark_entry__ as E
    rows = E.entry(spark).collect()
    assert len(rows) == 6
    assert F is not None and ragged_batch is not None


def test_sql_functions_are_inlined(spark):
    p = plan(QUERIES["sql_track_deltas"](spark, SF))
    assert "ASIN(" in p and "md5(" in p
    assert not any(word in p for word in ("haversine_meters(", "surrogate_key(", "PythonUDF", "BatchEvalPython",
                                          "ScalaUDF", "SQLFunction"))


def test_sql_functions_treat_nulls_like_the_column_functions(spark):
    from kinetra.functions import columns, sql
    sql.register(spark)
    df = spark.createDataFrame([(None, "x", 1.0), ("x", None, None), ("a", "b", float("nan")), (None, None, -3.0)],
                               "a string, b string, v double")
    got = df.selectExpr("surrogate_key(array(a, b)) k", "speed_bucket(v) s",
                        "haversine_meters(v, 1, 2, 3) d").collect()
    want = df.select(columns.surrogate_key("a", "b").alias("k"), columns.speed_bucket("v").alias("s"),
                     columns.haversine_m("v", F.lit(1), F.lit(2), F.lit(3)).alias("d")).collect()
    assert [(r.k, r.s, str(r.d)) for r in got] == [(r.k, r.s, str(r.d)) for r in want]


def test_sql_over_registered_views(spark):
    w = events_wh(spark, SF)
    w.register_views(spark, prefix="t_")
    got = spark.sql("""
        SELECT ROUND(latitude, 4) AS lat_bin, ROUND(longitude, 4) AS lon_bin, COUNT(*) AS point_count
        FROM t_fct_trajectory_points GROUP BY 1, 2""")
    want = QUERIES["density_grid"](spark, SF)
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in want.collect())


def test_checks_keep_no_value_that_occurs_once(spark, monkeypatch):
    """A unique column's values are counted packed; only repeated ones are written."""
    seen = {}
    monkeypatch.setattr(quality, "materialize", lambda df, name: seen.setdefault(name, df.localCheckpoint()))
    keys = ["0" * 32, "0" * 32, "f" * 32, "F" * 32, "f" * 31, "", None, None]
    df = spark.createDataFrame([(k,) for k in keys], "trajectory_point_sk string")
    assert quality.evaluate({"stg_points": df}, tests={"unique"}).first().failures == 1
    assert {r.n for r in seen["check-values"].collect()} == {2}
    lengths = df.select(F.length(quality.packed(F.col("trajectory_point_sk"))).alias("n")).collect()
    assert [r.n for r in lengths] == [17, 17, 17, 33, 32, 1, None, None]


def test_keys_are_hashed_after_the_shuffles(spark, tmp_dir):
    from kinetra.operators import staging, trajectory
    raw = spark.createDataFrame([("f", 1, i, 38.0, 23.7, float(i), 0.0, 0.0, float(i)) for i in range(3)],
                                "source_file string, track_id int, frame_idx int, lat double, lon double, speed double, "
                                "lon_acc double, lat_acc double, time_sec double").withColumn(
        "loaded_at", F.current_timestamp())
    raw.write.parquet(f"{tmp_dir}/raw")
    rows = trajectory.points_with_deltas(staging.stg_points(spark.read.parquet(f"{tmp_dir}/raw")))
    lines = plan(rows).split("== Initial Plan ==")[-1].splitlines()
    last_hash = max(i for i, x in enumerate(lines) if "md5(" in x)
    assert last_hash < min(i for i, x in enumerate(lines) if "Exchange" in x)
    assert [r.prev_speed_kmh for r in rows.orderBy("frame_idx").collect()] == [None, 0.0, 1.0]
