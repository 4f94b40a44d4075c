"""Query registry: one callable ``(spark, sf_dir) -> DataFrame`` per query key.

Star-schema, dashboard and incremental queries run over the warehouse built
from ``events``; source, load, data-quality and streaming queries run over
the ragged files written from ``orders`` + ``lineitem``.  Doubles produced by
floating-point aggregation or trigonometry are rounded to 6 decimals so the
results compare exactly with the DuckDB oracle.
"""

from __future__ import annotations

import datetime as dt
import math
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinetra import catalog
from kinetra.functions import sql as sql_functions
from kinetra.functions.columns import surrogate_key
from kinetra.operators import colocated, incremental, load, marts, quality, speed_partials
from kinetra.operators.observed import Observed
from kinetra.plans import dashboards
from kinetra.plans.warehouse import Warehouse, run_transform
from kinetra.session import CODEC, materialize, replace_table, scratch_path, scratch_released
from kinetra.sources import ragged, testdata
from kinetra.streaming import deltas, ingest

# Fixed values of the test scenarios (the oracle uses the same).
RAGGED_LOADED_AT = "2024-01-01 00:00:00"
INCREMENTAL_SPLIT = "2024-01-20 00:00:00"   # old fact = frames loaded before
FRESHNESS_AS_OF = dt.datetime(2024, 2, 1, 0, 0, 0)
DELETED_FILE = "ragged_000.csv"
# Longitude axis of the density pivot: the 4-decimal cells of the recording area.
PIVOT_LON_BINS = [f"{23.7 + i / 10000:.4f}" for i in range(0, 1001)]

Query = Callable[[SparkSession, str], DataFrame]


def r6(c) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# ---------------------------------------------------------------------------
# building blocks

def events_wh(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse.from_events(spark, sf_dir)


def ragged_batch(spark: SparkSession, sf_dir: str) -> ragged.RaggedBatch:
    folder = testdata.write_ragged_fixture(spark, sf_dir)
    return ragged.read_ragged(spark, folder, "ragged_*.csv")


def ragged_raw(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Raw tables as the loader would write them (first-wins per key)."""
    b = ragged.RaggedBatch(materialize(ragged_batch(spark, sf_dir).slim().parsed, "parsed", codec=CODEC))
    stamp = F.lit(RAGGED_LOADED_AT).cast("timestamp_ntz")
    repeated = load.Repeated.of(b)
    tracks = load.distinct_tracks(b, repeated).withColumn("loaded_at", stamp)
    points = load.distinct_points(b, repeated).withColumn("loaded_at", stamp)
    return tracks.select(*load.TRACK_COLS), points.select(*load.POINT_COLS)


def ragged_wh(spark: SparkSession, sf_dir: str) -> Warehouse:
    t, p = ragged_raw(spark, sf_dir)
    return Warehouse(t, p)


def fact_view(fct: DataFrame) -> DataFrame:
    return fct.select(*[r6(c).alias(c) if c == "delta_distance_m" else F.col(c)
                        for c in marts.FACT_COLUMNS])


TRACK_OUT = ["source_file", "track_id", "vehicle_type", "traveled_d", "avg_speed"]
POINT_OUT = ["source_file", "track_id", "frame_idx", "lat", "lon", "speed", "lon_acc",
             "lat_acc", "time_sec"]


# ---------------------------------------------------------------------------
# A. sources and sinks

def q_ragged_headers(spark, sf_dir):
    return ragged_batch(spark, sf_dir).tracks.select(*TRACK_OUT)


def q_ragged_unnest(spark, sf_dir):
    return ragged_batch(spark, sf_dir).points.select(*POINT_OUT)


def q_ragged_rejects(spark, sf_dir):
    return ragged_batch(spark, sf_dir).rejects.select(
        "source_file", "first_field", F.col("n_fields").cast("long").alias("n_fields"),
        "reject_reason")


def _load_twice(spark, sf_dir) -> tuple[str, list[load.LoadCounts]]:
    root = scratch_path(spark, "raw")
    counts = [load.load_batch(ragged_batch(spark, sf_dir), root, mode="permissive")
              for _ in range(2)]
    return root, counts


def q_load_tracks_idempotent(spark, sf_dir):
    root, _ = _load_twice(spark, sf_dir)
    return load.read_raw(spark, root, "tracks").select(*TRACK_OUT)


def q_load_points_idempotent(spark, sf_dir):
    root, _ = _load_twice(spark, sf_dir)
    return load.read_raw(spark, root, "trajectory_points").select(*POINT_OUT)


def q_load_counts(spark, sf_dir):
    _, counts = _load_twice(spark, sf_dir)
    rows = [(i + 1, c.tracks_loaded, c.points_loaded, c.tracks_inserted, c.points_inserted,
             c.rejected_lines) for i, c in enumerate(counts)]
    return spark.createDataFrame(
        rows, "run int, tracks_loaded long, points_loaded long, tracks_inserted long, "
              "points_inserted long, rejected_lines long")


def q_delete_source_file(spark, sf_dir):
    root = scratch_path(spark, "raw")
    load.load_batch(ragged_batch(spark, sf_dir), root, mode="permissive")
    load.delete_source_file(spark, root, DELETED_FILE)
    t = load.read_raw(spark, root, "tracks").groupBy("source_file").agg(
        F.count(F.lit(1)).alias("track_count"))
    p = load.read_raw(spark, root, "trajectory_points").groupBy("source_file").agg(
        F.count(F.lit(1)).alias("point_count"))
    return t.join(p, "source_file", "full_outer").select(
        "source_file", F.coalesce("track_count", F.lit(0)).alias("track_count"),
        F.coalesce("point_count", F.lit(0)).alias("point_count"))


# ---------------------------------------------------------------------------
# B-E. staging, deltas, kinematics, marts

def q_stg_tracks(spark, sf_dir):
    return events_wh(spark, sf_dir).stg_tracks


def q_stg_points(spark, sf_dir):
    return events_wh(spark, sf_dir).stg_points


def q_surrogate_key(spark, sf_dir):
    t = testdata.events_tracks(spark, sf_dir)
    return t.select(
        "source_file", "track_id", "vehicle_type",
        surrogate_key("source_file", "track_id").alias("track_sk"),
        surrogate_key("vehicle_type").alias("vehicle_type_sk"),
        surrogate_key("source_file", F.nullif(F.col("vehicle_type"), F.lit("Car")))
        .alias("file_type_sk"))


def q_speed_bucket(spark, sf_dir):
    w = events_wh(spark, sf_dir)
    return w.points_with_deltas.select("trajectory_point_sk", "speed_kmh", "speed_bucket")


def q_haversine(spark, sf_dir):
    w = events_wh(spark, sf_dir)
    return w.points_with_deltas.select("trajectory_point_sk", "prev_latitude", "prev_longitude",
                                       "latitude", "longitude", r6("delta_distance_m")
                                       .alias("delta_distance_m"))


def q_track_deltas(spark, sf_dir):
    w = events_wh(spark, sf_dir)
    return w.points_with_deltas.select(
        "trajectory_point_sk", "track_sk", "frame_idx", "prev_speed_kmh",
        "prev_seconds_since_start", "prev_latitude", "prev_longitude", "delta_time_sec",
        "delta_speed_kmh", r6("delta_distance_m").alias("delta_distance_m"), "speed_bucket")


def q_sql_track_deltas(spark, sf_dir):
    """The delta model written as SQL text, over the views and SQL functions."""
    events_wh(spark, sf_dir).register_views(spark, prefix="sql_")
    sql_functions.register(spark)
    return spark.sql("""
        SELECT surrogate_key(array(source_file, CAST(track_id AS STRING), CAST(frame_idx AS STRING)))
                 AS trajectory_point_sk,
               surrogate_key(array(source_file, CAST(track_id AS STRING))) AS track_sk,
               frame_idx, prev_speed_kmh, prev_seconds_since_start, prev_latitude, prev_longitude,
               seconds_since_start - prev_seconds_since_start AS delta_time_sec,
               speed_kmh - prev_speed_kmh AS delta_speed_kmh,
               round(haversine_meters(prev_latitude, prev_longitude, latitude, longitude), 6)
                 AS delta_distance_m,
               speed_bucket(speed_kmh) AS speed_bucket
        FROM (
          SELECT *, lag(speed_kmh) OVER w AS prev_speed_kmh,
                 lag(seconds_since_start) OVER w AS prev_seconds_since_start,
                 lag(latitude) OVER w AS prev_latitude, lag(longitude) OVER w AS prev_longitude
          FROM sql_stg_trajectory_points
          WINDOW w AS (PARTITION BY track_sk ORDER BY frame_idx))""")


def q_track_kinematics(spark, sf_dir):
    return events_wh(spark, sf_dir).track_kinematics


def q_dim_vehicle_type(spark, sf_dir):
    return events_wh(spark, sf_dir).dim_vehicle_type


def q_dim_track(spark, sf_dir):
    return events_wh(spark, sf_dir).dim_track


def q_fct_points(spark, sf_dir):
    return fact_view(events_wh(spark, sf_dir).fct_points)


def _agg_view(df: DataFrame) -> DataFrame:
    return df.select("vehicle_type_sk", "vehicle_type_name", "observation_count",
                     *[r6(c).alias(c) for c in ["avg_speed_kmh", "min_speed_kmh", "max_speed_kmh",
                                                "stddev_speed_kmh", "median_speed_kmh",
                                                "p95_speed_kmh"]])


def q_agg_speed_by_type(spark, sf_dir):
    return _agg_view(events_wh(spark, sf_dir).agg_speed_by_vehicle_type)


def _partials_of_two_runs(spark, sf_dir) -> tuple[DataFrame, Warehouse]:
    """Stored partials after two incremental runs: the second brings a file of its own
    and new frames of one that was there; the other file's partials are from the first."""
    w = events_wh(spark, sf_dir)
    late = (F.col("source_file") == "part2") | (
        (F.col("source_file") == "part1") & (F.col("loaded_at") >= F.lit(INCREMENTAL_SPLIT)))
    root = scratch_path(spark, "two-runs")
    first = incremental.merge_into(spark, f"{root}/fact", Warehouse(
        w.raw_tracks, w.raw_points.filter(~late)).fct_points)
    fact = incremental.read_table(spark, f"{root}/fact")
    speed_partials.refresh(spark, f"{root}/partials", fact, w.dim_track, first)
    second = incremental.merge_into(spark, f"{root}/fact", w.fct_points.filter(late))
    fact = incremental.read_table(spark, f"{root}/fact")
    speed_partials.refresh(spark, f"{root}/partials", fact, w.dim_track, second)
    return speed_partials.stored(spark, f"{root}/partials"), w


def q_speed_moments_merged(spark, sf_dir):
    """The speed mart's moments from stored partials alone."""
    partials, w = _partials_of_two_runs(spark, sf_dir)
    m = speed_partials.moments(speed_partials.of_stored(partials), w.dim_vehicle_type)
    return m.select("vehicle_type_sk", "vehicle_type_name", "observation_count",
                    *[r6(c).alias(c) for c in ["avg_speed_kmh", "min_speed_kmh", "max_speed_kmh",
                                               "stddev_speed_kmh"]])


#: Rank error that the merged sketches must keep, as a share of the speeds.
SKETCH_RANK_ERROR = 0.02


def q_speed_sketch_merged(spark, sf_dir):
    """Whether percentiles of the merged sketches keep the rank error."""
    partials, w = _partials_of_two_runs(spark, sf_dir)
    q = speed_partials.sketch_percentiles(speed_partials.of_stored(partials), w.dim_vehicle_type, {
        "median_speed_kmh": 0.5, "p95_speed_kmh": 0.95}).withColumnRenamed("m", "observation_count")
    speeds = marts.speeds_by_type(w.fct_points, w.dim_track, w.dim_vehicle_type)
    return marts.approx_rank_errors(q, speeds, accuracy=int(1 / SKETCH_RANK_ERROR))


def q_agg_speed_approx(spark, sf_dir):
    """Whether the sketch's percentiles keep their promised rank error."""
    w = events_wh(spark, sf_dir)
    approx = marts.agg_speed_approx(w.fct_points, w.dim_track, w.dim_vehicle_type)
    speeds = marts.speeds_by_type(w.fct_points, w.dim_track, w.dim_vehicle_type)
    return marts.approx_rank_errors(approx, speeds)


# ---------------------------------------------------------------------------
# Incremental fact

def _old_fact_table(spark, sf_dir, drop: list[str] = (), extra: dict | None = None) -> tuple[str, Warehouse]:
    w = events_wh(spark, sf_dir)
    split = F.lit(INCREMENTAL_SPLIT).cast("timestamp_ntz")
    old = Warehouse(w.raw_tracks, w.raw_points.filter(F.col("loaded_at") < split))
    fct = old.fct_points
    for c, v in (extra or {}).items():
        fct = fct.withColumn(c, v)
    fct = fct.drop(*drop)
    path = scratch_path(spark, "fact") + "/fct_trajectory_points"
    replace_table(fct, path, "source_file")
    return path, w


def _new_rows(spark, path: str, w: Warehouse) -> DataFrame:
    mark = incremental.high_water_mark(incremental.read_table(spark, path))
    return incremental.new_fact_rows(w.stg_points, mark)


def q_incremental_new_rows(spark, sf_dir):
    path, w = _old_fact_table(spark, sf_dir)
    return fact_view(_new_rows(spark, path, w))


def q_incremental_new_rows_by_key(spark, sf_dir):
    path, w = _old_fact_table(spark, sf_dir)
    return fact_view(incremental.new_fact_rows_by_key(w.stg_points, incremental.read_table(spark, path)))


def q_incremental_swapped_frames(spark, sf_dir):
    """The old fact holds a stale frame in the place of some tracks' first one: as many
    frames as it should, and one of them missing."""
    path, w = _old_fact_table(spark, sf_dir)
    swapped = (F.col("track_id") % 10 == 4) & (F.col("frame_idx") == 0)
    stale = incremental.read_table(spark, path).select(*[
        F.when(swapped, F.lit(v)).otherwise(F.col(c)).alias(c) if (v := {
            "frame_idx": -1, "trajectory_point_sk": "stale"}.get(c)) else F.col(c)
        for c in marts.FACT_COLUMNS])
    return fact_view(incremental.new_fact_rows_by_key(w.stg_points, stale))


def q_fact_merge(spark, sf_dir):
    """New rows, and old rows of some tracks changed: another acceleration and
    a speed that becomes NULL."""
    path, w = _old_fact_table(spark, sf_dir)
    old = incremental.read_table(spark, path)
    changed = old.filter(F.col("track_id") % 10 == 3).withColumn(
        "speed_kmh", F.lit(None).cast("double")).withColumn(
        "lon_acceleration_ms2", F.col("lon_acceleration_ms2") + 1)
    incremental.merge_into(spark, path, _new_rows(spark, path, w).unionByName(changed))
    return fact_view(incremental.read_table(spark, path))


def q_fact_schema_sync(spark, sf_dir):
    # The stored fact still carries a legacy column; speed_bucket is dropped by a run
    # without new rows and comes back with the next one: old rows have lost it.
    path, w = _old_fact_table(spark, sf_dir, extra={"legacy_flag": F.lit(True)})
    new = _new_rows(spark, path, w)
    incremental.merge_into(spark, path, new.drop("speed_bucket").filter(F.lit(False)))
    incremental.merge_into(spark, path, new)
    return fact_view(incremental.read_table(spark, path))


#: Buckets of the registered query; a job chooses them by its data (``colocated.buckets``).
FACT_BUCKETS = 8


def q_fact_colocated(spark, sf_dir):
    """The older fact and all frames in tables bucketed alike, then one refresh.  The
    fact holds some of the newer frames already, loaded long ago and without a speed."""
    w = events_wh(spark, sf_dir)
    old = F.col("loaded_at") < F.lit(INCREMENTAL_SPLIT).cast("timestamp_ntz")
    early = w.fct_points.filter(~old & (F.col("track_id") % 10 == 3)).withColumn(
        "speed_kmh", F.lit(None).cast("double")).withColumn(
        "loaded_at", F.lit("2020-01-01").cast("timestamp_ntz"))
    stored = Warehouse(w.raw_tracks, w.raw_points.filter(old)).fct_points.unionByName(early)
    tag, root = uuid.uuid4().hex[:12], scratch_path(spark, "colocated")
    points, fact = f"points_{tag}", f"fct_{tag}"
    colocated.publish_points(w.stg_points, points, root, FACT_BUCKETS)
    colocated.publish_fact(stored, fact, root, FACT_BUCKETS)
    return fact_view(colocated.refresh(spark, points, fact, root, FACT_BUCKETS))


def q_fact_publish(spark, sf_dir):
    """The fact behind a catalog name: older frames with a wrong bucket first, then all
    files' partitions switched to the whole fact."""
    w = events_wh(spark, sf_dir)
    name, root = f"fct_{uuid.uuid4().hex[:12]}", scratch_path(spark, "published")
    old = w.fct_points.filter(F.col("loaded_at") < F.lit(INCREMENTAL_SPLIT)).withColumn("speed_bucket", F.lit("OLD"))
    catalog.publish(old, name, root, "source_file")
    return fact_view(catalog.publish(w.fct_points, name, root, "source_file"))


# ---------------------------------------------------------------------------
# K. data quality (over the ragged warehouse: it has real violations)

def flawed(tracks: DataFrame, points: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The raw layer as a faulty loader might leave it: some tracks twice, some
    missing (orphan frames), some first frames twice, some types missing."""
    k = F.col("track_id")
    tracks = tracks.filter(k % 70 != 3).withColumn(
        "vehicle_type", F.when(k % 30 != 4, F.col("vehicle_type")))
    return (tracks.unionByName(tracks.filter(k % 40 == 1)),
            points.unionByName(points.filter((k % 60 == 2) & (F.col("frame_idx") == 0))))


def flawed_ragged_wh(spark: SparkSession, sf_dir: str, seen: Observed | None = None) -> Warehouse:
    """The transform run as deployed, over the flawed raw layer: raw tables
    and table models written first, checks afterwards over what is stored (or, with
    ``seen``, row-wise ones by the writes)."""
    root = scratch_path(spark, "warehouse")
    with scratch_released(spark):
        tracks, points = ragged_raw(spark, sf_dir)
        t, p = flawed(tracks, points)
        raw = [replace_table(df, f"{root}/{name}", "source_file", seen and seen.watch(name), by_file=True)
               for name, df in (("raw_tracks", t), ("raw_trajectory_points", p))]
    return Warehouse(*raw).materialize(root, seen)


def _dq(tests: set[str] | None):
    def run(spark, sf_dir):
        return quality.evaluate(flawed_ragged_wh(spark, sf_dir).models(), tests=tests)
    return run


def _dq_observed(tests: set[str]):
    """Row-wise checks from the metrics of the run's own writes."""
    def run(spark, sf_dir):
        seen = Observed(tests=tests)
        flawed_ragged_wh(spark, sf_dir, seen)
        return seen.results(spark)
    return run


def q_dq_max_speed(spark, sf_dir):
    # Over the events warehouse: its speeds reach ~490 km/h, so rows return.
    return quality.assert_max_speed(events_wh(spark, sf_dir).dim_track)


def q_dq_negative_distance(spark, sf_dir):
    # A distance is never negative by itself: some are planted.
    fct = events_wh(spark, sf_dir).fct_points.withColumn("delta_distance_m", F.when(
        F.col("frame_idx") % 50 == 7, -F.col("delta_distance_m")).otherwise(F.col("delta_distance_m")))
    return quality.assert_no_negative_distance(fct).select(
        "trajectory_point_sk", "track_sk", r6("delta_distance_m").alias("delta_distance_m"))


def q_dq_report(spark, sf_dir):
    w = flawed_ragged_wh(spark, sf_dir)
    return quality.evaluate(w.models()).unionByName(
        quality.singular_results(w.dim_track, w.fct_points))


def q_run_history(spark, sf_dir):
    """Model rows and gate verdict of one transform run over loaded files."""
    raw, out = scratch_path(spark, "raw"), scratch_path(spark, "run")
    at = dt.datetime.fromisoformat(RAGGED_LOADED_AT)
    load.load_batch(ragged_batch(spark, sf_dir), raw, mode="permissive", loaded_at=at)
    run_transform(spark, raw, out, "run-1", as_of=at + dt.timedelta(hours=1), gate=False)
    return quality.run_history(spark, out).select("run_id", "model", "status", "row_count", "gate")


def q_freshness(spark, sf_dir):
    w = events_wh(spark, sf_dir)
    return quality.freshness({"tracks": w.raw_tracks, "trajectory_points": w.raw_points},
                             FRESHNESS_AS_OF)


# ---------------------------------------------------------------------------
# L. dashboards

def q_fleet_mix(spark, sf_dir):
    w = events_wh(spark, sf_dir)
    return dashboards.fleet_mix(w.dim_track, w.dim_vehicle_type).select(
        "vehicle_type_name", "track_count", r6("share").alias("share"))


def q_speed_box_by_type(spark, sf_dir):
    w = events_wh(spark, sf_dir)
    b = dashboards.speed_box_by_type(w.speeds, w.dim_track, w.dim_vehicle_type)
    return b.select("vehicle_type_name", *[r6(c).alias(c) for c in
                                           ["q1", "median", "q3", "iqr", "lower_whisker",
                                            "upper_whisker"]],
                    "outlier_count", "observation_count")


def q_speed_histogram(spark, sf_dir):
    # some speeds are made NaN, infinite or NULL
    i = F.col("frame_idx")
    fct = events_wh(spark, sf_dir).fct_points.withColumn("speed_kmh", F.when(
        i % 31 == 5, float("nan")).when(i % 37 == 5, float("inf")).when(i % 41 != 5, F.col("speed_kmh")))
    h = dashboards.speed_histogram(fct)
    return h.select("bin", r6("bin_lower").alias("bin_lower"), r6("bin_upper").alias("bin_upper"),
                    "point_count")


def q_density_grid(spark, sf_dir):
    return dashboards.density_grid(events_wh(spark, sf_dir).fct_points)


def q_density_pivot(spark, sf_dir):
    return dashboards.density_pivot(events_wh(spark, sf_dir).fct_points, PIVOT_LON_BINS)


def q_longest_tracks(spark, sf_dir):
    return dashboards.longest_tracks(events_wh(spark, sf_dir).dim_track)


def q_accel_sample(spark, sf_dir):
    """One row: whether every sampled row is a row of the fact and the sample's
    size lies within six deviations of the expected one."""
    fct = events_wh(spark, sf_dir).fct_points
    n = fct.count()
    cols = ["trajectory_point_sk", "lon_acceleration_ms2", "lat_acceleration_ms2"]
    sample = dashboards.accel_sample(fct)
    member = sample.join(fct.select(*cols, F.lit(1).alias("hit")), cols, "left").agg(
        F.count(F.lit(1)).alias("k"), F.count_if(F.col("hit").isNull()).alias("strangers"))
    f = dashboards.SAMPLE_FRACTION
    return member.select(
        (F.col("strangers") == 0).alias("all_members"),
        (F.abs(F.col("k") - f * n) <= 6 * math.sqrt(f * (1 - f) * n) + 1).alias("size_ok"))


def q_accel_sample_hash(spark, sf_dir):
    return dashboards.accel_sample_hash(events_wh(spark, sf_dir).fct_points)


# ---------------------------------------------------------------------------
# J. streaming

def _stream_load(spark, sf_dir, refresh_fact: bool, files_per_batch: int | None = None) -> str:
    folder = testdata.write_ragged_fixture(spark, sf_dir)
    root = scratch_path(spark, "stream-raw")
    ingest.run_ragged_ingest(spark, folder, root, checkpoint=root + "/_checkpoint",
                             glob="ragged_*.csv", refresh_fact=refresh_fact,
                             max_files_per_trigger=files_per_batch,
                             loaded_at=dt.datetime.fromisoformat(RAGGED_LOADED_AT))
    return root


def q_stream_ragged_load(spark, sf_dir):
    root = _stream_load(spark, sf_dir, refresh_fact=False)
    return load.read_raw(spark, root, "tracks").select(*TRACK_OUT)


def q_stream_fact_refresh(spark, sf_dir):
    # several micro-batches, all of one loaded_at
    files = testdata.ragged_file_count(testdata.table(spark, sf_dir, "orders").count())
    root = _stream_load(spark, sf_dir, refresh_fact=True, files_per_batch=-(-files // 2))
    f = incremental.read_table(spark, root + "/fct_trajectory_points")
    return fact_view(f).withColumn("loaded_at", F.col("loaded_at").cast("timestamp_ntz"))


def q_stream_track_deltas(spark, sf_dir):
    """Frames that arrive in two micro-batches, with a restart between them."""
    w = events_wh(spark, sf_dir)
    base = scratch_path(spark, "stream-deltas")
    later = F.col("loaded_at") >= F.lit(INCREMENTAL_SPLIT)
    for part in (~later, later):
        w.stg_points.filter(part).write.mode("append").parquet(f"{base}/in")
        deltas.run_deltas(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint", w.stg_points.schema)
    return spark.read.parquet(f"{base}/out").filter("NOT late").select(
        "trajectory_point_sk", "track_sk", "frame_idx", "prev_speed_kmh",
        "prev_seconds_since_start", "prev_latitude", "prev_longitude", "delta_time_sec",
        "delta_speed_kmh", r6("delta_distance_m").alias("delta_distance_m"), "speed_bucket")


QUERIES: dict[str, Query] = {
    "ragged_headers": q_ragged_headers,
    "ragged_unnest": q_ragged_unnest,
    "ragged_rejects": q_ragged_rejects,
    "load_tracks_idempotent": q_load_tracks_idempotent,
    "load_points_idempotent": q_load_points_idempotent,
    "load_counts": q_load_counts,
    "delete_source_file": q_delete_source_file,
    "stg_tracks": q_stg_tracks,
    "stg_points": q_stg_points,
    "surrogate_key": q_surrogate_key,
    "speed_bucket": q_speed_bucket,
    "haversine": q_haversine,
    "track_deltas": q_track_deltas,
    "sql_track_deltas": q_sql_track_deltas,
    "track_kinematics": q_track_kinematics,
    "dim_vehicle_type": q_dim_vehicle_type,
    "dim_track": q_dim_track,
    "fct_points": q_fct_points,
    "agg_speed_by_type": q_agg_speed_by_type,
    "agg_speed_by_type_distributed": q_agg_speed_by_type,      # the only plan there is
    "speed_moments_merged": q_speed_moments_merged,
    "speed_sketch_merged": q_speed_sketch_merged,
    "agg_speed_approx": q_agg_speed_approx,
    "incremental_new_rows": q_incremental_new_rows,
    "incremental_new_rows_by_key": q_incremental_new_rows_by_key,
    "incremental_swapped_frames": q_incremental_swapped_frames,
    "fact_merge": q_fact_merge,
    "fact_schema_sync": q_fact_schema_sync,
    "fact_publish": q_fact_publish,
    "fact_colocated": q_fact_colocated,
    "dq_not_null": _dq_observed({"not_null"}),
    "dq_unique": _dq({"unique"}),
    "dq_accepted_values": _dq({"accepted_values"}),
    "dq_relationships": _dq({"relationships"}),
    "dq_between": _dq_observed({"between"}),
    "dq_max_speed": q_dq_max_speed,
    "dq_negative_distance": q_dq_negative_distance,
    "dq_report": q_dq_report,
    "run_history": q_run_history,
    "freshness": q_freshness,
    "fleet_mix": q_fleet_mix,
    "speed_box_by_type": q_speed_box_by_type,
    "speed_histogram": q_speed_histogram,
    "density_grid": q_density_grid,
    "density_pivot": q_density_pivot,
    "longest_tracks": q_longest_tracks,
    "accel_sample": q_accel_sample,
    "accel_sample_hash": q_accel_sample_hash,
    "stream_ragged_load": q_stream_ragged_load,
    "stream_fact_refresh": q_stream_fact_refresh,
    "stream_track_deltas": q_stream_track_deltas,
}
