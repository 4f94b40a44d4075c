"""Marts: vehicle-type and track dimensions, the point fact and the per-type
speed aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinetra.functions.columns import surrogate_key
from kinetra.functions.order_statistics import class_counts, in_order, percentiles
from kinetra.operators import speed_partials
from kinetra.schemas import TRACK_KEY
from kinetra.session import materialize

FACT_COLUMNS = [
    "trajectory_point_sk", "track_sk", "source_file", "track_id", "frame_idx",
    "latitude", "longitude", "speed_kmh", "lon_acceleration_ms2", "lat_acceleration_ms2",
    "seconds_since_start", "delta_time_sec", "delta_speed_kmh", "delta_distance_m",
    "speed_bucket", "loaded_at",
]

DIM_TRACK_COLUMNS = [
    "track_sk", "vehicle_type_sk", "source_file", "track_id", "vehicle_type",
    "total_distance_m", "avg_speed_kmh", "point_count", "duration_sec", "min_speed_kmh",
    "max_speed_kmh", "stopped_point_count", "loaded_at",
]


def dim_vehicle_type(stg_tracks: DataFrame) -> DataFrame:
    types = stg_tracks.filter(F.col("vehicle_type").isNotNull()).select("vehicle_type").distinct()
    return types.select(surrogate_key("vehicle_type").alias("vehicle_type_sk"),
                        F.col("vehicle_type").alias("vehicle_type_name"))


def dim_track(stg_tracks: DataFrame, kinematics: DataFrame, vehicle_types: DataFrame) -> DataFrame:
    """Tracks left-joined to their kinematics (a track without frames keeps
    NULL measures) and to the type dimension (NULL type -> NULL key)."""
    types = vehicle_types.select("vehicle_type_sk", "vehicle_type_name")
    kin = kinematics.select("track_sk", "point_count", "duration_sec", "min_speed_kmh",
                            "max_speed_kmh", "stopped_point_count")
    j = (stg_tracks.join(kin, "track_sk", "left")
         .join(types, F.col("vehicle_type") == F.col("vehicle_type_name"), "left"))
    return j.select(*DIM_TRACK_COLUMNS)


def fct_points(points_with_deltas: DataFrame) -> DataFrame:
    return points_with_deltas.select(*FACT_COLUMNS)


TYPE_KEYS = ["vehicle_type_sk", "vehicle_type_name"]


def speeds_by_type(fct: DataFrame, dim_trk: DataFrame, vehicle_types: DataFrame) -> DataFrame:
    """(type, _v, _c): how often each speed (NULL included) occurs per vehicle
    type, written once.  Frames are counted per track and speed first, so the
    joins to the dimensions move counts and not frames; tracks without a known
    type drop out (inner joins).  Spark sizes the joins itself."""
    per_track = fct.groupBy("track_sk", F.col("speed_kmh").alias("_v")).agg(
        F.count(F.lit(1)).alias("_c"))
    trk = dim_trk.select("track_sk", "vehicle_type_sk").filter(F.col("vehicle_type_sk").isNotNull())
    types = vehicle_types.select(*TYPE_KEYS)
    typed = per_track.join(trk, "track_sk").groupBy("vehicle_type_sk", "_v").agg(
        F.sum("_c").alias("_c"))
    return materialize(typed.join(types, "vehicle_type_sk").groupBy(*TYPE_KEYS, "_v").agg(
        F.sum("_c").alias("_c")), "speeds-by-type")


def _values_and_owners(fct: DataFrame, dim_trk: DataFrame) -> tuple[DataFrame, DataFrame]:
    track = speed_partials.owner(fct, dim_trk).alias("_owner")
    values = fct.select(track, F.col("speed_kmh").alias("_v")).filter("_v IS NOT NULL")
    owners = dim_trk.select(track, F.col("vehicle_type_sk").alias("_group"))
    return values, owners.filter("_group IS NOT NULL")


def _track_types(dim_trk: DataFrame) -> DataFrame:
    return materialize(dim_trk.select(*[c for c in ("track_sk", *TRACK_KEY, "vehicle_type_sk")
                                        if c in dim_trk.columns]), "track-types")


def agg_speed_by_vehicle_type(fct: DataFrame, dim_trk: DataFrame, vehicle_types: DataFrame,
                              by_type: DataFrame | None = None, stored: bool = False) -> DataFrame:
    """Count, mean, extremes, deviation and exact percentiles per type.  ``stored``: the
    track dimension is a written table, which is read as it is.

    All but the percentiles come from merged partials (``by_type``, or made from the
    frames); the percentiles read the fact's speeds, of which only those near a
    percentile are shuffled."""
    dim_trk = dim_trk if stored else _track_types(dim_trk)
    by_type = materialize(by_type if by_type is not None else speed_partials.of_types(fct, dim_trk),
                          "speeds-by-type")
    values, owners = _values_and_owners(fct, dim_trk)
    found = percentiles(values, owners, by_type.withColumnRenamed("vehicle_type_sk", "_group"),
                        {"median": 0.5, "p95": 0.95})
    pct = fct.sparkSession.createDataFrame(
        [(g, q["median"], q["p95"]) for g, q in found.items()],
        "vehicle_type_sk string, median_speed_kmh double, p95_speed_kmh double")
    return speed_partials.moments(by_type, vehicle_types).join(pct, "vehicle_type_sk", "left").select(
        *TYPE_KEYS, "observation_count", "avg_speed_kmh", "min_speed_kmh", "max_speed_kmh",
        "stddev_speed_kmh", "median_speed_kmh", "p95_speed_kmh")


def speed_box(fct: DataFrame, dim_trk: DataFrame, vehicle_types: DataFrame,
              by_type: DataFrame | None = None) -> DataFrame:
    """Box plot per type with speeds: quartiles, Tukey whiskers (1.5 IQR) and outliers.
    The fences cut the axis into classes, whose counts and extremes say the rest."""
    dim_trk = _track_types(dim_trk)
    by_type = materialize(by_type if by_type is not None else speed_partials.of_types(fct, dim_trk),
                          "speeds-by-type")
    values, owners = _values_and_owners(fct, dim_trk)
    found = percentiles(values, owners, by_type.withColumnRenamed("vehicle_type_sk", "_group"),
                        {"q1": 0.25, "median": 0.5, "q3": 0.75})
    fences = {g: (q["q1"] - 1.5 * (q["q3"] - q["q1"]), q["q3"] + 1.5 * (q["q3"] - q["q1"]))
              for g, q in found.items()}
    bounds = in_order(x for f in fences.values() for x in f)
    place = {str(u): i for i, u in enumerate(bounds)}
    counts = class_counts(values, owners, bounds, extremes=True)
    rows = []
    for g, q in found.items():
        lo, hi = (2 * place[str(x)] + 1 for x in fences[g])
        inside = [r for c, r in counts[g].items() if lo <= c <= hi]
        total = sum(r.n for r in counts[g].values())
        low = [r.low for r in inside]
        rows.append((g, q["q1"], q["median"], q["q3"], q["q3"] - q["q1"],
                     in_order(low)[0] if low else None, in_order(r.high for r in inside)[-1] if low else None,
                     total - sum(r.n for r in inside), total))
    box = fct.sparkSession.createDataFrame(
        rows, "vehicle_type_sk string, q1 double, median double, q3 double, iqr double, lower_whisker double, "
              "upper_whisker double, outlier_count long, observation_count long")
    return box.join(vehicle_types.select(*TYPE_KEYS), "vehicle_type_sk").drop("vehicle_type_sk")


def points_by_type(fct: DataFrame, dim_trk: DataFrame, vehicle_types: DataFrame,
                   cols: list[str]) -> DataFrame:
    """Fact rows with their vehicle type (for the sketch, which takes rows)."""
    trk = dim_trk.select("track_sk", "vehicle_type_sk").filter(F.col("vehicle_type_sk").isNotNull())
    return fct.select("track_sk", *cols).join(trk, "track_sk").join(
        vehicle_types.select(*TYPE_KEYS), "vehicle_type_sk")


def agg_speed_approx(fct: DataFrame, dim_trk: DataFrame, vehicle_types: DataFrame,
                     accuracy: int = 10_000) -> DataFrame:
    """Approximate twin of the aggregate: percentiles from a bounded sketch in
    a single pass (rank error <= n / accuracy)."""
    j = points_by_type(fct, dim_trk, vehicle_types, ["speed_kmh"])
    q = F.percentile_approx("speed_kmh", [0.5, 0.95], accuracy)
    return j.groupBy(*TYPE_KEYS).agg(F.count(F.lit(1)).alias("observation_count"), q.alias("_q")).select(
        *TYPE_KEYS, "observation_count", F.col("_q")[0].alias("median_speed_kmh"),
        F.col("_q")[1].alias("p95_speed_kmh"))


def approx_rank_errors(approx: DataFrame, speeds: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """Whether the sketch's percentiles lie within its promised rank error:
    per type, for the median and the 95th percentile."""
    v, c = F.col("_v"), F.col("_c")
    j = speeds.filter(v.isNotNull()).join(approx, TYPE_KEYS)
    out = []
    for name, p in (("median", 0.5), ("p95", 0.95)):
        q = F.col(f"{name}_speed_kmh")
        below, upto = F.sum(F.when(v < q, c).otherwise(0)), F.sum(F.when(v <= q, c).otherwise(0))
        slack = F.sum(c) / accuracy + 1
        out.append(((below <= p * F.sum(c) + slack) & (upto >= p * F.sum(c) - slack))
                   .alias(f"{name}_within"))
    return j.groupBy(*TYPE_KEYS, "observation_count").agg(*out)
