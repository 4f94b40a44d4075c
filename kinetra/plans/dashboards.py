"""The six dashboard questions over the marts."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinetra.operators import marts
from kinetra.session import materialize

HISTOGRAM_BINS = 30
TOP_N = 10
SAMPLE_FRACTION = 0.01
# Histogram row of the speeds that are no number on the axis (NaN, infinities).
NON_FINITE_BIN = -1
# Eight hex digits of a key's hash are compared for the repeatable sample.
HASH_DIGITS = 8


def fleet_mix(dim_track: DataFrame, vehicle_types: DataFrame) -> DataFrame:
    """Tracks per vehicle type and share of all typed tracks."""
    per_key = dim_track.groupBy("vehicle_type_sk").agg(F.count(F.lit(1)).alias("n"))
    counts = (per_key.join(vehicle_types, "vehicle_type_sk")
              .groupBy("vehicle_type_name").agg(F.sum("n").alias("track_count")))
    # The window runs over the aggregated rows (one per type) only.
    total = F.sum("track_count").over(Window.partitionBy())
    return counts.select("vehicle_type_name", "track_count",
                         (F.col("track_count") / total).alias("share"))


def speed_box_by_type(fct: DataFrame, dim_track: DataFrame, vehicle_types: DataFrame,
                      by_type: DataFrame | None = None) -> DataFrame:
    """Box plot per type (see ``marts.speed_box``)."""
    return marts.speed_box(fct, dim_track, vehicle_types, by_type).select(
        "vehicle_type_name", "q1", "median", "q3", "iqr", "lower_whisker", "upper_whisker",
        "outlier_count", "observation_count")


def speed_histogram(fct: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins between the least and greatest finite speed; the
    greatest lands in the last bin.  NaN and infinite speeds are counted in a
    row of their own (bin -1, no bounds), NULL speeds not at all.

    Speeds are counted first, so the fact is read once; the bounds are two
    numbers on the driver."""
    s = materialize(fct.filter(F.col("speed_kmh").isNotNull()).groupBy("speed_kmh").agg(
        F.count(F.lit(1)).alias("n")), "speed-counts")
    v = F.col("speed_kmh")
    finite = ~F.isnan(v) & (F.abs(v) < float("inf"))
    b_lo, b_hi = s.filter(finite).agg(F.min(v), F.max(v)).first()
    lo, hi = F.lit(b_lo).cast("double"), F.lit(b_hi).cast("double")
    width = (hi - lo) / F.lit(float(bins))
    b = F.when(~finite, F.lit(NON_FINITE_BIN)).when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((v - lo) / width), F.lit(bins - 1))).cast("int")
    counts = s.groupBy(b.alias("bin")).agg(F.sum("n").alias("point_count"))
    on_axis = F.col("bin") != NON_FINITE_BIN
    return counts.select("bin", F.when(on_axis, lo + F.col("bin") * width).alias("bin_lower"),
                         F.when(on_axis, lo + (F.col("bin") + 1) * width).alias("bin_upper"),
                         "point_count")


def density_grid(fct: DataFrame) -> DataFrame:
    """Points per 4-decimal (lat, lon) cell."""
    return fct.groupBy(F.round("latitude", 4).alias("lat_bin"),
                       F.round("longitude", 4).alias("lon_bin")).agg(
        F.count(F.lit(1)).alias("point_count"))


def density_pivot(fct: DataFrame, lon_bins: list[str]) -> DataFrame:
    """Heat-map layout of the 4-decimal grid: one row per latitude cell, one
    column per longitude cell of ``lon_bins`` (decimal text; column name
    lon_<degrees>), and the row's points in all cells.  The axis is stated by
    the caller, so that a chart keeps its columns whatever the data holds."""
    grid = density_grid(fct).withColumn("lon", F.format_string("%.4f", "lon_bin"))
    wide = grid.groupBy("lat_bin").pivot("lon", lon_bins).agg(F.sum("point_count"))
    totals = grid.groupBy("lat_bin").agg(F.sum("point_count").alias("all_points"))
    return wide.join(totals, "lat_bin").select(
        "lat_bin", "all_points", *[F.col(f"`{b}`").alias(f"lon_{b}") for b in lon_bins])


def longest_tracks(dim_track: DataFrame, n: int = TOP_N) -> DataFrame:
    """Top-n tracks by distance (distributed top-k: TakeOrderedAndProject)."""
    return (dim_track.select("track_sk", "track_id", "vehicle_type", "total_distance_m",
                             "avg_speed_kmh")
            .orderBy(F.col("total_distance_m").desc_nulls_last(), F.col("track_sk"))
            .limit(n))


def accel_sample(fct: DataFrame, fraction: float = SAMPLE_FRACTION, seed: int = 42) -> DataFrame:
    """Bernoulli sample of the acceleration pairs (scatter plot)."""
    return fct.select("trajectory_point_sk", "lon_acceleration_ms2", "lat_acceleration_ms2").sample(
        withReplacement=False, fraction=fraction, seed=seed)


def accel_sample_hash(fct: DataFrame, fraction: float = SAMPLE_FRACTION) -> DataFrame:
    """Repeatable sample: rows whose key hash, read as a number of eight hex
    digits, lies below ``fraction`` of its range."""
    below = f"{math.ceil(fraction * 16 ** HASH_DIGITS):0{HASH_DIGITS}x}"
    return fct.filter(F.substring(F.md5("trajectory_point_sk"), 1, HASH_DIGITS) < below).select(
        "trajectory_point_sk", "lon_acceleration_ms2", "lat_acceleration_ms2")
