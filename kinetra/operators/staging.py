"""Staging layer: renames plus surrogate keys (views in the warehouse)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinetra.functions.columns import surrogate_key


def track_columns() -> dict[str, Column]:
    return {
        "track_sk": surrogate_key("source_file", "track_id"),
        "source_file": F.col("source_file"),
        "track_id": F.col("track_id"),
        "vehicle_type": F.col("vehicle_type"),
        "total_distance_m": F.col("traveled_d"),
        "avg_speed_kmh": F.col("avg_speed"),
        "loaded_at": F.col("loaded_at"),
    }


def point_keys() -> dict[str, Column]:
    return {
        "trajectory_point_sk": surrogate_key("source_file", "track_id", "frame_idx"),
        "track_sk": surrogate_key("source_file", "track_id"),
    }


def point_columns() -> dict[str, Column]:
    return {
        **point_keys(),
        "source_file": F.col("source_file"),
        "track_id": F.col("track_id"),
        "frame_idx": F.col("frame_idx"),
        "latitude": F.col("lat"),
        "longitude": F.col("lon"),
        "speed_kmh": F.col("speed"),
        "lon_acceleration_ms2": F.col("lon_acc"),
        "lat_acceleration_ms2": F.col("lat_acc"),
        "seconds_since_start": F.col("time_sec"),
        "loaded_at": F.col("loaded_at"),
    }


def _renamed(raw: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return raw.select(*[c.alias(n) for n, c in columns.items()])


def stg_tracks(raw_tracks: DataFrame) -> DataFrame:
    return _renamed(raw_tracks, track_columns())


def stg_points(raw_points: DataFrame) -> DataFrame:
    return _renamed(raw_points, point_columns())
