"""Intermediate layer: per-frame deltas and per-track kinematics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinetra.functions.columns import haversine_m, speed_bucket
from kinetra.operators.sequence import DEFAULT_CHUNK, with_predecessor
from kinetra.operators.staging import point_keys
from kinetra.schemas import TRACK_KEY

LAGGED = ["speed_kmh", "seconds_since_start", "latitude", "longitude"]


def points_with_deltas(stg_points: DataFrame, chunk_size: int = DEFAULT_CHUNK,
                       chunk_col: str | None = None, in_order: bool = False) -> DataFrame:
    """Each frame with its predecessor in the same track (by frame_idx, gaps
    allowed), time/speed deltas, great-circle step distance and speed bucket.
    The first frame of a track has NULL predecessor and NULL deltas.  Frames are
    shuffled by what the keys are hashes of, and the keys made afterwards.  ``in_order``:
    file after file over the tasks, ready for a write partitioned by file."""
    if chunk_col or not {*TRACK_KEY} <= {*stg_points.columns}:       # stored, dealt by its key; or only keys are there
        return with_deltas(with_predecessor(stg_points, ["track_sk"], "frame_idx", LAGGED,
                                            prefix="prev_", chunk_size=chunk_size, chunk_col=chunk_col))
    keys = {n: c for n, c in point_keys().items() if n in stg_points.columns}
    bare = with_predecessor(stg_points.drop(*keys), TRACK_KEY, "frame_idx", LAGGED, prefix="prev_",
                            chunk_size=chunk_size, in_order=in_order)
    named = bare.withColumns(keys)
    return with_deltas(named.select(*stg_points.columns, *[c for c in bare.columns if c not in stg_points.columns]))


def with_deltas(w: DataFrame) -> DataFrame:
    """Deltas, step distance and speed bucket of frames that have their ``prev_*``."""
    return w.select(
        "*",
        (F.col("seconds_since_start") - F.col("prev_seconds_since_start")).alias("delta_time_sec"),
        (F.col("speed_kmh") - F.col("prev_speed_kmh")).alias("delta_speed_kmh"),
        haversine_m("prev_latitude", "prev_longitude", "latitude", "longitude").alias("delta_distance_m"),
        speed_bucket("speed_kmh").alias("speed_bucket"),
    )


def track_kinematics(stg_points: DataFrame) -> DataFrame:
    """One row per track: frame count, first/last time, duration, speed
    range, stopped frames.  Frames meet by what the key is a hash of.  Partial aggregation before the shuffle keeps a
    very long track from concentrating rows in one task."""
    t = F.col("seconds_since_start")
    s = F.col("speed_kmh")
    keys = TRACK_KEY if {*TRACK_KEY} <= {*stg_points.columns} else ["track_sk"]
    per_track = stg_points.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("point_count"),
        F.min(t).alias("first_seen_sec"),
        F.max(t).alias("last_seen_sec"),
        (F.max(t) - F.min(t)).alias("duration_sec"),
        F.min(s).alias("min_speed_kmh"),
        F.max(s).alias("max_speed_kmh"),
        F.count_if(s < 1).alias("stopped_point_count"),
    )
    return per_track if keys == ["track_sk"] else per_track.select(
        point_keys()["track_sk"].alias("track_sk"), *[c for c in per_track.columns if c not in keys])
