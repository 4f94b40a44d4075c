"""The transform run: raw -> staging -> intermediate -> marts.

Each model is a lazily built DataFrame; Catalyst composes them (ephemeral
models are simply inlined).  ``materialize`` writes the table-materialised
models (kinematics, dims, fact, aggregate) as Parquet, each to a fresh folder
that then takes the old one's place, and returns readers on the written
tables, which also cuts lineage.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinetra.operators import (incremental, load, marts, quality, speed_partials, staging,
                               trajectory)
from kinetra.operators.observed import Observed
from kinetra.operators.sequence import DEFAULT_CHUNK
from kinetra.session import materialize, replace_table, scratch_released
from kinetra.sources import testdata


@dataclass
class Warehouse:
    raw_tracks: DataFrame
    raw_points: DataFrame
    chunk_size: int = DEFAULT_CHUNK
    _tables: dict = field(default_factory=dict)

    @classmethod
    def from_events(cls, spark: SparkSession, sf_dir: str, **kw) -> "Warehouse":
        return cls(testdata.events_tracks(spark, sf_dir), testdata.events_points(spark, sf_dir), **kw)

    # staging (views)
    @cached_property
    def stg_tracks(self) -> DataFrame:
        return staging.stg_tracks(self.raw_tracks)

    @cached_property
    def stg_points(self) -> DataFrame:
        return staging.stg_points(self.raw_points)

    # intermediate
    @cached_property
    def points_with_deltas(self) -> DataFrame:
        return trajectory.points_with_deltas(self.stg_points, chunk_size=self.chunk_size)

    @cached_property
    def track_kinematics(self) -> DataFrame:
        if "track_kinematics" in self._tables:
            return self._tables["track_kinematics"]
        return trajectory.track_kinematics(self.stg_points)

    # marts
    @cached_property
    def dim_vehicle_type(self) -> DataFrame:
        if "dim_vehicle_type" in self._tables:
            return self._tables["dim_vehicle_type"]
        return marts.dim_vehicle_type(self.stg_tracks)

    @cached_property
    def dim_track(self) -> DataFrame:
        if "dim_track" in self._tables:
            return self._tables["dim_track"]
        return marts.dim_track(
            self.stg_tracks, self.track_kinematics, self.dim_vehicle_type)

    @cached_property
    def fct_points(self) -> DataFrame:
        if "fct_trajectory_points" in self._tables:
            return self._tables["fct_trajectory_points"]
        return marts.fct_points(self.points_with_deltas)

    @cached_property
    def speeds(self) -> DataFrame:
        """(track_sk, source_file, track_id, speed_kmh) of the fact: of the written table, or else
        written for the statistics that read them more than once.  The fact takes these
        columns from staging as they are."""
        cols = ["track_sk", "source_file", "track_id", "speed_kmh"]
        if "fct_trajectory_points" in self._tables:
            return self.fct_points.select(*cols)
        return materialize(self.stg_points.select(*cols), "speeds")

    @cached_property
    def agg_speed_by_vehicle_type(self) -> DataFrame:
        if "agg_speed_by_vehicle_type" in self._tables:
            return self._tables["agg_speed_by_vehicle_type"]
        partials = self._tables.get("speed_partials")
        return marts.agg_speed_by_vehicle_type(
            self.speeds, self.dim_track, self.dim_vehicle_type,
            speed_partials.of_stored(partials) if partials is not None else None, "dim_track" in self._tables)

    def register_views(self, spark: SparkSession, prefix: str = "") -> list[str]:
        """Expose the layers to ``spark.sql`` as temp views (lazy: a view is
        its plan, so SQL over it is optimised together with the model)."""
        views = {
            "tracks": self.raw_tracks,
            "trajectory_points": self.raw_points,
            "stg_tracks": self.stg_tracks,
            "stg_trajectory_points": self.stg_points,
            "int_points_with_deltas": self.points_with_deltas,
            "int_track_kinematics": self.track_kinematics,
            "dim_vehicle_type": self.dim_vehicle_type,
            "dim_track": self.dim_track,
            "fct_trajectory_points": self.fct_points,
            "agg_speed_by_vehicle_type": self.agg_speed_by_vehicle_type,
        }
        for name, df in views.items():
            df.createOrReplaceTempView(prefix + name)
        return [prefix + n for n in views]

    def with_table(self, name: str, table: DataFrame) -> "Warehouse":
        """This warehouse with one model read from a written table."""
        return Warehouse(self.raw_tracks, self.raw_points, self.chunk_size,
                         {**self._tables, name: table})

    def materialize(self, root: str, seen: Observed | None = None) -> "Warehouse":
        """Rebuild the table models below ``root`` (each written beside the
        old table, then swapped) and return a warehouse that reads them.  ``seen``
        counts their row-wise checks while they are written."""
        w = self
        for name in TABLE_MODELS:
            with scratch_released(self.raw_points.sparkSession):
                model = w.fct_in_order() if name in PARTITIONED else MODEL[name](w)
                w = w.with_table(name, replace_table(model, f"{root}/{name}", PARTITIONED.get(name),
                                                     seen and seen.watch(name), by_file=name in PARTITIONED))
        return w

    def fct_in_order(self) -> DataFrame:
        """The fact's rows, ready for the write partitioned by file."""
        return marts.fct_points(trajectory.points_with_deltas(
            self.stg_points, chunk_size=self.chunk_size, in_order=True))

    def models(self) -> dict[str, DataFrame]:
        """Every model the declared checks name.  Of the deltas only the columns that
        they name: none needs a frame's predecessor."""
        named = dict.fromkeys(c.column for c in quality.CHECKS if c.model == "points_with_deltas")
        return {"raw_tracks": self.raw_tracks, "raw_trajectory_points": self.raw_points,
                "stg_tracks": self.stg_tracks, "stg_points": self.stg_points,
                "points_with_deltas": self.points_with_deltas.select(*named),
                **{name: MODEL[name](self) for name in TABLE_MODELS}}


#: Models that are written, in the order of their dependence.
MODEL = {
    "track_kinematics": lambda w: w.track_kinematics,
    "dim_vehicle_type": lambda w: w.dim_vehicle_type,
    "dim_track": lambda w: w.dim_track,
    "fct_trajectory_points": lambda w: w.fct_points,
    "agg_speed_by_vehicle_type": lambda w: w.agg_speed_by_vehicle_type,
}
TABLE_MODELS = list(MODEL)
#: The fact grows with the data: partitioned like the raw tables.
PARTITIONED = {"fct_trajectory_points": "source_file"}


def run_transform(spark: SparkSession, raw_root: str, out_root: str, run_id: str,
                  as_of=None, gate: bool = True, new_rows: str = "cutoff"):
    """One transform run over the raw tables below ``raw_root``:

    1. source freshness of both raw tables (an ``error`` stops the run);
    2. table models rebuilt below ``out_root`` (new folder, then swap), except
       the fact, which is merged incrementally (new frames only: after the
       high-water mark, or with ``new_rows="keys"`` every missing key); the speed
       partials of the files that the merge touched are made anew, and the speed
       aggregate takes its moments and sketches from the stored partials;
    3. all declared checks and the two assertions, after every write;
    4. models (status, rows, start, seconds) and check results appended to the
       run history; error-level failures raise.
    Returns (warehouse, check results)."""
    tracks = load.read_raw(spark, raw_root, "tracks")
    points = load.read_raw(spark, raw_root, "trajectory_points")
    as_of = as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    fresh = quality.freshness({"tracks": tracks, "trajectory_points": points}, as_of)
    stale = [r.table_name for r in fresh.filter(F.col("status") == "error").collect()]
    if stale:
        raise RuntimeError(f"source freshness error for {stale}; transform not run")

    w = Warehouse(tracks, points)
    log = quality.RunLog(spark, f"{out_root}/_run_history", run_id)
    for name in TABLE_MODELS:
        path = f"{out_root}/{name}"
        with log.model(name) as entry, scratch_released(spark):
            if name == "fct_trajectory_points":
                fact = incremental.read_table(spark, path)
                mark = incremental.high_water_mark(fact)
                first = new_rows != "keys" and mark == incremental.FLOOR_MARK
                if new_rows == "keys":  # safe mode: by missing key, not by load time
                    new = incremental.new_fact_rows_by_key(w.stg_points, fact, w.chunk_size)
                else:
                    new = incremental.new_fact_rows(w.stg_points, mark, w.chunk_size, in_order=first)
                touched = incremental.merge_into(spark, path, new, late=staging.point_keys(), in_order=first)
                table = incremental.read_table(spark, path)
                partials = f"{out_root}/speed_partials"
                speed_partials.refresh(spark, partials, table, w.dim_track, touched)
                w = w.with_table("speed_partials", speed_partials.stored(spark, partials))
            else:
                table = replace_table(MODEL[name](w), path)
            entry["rows"] = table.count()      # from the files' footers
        w = w.with_table(name, table)

    with scratch_released(spark):
        results = materialize(quality.evaluate(w.models()).unionByName(
            quality.singular_results(w.dim_track, w.fct_points)), "check-results")
        quality.append_history(results, f"{out_root}/_check_history", run_id)
    stored = spark.read.schema(quality.HISTORY).parquet(f"{out_root}/_check_history").filter(
        F.col("run_id") == run_id)
    if gate:
        quality.gate(stored)
    return w, stored
