"""Declared data-quality checks and their evaluation.

Every declared check becomes one result row (model, column, test, failures,
severity, status).  All checks of all models are one aggregation with one pass
over each model (see ``evaluate``).  Failure counts follow the generic test definitions:
not_null / between / relationships count rows, unique counts duplicated
values, accepted_values counts distinct unaccepted values (NULL passes).
"""

from __future__ import annotations

import contextlib
import datetime as dt
import json
import time
from collections import defaultdict
from dataclasses import dataclass
from functools import reduce
from itertools import count
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinetra import session
from kinetra.schemas import SPEED_BUCKETS, VEHICLE_TYPES
from kinetra.session import materialize, scratch_released


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    test: str                      # not_null | unique | accepted_values | between | relationships
    severity: str = "error"
    values: tuple = ()             # accepted values
    low: float | None = None       # between bounds (inclusive)
    high: float | None = None
    row_condition: str | None = None
    parent: str | None = None      # relationships: parent model and column
    parent_column: str | None = None


def _nn(model, *cols):
    return [Check(model, c, "not_null") for c in cols]


def _between(model, col, lo, hi, cond=True, severity="error"):
    return Check(model, col, "between", severity=severity, low=lo, high=hi,
                 row_condition=f"{col} is not null" if cond else None)


# The declared checks of the warehouse (69 in total).
CHECKS: list[Check] = [
    *_nn("raw_tracks", "source_file", "track_id", "loaded_at"),
    *_nn("raw_trajectory_points", "source_file", "track_id", "frame_idx", "loaded_at"),
    Check("stg_tracks", "track_sk", "unique"),
    *_nn("stg_tracks", "track_sk", "source_file", "track_id", "vehicle_type"),
    Check("stg_tracks", "vehicle_type", "accepted_values", values=tuple(VEHICLE_TYPES)),
    _between("stg_tracks", "total_distance_m", 0, 50000),
    _between("stg_tracks", "avg_speed_kmh", 0, 200),
    *_nn("stg_tracks", "loaded_at"),
    Check("stg_points", "trajectory_point_sk", "unique"),
    *_nn("stg_points", "trajectory_point_sk", "track_sk"),
    Check("stg_points", "track_sk", "relationships", parent="stg_tracks", parent_column="track_sk"),
    *_nn("stg_points", "source_file", "track_id", "frame_idx", "latitude"),
    _between("stg_points", "latitude", 37.9, 38.05, cond=False),
    *_nn("stg_points", "longitude"),
    _between("stg_points", "longitude", 23.70, 23.80, cond=False),
    _between("stg_points", "speed_kmh", 0, 200),
    _between("stg_points", "lon_acceleration_ms2", -15, 15, severity="warn"),
    _between("stg_points", "lat_acceleration_ms2", -15, 15),
    _between("stg_points", "seconds_since_start", 0, 7200),
    *_nn("stg_points", "loaded_at"),
    Check("points_with_deltas", "trajectory_point_sk", "unique"),
    *_nn("points_with_deltas", "trajectory_point_sk", "track_sk", "speed_bucket"),
    Check("points_with_deltas", "speed_bucket", "accepted_values", values=tuple(SPEED_BUCKETS)),
    Check("track_kinematics", "track_sk", "unique"),
    *_nn("track_kinematics", "track_sk", "point_count"),
    Check("dim_vehicle_type", "vehicle_type_sk", "unique"),
    *_nn("dim_vehicle_type", "vehicle_type_sk"),
    Check("dim_vehicle_type", "vehicle_type_name", "unique"),
    *_nn("dim_vehicle_type", "vehicle_type_name"),
    Check("dim_track", "track_sk", "unique"),
    *_nn("dim_track", "track_sk", "vehicle_type_sk"),
    Check("dim_track", "vehicle_type_sk", "relationships", parent="dim_vehicle_type",
          parent_column="vehicle_type_sk"),
    *_nn("dim_track", "source_file", "track_id", "vehicle_type", "point_count", "loaded_at"),
    Check("fct_trajectory_points", "trajectory_point_sk", "unique"),
    *_nn("fct_trajectory_points", "trajectory_point_sk", "track_sk"),
    Check("fct_trajectory_points", "track_sk", "relationships", parent="dim_track",
          parent_column="track_sk"),
    *_nn("fct_trajectory_points", "source_file", "track_id", "frame_idx", "speed_bucket"),
    Check("fct_trajectory_points", "speed_bucket", "accepted_values", values=tuple(SPEED_BUCKETS)),
    *_nn("fct_trajectory_points", "loaded_at"),
    Check("agg_speed_by_vehicle_type", "vehicle_type_sk", "unique"),
    *_nn("agg_speed_by_vehicle_type", "vehicle_type_sk"),
    Check("agg_speed_by_vehicle_type", "vehicle_type_sk", "relationships",
          parent="dim_vehicle_type", parent_column="vehicle_type_sk"),
    Check("agg_speed_by_vehicle_type", "vehicle_type_name", "unique"),
    *_nn("agg_speed_by_vehicle_type", "vehicle_type_name", "observation_count"),
]

# Thresholds of the two hand-written assertions.
MAX_SPEED_KMH = 250


def _status(failures: F.Column, severity: F.Column) -> F.Column:
    return (F.when(failures == 0, "pass").when(severity == "warn", "warn").otherwise("fail"))


def _bad(c: Check) -> F.Column:
    """Whether a row fails a not_null or between check."""
    col = F.col(c.column)
    if c.test == "not_null":
        return col.isNull()
    cond = F.expr(c.row_condition) if c.row_condition else F.lit(True)
    return cond & ~((col >= F.lit(c.low)) & (col <= F.lit(c.high)))


ROW_WISE = ("not_null", "between")


def packed(v: F.Column) -> F.Column:
    """A text as bytes, without loss: 32 lower-case hex digits (a surrogate key) take 17
    bytes, other texts a byte more than they have."""
    digits = F.when((F.octet_length(v) == 32) & (F.lower(v) == v), F.unhex(v))     # NULL if there is another character
    return F.coalesce(F.concat(F.lit(b"\x01"), digits), F.concat(F.lit(b"\x00"), v.cast("binary")))


#: Row-wise checks that share a number with a bit for each.
BITS = 60


def check_entries(models: dict[str, DataFrame], row_wise: dict[int, list[Check]],
                  columns: dict[tuple[str, str], int]) -> DataFrame:
    """(id, v) of every model in one pass over each: an entry per row and checked
    column with the column's value, and one per row and list of row-wise checks (of one
    model) that it fails any of, with a bit for each of these."""
    parts = []
    for model in dict.fromkeys([*(c[0].model for c in row_wise.values()), *(m for m, _ in columns)]):
        entries = [F.struct(F.lit(i).alias("id"), packed(F.col(c).cast("string")).alias("v"))
                   for (m, c), i in columns.items() if m == model]
        arrays = [F.array(*entries)] if entries else []
        for i, checks in row_wise.items():
            if checks[0].model == model:
                failed = reduce(Column.bitwiseOR, [F.when(_bad(c), F.lit(1 << k).cast("long")).otherwise(
                    F.lit(0).cast("long")) for k, c in enumerate(checks)])
                entry = F.array(F.struct(F.lit(i).alias("id"), failed.cast("string").cast("binary").alias("v")))
                arrays.append(F.when(failed != 0, entry).otherwise(F.slice(entry, 1, 0)))
        parts.append(models[model].select(F.inline(F.concat(*arrays))))
    return reduce(DataFrame.unionByName, parts)


def evaluate(models: dict[str, DataFrame], checks: list[Check] = CHECKS,
             tests: set[str] | None = None) -> DataFrame:
    """One row per check.

    Every model is read once.  Its rows become entries (checks or column, value), which
    one aggregation counts; partial counts collapse hot values in the map tasks.  The
    counts, written once, say the rest: a value counted twice is not unique, a bit in an
    entry of row-wise checks is a failure, and the values of a foreign key and of its
    parent meet in a second, smaller aggregation.  Values are compared themselves, not
    their hashes."""
    with scratch_released(next(iter(models.values())).sparkSession):
        return session.materialize(_evaluate(models, checks, tests), "checks", keep=True)


def _evaluate(models: dict[str, DataFrame], checks: list[Check], tests: set[str] | None) -> DataFrame:
    selected = [c for c in checks if (tests is None or c.test in tests) and c.model in models]
    number = count()
    by_model = defaultdict(list)
    for c in selected:
        if c.test in ROW_WISE:
            by_model[c.model].append(c)
    row_wise = {next(number): some[k:k + BITS] for some in by_model.values() for k in range(0, len(some), BITS)}
    related = [c for c in selected if c.test == "relationships"]
    columns = {k: next(number) for k in dict.fromkeys(
        [(c.model, c.column) for c in selected if c.test not in ROW_WISE]
        + [(c.parent, c.parent_column) for c in related])}
    # of a column that is only to be unique, values that occur once say nothing more
    asked = {columns[k] for c in selected if c.test in ("accepted_values", "relationships")
             for k in ((c.model, c.column), (c.parent, c.parent_column)) if k in columns}
    unasked = sorted(set(columns.values()) - asked)
    counts = materialize(check_entries(models, row_wise, columns).groupBy("id", "v").agg(
        F.count(F.lit(1)).alias("n")).filter((F.col("n") > 1) | ~F.col("id").isin(unasked)), "check-values")

    known = F.col("v").isNotNull()
    strange = [(F.col("id") == columns[c.model, c.column]) & ~F.col("v").isin([b"\x00" + x.encode() for x in c.values])
               for c in selected if c.test == "accepted_values"]
    by_id = counts.groupBy("id").agg(
        F.count_if(known & (F.col("n") > 1)).alias("repeated"),
        F.count_if(known & reduce(or_, strange, F.lit(False))).alias("strange"))
    sides = defaultdict(list)       # id of a column -> its part in relationships
    for i, c in enumerate(related):
        sides[str(columns[c.model, c.column])].append({"rel": i, "parent": False})
        sides[str(columns[c.parent, c.parent_column])].append({"rel": i, "parent": True})
    side = F.from_json(F.lit(json.dumps(sides)), "map<string,array<struct<rel:int,parent:boolean>>>")
    orphans = counts.filter(known).select("v", "n", F.inline(F.try_element_at(side, F.col("id").cast("string")))
                                          ).groupBy("rel", "v").agg(
        F.max("parent").alias("has"), F.sum(F.when(~F.col("parent"), F.col("n"))).alias("n")).groupBy("rel").agg(
        F.sum(F.when(~F.col("has"), F.col("n"))).alias("orphans"))

    mask = F.col("v").cast("string").try_cast("long")
    by_bit = counts.filter(F.col("id").isin(list(row_wise))).select(
        "id", "n", mask.alias("mask"), F.explode(F.sequence(F.lit(0), F.lit(BITS - 1))).alias("bit")).filter(
        "shiftright(mask, bit) & 1 = 1").groupBy("id", "bit").agg(F.sum("n").alias("failed"))

    place = {c: (i, k) for i, some in row_wise.items() for k, c in enumerate(some)}
    rows = [(c.model, c.column, c.test, c.severity, *place.get(c, (columns.get((c.model, c.column)), -1)),
             related.index(c) if c in related else -1) for c in selected]
    listed = counts.sparkSession.createDataFrame(
        rows, "model string, column_name string, test_name string, severity string, id int, bit int, rel int")
    test = F.col("test_name")
    failures = (F.when(test == "unique", F.col("repeated")).when(test == "accepted_values", F.col("strange"))
                .when(test == "relationships", F.col("orphans")).otherwise(F.col("failed")))
    return listed.join(by_id, "id", "left").join(by_bit, ["id", "bit"], "left").join(orphans, "rel", "left").select(
        "model", "column_name", "test_name", F.coalesce(failures, F.lit(0)).cast("long").alias("failures"),
        "severity").withColumn("status", _status(F.col("failures"), F.col("severity")))


def assert_max_speed(dim_track: DataFrame) -> DataFrame:
    return dim_track.filter(F.col("max_speed_kmh") > MAX_SPEED_KMH).select(
        "track_sk", "vehicle_type", "max_speed_kmh")


def assert_no_negative_distance(fct: DataFrame) -> DataFrame:
    return fct.filter(F.col("delta_distance_m") < 0).select(
        "trajectory_point_sk", "track_sk", "delta_distance_m")


def singular_results(dim_track: DataFrame, fct: DataFrame) -> DataFrame:
    a = assert_max_speed(dim_track).agg(F.count(F.lit(1)).alias("failures"))
    b = assert_no_negative_distance(fct).agg(F.count(F.lit(1)).alias("failures"))
    mk = lambda df, model, name: df.select(
        F.lit(model).alias("model"), F.lit(None).cast("string").alias("column_name"),
        F.lit(name).alias("test_name"), F.col("failures").cast("long").alias("failures"),
        F.lit("error").alias("severity"))
    out = mk(a, "dim_track", "assert_max_speed_within_bounds").unionByName(
        mk(b, "fct_trajectory_points", "assert_no_negative_delta_distance"))
    return out.withColumn("status", _status(F.col("failures"), F.col("severity")))


def gate(results: DataFrame) -> None:
    """Raise when any error-severity check failed (run after all writes)."""
    bad = results.filter(F.col("status") == "fail").select("model", "column_name", "test_name").collect()
    if bad:
        raise AssertionError(f"{len(bad)} data-quality check(s) failed: {bad[:5]}")


HISTORY = ("model string, column_name string, test_name string, failures long, severity string, "
           "status string, run_id string, checked_at timestamp_ntz")
RUNS = ("run_id string, model string, status string, row_count long, started_at timestamp_ntz, "
        "seconds double")


def append_history(results: DataFrame, path: str, run_id: str,
                   at: dt.datetime | None = None) -> None:
    """Append check results to the run-history table."""
    at = at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    (results.withColumn("run_id", F.lit(run_id))
     .withColumn("checked_at", F.lit(at).cast("timestamp_ntz")).write.mode("append").parquet(path))


class RunLog:
    """Appends one row per model of a run: status, rows, start, seconds."""

    def __init__(self, spark: SparkSession, path: str, run_id: str):
        self.spark, self.path, self.run_id = spark, path, run_id

    @contextlib.contextmanager
    def model(self, name: str):
        """Times a model's build; the caller sets ``entry["rows"]``."""
        entry = {"rows": None}
        began, t = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), time.monotonic()
        status = "error"
        try:
            yield entry
            status = "success"
        finally:
            row = (self.run_id, name, status, entry["rows"], began, time.monotonic() - t)
            self.spark.createDataFrame([row], RUNS).write.mode("append").parquet(self.path)


def run_history(spark: SparkSession, root: str) -> DataFrame:
    """Model rows of all runs below ``root`` with the verdict of each run's gate."""
    checks = spark.read.schema(HISTORY).parquet(f"{root}/_check_history").groupBy("run_id").agg(
        F.count_if(F.col("status") == "fail").alias("failed_checks"),
        F.count_if(F.col("status") == "warn").alias("warned_checks"))
    return spark.read.schema(RUNS).parquet(f"{root}/_run_history").join(checks, "run_id", "left").withColumn(
        "gate", F.when(F.col("failed_checks") == 0, "pass").when(F.col("failed_checks") > 0, "fail"))


# ---------------------------------------------------------------------------
# Source freshness

# Freshness thresholds in hours.
WARN_AFTER_HOURS = 24
ERROR_AFTER_HOURS = 72


def freshness(tables: dict[str, DataFrame], as_of: dt.datetime) -> DataFrame:
    parts = []
    for name, df in tables.items():
        parts.append(df.agg(F.max("loaded_at").alias("max_loaded_at"))
                     .select(F.lit(name).alias("table_name"), "max_loaded_at"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    age_us = F.timestamp_diff("MICROSECOND", F.col("max_loaded_at"), F.lit(as_of).cast(
        dict(out.dtypes)["max_loaded_at"]))
    age_h = age_us / F.lit(3600.0 * 1e6)
    status = (F.when(F.col("max_loaded_at").isNull(), "error")
              .when(age_h > ERROR_AFTER_HOURS, "error")
              .when(age_h > WARN_AFTER_HOURS, "warn").otherwise("pass"))
    return out.select("table_name", "max_loaded_at", F.round(age_h, 6).alias("age_hours"),
                      status.alias("status"))
