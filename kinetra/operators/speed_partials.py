"""Speed statistics from partials that merge.

A partial holds the frames of a group as count, mean, sum of squared distances from the
mean (``m2``), extremes and a quantile sketch.  Partials of parts of a group merge to that
of the whole: counts and extremes as usual, ``m2`` by the parallel-variance rule (each
part's own plus its size times the squared distance of its mean from the common one) and
sketches by ``kll_merge_agg_double``.

Frames are reduced to partials per track where they are read, so tracks meet their
vehicle type as one row each and no frame is shuffled.  Partials per (file, type) are
kept as a table partitioned by file: an incremental run makes anew those of the files
whose facts it touched, and the statistics of all data come from the table alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinetra.functions.order_statistics import SKETCH_K
from kinetra.schemas import TRACK_KEY
from kinetra.session import for_partitioned_write, materialize, path_exists, shuffles_released

TYPE_KEY = "vehicle_type_sk"
PARTIALS = (f"{TYPE_KEY} string, n long, m long, mean double, m2 double, low double, high double, "
            "sketch binary, source_file string")


def owner(*frames: DataFrame) -> Column:
    """What tells a track in all ``frames``: the columns that its key is a hash of, which
    shuffles compress, or the key where one of them has only that."""
    return F.struct(*TRACK_KEY) if all({*TRACK_KEY} <= {*f.columns} for f in frames) else F.col("track_sk")


def per_track(fct: DataFrame, *keys: str, track: Column | None = None) -> DataFrame:
    """A partial per ``track`` (``_owner``): n frames, m of them with a speed."""
    v = F.col("speed_kmh")
    track = F.col("track_sk") if track is None else track
    return fct.groupBy(*keys, track.alias("_owner")).agg(
        F.count(F.lit(1)).alias("n"), F.count(v).alias("m"), F.avg(v).alias("mean"),
        (F.var_pop(v) * F.count(v)).alias("m2"), F.min(v).alias("low"), F.max(v).alias("high"),
        F.kll_sketch_agg_double(v, F.lit(SKETCH_K)).alias("sketch"))


def merge(parts: DataFrame, *keys: str) -> DataFrame:
    """One partial per group of partials (no NULL keys)."""
    m, mean = F.col("m"), F.col("mean")
    common = parts.groupBy(*keys).agg(F.try_divide(F.sum(m * mean), F.sum(m)).alias("common"))
    apart = mean - F.col("common")
    return parts.join(common, list(keys)).groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("m").alias("m"), F.first("common").alias("mean"),
        F.sum(F.col("m2") + m * apart * apart).alias("m2"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.kll_merge_agg_double("sketch").alias("sketch"))


def typed(fct: DataFrame, dim_track: DataFrame, *keys: str) -> DataFrame:
    """Partials of tracks with their type; tracks without one drop out."""
    track = owner(fct, dim_track)
    known = dim_track.select(track.alias("_owner"), TYPE_KEY).filter(F.col(TYPE_KEY).isNotNull())
    return per_track(fct, *keys, track=track).join(known, "_owner").drop("_owner")


def of_types(fct: DataFrame, dim_track: DataFrame) -> DataFrame:
    """A partial per vehicle type, straight from the frames."""
    return merge(materialize(typed(fct, dim_track), "track-partials"), TYPE_KEY)


def refresh(spark: SparkSession, path: str, fct: DataFrame, dim_track: DataFrame, files: DataFrame) -> None:
    """Make anew the stored partials of ``files`` (source_file); only their partitions of
    the fact are read.  A file whose tracks have no type keeps a row without one."""
    files = materialize(files.select("source_file").distinct(), "touched-files")
    # a comparison that always holds: without one Spark does not prune partitions by a join
    named = F.broadcast(files.filter(F.col("source_file") >= ""))  # shuffled, a large file meets in one task
    touched = fct.select(*[c for c in ("track_sk", *TRACK_KEY, "speed_kmh") if c in fct.columns]).join(
        named, "source_file", "left_semi")
    parts = materialize(typed(touched, dim_track, "source_file"), "track-partials")
    none = files.select("source_file", F.lit(None).cast("string").alias(TYPE_KEY), F.lit(0).cast("long").alias("n"))
    rows = merge(parts, "source_file", TYPE_KEY).unionByName(none, allowMissingColumns=True)
    with shuffles_released(spark):
        (for_partitioned_write(rows).write.partitionBy("source_file").mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").parquet(path))


def stored(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], PARTIALS)
    return spark.read.schema(PARTIALS).parquet(path)


def of_stored(partials: DataFrame) -> DataFrame:
    """A partial per vehicle type from the stored ones."""
    return merge(partials.filter(F.col(TYPE_KEY).isNotNull()), TYPE_KEY)


def moments(by_type: DataFrame, vehicle_types: DataFrame) -> DataFrame:
    """Count, mean, extremes and sample deviation per type."""
    return by_type.join(vehicle_types.select(TYPE_KEY, "vehicle_type_name"), TYPE_KEY).select(
        TYPE_KEY, "vehicle_type_name", F.col("n").alias("observation_count"),
        F.col("mean").alias("avg_speed_kmh"), F.col("low").alias("min_speed_kmh"),
        F.col("high").alias("max_speed_kmh"),
        F.when(F.col("m") > 1, F.sqrt(F.col("m2") / (F.col("m") - 1))).alias("stddev_speed_kmh"))


def sketch_percentiles(by_type: DataFrame, vehicle_types: DataFrame, probs: dict[str, float]) -> DataFrame:
    """Approximate percentiles per type from the merged sketches (``m`` speeds)."""
    q = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(p) for p in probs.values()]))
    held = by_type.filter(F.kll_sketch_get_n_double("sketch") > 0).select(TYPE_KEY, "m", q.alias("q"))
    return held.join(vehicle_types.select(TYPE_KEY, "vehicle_type_name"), TYPE_KEY).select(
        TYPE_KEY, "vehicle_type_name", "m", *[F.col("q")[i].alias(name) for i, name in enumerate(probs)])
