"""Frames and fact in bucketed catalog tables: incremental runs that shuffle neither.

Both tables are partitioned by ``source_file`` and bucketed by (track, chunk of 4096
frames), so a track with most of the rows still lies in many buckets.  The delta window
works on exactly these keys and the merge joins on them and the frame's key, so frames
and fact rows are read, windowed, joined and written bucket by bucket.  Only the table
with one row per chunk, which carries the last frame of each over to the next, moves.

A run reads the partitions of the files that have frames after the fact's high-water
mark; their names are listed on the driver, as the catalog switches one partition of
them by one statement.  Results are published by ``catalog.publish``: readers see each
partition old or new.

Defined cases: without new frames nothing changes; a frame that comes again with a later
``loaded_at`` replaces its fact row; two rows of one frame are an error
(``DuplicateKeyError``) and nothing is published; a fact without rows counts as older
than every frame.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinetra import catalog
from kinetra.operators import incremental, marts, trajectory
from kinetra.operators.sequence import chunk_of
from kinetra.session import scratch_path

KEY, PARTITION, CHUNK = "trajectory_point_sk", "source_file", "frame_chunk"
DEALT = ("track_sk", CHUNK)
FACT = [*marts.FACT_COLUMNS, CHUNK]

# A join on the bucket columns and the frame's key may keep the buckets' partitioning.
BY_PART_OF_KEY = "spark.sql.requireAllClusterKeysForCoPartition"


def buckets(number: int) -> catalog.Buckets:
    """Choose ``number`` so that a bucket of the files of one run stays near 128 MB."""
    return catalog.Buckets(number, DEALT, (*DEALT, "frame_idx"))


@contextmanager
def _joined_by_buckets(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(BY_PART_OF_KEY)
    spark.conf.set(BY_PART_OF_KEY, "false")
    try:
        yield
    finally:
        spark.conf.set(BY_PART_OF_KEY, before)


def _dealt(df: DataFrame, number: int) -> DataFrame:
    return df.withColumn(CHUNK, chunk_of("frame_idx")).repartition(number, *DEALT)


def publish_points(stg_points: DataFrame, table: str, root: str, number: int) -> DataFrame:
    """Make the files' partitions of the frame table hold ``stg_points`` (whole files)."""
    return catalog.publish(_dealt(stg_points, number), table, root, PARTITION, buckets(number))


def publish_fact(fact: DataFrame, table: str, root: str, number: int) -> DataFrame:
    return catalog.publish(_dealt(fact, number).select(*FACT), table, root, PARTITION, buckets(number))


def new_rows(points: DataFrame, fact: DataFrame) -> tuple[DataFrame, list[str]]:
    """(fact rows of frames after the high-water mark, files that hold them)."""
    mark = incremental.high_water_mark(fact)
    is_new = F.col("loaded_at") > F.lit(mark).cast(dict(points.dtypes)["loaded_at"])
    files = sorted(r[0] for r in points.filter(is_new).select(PARTITION).distinct().collect())
    history = points.filter(F.col(PARTITION).isin(files))
    rows = trajectory.points_with_deltas(history, chunk_col=CHUNK)
    return rows.select(*FACT).filter(is_new), files


def merged(batch: DataFrame, fact: DataFrame, files: list[str]) -> DataFrame:
    """The files' fact rows with those of ``batch`` (dealt alike) put in their place."""
    old = fact.filter(F.col(PARTITION).isin(files)).alias("o")
    n = batch.alias("n")
    keys = [*DEALT, KEY]
    j = old.join(n, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys], "full_outer")
    row = F.when(F.col(f"n.{KEY}").isNotNull(), F.struct(*[F.col(f"n.{c}") for c in FACT])).otherwise(
        F.struct(*[F.col(f"o.{c}") for c in FACT]))
    return j.select(row.alias("_row")).select(*[F.col("_row")[c].alias(c) for c in FACT])


def refresh(spark: SparkSession, points_table: str, fact_table: str, root: str, number: int) -> DataFrame:
    """Bring the fact up to its frames; returns a reader on the fact."""
    fact = spark.table(fact_table)
    rows, files = new_rows(spark.table(points_table), fact)
    if not files:
        return fact
    staged = f"{fact_table}_batch_{uuid.uuid4().hex[:12]}"
    with _joined_by_buckets(spark):
        try:
            batch = catalog.write_bucketed(rows, staged, scratch_path(spark, "batch"), buckets(number))
            twice = batch.groupBy(*DEALT, KEY).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
            if not twice.isEmpty():
                raise incremental.DuplicateKeyError(f"batch holds duplicate values of {KEY}")
            return catalog.publish(merged(batch, fact, files), fact_table, root, PARTITION, buckets(number))
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {staged}")
