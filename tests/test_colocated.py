"""Bucketed frames and fact: the incremental run moves neither."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from kinetra.operators import colocated, marts, staging, trajectory
from kinetra.operators.incremental import DuplicateKeyError
from kinetra.schemas import TRAJECTORY_POINTS

BUCKETS = 4
DAY = dt.datetime(2024, 1, 1)


def frames(spark, rows):
    """Staged frames of (file, track, frame, speed, day)."""
    return staging.stg_points(spark.createDataFrame(
        [(f, t, i, 37.9 + i / 1000, 23.7, v, 0.0, 0.0, float(i), DAY + dt.timedelta(days=d))
         for f, t, i, v, d in rows], TRAJECTORY_POINTS))


OLD = [("a", t, i, float(i % 7), 0) for t in range(6) for i in range(0, 9000, 450)] + [
    ("b", 1, i, 1.0, 0) for i in range(5)]
NEW = [("a", 2, i, 3.0, 1) for i in range(9000, 9004)] + [("c", 7, i, None, 1) for i in (0, 1, 5000)]


@pytest.fixture
def tables(spark, tmp_dir):
    tag = uuid.uuid4().hex[:8]
    names = (f"points_{tag}", f"fact_{tag}", "file://" + tmp_dir)
    yield names
    for n in names[:2]:
        spark.sql(f"DROP TABLE IF EXISTS {n}")


def fact_of(points):
    return marts.fct_points(trajectory.points_with_deltas(points))


def rows(df):
    return sorted((tuple(r) for r in df.select(*marts.FACT_COLUMNS).collect()), key=repr)


def build(spark, tables, now, before):
    points, fact, root = tables
    colocated.publish_points(frames(spark, now), points, root, BUCKETS)
    colocated.publish_fact(fact_of(frames(spark, before)), fact, root, BUCKETS)
    return lambda: colocated.refresh(spark, points, fact, root, BUCKETS)


def test_refresh_equals_a_rebuild(spark, tables):
    refresh = build(spark, tables, OLD + NEW, OLD)
    want = rows(fact_of(frames(spark, OLD + NEW)))
    assert rows(refresh()) == want
    assert rows(refresh()) == want  # nothing new


def test_a_frame_loaded_again_replaces_its_row(spark, tables):
    again = [("b", 1, i, 1.0, 0) for i in range(3)] + [("b", 1, 3, 9.0, 2), ("b", 1, 4, 1.0, 2)]
    refresh = build(spark, tables, OLD[:-5] + again, OLD)
    assert rows(refresh()) == rows(fact_of(frames(spark, OLD[:-5] + again)))


def test_an_empty_fact_takes_all_frames(spark, tables):
    points, fact, root = tables
    build(spark, tables, OLD, [])
    assert rows(colocated.refresh(spark, points, fact, root, BUCKETS)) == rows(fact_of(frames(spark, OLD)))


def test_a_repeated_frame_publishes_nothing(spark, tables):
    refresh = build(spark, tables, OLD + NEW + NEW[:1], OLD)
    before = rows(spark.table(tables[1]))
    with pytest.raises(DuplicateKeyError):
        refresh()
    assert rows(spark.table(tables[1])) == before
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(tables[1] + "_batch")]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_neither_frames_nor_fact_are_shuffled(spark, tables):
    points, fact, root = tables
    build(spark, tables, OLD + NEW, OLD)
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new, files = colocated.new_rows(spark.table(points), spark.table(fact))
        assert files == ["a", "c"]
        with colocated._joined_by_buckets(spark):
            lines = plan(new).split("\n")
            moved = [i for i, x in enumerate(lines) if "Exchange" in x]
            # the table of one row per chunk: to its track and back to its chunk
            assert len(moved) == 2
            assert any("isnull(_seq_next_ord" in x for x in lines[moved[-1]:moved[-1] + 4])
            joined = plan(colocated.merged(spark.table(fact).filter(F.col("source_file") == "a"),
                                           spark.table(fact), files))
            assert "Exchange" not in joined and joined.count("Bucketed: true") == 2
        batch = spark.table(fact).filter(F.col("source_file") == "a")
        assert "Exchange" in plan(colocated.merged(batch, spark.table(fact), files))  # by all keys
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)


def test_a_track_of_many_frames_lies_in_many_buckets(spark, tables):
    points, _, root = tables
    long = [("a", 1, i, 1.0, 0) for i in range(0, 4096 * 40, 512)]
    t = colocated.publish_points(frames(spark, long), points, root, BUCKETS)
    assert t.select(F.spark_partition_id()).distinct().count() > 1
