"""Session construction and shared-storage helpers."""

from __future__ import annotations

import contextlib
import tempfile
import threading
import uuid
from collections.abc import Iterator
from pathlib import Path
from urllib.parse import urlparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Settings that matter at cluster scale.  Everything here is a default that a
# cluster deployment may override through spark-submit.
SCALE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    # Parquet scan splits of 128 MB keep one task's input well inside
    # executor memory; the ragged text reader uses the same split size.
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    # Broadcast only what is known to be small; the dimension joins pass an
    # explicit hint after a size check instead of relying on statistics.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Partition values (source file names) are always strings.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "kinetra", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SCALE_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the deployment sets it to a shared file system; without it
    every executor would write its own disk, so that is an error.  Only a
    local master (one machine, as in tests) gets a folder of our own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on master {master!r}")
        d = Path(tempfile.mkdtemp(prefix="kinetra-ckpt-")).as_uri()
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    if not urlparse(d).scheme:
        # A bare path belongs to the default file system: the one that the context
        # qualified it with (as <folder>/<id>), also if that setting changes later.
        held = spark.sparkContext.getCheckpointDir().rsplit("/", 1)[0]
        if urlparse(held).path.rstrip("/") == d.rstrip("/"):
            return held
    return str(d)


#: Of the stored tables: keys are hex digests, which snappy leaves as they are.
CODEC = "zstd"
#: Rows of one partition value that a writing task takes, where their numbers are known.
ROWS_PER_TASK = 500_000


def crowded(rows, partition_col: str = "source_file"):
    """(value, parts) of the partition values with more rows than a task should write.
    ``rows`` is stored, so this reads one column; the result has a row per half a
    million rows at most."""
    n = F.count(F.lit(1))
    return rows.groupBy(F.col(partition_col).alias("_value")).agg(n.alias("_n")).filter(
        F.col("_n") > ROWS_PER_TASK).select("_value", F.ceil(F.col("_n") / ROWS_PER_TASK).alias("_parts"))


def for_partitioned_write(df, partition_col: str = "source_file", parts=None, by: str | None = None,
                          late: dict | None = None):
    """Rebalance rows by the table's partition column before a partitioned
    write: AQE then coalesces small partitions and splits a hot file's rows
    into several tasks, so each partition folder gets a few files of the
    advisory size instead of one file per upstream task.  With ``parts``
    (``crowded``) the rows of such values are dealt by the hash of ``by`` as well, so
    that a task's share does not depend on what AQE can split.  ``late`` columns are made
    of the others after the shuffle."""
    late = late or {}
    if parts is None:
        return df.drop(*late).hint("rebalance", partition_col).withColumns(late).select(*df.columns)
    part = F.when(F.col("_parts").isNotNull(), F.pmod(F.xxhash64(by), F.col("_parts")))
    dealt = df.join(F.broadcast(parts), F.col(partition_col).eqNullSafe(F.col("_value")), "left")
    return dealt.select(*[c for c in df.columns if c not in late], part.alias("_part")).hint(
        "rebalance", partition_col, "_part").withColumns(late).select(*df.columns)


#: Shuffle files of an execution are deleted when it ends, not when the driver's JVM
#: happens to collect its plan.
RELEASE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files behind."""
    before = spark.conf.get(RELEASE_SHUFFLES, "false")
    spark.conf.set(RELEASE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(RELEASE_SHUFFLES, before)


#: Folders made inside each open ``scratch_released`` of a thread, the innermost last.
_open = threading.local()


@contextlib.contextmanager
def scratch_released(spark: SparkSession) -> Iterator[None]:
    """Tables materialized inside are deleted at the end: nothing that still reads one of
    them may leave the block unwritten."""
    scopes = _open.__dict__.setdefault("scopes", [])
    scopes.append([])
    try:
        yield
    finally:
        for path in scopes.pop():
            remove_path(spark, path)


def materialize(df, name: str, keep: bool = False, codec: str | None = None):
    """Write ``df`` once as Parquet below the shared checkpoint folder and
    return a reader on it: cuts lineage (survives executor loss) and turns
    several later uses into cheap columnar scans.  ``keep``: it outlives ``scratch_released``."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    scopes = getattr(_open, "scopes", [])
    if scopes and not keep:
        scopes[-1].append(path)
    with shuffles_released(spark):
        df.write.parquet(path, compression=codec)
    return spark.read.parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/kinetra/{name}-{uuid.uuid4().hex[:12]}"


def _hadoop_path(spark: SparkSession, path: str):
    """(file system of the path, path): the default file system of the
    cluster decides what a path without scheme means."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop_path(spark, path)
    return bool(fs.exists(p))


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder this library created (any file system)."""
    fs, p = _hadoop_path(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def read_text_file(spark: SparkSession, path: str) -> str | None:
    """A small text file, or None where there is none."""
    fs, p = _hadoop_path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text_file(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _hadoop_path(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def replace_table(df, path: str, partition_col: str | None = None, watch=None, late: dict | None = None,
                  by_file: bool = False):
    """Rebuild a Parquet table: write a new folder beside it, then swap the
    folders.  The old table is readable until the new one is complete, and a
    failed write leaves it as it was.  ``watch`` (DataFrame -> DataFrame of the same
    columns) is the last step before the write, after its shuffle; ``late`` columns of a
    partitioned table are made after it too.  ``by_file``: a value of the partition column
    lies in few tasks already, so there is no shuffle.  Returns a reader with ``df``'s schema."""
    watch = watch or (lambda rows: rows)
    spark = df.sparkSession
    new, old = (f"{path.rstrip('/')}.{word}-{uuid.uuid4().hex[:8]}" for word in ("new", "old"))
    with shuffles_released(spark):
        if partition_col:
            watch(df if by_file else for_partitioned_write(df, partition_col, late=late)).write.partitionBy(
                partition_col).parquet(new, compression=CODEC)
        else:
            watch(df).write.parquet(new, compression=CODEC)
    fs, p = _hadoop_path(spark, path)
    to_old, from_new = (_hadoop_path(spark, x)[1] for x in (old, new))
    had = fs.exists(p)
    if had:
        fs.rename(p, to_old)
    if not fs.rename(from_new, p):
        if had:
            fs.rename(to_old, p)
        raise RuntimeError(f"could not publish {path}")
    if had:
        fs.delete(to_old, True)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)
