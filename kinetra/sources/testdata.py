"""Adapters from the driver's test tables to the trajectory raw layer.

The test tables hold no trajectories, so they are mapped:

* ``events`` -> raw tracks / trajectory points (one track per user; frames in
  (ts, event_id) order; coordinates derived from ``props`` and ``value`` so
  they fall inside the recording area).
* ``orders`` + ``lineitem`` -> ragged text files (one line per order, one
  6-field block per line item), written to the shared checkpoint folder and
  read back through the ragged source.

The mapping rules are stated once here; the DuckDB oracle in
``kinetra.plans.oracle`` restates them in SQL.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinetra.operators.sequence import with_ordinal
from kinetra.schemas import VEHICLE_TYPES
from kinetra.session import ensure_checkpoint_dir, path_exists, shuffles_released, write_text_file

# Fixed values of the mapping (the oracle SQL uses the same numbers).
EPOCH = "2024-01-01 00:00:00"
LAT_BASE = 37.9
LON_BASE = 23.7
N_SOURCE_FILES_EVENTS = 3
RAGGED_LINES_PER_FILE = 5000  # ragged files written per 5,000 orders (min 3)
RAGGED_MIN_FILES = 3
RAGGED_LAYOUT = 2             # of the files this module writes
RAGGED_HEADER = "track_id; type; traveled_d; avg_speed; lat; lon; speed; lon_acc; lat_acc; time"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _vehicle_type(uid) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in VEHICLE_TYPES]),
                        (F.pmod(uid, F.lit(len(VEHICLE_TYPES))) + 1).cast("int"))


def _source_file(uid) -> F.Column:
    return F.concat(F.lit("part"), F.pmod(uid, F.lit(N_SOURCE_FILES_EVENTS)).cast("string"))


def events_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trajectory points (raw.trajectory_points columns) from ``events``."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value", "props")
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    v = F.col("value")
    # frame_idx = position of the event in the user's (ts, event_id) order;
    # numbered per (user, hour) and shifted, so a very busy user is spread.
    ev = with_ordinal(ev, ["user_id"], ["ts", "event_id"],
                      chunk=F.date_trunc("hour", F.col("ts")), name="frame_idx")
    return ev.select(
        _source_file(F.col("user_id")).alias("source_file"),
        F.col("user_id").cast("int").alias("track_id"),
        F.col("frame_idx").cast("int").alias("frame_idx"),
        (F.lit(LAT_BASE) + k / F.lit(1000.0)).alias("lat"),
        (F.lit(LON_BASE) + (v - F.floor(v / 100) * 100) / F.lit(1000.0)).alias("lon"),
        v.alias("speed"),
        ((k - 50) / F.lit(5.0)).alias("lon_acc"),
        ((v - F.floor(v / 10) * 10) - F.lit(5.0)).alias("lat_acc"),
        (F.timestamp_diff("MICROSECOND", F.lit(EPOCH).cast("timestamp_ntz"), F.col("ts"))
         / F.lit(1e6)).alias("time_sec"),
        F.col("ts").alias("loaded_at"),
    )


def events_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw tracks (raw.tracks columns) from ``events``: one per user."""
    ev = table(spark, sf_dir, "events")
    agg = ev.groupBy("user_id").agg(
        F.round(F.sum("value"), 2).alias("traveled_d"),
        ((F.min("value") + F.max("value")) / 2).alias("avg_speed"),
        F.min("ts").alias("loaded_at"),
    )
    return agg.select(
        _source_file(F.col("user_id")).alias("source_file"),
        F.col("user_id").cast("int").alias("track_id"),
        _vehicle_type(F.col("user_id")).alias("vehicle_type"),
        "traveled_d", "avg_speed", "loaded_at",
    )


# ---------------------------------------------------------------------------
# Ragged text files from orders + lineitem


def ragged_file_count(n_orders: int) -> int:
    return max(RAGGED_MIN_FILES, math.ceil(n_orders / RAGGED_LINES_PER_FILE))


def _num_text(c) -> F.Column:
    return F.col(c).cast("double").cast("string")


# Orders (by key modulo) whose line comes a second time, and whose line holds
# the reader's separator.
REPEAT_MODULO, REPEAT_AT = 97, 5
CONTROL_MODULO, CONTROL_AT = 101, 7


def ragged_lines(spark: SparkSession, sf_dir: str, n_files: int) -> DataFrame:
    """A header line per file (sort_key -1) and one text line per order, those of a file in
    one task: header = (o_orderkey, o_orderpriority,
    o_totalprice, 0.0), then one block per line item, sorted by (l_partkey,
    l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax); the first two
    give the coordinates (a grid of 0.0001 degrees), the rest are the values.

    Orders with status 'P' and priority '5-LOW' lose their last field, orders
    at CONTROL_AT hold a U+0001 (both rejects); orders without line items give
    zero-frame tracks.  Good orders at REPEAT_AT are followed by a second line
    of the same track: another type and header, every speed raised by 1000,
    and one more block."""
    six = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    three = ["o_orderstatus", "o_orderpriority", "o_totalprice"]
    items = table(spark, sf_dir, "lineitem").filter("l_orderkey IS NOT NULL").select(
        F.col("l_orderkey").cast("long").alias("key"), *six)
    orders = table(spark, sf_dir, "orders").filter("o_orderkey IS NOT NULL")
    # Orders and items meet in the file of their line, so nothing moves twice; a file's
    # header line comes as an order of its own under a key that belongs to the file.
    heads = spark.range(n_files).select((F.col("id") - n_files).alias("key"), F.struct(
        *[F.lit(None).cast(orders.schema[c].dataType).alias(c) for c in three], F.lit(True).alias("header")).alias("order"))
    orders = orders.select(F.col("o_orderkey").cast("long").alias("key"),
                           F.struct(*three, F.lit(False).alias("header")).alias("order"))
    file_no = F.pmod(F.col("key"), F.lit(n_files))
    item = F.struct(*[F.col(c).cast("double").alias(c) for c in six])
    j = (items.unionByName(orders, allowMissingColumns=True).unionByName(heads, allowMissingColumns=True)
         .repartition(n_files, file_no).groupBy(file_no.alias("file_no"), "key").agg(
             F.array_sort(F.collect_list(F.when(F.col("order").isNull(), item))).alias("blocks"),
             F.collect_list("order").alias("orders"))
         .select("file_no", "key", "blocks", F.explode("orders").alias("order"))
         .select("file_no", "key", "blocks", "order.*"))
    key = F.col("key")
    broken = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW")
    control = F.pmod(key, F.lit(CONTROL_MODULO)) == CONTROL_AT

    def values(raised: float):
        return F.flatten(F.transform(F.col("blocks"), lambda b: F.array(
            *[x.cast("string") for x in (
                F.lit(37.9) + (b["l_partkey"] % 1000) / 10000.0,
                F.lit(23.7) + (b["l_suppkey"] % 1000) / 10000.0,
                b["l_quantity"] + raised, b["l_extendedprice"], b["l_discount"], b["l_tax"])])))

    kind = F.when(control, F.concat(F.lit("\u0001"), F.col("o_orderpriority"))).otherwise(
        F.col("o_orderpriority"))
    fields = F.concat(F.array(key.cast("string"), kind, _num_text("o_totalprice"), F.lit("0.0")),
                      values(0.0))
    fields = F.when(broken, F.slice(fields, 1, F.size(fields) - 1)).otherwise(fields)
    again = F.concat(F.array(key.cast("string"), F.lit("again"), F.lit("1.0"), F.lit("2.0")),
                     values(1000.0), F.array(*map(F.lit, ("37.5", "23.5", "7.0", "0.0", "0.0", "99.0"))))
    repeated = (F.pmod(key, F.lit(REPEAT_MODULO)) == REPEAT_AT) & ~broken & ~control
    text = lambda c: F.concat(F.concat_ws("; ", c), F.lit(";"))
    return j.select(
        "file_no", F.when(F.col("header"), F.lit(-1).cast("long")).otherwise(key).alias("sort_key"),
        F.posexplode(F.when(F.col("header"), F.array(F.lit(RAGGED_HEADER))).when(
            repeated, F.array(text(fields), text(again))).otherwise(F.array(text(fields)))).alias("nth", "line"))


def ragged_file_name(file_no: int) -> str:
    return f"ragged_{file_no:03d}.csv"


def write_ragged_fixture(spark: SparkSession, sf_dir: str) -> str:
    """The folder of the ragged files for ``sf_dir``; its name tells the input,
    and a folder that was written completely is used as it is.

    Files are written in parallel (one task per file group) with a header
    line each, then renamed to stable names ragged_NNN.csv.
    """
    name = hashlib.sha256(f"{RAGGED_LAYOUT} {sf_dir}".encode()).hexdigest()[:12]
    out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/kinetra/ragged-{name}"
    if path_exists(spark, f"{out}/_complete"):
        return out
    n_orders = table(spark, sf_dir, "orders").count()
    n_files = ragged_file_count(n_orders)
    staging = out + "/_staging"
    with shuffles_released(spark):
        (ragged_lines(spark, sf_dir, n_files)
         .sortWithinPartitions("file_no", "sort_key", "nth")
         .select("file_no", "line")
         .write.mode("overwrite").partitionBy("file_no").text(staging))
    _publish_files(spark, staging, out, n_files)
    write_text_file(spark, f"{out}/_complete", "")
    return out


def _publish_files(spark: SparkSession, staging: str, out: str, n_files: int) -> None:
    """Move staging/file_no=K/part-*.txt to out/ragged_K.csv (metadata only).
    The emptied ``_staging`` folder stays; readers skip names starting '_'."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    Path = jvm.org.apache.hadoop.fs.Path
    fs = Path(staging).getFileSystem(conf)
    for k in range(n_files):
        parts = [s.getPath() for s in fs.listStatus(Path(f"{staging}/file_no={k}"))
                 if s.getPath().getName().startswith("part-")]
        if len(parts) != 1:
            raise RuntimeError(f"expected one part file for ragged file {k}, got {len(parts)}")
        fs.rename(parts[0], Path(f"{out}/{ragged_file_name(k)}"))
