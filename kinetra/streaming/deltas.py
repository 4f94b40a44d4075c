"""Predecessor deltas as a stateful streaming operator.

``lag`` over a stream: frames are grouped by track, and a track's state is its last frame
(number, speed, time, position).  Each micro-batch brings new frames; they are taken in
frame order, each with the one before it in the batch or, for the first, in the state.
The deltas and the speed bucket are column expressions on the operator's output, the same
as in batch, so Python only passes the four predecessor values on.

Late frames: a frame whose number is not above the state's has no place left in the
sequence that went out already.  It is returned with ``late`` = true, without a
predecessor, and leaves the state as it is.  A frame that comes twice in one batch is
late the second time.

The state is one row per track in RocksDB and survives restarts with the checkpoint.
Rows are handled one by one, since pandas has no NULL beside NaN in a double; the frames
of one track and micro-batch are sorted in memory (bound them by ``maxFilesPerTrigger``).
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from kinetra.operators.trajectory import LAGGED, with_deltas

ORDER = "frame_idx"
# The setting that chooses the state store, and the one this operator needs.
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

STATE = T.StructType([T.StructField(ORDER, T.IntegerType())] + [T.StructField(c, T.DoubleType()) for c in LAGGED])


class Predecessor(StatefulProcessor):
    """Adds the value columns of the frame before, across micro-batches."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", STATE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        last = tuple(self.last.get()) if self.last.exists() else None
        before = last
        found = None
        for row in sorted(rows, key=lambda r: r[ORDER]):
            late = last is not None and row[ORDER] <= last[0]
            known = (None,) * len(LAGGED) if late or last is None else last[1:]
            if not late:
                last = (row[ORDER], *[row[c] for c in LAGGED])
            found = found or Row(*row.__fields__, *[f"prev_{c}" for c in LAGGED], "late")
            yield found(*row, *known, late)
        if last != before:
            self.last.update(last)

    def close(self) -> None:
        pass


@contextlib.contextmanager
def rocksdb(spark: SparkSession):
    """The session's state store is RocksDB for queries started inside."""
    old = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, old)


def stream_deltas(stg_points: DataFrame) -> DataFrame:
    """``points_with_deltas`` of streaming staged points, with ``late``.  Start the query
    inside ``rocksdb``."""
    found = T.StructType(stg_points.schema.fields + [T.StructField(f"prev_{c}", T.DoubleType()) for c in LAGGED]
                         + [T.StructField("late", T.BooleanType())])
    return with_deltas(stg_points.groupBy("track_sk").transformWithState(
        statefulProcessor=Predecessor(), outputStructType=found, outputMode="Append", timeMode="None"))


def run_deltas(spark: SparkSession, source: str, sink: str, checkpoint: str, schema: T.StructType) -> None:
    """Take the new Parquet files of staged points below ``source`` and append their rows
    with deltas to ``sink``."""
    points = spark.readStream.schema(schema).parquet(source)
    with rocksdb(spark):
        query = (stream_deltas(points).writeStream.format("parquet").option("path", sink)
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()
