"""Ordered-sequence operators that stay balanced when one group is huge.

A plain ``Window.partitionBy(track)`` puts every frame of a track into one
task; a single track holding a large share of all frames would then be one
straggler task.  Both operators below split each group into chunks of the
ordering key, run the window per (group, chunk) -- evenly spread -- and carry
the values across chunk borders through a small per-chunk table (one row per
chunk, so a 4096x smaller window).  Results are identical to the plain
window; tests check this against the single-window form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinetra.session import materialize

# Frames per chunk.  Tracks in the source data have up to ~20,000 frames, so
# a typical track is one to five chunks.
DEFAULT_CHUNK = 4096

#: Chunks with a predecessor that are handed to every task; more are joined by a shuffle.
FEW_CHUNKS = 1_000_000


def chunk_of(order_col: str, chunk_size: int = DEFAULT_CHUNK) -> Column:
    return F.floor(F.col(order_col) / F.lit(chunk_size))


def with_predecessor(df: DataFrame, group_cols: list[str], order_col: str,
                     value_cols: list[str], prefix: str = "prev_",
                     chunk_size: int = DEFAULT_CHUNK, chunk_col: str | None = None,
                     in_order: bool = False) -> DataFrame:
    """Add ``prefix + c`` = value of ``c`` on the previous row of the group in
    ``order_col`` order (NULL on the first row), like ``lag(c)``.  ``chunk_col`` names a
    column that holds ``chunk_of(order_col)``, by which the rows may lie dealt already.
    ``in_order``: the rows come in ranges of (group, chunk), one after the other over the
    tasks, so that a write partitioned by the first of ``group_cols`` needs no shuffle."""
    chunk = chunk_col or "_seq_chunk"
    keys = group_cols + [chunk]
    d = df if chunk_col else df.withColumn(chunk, chunk_of(order_col, chunk_size))
    w = Window.partitionBy(*keys).orderBy(order_col)
    few = False
    if in_order:
        long = materialize(_of_several_chunks(d, group_cols, chunk), "long-groups")
        some = d.join(F.broadcast(long), group_cols, "left_semi") if long.count() <= FEW_CHUNKS else d
        carry = materialize(_carried(some, group_cols, chunk, order_col, value_cols), "chunk-carry")
        few = carry.count() <= FEW_CHUNKS
    elif not chunk_col:
        carry = _carried(d, group_cols, chunk, order_col, value_cols)
    lagged = (d.repartitionByRange(*keys) if few else d).select(
        "*",
        F.lag(order_col).over(w).alias("_seq_prev_ord"),
        F.lead(order_col).over(w).alias("_seq_next_ord"),
        *[F.lag(c).over(w).alias(prefix + c) for c in value_cols],
    )
    if chunk_col:
        # Last row of every chunk, then the last row of the previous non-empty
        # chunk of the same group: one row per chunk.  (This branch re-reads the
        # input with only the key and value columns, where it lies.)
        last = lagged.filter(F.col("_seq_next_ord").isNull()).select(
            *keys, F.struct(*value_cols).alias("_seq_last"))
        carry = last.select(
            *keys,
            F.lag("_seq_last").over(Window.partitionBy(*group_cols).orderBy(chunk)).alias("_seq_carry"))
    # Join on exactly the window's partition keys: the big side keeps its
    # partitioning and order, only the per-chunk table moves.
    j = lagged.join(F.broadcast(carry) if few else carry, keys, "left")
    if in_order and not few:
        j = j.repartitionByRange(*keys).sortWithinPartitions(*keys)
    first_in_chunk = F.col("_seq_prev_ord").isNull()
    out = j.select(
        *[c for c in d.columns if c != "_seq_chunk" and c not in {prefix + v for v in value_cols}],
        *[F.when(first_in_chunk, F.col("_seq_carry")[c]).otherwise(F.col(prefix + c))
          .alias(prefix + c) for c in value_cols],
    )
    return out


def _of_several_chunks(d: DataFrame, group_cols: list[str], chunk: str) -> DataFrame:
    """The groups with rows in more than one chunk (NULL is one): a row per group moves."""
    c = F.col(chunk)
    return d.groupBy(*group_cols).agg(
        F.min(c).alias("_seq_low"), F.max(c).alias("_seq_high"), F.count_if(c.isNull()).alias("_seq_none")).filter(
        "_seq_low < _seq_high OR (_seq_low IS NOT NULL AND _seq_none > 0)").select(*group_cols)


def _carried(d: DataFrame, group_cols: list[str], chunk: str, order_col: str,
             value_cols: list[str]) -> DataFrame:
    """The last row of the previous non-empty chunk of the same group, one row per chunk
    that has one.  A chunk's rows collapse before the shuffle, and groups of one chunk,
    mostly all, drop out before they are ordered.  (This re-reads the input with only the
    key and value columns.)"""
    keys = group_cols + [chunk]
    place = F.coalesce(F.col(order_col), F.lit(0))       # NULLs are a chunk of their own
    last = d.groupBy(*keys).agg(*[F.max_by(c, place).alias(f"_seq_v{i}") for i, c in enumerate(value_cols)])
    several = last.select(
        *keys, F.struct(*[F.col(f"_seq_v{i}").alias(c) for i, c in enumerate(value_cols)]).alias("_seq_last"),
        F.count(F.lit(1)).over(Window.partitionBy(*group_cols)).alias("_seq_chunks")).filter("_seq_chunks > 1")
    return several.select(
        *keys, F.lag("_seq_last").over(Window.partitionBy(*group_cols).orderBy(chunk)).alias("_seq_carry")).filter(
        F.col("_seq_carry").isNotNull())


def with_ordinal(df: DataFrame, group_cols: list[str], order_cols: list[Column | str],
                 chunk: Column, name: str = "ordinal") -> DataFrame:
    """Add ``name`` = 0-based position of the row in its group under
    ``order_cols`` (``row_number() - 1``).

    ``chunk`` must be non-decreasing in ``order_cols`` within a group (e.g. the
    hour of a timestamp ordering key).  Rows are numbered per (group, chunk) and
    shifted by the row count of the group's earlier chunks.
    """
    c = "_ord_chunk"
    keys = group_cols + [c]
    d = df.withColumn(c, chunk)
    counts = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("_ord_n"))
    before = Window.partitionBy(*group_cols).orderBy(c).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, F.coalesce(F.sum("_ord_n").over(before), F.lit(0))
                            .alias("_ord_offset"))
    ranked = d.withColumn("_ord_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order_cols)))
    out = ranked.join(offsets, keys, "inner")
    return out.select(*[x for x in d.columns if x != c],
                      (F.col("_ord_offset") + F.col("_ord_rn") - 1).cast("int").alias(name))
