"""Exact interpolated percentiles (``percentile_cont``) per group, at any size.

Spark's exact ``percentile`` merges a value->count map of a whole group in one
task.  Here a group never meets in one task:

1. ``value_counts`` counts equal (group, value) pairs (hot values collapse in
   the map tasks); the counts serve every other statistic of the group too;
2. a bounded sketch of the distinct values cuts each group into
   ``CUTS + 1`` value ranges, whose exact row counts are summed;
3. prefix sums over those (at most ``CUTS + 1`` rows a group) say which ranges
   hold the wanted ranks, whatever the sketch's error;
4. only the values of these ranges are ranked with a window, and the two
   order statistics around ``p * (n - 1)`` are interpolated.

One plan for all sizes.  Infinities are ordinary values; NaN is the largest.
Equal order statistics are returned as they are (no ``inf - inf``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinetra.session import materialize

CUTS = 255


def value_counts(df: DataFrame, group_cols: list[str], value_col: str) -> DataFrame:
    """(group, _v, _c): rows of each value of each group, NULL included,
    written once below the shared checkpoint folder."""
    return materialize(df.groupBy(*group_cols, F.col(value_col).alias("_v")).agg(
        F.count(F.lit(1)).alias("_c")), "value-counts")


def exact_percentiles(df: DataFrame, group_cols: list[str], value_col: str,
                      probs: dict[str, float], cuts: int = CUTS) -> DataFrame:
    """One row per group with non-NULL values: ``group_cols`` + one column per
    entry of ``probs`` (name -> p in [0, 1])."""
    return percentiles_of_counts(value_counts(df, group_cols, value_col), group_cols, probs, cuts)


def percentiles_of_counts(counts: DataFrame, group_cols: list[str], probs: dict[str, float],
                          cuts: int = CUTS) -> DataFrame:
    """The same from value counts (columns ``_v``, ``_c``), which are read twice."""
    vals = counts.filter(F.col("_v").isNotNull())
    names = list(probs)
    stats = materialize(vals.groupBy(*group_cols).agg(
        F.sum("_c").alias("_n"),
        F.percentile_approx("_v", [(i + 1) / (cuts + 1) for i in range(cuts)], 10_000).alias("_cuts")),
        "percentile-cuts")
    ranges = vals.join(stats.select(*group_cols, "_cuts"), group_cols).select(
        *group_cols, "_v", "_c", F.size(F.filter("_cuts", lambda x: x < F.col("_v"))).alias("_b"))
    keys = [*group_cols, "_b"]
    sizes = ranges.groupBy(*keys).agg(F.sum("_c").alias("_size"))
    before = Window.partitionBy(*group_cols).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(sizes.select(*keys, "_size", F.coalesce(F.sum("_size").over(before), F.lit(0))
                                      .alias("_first")), "percentile-ranges")
    ranks = stats.select(*group_cols, F.inline(F.array(*[F.struct(
        F.lit(i).alias("_p"), (F.lit(float(probs[k])) * (F.col("_n") - 1)).alias("_h"))
        for i, k in enumerate(names)]))).select(
        "*", F.floor("_h").cast("long").alias("_lo"), F.ceil("_h").cast("long").alias("_hi"))

    def holds(rank: str, first: Column, size: Column) -> Column:
        return (F.col(rank) >= first) & (F.col(rank) < first + size)

    wanted = starts.join(ranks, group_cols).filter(
        holds("_lo", F.col("_first"), F.col("_size")) | holds("_hi", F.col("_first"), F.col("_size")))
    wanted = materialize(wanted.select(*keys, "_first", "_p", "_h", "_lo", "_hi"), "percentile-ranks")
    inside = ranges.join(wanted.select(*keys, "_first").distinct(), keys)
    so_far = Window.partitionBy(*keys).orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    placed = inside.select(*keys, "_v", "_c", (F.col("_first") + F.coalesce(
        F.sum("_c").over(so_far), F.lit(0))).alias("_start"))
    picked = placed.join(wanted.drop("_first"), keys).groupBy(*group_cols, "_p").agg(
        F.max(F.when(holds("_lo", F.col("_start"), F.col("_c")), F.col("_v"))).alias("_vlo"),
        F.max(F.when(holds("_hi", F.col("_start"), F.col("_c")), F.col("_v"))).alias("_vhi"),
        F.first("_h").alias("_h"), F.first("_lo").alias("_lo"))
    frac = F.col("_h") - F.col("_lo")
    value = F.when((frac == 0) | (F.col("_vlo") == F.col("_vhi")), F.col("_vlo")).otherwise(
        F.col("_vlo") + frac * (F.col("_vhi") - F.col("_vlo")))
    return picked.groupBy(*group_cols).agg(
        *[F.max(F.when(F.col("_p") == i, value)).alias(k) for i, k in enumerate(names)])
