"""Exact percentiles of groups whose rows belong to a group through an owner (frames of
tracks of a vehicle type), without moving the rows.

A row knows its owner, the owner its group.  Sending every row to its group is a shuffle
of all rows; here a few numbers per owner move instead:

1. each group's mergeable sketch names, for every wanted rank, two values around it;
2. all these values of all groups cut the axis into classes -- each value by itself, and
   the gaps between neighbours.  Rows are counted per (owner, class), which collapses in
   the map tasks, and only the counts meet their group.  They tell exactly which class
   holds each rank, whatever the sketch's error;
3. a rank in a class of one value is that value.  A gap that holds a rank is read again:
   its rows (about the sketch's error, 1 % of a group) are the only ones that move.  A
   gap above ``limit`` rows is sketched and cut once more instead, so no task
   ranks more than ``limit`` rows.

Groups are a dimension: one row for each is held on the driver.  Infinities are ordinary
values and NaN is the largest, as in Spark's order.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinetra.session import shuffles_released

#: Size of a sketch, which sets its error (about 0.5 % of the rows), and the
#: distance in ranks of the values that a rank is looked for between.
SKETCH_K = 1000
MARGIN = 0.01
#: Pieces that a large gap is cut into.
PIECES = 64
#: Most rows of a gap that one task ranks.
LIMIT = 1_000_000


def in_order(values: Iterable[float]) -> list[float]:
    """Distinct values in Spark's order (NaN once, last)."""
    values = set(values)
    numbers = sorted(v for v in values if not math.isnan(v))
    return numbers + [math.nan] * (len(numbers) < len(values))


def class_of(v: Column, bounds: list[float]) -> Column:
    """Class of a value: 2i + 1 is the i-th bound itself, 2i the gap before it.  Nested
    CASEs halve the bounds: few comparisons a row, and code that the JVM compiles."""
    def within(first: int, after: int) -> Column:
        if first == after:
            return F.lit(2 * first)
        mid = (first + after) // 2
        return F.when(v < bounds[mid], within(first, mid)).when(
            v == bounds[mid], 2 * mid + 1).otherwise(within(mid + 1, after))

    return within(0, len(bounds))


def class_counts(values: DataFrame, owners: DataFrame, bounds: list[float], extremes: bool = False) -> dict:
    """``{group: {class: row}}`` with ``n`` of the class and, with ``extremes``, its ``low``
    and ``high``."""
    v = F.col("_v")
    low_high = [F.min(v).alias("low"), F.max(v).alias("high")] if extremes else []
    merged = [F.min("low").alias("low"), F.max("high").alias("high")] if extremes else []
    with shuffles_released(values.sparkSession):
        per_owner = values.groupBy("_owner", class_of(v, bounds).alias("_class")).agg(
            F.count(F.lit(1)).alias("n"), *low_high)
        rows = per_owner.join(owners, "_owner").groupBy("_group", "_class").agg(
            F.sum("n").alias("n"), *merged).collect()
    out = defaultdict(dict)
    for r in rows:
        out[r["_group"]][r["_class"]] = r
    return out


def quantiles(sketch: Column, probs: Column) -> Column:
    """Values of a sketch at ``probs``; NULL where it holds no number."""
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, probs))


def _sketched(values: DataFrame, owners: DataFrame, bounds: list[float], gaps: dict) -> list[float]:
    """Values around the wanted ranks inside large gaps ``{(group, class): (ranks, n)}``."""
    cls = class_of(F.col("_v"), bounds)
    some = values.withColumn("_class", cls).filter(F.col("_class").isin(sorted({c for _, c in gaps})))
    merged = some.groupBy("_owner", "_class").agg(
        F.kll_sketch_agg_double("_v", F.lit(SKETCH_K)).alias("s")).join(owners, "_owner").groupBy(
        "_group", "_class").agg(F.kll_merge_agg_double("s").alias("s"))
    cuts = F.array(*[F.lit(i / PIECES) for i in range(PIECES + 1)])
    out = []
    for row in merged.select("_group", "_class", quantiles(F.col("s"), cuts).alias("q")).collect():
        ranks, n = gaps.get((row["_group"], row["_class"]), ([], 1))
        for r in ranks:         # a piece more on either side, for the sketch's error
            at = r * PIECES // n
            out += [math.nan] if row.q is None else [row.q[max(0, at - 1)], row.q[min(PIECES, at + 2)]]
    return out


def _ranked(values: DataFrame, owners: DataFrame, bounds: list[float], gaps: dict) -> dict:
    """``{(group, class, rank in the gap): value}`` for small gaps."""
    cls = class_of(F.col("_v"), bounds)
    wanted = values.sparkSession.createDataFrame(
        [(g, c, r) for (g, c), (ranks, _) in gaps.items() for r in ranks],
        "_group string, _class int, rank long")
    counts = values.withColumn("_class", cls).filter(F.col("_class").isin(sorted({c for _, c in gaps}))).groupBy(
        "_owner", "_class", "_v").agg(F.count(F.lit(1)).alias("n"))
    keys = ["_group", "_class"]
    inside = counts.join(owners, "_owner").join(
        F.broadcast(wanted.select(*keys).distinct()), keys, "left_semi").groupBy(*keys, "_v").agg(
        F.sum("n").alias("n"))
    upto = F.sum("n").over(Window.partitionBy(*keys).orderBy("_v"))
    placed = inside.select(*keys, "_v", (upto - F.col("n")).alias("first"), upto.alias("after"))
    found = placed.join(F.broadcast(wanted), keys).filter("rank >= first AND rank < after")
    return {(r["_group"], r["_class"], r["rank"]): r["_v"] for r in found.collect()}


def percentiles(values: DataFrame, owners: DataFrame, stats: DataFrame, probs: dict[str, float],
                limit: int = LIMIT) -> dict[str, dict[str, float]]:
    """``{group: {name: percentile}}`` (``percentile_cont``) of every group with values.

    values  _owner, _v (no NULL)
    owners  _owner, _group: one row per owner
    stats   _group, m (number of values), sketch of them: one row per group
    """
    around = F.array(*[F.lit(x) for p in probs.values() for x in
                       (max(0.0, p - MARGIN), min(1.0, p + MARGIN))])
    groups = stats.filter("m > 0").select(
        "_group", "m", F.coalesce(quantiles(F.col("sketch"), around), F.array(F.lit(math.nan))).alias("q")).collect()
    at = {(g["_group"], name): p * (g.m - 1) for g in groups for name, p in probs.items()}
    known: dict[tuple[str, int], float] = {}
    wanted = {(g, rank) for (g, _), h in at.items() for rank in (math.floor(h), math.ceil(h))}
    bounds = in_order(v for g in groups for v in g.q)
    while wanted:
        counts = class_counts(values, owners, bounds)
        gaps: dict = defaultdict(lambda: ([], 0))
        place = {}
        for g, rank in wanted:
            first = 0
            for c in sorted(counts[g]):
                n = counts[g][c].n
                if rank < first + n:
                    break
                first += n
            if c % 2:
                known[g, rank] = bounds[c // 2]
            else:
                place[g, rank] = (g, c, rank - first)
                gaps[g, c] = (gaps[g, c][0] + [rank - first], n)
        large = {k: v for k, v in gaps.items() if v[1] > limit}
        small = {k: v for k, v in gaps.items() if k not in large}
        if small:
            found = _ranked(values, owners, bounds, small)
            known |= {k: found[p] for k, p in place.items() if p in found}
        wanted = {k for k, (g, c, _) in place.items() if (g, c) in large}
        if large:
            bounds = in_order([*bounds, *_sketched(values, owners, bounds, large)])
    out: dict[str, dict[str, float]] = defaultdict(dict)
    for (g, name), h in at.items():
        lo, hi = known[g, math.floor(h)], known[g, math.ceil(h)]
        frac = h - math.floor(h)
        out[g][name] = lo if frac == 0 or lo == hi else lo + frac * (hi - lo)
    return out
