"""Connected components of an edge table, as Spark joins.

Alternating large-star and small-star rounds (each keeps the components and
moves every node towards the least id) until nothing changes; the rounds grow
with the logarithm of the graph.  Every step is a partial aggregate or a join
whose skewed side Spark can split, and each round is written to the shared
folder, so nothing depends on a lost executor.  No edge reaches the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinetra.session import materialize


def unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Within a task: union of the links a-b on the forest ``label`` (parents;
    the least index of a tree is its root)."""
    while len(a):
        flatten(label)
        ra, rb = label[a], label[b]
        open_ = ra != rb
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(label, np.maximum(ra, rb), np.minimum(ra, rb))


def flatten(label: np.ndarray) -> None:
    """Point every node of a forest at its root."""
    while True:
        up = label[label]
        if np.array_equal(up, label):
            return
        label[:] = up


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step.  Edges are (a, b) with a > b."""
    if large:  # all neighbours of u; those above u move to the least
        sides = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = sides.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        moved = edges.select(F.col("b").alias("a"), F.col("a").alias("v")).join(least, "a")
        return moved.filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a")
    return moved.select("b", "m").filter("b <> m").select(
        F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
        least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (two columns of one
    comparable type; order, repeats and self links do not matter); component
    is the least node reachable.  An empty table gives no rows."""
    a, b = edges.columns
    edges = materialize(edges.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "edges")
    while True:
        # large-star may leave nodes of a star's centre; small-star joins centres
        new = materialize(_star(_star(edges, True), False), "edges")
        # a forest of stars: no centre is itself a leaf
        if new.join(new.select(F.col("a").alias("b")).distinct(), "b", "left_semi").isEmpty():
            same = new.join(edges, ["a", "b"], "left_anti").isEmpty()
            if same or _star(new, True).join(new, ["a", "b"], "left_anti").isEmpty():
                break
        edges = new
    return new.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        new.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
