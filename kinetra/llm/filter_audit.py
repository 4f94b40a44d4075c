"""Filter interaction audit: what each filter removes, in every order of them.

Which documents a filter removes depends on the filters before it; which set of
filters removes a document does not.  So documents are counted once by the set
of filters that they fail (at most 32 sets a part), and the rest is arithmetic on
these counts:

* ``removed[S]`` -- documents that fail any filter of the coalition S, for all 32
  coalitions, and the same for documents labelled good and toxic;
* a step of an order removes ``removed[before + filter] - removed[before]``;
* Shapley values by exact constrained least squares: of all additive models
  ``sum(phi_i, i in S)`` with ``sum(phi) = removed[all]`` (efficiency) the one
  nearest to ``removed[S]`` under the Shapley kernel's weights.  The normal
  equations with their Lagrange multiplier do not depend on the counts but for the
  right-hand side, so they are solved once, in rationals, for a unit right-hand
  side per coalition.  Times the number of orders the solution is a table of
  integers; each part applies it to its own counts, so no value is rounded.

Spark does the counting.  Texts are read once; equal texts meet by their SHA-256
and not by the text, and rows of one text are summed per (part, labels) before they
meet, so a text that holds a third of all rows is a few rows there.

Defined cases: a null text is the empty text (fails A: no words; B: 0 < 0 does not
hold).  A null source is the part of the empty string.  A row without doc_id is
judged by its text; it has no smaller doc_id and is no other row's smaller one, and
has no labels.  Rows of equal text and equal doc_id are no copies of each other
(none is smaller) and count as often as they occur.  Several label rows of a
document count as one: quality 1 if any says so, toxic likewise; other values and
nulls are neither.  An empty table has no parts and gives no rows.  Very long texts
are split whole in one row of one task.  Other columns of either table are not read.
"""

from __future__ import annotations

import json
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinetra.session import materialize

#: The filters in the order of their bits; E is the one that looks at other rows.
FILTERS = "ABCDE"
COPY = FILTERS.index("E")
# The filters' limits.
LEAST_WORDS = 50
LEAST_DISTINCT_PERCENT = 65
MOST_UPPER_PERCENT = 5
BREAKS = r"[\x20\x09-\x0D]+"
MARKS = r"[#$%&*|]"


def text_failures(text: Column, words: Column) -> list[Column]:
    """Failure conditions of A to D on a text and the array of its words."""
    n = F.size(words)
    upper = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return [n < LEAST_WORDS,
            100 * F.size(F.array_distinct(words)) < LEAST_DISTINCT_PERCENT * n,
            100 * upper > MOST_UPPER_PERCENT * F.length(text),
            text.rlike(MARKS)]


def judged(docs: DataFrame) -> DataFrame:
    """(doc_id, part, key, mask): the text's digest and the bits of A to D that it
    fails, one row per document, written once."""
    text = F.col("text")
    words = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                        F.coalesce(text.cast("string"), F.lit("")).alias("text")).select(
        "*", F.array_remove(F.split(text, BREAKS), "").alias("words"))
    mask = sum((F.when(bad, 1 << i).otherwise(0) for i, bad in
                enumerate(text_failures(text, F.col("words")))), F.lit(0))
    return materialize(words.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("key"),
                                    mask.alias("mask")), "judged")


def label_flags(labels: DataFrame) -> DataFrame:
    """(doc_id, good, toxic), one row per labelled document."""
    return labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by the exact set of filters that they
    fail, bit i for ``FILTERS[i]``; only sets that occur."""
    keys = ["key", "mask", "part"]
    rows = materialize(judged(docs).groupBy(*keys, "doc_id").agg(F.count(F.lit(1)).alias("n")),
                       "audited")
    # rows without doc_id match nothing: they stay out of the join on it
    flagged = rows.filter("doc_id IS NOT NULL").join(label_flags(labels), "doc_id", "left").select(
        *keys, "doc_id", "n", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")])
    flagged = flagged.unionByName(rows.filter("doc_id IS NULL").select(
        *keys, "doc_id", "n", F.lit(False).alias("good"), F.lit(False).alias("toxic")))
    alike = flagged.groupBy(*keys, "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("nameless"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("low"))
    # a few rows of each text: its parts and labels
    least = F.min("low.doc_id").over(Window.partitionBy("key"))
    first = alike.select("*", (F.col("nameless") + F.when(F.col("low.doc_id") == least, F.col("low.n"))
                               .otherwise(0)).alias("first"))
    split = first.select("part", "good", "toxic", F.inline(F.array(
        F.struct(F.col("mask"), F.col("first").alias("n")),
        F.struct((F.col("mask") + (1 << COPY)).alias("mask"), (F.col("n") - F.col("first")).alias("n")))))
    return split.filter("n > 0").groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        *[F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c) for c in ("good", "toxic")])


def _solve(matrix: list[list[Fraction]], right: list[list[Fraction]]) -> list[list[Fraction]]:
    """X of matrix X = right, by elimination (the matrix is regular)."""
    n = len(matrix)
    rows = [list(a) + list(b) for a, b in zip(matrix, right)]
    for c in range(n):
        at = next(r for r in range(c, n) if rows[r][c])
        rows[c], rows[at] = rows[at], rows[c]
        pivot = rows[c][c]
        rows[c] = [x / pivot for x in rows[c]]
        for r in range(n):
            if r != c and (f := rows[r][c]):
                rows[r] = [x - f * y for x, y in zip(rows[r], rows[c])]
    return [r[n:] for r in rows]


def shapley_table(n: int) -> list[list[Fraction]]:
    """``table[i][S]``: what coalition S's value adds to the Shapley value of player i.

    Minimise ``sum(w(S) * (v(S) - v(0) - sum(phi_i, i in S))^2)`` over all S but none
    and all, ``w(S) = (n - 1) / (C(n, s) * s * (n - s))``, subject to ``sum(phi) =
    v(all) - v(0)``: the normal equations and the constraint are n + 1 equations in
    phi and a multiplier, linear in v."""
    every = (1 << n) - 1
    size = n + 1
    matrix = [[Fraction(0)] * size for _ in range(size)]
    right = [[Fraction(0)] * (every + 1) for _ in range(size)]
    for s in range(1, every):
        members = [i for i in range(n) if s >> i & 1]
        k = len(members)
        w = Fraction(n - 1, comb(n, k) * k * (n - k))
        for i in members:
            for j in members:
                matrix[i][j] += w
            right[i][s] += w
            right[i][0] -= w
    for i in range(n):
        matrix[i][n] = matrix[n][i] = Fraction(1)
    right[n][every] += 1
    right[n][0] -= 1
    return _solve(matrix, right)[:n]


def _json(rows: list, schema: str) -> Column:
    """A constant of any depth as one literal."""
    return F.from_json(F.lit(json.dumps(rows)), schema)


def orders() -> list[dict]:
    """Every step of every order: its filter's bit number, the coalition of it alone,
    and the coalitions before and after it."""
    out = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, bit in enumerate(order):
            out.append({"filter_order": "".join(FILTERS[i] for i in order), "step": step + 1, "bit": bit,
                        "own": 1 << bit, "before": before, "after": before | 1 << bit})
            before |= 1 << bit
    return out


def tabulate(counts: DataFrame) -> DataFrame:
    """One row per part: its documents (``total``), arrays over the coalitions
    (``removed``, ``good``, ``toxic``), and per filter ``alone`` (documents that fail
    nothing else) and ``shapley`` (Shapley value times the number of orders)."""
    n = len(FILTERS)
    sets = counts.groupBy("part").agg(F.sum("n").alias("total"),
                                      F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("sets"))

    def coalitions(field: str) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit((1 << n) - 1)), lambda s: F.aggregate(
            "sets", F.lit(0).cast("long"), lambda sum_, e: sum_ + F.when(
                e["mask"].bitwiseAND(s) != 0, e[field]).otherwise(0)))

    def only(s: int) -> Column:
        return F.aggregate("sets", F.lit(0).cast("long"), lambda sum_, e: sum_ + F.when(
            e["mask"] == s, e["n"]).otherwise(0))

    # the rationals' denominators divide the number of orders
    table = [[int(x * factorial(n)) for x in row] for row in shapley_table(n)]
    return sets.select(
        "part", "total", coalitions("n").alias("removed"), coalitions("good").alias("good"),
        coalitions("toxic").alias("toxic"),
        F.array(*[only(1 << i) for i in range(n)]).alias("alone")).select(
        "*", F.transform(_json(table, "array<array<bigint>>"), lambda row: F.aggregate(
            F.zip_with(row, "removed", lambda a, b: a * b), F.lit(0).cast("long"),
            lambda sum_, x: sum_ + x)).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step."""
    step = _json(orders(), "array<struct<filter_order:string,step:int,bit:int,own:int,before:int,after:int>>")
    steps = tabulate(failure_counts(docs, labels)).select("*", F.inline(step))

    def here(field: str) -> Column:
        return F.get(field, F.col("after")) - F.get(field, F.col("before"))

    fails = F.get("removed", F.col("own"))
    return steps.select(
        "part", "filter_order", "step",
        (F.col("total") - F.get("removed", F.col("after"))).alias("kept"),
        here("removed").alias("removed"), (fails - here("removed")).alias("redundant"),
        F.get("alone", F.col("bit")).alias("unique_fails"),
        here("good").alias("good_lost"), here("toxic").alias("toxic_lost"),
        F.get("shapley", F.col("bit")).alias("shapley"))
