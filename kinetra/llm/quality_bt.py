"""Quality classifier: Bradley-Terry ranking of documents from preferences.

Every document has a feature vector taken from its whole text.  A document
marked good is preferred to one marked bad; with scores ``s = w . x`` the
preference has probability ``sigmoid(s_good - s_bad)``, so ``w`` is a logistic
regression on feature *differences* without intercept.  It is fitted on pairs
from at most ``max_labelled`` labelled training rows (the ones of least key
hash, per label), each paired with ``rivals`` rows of the other label.

The threshold is a quantile of the scores of all documents: of ``levels``
quantiles, the one that parts all labelled training rows best (balanced
accuracy; the middle of equally good ones).  The published score is
``sigmoid(s - threshold + logit(0.7))``, which is 0.7 at the threshold.

Defined cases: null and empty texts have the features of an empty text; rows
without a label, or with a null or other label than 0 and 1, are scored but
not learned from; a null doc_id counts as training but joins no label;
repeated rows are scored each; texts of any length are read whole; a score at the
threshold is kept; without rows of both labels nothing can be
learned and every score is 0.75; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinetra.session import materialize

MAX_LABELLED = 4_000
RIVALS = 16
LEVELS = 1_000
KEEP_AT = 0.7

FEATURES = ("log_bytes", "upper", "digits", "marks", "loud", "bars", "blanks", "lines",
            "distinct_words", "repeats_next", "top_word", "repeated_lines", "word_bytes",
            "short_words", "long_words", "marked_words", "distinct_log", "empty")

_CLASS = np.zeros((256, 6))
for _chars, _k in (("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 0), ("0123456789", 1),
                   ("#$%&*+/<=>@^_`~{}[]\\", 2), ("!?", 3), ("|", 4), (" \t\n\r\x0b\x0c", 5)):
    for _c in _chars:
        _CLASS[ord(_c), _k] = 1


def features(text: bytes | None) -> list[float]:
    """The vector of FEATURES of a UTF-8 text."""
    text = text or b""
    words = text.split()
    if not words:
        return [math.log1p(len(text)), *[0.0] * 16, 1.0]
    size, n = len(text), len(words)
    classes = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _CLASS / size
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lines = [line for line in text.split(b"\n") if line.strip()]
    sizes = list(map(len, words))
    follows = sum(map(bytes.__eq__, words, words[1:]))
    tails = sum(w[-1] in b"#$%&*!|" for w in words)
    return [math.log1p(size), *classes.tolist(), len(lines) / n, len(counts) / n, follows / n,
            max(counts.values()) / n, 1 - len(set(lines)) / max(1, len(lines)),
            sum(sizes) / n / 10, sum(s < 4 for s in sizes) / n, sum(s > 15 for s in sizes) / n,
            tails / n, math.log1p(len(counts)) / math.log1p(n), 0.0]


def featurise(docs: DataFrame) -> DataFrame:
    """(doc_id, x) per row, from whole texts."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [features(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float64()))],
                                             names=["doc_id", "x"])

    return docs.select("doc_id", F.col("text").cast("string").cast("binary").alias("t")).mapInArrow(
        scan, "doc_id long, x array<double>")


@dataclass
class Model:
    weights: list[float]
    threshold: float | None

    def raw(self, x: Column) -> Column:
        w = F.array(*[F.lit(v) for v in self.weights])
        return F.aggregate(F.zip_with(x, w, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)

    def score(self, x: Column) -> Column:
        if self.threshold is None:
            return F.lit(0.75)
        z = self.raw(x) - F.lit(self.threshold) + F.lit(math.log(KEEP_AT / (1 - KEEP_AT)))
        return 1 / (1 + F.exp(-z))


def bradley_terry(good: np.ndarray, bad: np.ndarray, rivals: int = RIVALS,
                  ridge: float = 1e-3, steps: int = 30) -> np.ndarray:
    """Weights by Newton steps on the logistic loss of ``good - bad`` pairs:
    every row meets ``rivals`` rows of the other label."""
    both = np.vstack([good, bad])
    scale = both.std(0)
    scale[scale < 1e-12] = np.inf
    g = np.concatenate([np.tile(np.arange(len(good)), rivals),
                        (np.arange(len(bad) * rivals) * 7919) % len(good)])
    b = np.concatenate([(np.arange(len(good) * rivals) * 7907) % len(bad),
                        np.tile(np.arange(len(bad)), rivals)])
    d = (good[g] - bad[b]) / scale
    w = np.zeros(d.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(np.clip(d @ w, -40, 40)))  # of the wrong order
        grad = -(d * p[:, None]).mean(0) + ridge * w
        hess = (d * (p * (1 - p))[:, None]).T @ d / len(d) + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w / scale


def held_out() -> Column:
    """Rows that are never learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def fit(x: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Model:
    """``x``: (doc_id, x) of all documents; ``labels``: (doc_id, quality)."""
    known = labels.filter("quality IN (0, 1)").select("doc_id", "quality").distinct()
    train = materialize(x.filter(~held_out()).join(known, "doc_id"), "labelled")
    order = F.xxhash64(F.col("doc_id"), F.lit("fit"))
    sample = [np.array([r.x for r in train.filter(F.col("quality") == q).orderBy(order, "doc_id")
                        .limit(max_labelled // 2).select("x").collect()]) for q in (1, 0)]
    if not all(map(len, sample)):
        return Model([0.0] * len(FEATURES), None)
    model = Model(bradley_terry(*sample).tolist(), 0.0)

    levels = [i / LEVELS for i in range(LEVELS + 1)]
    cuts = sorted(set(x.select(F.percentile_approx(model.raw(F.col("x")), levels, 10_000)
                               .alias("q")).first().q))
    cuts = [(a + b) / 2 for a, b in zip(cuts, cuts[1:])] or [cuts[0] - 1.0]
    def tally_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, len(cuts) + 1), np.int64)
        for b in batches:
            np.add.at(n, (b.column(0).to_numpy(), np.searchsorted(cuts, b.column(1).to_numpy(), "right")), 1)
        q, k = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(k), pa.array(n[q, k])], ["q", "k", "n"])

    tally = np.zeros((2, len(cuts) + 1))
    for r in train.select(F.col("quality").cast("long").alias("quality"), model.raw(F.col("x")).alias("raw")).mapInArrow(
            tally_rows, "q long, k long, n long").groupBy("q", "k").agg(F.sum("n").alias("n")).collect():
        tally[r.q, r.k] = r.n                       # at most 2 (LEVELS + 1) rows
    # at cut i a row is kept when more than i cuts lie at or below its score
    kept = tally[:, ::-1].cumsum(1)[:, ::-1][:, 1:]
    right = kept[1] / tally[1].sum() + 1 - kept[0] / tally[0].sum()
    best = np.flatnonzero(right >= right.max() - 1e-12)
    return Model(model.weights, cuts[best[len(best) // 2]])


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    x = materialize(featurise(docs), "features")
    model = fit(x, labels)
    return x.select("doc_id", held_out().alias("held_out"), model.score(F.col("x")).alias("score")
                    ).withColumn("predicted", (F.col("score") >= KEEP_AT).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that the classifier rejects.  Each row is
    judged by its own text, whatever its doc_id; features are computed again
    for that, so no text is shuffled."""
    model = fit(materialize(featurise(docs), "features"), labels)
    at, extra = docs.columns.index("text"), max(docs.columns, key=len) + "_features"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [features(t.as_py()) for t in b.column(at).cast(pa.binary())]
            yield b.append_column(extra, pa.array(x, pa.list_(pa.float64())))

    wide = docs.withColumn("text", F.col("text").cast("string"))
    schema = T.StructType([*wide.schema.fields, T.StructField(extra, T.ArrayType(T.DoubleType()))])
    kept = wide.mapInArrow(scan, schema).filter(model.score(F.col(extra)) >= KEEP_AT)
    return kept.select(*docs.columns)
