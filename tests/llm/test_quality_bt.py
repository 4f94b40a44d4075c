"""The classifier: held-out accuracy, no leaks of held-out labels, edge cases."""

from __future__ import annotations

import zlib

import numpy as np

from kinetra.llm import quality_bt as q

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = {r.doc_id: r for r in q.score(docs, labels).collect()}
    assert len(rows) == docs.count()
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    known = [(r.quality, rows[r.doc_id]) for r in labels.collect() if r.quality is not None]
    held = [(y, r.predicted) for y, r in known if r.held_out]
    assert np.mean([y == p for y, p in held]) >= 0.97
    assert np.mean([p for y, p in held if y == 1]) >= 0.97
    # a held-out label changes nothing
    flipped = labels.withColumn("quality", q.F.when(q.held_out(), 1 - q.F.col("quality")).otherwise(
        q.F.col("quality")))
    again = {r.doc_id: r.score for r in q.score(docs.limit(200), flipped).collect()}
    same = {r.doc_id: r.score for r in q.score(docs.limit(200), labels).collect()}
    assert again == same


def test_preferences_are_learned():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((400, 5))
    s = x @ np.array([2.0, -1.0, 0.0, 0.5, 0.0])
    w = q.bradley_terry(x[s > 0], x[s <= 0])
    assert np.corrcoef(x @ w, s)[0, 1] > 0.98


def test_scores_against_a_plain_fit(spark):
    """The whole operator again in plain Python: features, preferences, descent on
    the same loss by another optimiser, threshold by trying every cut."""
    docs, labels = (spark.read.parquet(f"{SF}/../sf0.001/{t}.parquet") for t in ("documents", "labels"))
    rows = {r.doc_id: r.text for r in docs.collect()}
    quality = {r.doc_id: r.quality for r in labels.collect() if r.doc_id in rows and r.quality in (0, 1)}
    x = {i: np.array(q.features((t or "").encode())) for i, t in rows.items()}
    train = {i: y for i, y in quality.items() if zlib.crc32(str(i).encode()) % 4 != 2}
    got = {r.doc_id: r.score for r in q.score(docs, labels).collect()}
    raw = {i: np.log(s / (1 - s)) for i, s in got.items()}

    # scores are one linear function of the features, 0.7 at a threshold
    ids = sorted(rows)
    a = np.stack([np.r_[x[i], 1.0] for i in ids])
    w, *_ = np.linalg.lstsq(a, np.array([raw[i] for i in ids]), rcond=None)
    assert np.abs(a @ w - [raw[i] for i in ids]).max() < 1e-5
    # no other weights have a smaller loss on all preferences than those by more than the sampling of pairs
    good, bad = (np.stack([x[i] for i in sorted(train) if train[i] == y]) for y in (1, 0))
    scale = np.vstack([good, bad]).std(0)
    scale[scale < 1e-12] = np.inf
    d = ((good[:, None] - bad[None]) / scale).reshape(-1, good.shape[1])

    def loss(v):
        return np.logaddexp(0, -d @ v).mean() + 0.5e-3 * v @ v

    v = np.zeros(d.shape[1])
    for _ in range(4000):
        v += 0.5 * ((d / (1 + np.exp(d @ v))[:, None]).mean(0) - 1e-3 * v)
    mine = w[:-1] * np.where(np.isinf(scale), 0, scale)
    assert loss(mine) < 1.25 * loss(v) + 1e-3
    plain = np.array([x[i] @ np.where(np.isinf(scale), 0, v / scale) for i in ids])
    assert np.corrcoef(plain, [raw[i] for i in ids])[0, 1] > 0.99
    # balanced accuracy of the threshold: none of all cuts is better by more than a quantile step
    y = np.array([train[i] for i in ids if i in train])
    s = np.array([got[i] for i in ids if i in train])

    def right(cut):
        return (s[y == 1] >= cut).mean() + (s[y == 0] < cut).mean()

    assert right(0.7) >= max(map(right, s)) - 0.02


def test_edges(spark):
    docs = spark.createDataFrame(
        [(1, "good words here", 1, "e"), (2, None, 1, "e"), (3, "", 1, "e"), (3, "", 1, "e"), (None, "BAD!! BAD!!", 0, "e"),
         (7, "BAD!! $$$ " * 5000, 0, "e")], "doc_id long, text string, quality int, x string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = q.score(docs, none).collect()
    assert len(rows) == 6 and {(r.score, r.predicted) for r in rows} == {(0.75, 1)}
    labels = spark.createDataFrame([(i, y, 0) for i, y in ((1, 1), (7, 0), (2, None), (9, 1), (3, 5))],
                                   "doc_id long, quality int, toxic int")
    rows = q.score(docs, labels).collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 for r in rows)
    assert q.score(docs.limit(0), labels).count() == 0
    assert q.keep_good(docs, labels).columns == docs.columns
    clash = docs.withColumnRenamed("x", "__features")
    assert q.keep_good(clash, labels).columns == clash.columns
