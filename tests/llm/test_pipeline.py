"""Every stage of the pipeline against a plain version over its own input."""

from __future__ import annotations

import re

import corpus_pipeline as cp
from kinetra.llm import decontam, packing, pii, quality_bt, simhash_trie
from kinetra.session import materialize
from test_decontam import brute as leaks
from test_simhash_trie import slow_components, slow_fingerprint

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in cp.STAGES:
        out = materialize(stage(spark, docs, SF), f"test-{name}")
        seen[name] = (docs, out)
        if name != "packing":
            assert out.columns == columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
        docs = out

    before, after = (sorted(map(tuple, d.collect())) for d in seen["quality"])
    scored = quality_bt.score(seen["quality"][0], spark.read.parquet(f"{SF}/labels.parquet"))
    good = {r.doc_id for r in scored.filter("predicted = 1").collect()}
    assert after == [r for r in before if r[0] in good] and 0 < len(after) < len(before)

    before, after = (sorted(map(tuple, d.collect())) for d in seen["near_dups"])
    comp = slow_components([r[0] for r in before], [slow_fingerprint(r[1]) for r in before])
    assert after == [r for r, c in zip(before, comp) if r[0] == c] and len(after) < len(before)

    before, after = (sorted(map(tuple, d.collect())) for d in seen["decontam"])
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {d for d, _ in leaks([r[:2] for r in before], items)}
    assert after == [r for r in before if r[0] not in bad]

    before, after = (sorted(map(tuple, d.collect())) for d in seen["pii"])
    at = columns.index("n_chars")
    assert [r[0] for r in before] == [r[0] for r in after]
    for b, a in zip(before, after):
        assert a[1] == pii.masked(b[1]) and a[at] == len(a[1])
        assert not re.search(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", a[1])
        if not pii.find_spans(b[1]):
            assert a == b

    texts = {r[0]: r[1] for r in after}
    pieces = seen["packing"][1].collect()
    encode = packing.encoder(*packing.vocabulary())
    want = {i: len(encode(t)) // 4 + 1 for i, t in texts.items()}
    got = {}
    for p in pieces:
        got[p.doc_id] = got.get(p.doc_id, 0) + p.length
        assert p.doc_tokens == want[p.doc_id]
    assert got == want


def test_stages_take_nulls_repeats_and_empty_tables(spark):
    rows = [(1, "a good text of plain words", "en", "s", 3), (1, "a good text of plain words", "en", "s", 3),
            (2, None, None, None, None), (3, "", "en", None, 0), (None, "null id text", "de", "s", 1),
            (4, "mail me: some.one@host.example.org now", "en", "s", 9)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for name, stage in cp.STAGES:
            docs = materialize(stage(spark, docs, SF), f"edge-{name}")
        assert (docs.count() > 0) == bool(data)


def test_run_is_the_stages(spark):
    assert cp.run(spark, SF).columns[:3] == ["doc_id", "start", "length"]


def test_rows_are_judged_one_by_one(spark):
    """Rows without doc_id, and unlike rows that share one, stay or go by their own text."""
    items = spark.read.parquet(f"{SF}/benchmark.parquet").select("text").collect()
    leak = max((r.text for r in items), key=lambda t: len(t or ""))
    plain = [" ".join(f"{w}{k}" for w in "some plain words of a text about nothing at all".split())
             for k in range(4)]
    schema = "doc_id long, text string, x string, tid long"

    def texts(rows, stage):
        return sorted(((r[0], r[1]) for r in stage(spark.createDataFrame([(*r, "e", 0) for r in rows], schema)).collect()),
                      key=str)

    rows = [(None, plain[0]), (None, plain[1]), (None, plain[2]), (None, plain[2]), (1, plain[0]),
            (2, plain[1]), (2, plain[3]), (2, plain[3]), (3, plain[3])]
    want = sorted([(None, plain[2]), (1, plain[0]), (2, plain[1]), (2, plain[3])], key=str)
    assert texts(rows, simhash_trie.keep_one) == want

    # rows of one doc_id are one document here (test_decontam.py)
    rows = [(None, leak), (None, plain[0]), (None, plain[1]), (4, leak), (4, plain[2]), (5, plain[2])]
    want = sorted([(None, plain[0]), (None, plain[1]), (5, plain[2])], key=str)
    assert texts(rows, lambda d: decontam.decontaminate(d, spark.read.parquet(f"{SF}/benchmark.parquet"))) == want

    bad = "BAD!! $$$ ||| " * 60
    known = [(i, plain[i % 4] + f" {i}") for i in range(10, 40)] + [(i, bad + f" {i}") for i in range(40, 70)]
    labels = spark.createDataFrame([(i, int(i < 40)) for i, _ in known], "doc_id long, quality int")
    rows = known + [(None, bad), (None, plain[0]), (None, plain[1]), (7, bad), (7, plain[2])]
    got = texts(rows, lambda d: quality_bt.keep_good(d, labels))
    want = [(None, plain[0]), (None, plain[1]), (7, plain[2])]
    assert [r for r in got if r[0] is None or r[0] == 7] == sorted(want, key=str)
    assert {r[0] for r in got if r[0] and r[0] >= 10} == set(range(10, 40))
