"""The audit against running every order of the filters over the rows."""

from __future__ import annotations

import re
from fractions import Fraction
from itertools import permutations
from math import factorial

import pytest

from kinetra.llm import filter_audit

PROSE = " ".join(f"word{i}" for i in range(60))
TEXTS = [
    PROSE, PROSE, PROSE.upper(), "same " * 80, "short", "", None, "   \t\n", f"{PROSE} 5 % off",
    f"#{PROSE}", "LOUD TEXT " * 40, "é" * 30, f"\x0b{PROSE}\x0c", f"\x1c{PROSE}", "\x85" * 3, "A", "a" * 19 + "A",
    "A " * 49 + "A", "w " * 50, f"{PROSE} end", "same " * 80,
    " ".join(f"{i}" for i in range(65)) + " 0" * 35, " ".join(f"{i}" for i in range(64)) + " 0" * 36,
]


def brute(rows, labels):
    """{(part, order, step): counts} by filtering row lists."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    judged = []
    for doc, text, part in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = set()
        if len(words) < 50:
            fails.add("A")
        if 100 * len(set(words)) < 65 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 5 * len(t):
            fails.add("C")
        if re.search(r"[#$%&*|]", t):
            fails.add("D")
        if doc is not None and any(d is not None and d < doc and (x or "") == t for d, x, _ in rows):
            fails.add("E")
        judged.append((part or "", fails, doc in good, doc in toxic))
    out, total = {}, {}
    for part in {j[0] for j in judged}:
        mine = [j for j in judged if j[0] == part]
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [j for j in left if f in j[1]]
                left = [j for j in left if f not in j[1]]
                total[part, f] = total.get((part, f), 0) + len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in j[1] for j in mine) - len(gone),
                    sum(j[1] == {f} for j in mine), sum(j[2] for j in gone), sum(j[3] for j in gone)]
    for (part, order, step), v in out.items():
        v.append(total[part, order[step - 1]])
    return out


def tables(spark, rows, labels):
    docs = spark.createDataFrame([(*r, "x", 0, 9) for r in rows],
                                 "doc_id long, text string, source string, mask string, n int, part int")
    return docs, spark.createDataFrame([(*r, "y") for r in labels],
                                       "doc_id long, quality int, toxic int, good string")


@pytest.mark.parametrize("case", ["mixed", "nulls", "equal"])
def test_against_brute_force(spark, case):
    if case == "mixed":     # two parts, copies across them
        rows = [(i, t, ["a", "b"][i % 2]) for i, t in enumerate(TEXTS * 3)]
    elif case == "nulls":   # rows without id or source, repeated rows and ids
        rows = [(None if i % 4 == 0 else i % 15, t, [None, "", "a"][i % 3]) for i, t in enumerate(TEXTS * 3)]
        rows += rows[:20]
    else:                   # one text in most rows
        rows = [(i, PROSE if i % 3 else TEXTS[i % len(TEXTS)], f"s{i % 5}") for i in range(150)]
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 40)] + [(3, 1, None), (None, 1, 1), (5, None, 1)]
    got = {(r.part, r.filter_order, r.step): list(r[3:]) for r in
           filter_audit.audit(*tables(spark, rows, labels)).collect()}
    assert got == brute(rows, labels)


def test_empty_tables(spark):
    assert filter_audit.audit(*tables(spark, [], [])).isEmpty()
    docs, labels = tables(spark, [(1, PROSE, "a")], [])
    assert {tuple(r[3:]) for r in filter_audit.audit(docs, labels).collect()} == {(1, 0, 0, 0, 0, 0, 0)}


def test_long_text(spark):
    rows = [(1, PROSE, "a"), (2, "long " * 400_000 + "#", "a")]
    got = {(r.part, r.filter_order, r.step): list(r[3:]) for r in
           filter_audit.audit(*tables(spark, rows, [])).collect()}
    assert got == brute(rows, [])


@pytest.mark.parametrize("n", [2, 3, 5])
def test_shapley_table_is_the_mean_over_orders(n):
    value = [Fraction(s * s % 7 + bin(s).count("1"), 3) for s in range(1 << n)]
    table = filter_audit.shapley_table(n)
    for i in range(n):
        marginal = Fraction(0)
        for order in permutations(range(n)):
            before = sum(1 << j for j in order[:order.index(i)])
            marginal += value[before | 1 << i] - value[before]
        assert sum(a * v for a, v in zip(table[i], value)) == marginal / factorial(n)
        assert all((x * factorial(n)).denominator == 1 for x in table[i])
