"""Summarise the physical plan of every query key (writes PLANS.md).

Usage: python tools/plans.py [sf_dir] > PLANS.md

Per key: shuffles (Exchange), broadcasts, join kinds, windows, aggregates,
and every scan's pruned read schema and pushed filters, taken from the
executed (adaptive, final) plan after one run of the query.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kinetra.plans.registry import QUERIES  # noqa: E402
from kinetra.session import build_session  # noqa: E402


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    qe = df._jdf.queryExecution()
    return qe.executedPlan().toString()


def summarise(plan: str) -> dict:
    c = lambda pat: len(re.findall(pat, plan))
    scans = re.findall(r"FileScan (\w+) \[[^\]\n]*\][^\n]*?(?:PushedFilters: \[([^\]\n]*)\])?, "
                       r"ReadSchema: (struct<[^\n]*)", plan)
    ids = lambda pat: len(set(re.findall(pat + r".*?\[plan_id=(\d+)\]", plan)))
    return {
        "shuffles": ids(r"Exchange (?:hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)"),
        "broadcasts": ids(r"BroadcastExchange"),
        "smj": c(r"SortMergeJoin"),
        "bhj": c(r"BroadcastHashJoin"),
        "windows": c(r"\bWindow \["),
        "aggs": c(r"HashAggregate|ObjectHashAggregate|SortAggregate"),
        "scans": scans,
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8, extra={"spark.sql.maxMetadataStringLength": "2000"})
    spark.sparkContext.setLogLevel("OFF")
    print("# Physical plans per query key\n")
    print(f"Generated by `tools/plans.py` on `{sf_dir}` (local[8], AQE on; final adaptive plans, "
          "after the eager steps of a query such as loads or merges have run).\n")
    print("| key | shuffles | broadcasts | SMJ | BHJ | windows | aggregates |")
    print("|---|---|---|---|---|---|---|")
    details = []
    for k, fn in QUERIES.items():
        try:
            s = summarise(final_plan(fn(spark, sf_dir)))
        except Exception as e:  # noqa: BLE001
            print(f"| {k} | error: {type(e).__name__} | | | | | |")
            continue
        print(f"| {k} | {s['shuffles']} | {s['broadcasts']} | {s['smj']} | {s['bhj']} | "
              f"{s['windows']} | {s['aggs']} |")
        details.append((k, s["scans"]))
    print("\n## Scans (format, pushed filters, read schema)\n")
    for k, scans in details:
        seen = []
        for fmt, pushed, schema in scans:
            item = f"{fmt}: pushed=[{pushed}] schema={schema}"
            if item not in seen:
                seen.append(item)
        print(f"- **{k}**: " + "; ".join(f"`{x}`" for x in seen))
    spark.stop()


if __name__ == "__main__":
    main()
