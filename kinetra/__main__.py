"""Command line: ``python -m kinetra <command> ...``

  ingest     load ragged files (path or folder + glob) into the raw tables
  stream     same, as a file stream (each new file once; availableNow)
  transform  rebuild models, merge the fact, run all checks, gate
  sql        run a SQL statement over the registered warehouse views and functions
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from kinetra.functions import sql as sql_functions
from kinetra.operators import load
from kinetra.plans.warehouse import Warehouse, run_transform
from kinetra.session import build_session
from kinetra.sources import ragged
from kinetra.streaming import ingest


def _print_rows(df) -> None:
    """The whole answer as JSON lines, fetched partition by partition."""
    for row in df.toLocalIterator():
        print(json.dumps(row.asDict(True), default=str))


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="kinetra")
    ap.add_argument("--master", default="local[*]")
    ap.add_argument("--shuffle-partitions", type=int, default=200)
    sub = ap.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("ingest")
    a.add_argument("source")
    a.add_argument("raw_root")
    a.add_argument("--glob")
    a.add_argument("--mode", choices=["strict", "file", "permissive"], default="strict")
    s = sub.add_parser("stream")
    s.add_argument("source")
    s.add_argument("raw_root")
    s.add_argument("checkpoint")
    s.add_argument("--glob")
    s.add_argument("--refresh-fact", action="store_true")
    s.add_argument("--max-files-per-trigger", type=int,
                   help="bound each micro-batch when a backlog of files is waiting")
    t = sub.add_parser("transform")
    t.add_argument("raw_root")
    t.add_argument("out_root")
    t.add_argument("--run-id", default=dt.datetime.now().strftime("run-%Y%m%dT%H%M%S"))
    t.add_argument("--new-rows", choices=["cutoff", "keys"], default="cutoff")
    q = sub.add_parser("sql")
    q.add_argument("raw_root")
    q.add_argument("statement")
    q.add_argument("--out", help="write the answer as Parquet to this folder instead of printing it")
    args = ap.parse_args(argv)

    spark = build_session(args.master, args.shuffle_partitions, app_name=f"kinetra-{args.cmd}")
    if args.cmd == "ingest":
        c = load.load_batch(ragged.read_ragged(spark, args.source, args.glob), args.raw_root,
                            mode=args.mode)
        print(json.dumps(c.__dict__))
    elif args.cmd == "stream":
        ingest.run_ragged_ingest(spark, args.source, args.raw_root, args.checkpoint,
                                 glob=args.glob, refresh_fact=args.refresh_fact,
                                 max_files_per_trigger=args.max_files_per_trigger)
    elif args.cmd == "transform":
        _, res = run_transform(spark, args.raw_root, args.out_root, args.run_id,
                               new_rows=args.new_rows)
        _print_rows(res.select("model", "column_name", "test_name", "failures", "status"))
    elif args.cmd == "sql":
        w = Warehouse(load.read_raw(spark, args.raw_root, "tracks"),
                      load.read_raw(spark, args.raw_root, "trajectory_points"))
        w.register_views(spark)
        sql_functions.register(spark)
        answer = spark.sql(args.statement)
        if args.out:
            answer.write.parquet(args.out)
        else:
            _print_rows(answer)
    spark.stop()


if __name__ == "__main__":
    main()
