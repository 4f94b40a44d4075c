"""Benchmark: wall time per headline query key.

Runs each key of ``HEADLINE`` on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` and prints ONE JSON line.
Each query is forced completely with the ``noop`` sink (full computation,
nothing collected to the driver).  The ragged files are written once before
timing (fixture setup, reported separately as ``setup_sec``).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kinetra.plans.registry import QUERIES  # noqa: E402
from kinetra.session import build_session  # noqa: E402
from kinetra.sources import testdata  # noqa: E402

HEADLINE = [
    "ragged_unnest",
    "load_points_idempotent",
    "track_deltas",
    "track_kinematics",
    "dim_track",
    "fct_points",
    "agg_speed_by_type",
    "agg_speed_approx",
    "speed_box_by_type",
    "density_grid",
    "speed_histogram",
    "longest_tracks",
    "incremental_new_rows",
    "incremental_new_rows_by_key",
    "fact_merge",
    "fact_schema_sync",
    "dq_report",
    "stream_ragged_load",
    "stream_fact_refresh",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    keys = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus),
                          extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "16g")})
    t0 = time.time()
    testdata.write_ragged_fixture(spark, sf_dir)
    setup = time.time() - t0
    times: dict[str, float] = {}
    for k in keys:
        t = time.time()
        QUERIES[k](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[k] = round(time.time() - t, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "total_wall_time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": sf, "cpus": cpus, "setup_sec": round(setup, 3),
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
