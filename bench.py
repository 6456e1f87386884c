"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Runs each query once to warm up, then ``BENCH_RUNS`` times (default 3), forcing full
execution with the ``noop`` sink, and prints one JSON line with the median seconds per query
and their sum.

The given tables are single files of one row group, which Spark can only read in one task. Before
any clock runs, the larger ones are landed once as folders of as many files as two rounds of the
cores need, as a load job leaves them; every query reads these.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from delaylens.plans.catalog import load_all  # noqa: E402
from delaylens.session import build_session, scratch_path  # noqa: E402

HEADLINE = [
    "station_delay",            # flagship: validate -> latest per key -> lag -> fact -> mart
    "fact_station_arrival",
    "train_punctuality",
    "network_overview",
    "delay_distribution",
    "station_hotspots",
    "daily_trend",
    "route_sequence_lookup",
    "load_counters",
    "dq_report",
    "baseline_evaluate",
    "chronological_split",
    "expanding_history",
    "stream_fact_upsert",
]


#: Tables that the headline queries read, by size.
LANDED, COPIED = ["lineitem", "orders"], ["region", "nation", "customer", "supplier", "part", "events"]


def landed(spark, sf_dir: str, files: int) -> str:
    """A folder with the same tables: the large ones in ``files`` files each."""
    out = scratch_path(spark, "bench-tables")
    for name in LANDED + COPIED:
        df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        (df.repartition(files) if name in LANDED else df).write.parquet(f"{out}/{name}.parquet")
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2), app_name="delaylens-bench")
    registry = load_all()
    tables_dir = landed(spark, sf_dir, 2 * cpus)
    results: dict[str, float] = {}
    for name in names:
        build = registry[name].build
        times = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            build(spark, tables_dir).write.format("noop").mode("overwrite").save()
            if i > 0:
                times.append(time.perf_counter() - t0)
        results[name] = round(statistics.median(times), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(results.values()), 3),
                      "unit": "sec", "queries": results, "sf": sf, "cpus": cpus, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
