"""Benchmark of the headline queries.

Runs each query on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1), executes it fully with a no-op sink (nothing is
collected to the driver), and prints one JSON line.  Loads are never reused
between runs: every run of a load query loads a fresh warehouse.

    python bench.py [--repeat 3] [query ...]
"""

from __future__ import annotations

import argparse
import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "star_load",
    "star_load_two_batches",
    "stream_ingest",
    "quarantine_reasons",
    "parse_items",
    "flat_frame",
    "flat_tables_orders",
    "group_numbers",
    "quality_duplicates",
    "range_join",
    "range_contains",
    "hstore_decode",
    "composite_decode",
    "json_array_explode",
    "offset_to_utc",
]


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--repeat", type=int, default=int(os.environ.get("BENCH_REPEAT", "3")))
    ap.add_argument("queries", nargs="*")
    args = ap.parse_args()

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from tillstar import catalog
    from tillstar.session import get_session

    spark = get_session(f"local[{cpus}]", int(cpus), driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
    spark.sparkContext.setLogLevel("ERROR")
    names = args.queries or HEADLINE

    def run(name: str) -> float:
        catalog._LOADED.clear()
        catalog._FLAT.clear()
        t0 = time.perf_counter()
        df = catalog.QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    # JVM / codegen warm-up on the smallest scale, not reported.
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    for name in ("parse_items", "star_load"):
        catalog._LOADED.clear()
        catalog.QUERIES[name](spark, warm_dir if os.path.isdir(warm_dir) else sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        samples = [run(name) for _ in range(max(1, args.repeat))]
        times[name] = round(statistics.median(samples), 3)
        print(f"{name}: {times[name]}s {[round(s, 2) for s in samples]}", file=sys.stderr)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": int(cpus),
        "repeat": args.repeat,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
