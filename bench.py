"""Benchmark: every registered query at one scale factor, one JSON line on stdout.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed completely with the ``noop`` sink (all rows produced,
nothing collected to the driver).  The four reports run once untimed first so
JIT warm-up is not charged to the first query; each time is the median of
``BENCH_REPEATS`` (default 5) runs. ``BENCH_BROADCAST=-1`` switches Spark's own
broadcasts off (shuffle joins only).  ``value`` is the sum of the per-query
wall times in seconds; ``reports_sec`` is the sum for the four
reports alone; ``run_month_sec`` is the one-pass monthly run (both templates,
both programs, August 1996) -- what a production run executes.
"""

from __future__ import annotations

import json
import os
import sys
import statistics
import time
from concurrent.futures import ThreadPoolExecutor

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

REPORTS = ("open_ffs", "open_cco", "denied_ffs", "denied_cco")


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k]

    from remitview import catalog
    from remitview.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="remitview-bench")
    if "BENCH_BROADCAST" in os.environ:
        for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.set(k, os.environ["BENCH_BROADCAST"])
    for k in REPORTS:
        run(catalog.QUERIES[k](spark, sf_dir))

    repeats = int(os.environ.get("BENCH_REPEATS", "5"))
    times = {}
    for k, q in catalog.QUERIES.items():
        if only and k not in only:
            continue
        taken = []
        for _ in range(repeats):
            t0 = time.perf_counter()
            run(q(spark, sf_dir))  # plan construction is part of the time
            taken.append(time.perf_counter() - t0)
        times[k] = round(statistics.median(taken), 3)

    # The monthly run computes each template once for both programs.
    from remitview.plans.run import BUILDERS, window_inputs
    from remitview.sources import standins

    taken = []
    for _ in range(repeats):
        t0 = time.perf_counter()
        tables = {**standins.open_tables(spark, sf_dir), **standins.denied_tables(spark, sf_dir)}
        with window_inputs(tables, catalog.MONTH_LO, catalog.MONTH_HI) as month:

            def one(template, month=month):  # as run_month: build and write per thread
                run(BUILDERS[template](month, catalog.MONTH_LO, catalog.MONTH_HI, catalog.CFG))

            with ThreadPoolExecutor(max_workers=len(BUILDERS)) as pool:
                for f in [pool.submit(one, t) for t in BUILDERS]:
                    f.result()
        taken.append(time.perf_counter() - t0)
    run_month_sec = round(statistics.median(taken), 3)

    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    out = {
        "metric": "sum_query_wall_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "reports_sec": round(sum(times.get(k, 0.0) for k in REPORTS), 3),
        "run_month_sec": run_month_sec,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "config": {
            "master": f"local[{cpus}]",
            "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
            "aqe": spark.conf.get("spark.sql.adaptive.enabled"),
            "spark": spark.version,
        },
    }
    print(json.dumps(out), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
