"""Benchmark: every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
The raw rows are landed once ("land_raw_profiles", the reference's extract),
cleaned once ("clean_once", the one cleaned frame its builders share) and
the keyed relations built once ("etl_build_relations", its transform +
load); the other queries then read them, as the reference's
views read loaded tables. Each query is run to completion with the `noop`
sink, so the whole result is computed but nothing is pulled to the driver.
An untimed warm-up pass over sf0.001 runs first (BENCH_WARMUP=0 disables).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from rosterlens.plans import registry
    from rosterlens.session import build_session

    spark = build_session(f"local[{cpus}]", partitions=cpus)
    timings: dict[str, float] = {}
    names = only or list(registry.QUERIES)

    # Warm run: one untimed pass over the smallest fixture compiles the
    # generated code and warms the JIT, so the timed pass measures the work
    # at the bench scale rather than one-off start-up costs.
    warm_dir = os.path.join(os.path.dirname(os.path.abspath(sf_dir)), "sf0.001")
    warmed = os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir)
    if warmed and os.environ.get("BENCH_WARMUP", "1") == "1":
        for name in names:
            registry.QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    else:
        warmed = False

    t0 = time.perf_counter()
    registry.raw(spark, sf_dir)
    timings["land_raw_profiles"] = round(time.perf_counter() - t0, 3)

    t0 = time.perf_counter()
    registry.cleaned(spark, sf_dir)
    timings["clean_once"] = round(time.perf_counter() - t0, 3)

    t0 = time.perf_counter()
    registry.relations(spark, sf_dir)
    timings["etl_build_relations"] = round(time.perf_counter() - t0, 3)

    for name in names:
        t = time.perf_counter()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t, 3)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    total = round(sum(timings.values()), 3)
    print(json.dumps({
        "metric": "total_query_time",
        "value": total,
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
        "run": "warm (untimed pass over sf0.001 first)" if warmed else "cold",
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
