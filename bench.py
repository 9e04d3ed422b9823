"""Wall time of every registered query; prints one JSON line.

BENCH_SF_DIR names the folder of input tables, BENCH_CPUS the local cores, BENCH_QUERIES an
optional comma-separated choice, BENCH_SCRATCH the folder for intermediate tables.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

from marketlake.queries import REGISTRY, Tables
from marketlake.session import build_session


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(REGISTRY)
    # local master: driver and executors share this disk
    shared = os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="marketlake-bench-")
    spark = build_session(f"local[{cpus}]", "bench", **{"spark.checkpoint.dir": shared})
    tables = Tables(spark, folder)
    # throw-away queries, so that the first timings do not hold the start of the JVM
    for name in ("category_summary", "bars_weekly", "dedup_keep_last"):
        REGISTRY[name].run(tables).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in chosen:
        start = time.perf_counter()
        try:
            REGISTRY[name].run(tables).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
        except Exception as error:  # keep measuring the others; the line shows what failed
            failed[name] = str(error).splitlines()[0][:200]
        print(f"{name} {seconds.get(name, 'FAILED')}", file=sys.stderr, flush=True)
    scale = re.search(r"sf([0-9.]+)", folder)
    line = {
        "metric": "total wall time of the registered queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale.group(1)) if scale else None,
    }
    if failed:
        line["failed"] = failed
    print(json.dumps(line))


if __name__ == "__main__":
    main()
