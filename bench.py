"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local cores.  Each query runs once
to warm up and then ``BENCH_RUNS`` times (default 3); the median counts.  Arguments pick queries by name.  The jobs with
their writes are timed beside the queries, as ``job_...``; they read what the warm-up of ``bronze_to_silver`` wrote.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pluvia.parity import QUERIES  # noqa: E402
from pluvia.parity.jobs import JOBS  # noqa: E402
from pluvia.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def seconds(spark, name: str) -> float:
    start = time.perf_counter()
    if name in JOBS:
        JOBS[name](spark, SF_DIR)
    else:
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    only = sys.argv[1:] or [*QUERIES, *JOBS]
    spark = build_session(
        "pluvia-bench",
        master=f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="pluvia-bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in only:
        seconds(spark, name)
        timings[name] = round(statistics.median(seconds(spark, name) for _ in range(RUNS)), 4)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_warm_median",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
