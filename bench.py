"""Time the headline queries: prints one JSON line.

Each query is built, planned and run to the end (all rows produced, nothing collected). Every query runs
once untimed on the smallest tables to warm the JVM, then BENCH_REPEATS times; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from gapwright.session import local_session  # noqa: E402
from gapwright.suite.queries import QUERIES  # noqa: E402

HEADLINE = [
    "sheet_clean",
    "sheet_summary",
    "concat_ordered",
    "wmean_distinct",
    "grain_resolve",
    "run_import",
    "chain_context",
    "fill_records",
    "compile_units",
    "rollup_units",
    "calibrate_batch",
    "complete_records",
]


def run(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = local_session(cpus)
    small = Path(sf_dir).parent / "sf0.001"
    if small.is_dir() and str(small) != sf_dir:
        for name in names:
            run(spark, str(small), name)
    times = {name: round(statistics.median(run(spark, sf_dir, name) for _ in range(repeats)), 3) for name in names}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
