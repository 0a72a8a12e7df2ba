"""Time the registered queries; prints one JSON line.

BENCH_SF_DIR names the folder with the tables, BENCH_CPUS the number of cores.
Each query is run once, its whole result is computed and thrown away.
"""

from __future__ import annotations

import json
import os
import sys
import time

from sluice.registry import QUERIES
from sluice.session import build_session


def scale(folder: str) -> float | str:
    """The scale factor in a folder name such as ``sf0.1``, else the name."""
    name = os.path.basename(folder.rstrip("/"))
    try:
        return float(name.removeprefix("sf"))
    except ValueError:
        return name


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or list(QUERIES)
    # Start the JVM's workers and load its classes before anything is timed.
    QUERIES["content_performance"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": scale(folder),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
