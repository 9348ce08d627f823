"""Time every registered query and print one JSON line.

Reads the tables at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]. Each
query is run once to its last row (no-op sink). The landed inputs are written before the clock
starts and are reported on their own.
"""

from __future__ import annotations

import json
import os
import sys
import time

from meterloom.session import local_session
from meterloom.workload import shapes
from meterloom.workload.queries import QUERIES


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def main(only: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = local_session(cores, shuffle_partitions=int(cores) if cores.isdigit() else 8, app="bench")
    landing = {
        "documents": timed(lambda: shapes.documents(spark, sf_dir)),
        "wide": timed(lambda: shapes.wide(spark, sf_dir)),
    }
    seconds: dict[str, float] = {}
    for name, query in QUERIES.items():
        if only and name not in only:
            continue
        seconds[name] = timed(lambda: query(spark, sf_dir).write.format("noop").mode("overwrite").save())
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total seconds over all queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "landing": landing,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cores,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
