"""Times the load and every query; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default
8), BENCH_REPEATS (default 1, the median is reported).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import time

from haulmart.bound import bound
from haulmart.contracts import DIMENSIONS, FACTS, STAGING
from haulmart.queries import QUERIES
from haulmart.session import local_session


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def read_fully(df) -> None:
    """Compute every row and column without bringing them to the driver."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    spark = local_session(cpus)
    tables = bound(spark, sf_dir)

    seconds: dict[str, float] = {}
    for step, contracts in (("staging", STAGING), ("dimensions", DIMENSIONS), ("facts", FACTS)):
        names = [c.name for c in contracts]
        seconds[f"load_{step}"] = timed(lambda names=names: tables.layers.load(names))
    seconds["export_feeds_as_csv"] = timed(lambda: [tables.csv_path(c.name) for c in STAGING])
    seconds["load_from_csv_with_gates"] = timed(tables.load)
    for key, query in QUERIES.items():
        runs = [timed(lambda q=query: read_fully(q(spark, sf_dir))) for _ in range(repeats)]
        seconds[key] = round(statistics.median(runs), 3)

    factor = re.search(r"sf([\d.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "load and query wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(factor.group(1)) if factor else None,
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
