"""Wall seconds of every registered query, each run to the end without collecting rows.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line.  Each query runs twice; the second time is reported.  Names given as arguments
are run instead of all; ``jobs`` stands for the jobs over stored loads, which are not among all.
"""

import contextlib
import json
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from pyspark.sql import SparkSession  # noqa: E402

import registry.jobs  # noqa: E402, F401  adds its queries
from registry.queries import QUERIES  # noqa: E402


def run(make, spark, sf_dir: str) -> float:
    began = time.perf_counter()
    make(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    jobs = [name for name in QUERIES if name.startswith("jobs_")]
    wanted = [n for name in sys.argv[1:] for n in (jobs if name == "jobs" else [name])] or [n for n in QUERIES if n not in jobs]
    seconds = {}
    for name in wanted:
        run(QUERIES[name], spark, sf_dir)
        seconds[name] = round(run(QUERIES[name], spark, sf_dir), 3)
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    with contextlib.suppress(ValueError):
        sf = float(sf)
    line = {
        "metric": "total wall time of all registered queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf,
    }
    print(json.dumps(line), flush=True)


if __name__ == "__main__":
    main()
