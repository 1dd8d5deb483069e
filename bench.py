"""Benchmark: run every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

``duckdb`` holds the seconds that DuckDB takes for the same queries' statements
on the same host in the same minutes (sum and per query), so that a slow host
can be told from a slow query.

Each query is built and fully materialised (``write.format('noop')``, which
runs the whole plan without collecting to the driver) once to warm up and
then timed over a few runs; the median per query is reported.
"""

from __future__ import annotations

import importlib.util
import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cohortlens.session import build_session  # noqa: E402
from cohortlens.plans.catalog import REGISTRY, build  # noqa: E402


def duckdb_seconds(sf_dir: str, keys: list[str]) -> dict[str, float]:
    """Seconds per oracle statement, fetched in full; empty without DuckDB."""
    if importlib.util.find_spec("duckdb") is None:
        return {}
    import duckdb

    con = duckdb.connect()
    for name in sorted(os.listdir(sf_dir)):
        if name.endswith(".parquet"):
            path = os.path.join(sf_dir, name)
            files = os.path.join(path, "*.parquet") if os.path.isdir(path) else path
            con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{files}')")
    out = {}
    for k in keys:
        if REGISTRY[k].sql:
            t0 = time.perf_counter()
            con.execute(REGISTRY[k].sql).fetchall()
            out[k] = round(time.perf_counter() - t0, 4)
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = max(1, int(os.environ.get("BENCH_RUNS", "3")))
    only = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k]
    spark = build_session(master=f"local[{cpus}]", app="cohortlens-bench", shuffle_partitions=int(cpus),
                          extra={"spark.driver.memory": "16g"})
    keys = only or list(REGISTRY)
    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    for k in keys:
        samples = []
        try:
            for i in range(runs + 1):
                t0 = time.perf_counter()
                build(spark, k, sf_dir).write.format("noop").mode("overwrite").save()
                el = time.perf_counter() - t0
                if i > 0:  # first run warms the JVM and the file cache
                    samples.append(el)
        except Exception as exc:  # report the failure, keep timing the rest
            failed[k] = f"{type(exc).__name__}: {str(exc)[:200]}"
            continue
        times[k] = round(statistics.median(samples), 4)
    duck = duckdb_seconds(sf_dir, list(times))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    result = {
        "metric": "total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }
    if duck:
        result["duckdb"] = {"value": round(sum(duck.values()), 3), "queries": duck}
    if failed:
        result["failed"] = failed
    print(json.dumps(result))


if __name__ == "__main__":
    main()
