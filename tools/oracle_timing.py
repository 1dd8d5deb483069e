"""Time the oracle SQL of every registered query on DuckDB (single node,
same Parquet files) as a point of comparison for bench.py.  Prints one
JSON line like bench.py."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cohortlens.plans.catalog import REGISTRY  # noqa: E402
from compare import duck_connection  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    con = duck_connection(sf_dir)
    con.execute(f"SET threads = {os.environ.get('BENCH_CPUS', '8')}")
    out = {}
    for k, q in REGISTRY.items():
        if not q.sql:
            continue
        samples = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            con.execute(q.sql).fetchall()
            if i:
                samples.append(time.perf_counter() - t0)
        out[k] = round(statistics.median(samples), 4)
    print(json.dumps({"metric": "total_sec", "value": round(sum(out.values()), 3), "unit": "sec", "queries": out,
                      "engine": "duckdb"}))


if __name__ == "__main__":
    main()
