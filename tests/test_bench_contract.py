"""bench.py prints exactly one JSON line in the driver's format."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_RUNS="1", BENCH_CPUS="4",
               BENCH_QUERIES="moving_avg_monthly,rank_desc,records_per_entity")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], capture_output=True, text=True,
                         env=env, timeout=600, check=True).stdout
    lines = [ln for ln in out.splitlines() if ln.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["metric"] and d["sf"] == 0.001
    assert set(d["queries"]) == {"moving_avg_monthly", "rank_desc", "records_per_entity"}
    assert abs(d["value"] - sum(d["queries"].values())) < 0.01


def test_entry_contract_shapes():
    sys.path.insert(0, ROOT)
    import __spark_entry__ as entry

    q, s = entry.queries(), entry.oracle_sql()
    assert len(q) >= 90 and set(s) <= set(q)
    assert all(callable(f) for f in q.values()) and all(isinstance(v, str) and v for v in s.values())


def test_every_key_names_the_questions_it_restates():
    sys.path.insert(0, ROOT)
    from cohortlens.plans.catalog import REGISTRY, RESTATES
    from cohortlens.plans.clinical import QUESTIONS

    assert set(RESTATES) == set(REGISTRY)
    numbers = {q.number for q in QUESTIONS.values()}
    assert all(tok in numbers for v in RESTATES.values() for tok in v.split())
