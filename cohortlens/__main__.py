"""Run one registered query: ``python -m cohortlens <key> [sf_dir] [--rows N] [--explain] [--list]``."""

from __future__ import annotations

import argparse

from cohortlens.plans.catalog import REGISTRY, RESTATES, build
from cohortlens.session import build_session


def main() -> None:
    ap = argparse.ArgumentParser(prog="cohortlens")
    ap.add_argument("key", nargs="?")
    ap.add_argument("sf_dir", nargs="?", default="/root/testdata/sf0.01")
    ap.add_argument("--rows", type=int, default=20)
    ap.add_argument("--explain", action="store_true", help="print the formatted physical plan")
    ap.add_argument("--sql", action="store_true", help="print the oracle SQL")
    ap.add_argument("--list", action="store_true", help="list the query keys")
    a = ap.parse_args()
    if a.list or not a.key:
        for k, q in REGISTRY.items():
            print(f"{k:24s} {RESTATES.get(k, ''):14s} {q.ops}")
        return
    if a.sql:
        print(REGISTRY[a.key].sql or "(no SQL oracle: rows-only check)")
    spark = build_session(master="local[8]", shuffle_partitions=8)
    df = build(spark, a.key, a.sf_dir)
    if a.explain:
        df.explain("formatted")
    df.show(a.rows, truncate=False)


if __name__ == "__main__":
    main()
