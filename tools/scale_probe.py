"""Wall time of the scale-path operators as the input doubles.

Synthetic rows from a Spark range (a third of them on one value and one
entity), written to Parquet first so every timing includes a real scan.
Prints one JSON object {operator: {rows: seconds}}.
Usage: python tools/scale_probe.py <scratch_dir> [rows ...]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    from pyspark.sql import functions as F

    from cohortlens.operators import groups, joins, nested, ranking
    from cohortlens.session import build_session

    scratch = sys.argv[1]
    sizes = [int(x) for x in sys.argv[2:]] or [1_000_000, 2_000_000, 4_000_000]
    spark = build_session(master="local[8]", shuffle_partitions=8, extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt")})
    ops = {
        "rank_rows": lambda d: ranking.rank_rows(d, [("v", False)], out="r"),
        "ntile_rows": lambda d: ranking.ntile_rows(d, 4, [("v", True), ("k", True)], out="q"),
        "profile_exact": lambda d: groups.profile(d, "g", "v"),
        "collect_sorted": lambda d: nested.collect_sorted(d, "e", ["k", "v"], ["k"], per_part=50_000),
        "outer_join": lambda d: joins.outer_join(d.select("e").distinct(), d.select("e", "k"), "e"),
        "count_distinct": lambda d: groups.count_by(d, "g", distinct="k"),
    }
    out: dict[str, dict[int, float]] = {k: {} for k in ops}
    for n in sizes:
        path = os.path.join(scratch, f"data_{n}")
        spark.range(n).select(
            F.col("id").alias("k"),
            F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise((F.col("id") * 7919 % 1000003).cast("double")).alias("v"),
            F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 100000 + 2).alias("e"),
            (F.col("id") % 7).alias("g"),
        ).write.mode("overwrite").parquet(path)
        data = spark.read.parquet(path)
        for name, op in ops.items():
            op(data).write.format("noop").mode("overwrite").save()  # warm-up
            t0 = time.perf_counter()
            op(data).write.format("noop").mode("overwrite").save()
            out[name][n] = round(time.perf_counter() - t0, 2)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
