"""Measure how evenly the skew-sensitive operators spread rows over tasks.

Runs in its own Spark application with the event log written to a scratch
folder, on synthetic data derived from a Spark range where one value (and
one entity) holds a third of all rows.  Partition-size settings are scaled
down by the same factor as the data so the task layout resembles a cluster
run.  For every probe it reports, per stage that reads at least half of
the input volume, the largest share of the stage's records read by a
single task.  Usage: python tools/skew_probe.py <scratch_dir> [rows]
Prints one JSON object: {probe: max_task_share}.
"""

from __future__ import annotations

import glob
import json
import os
import sys
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def run(scratch: str, rows: int) -> dict:
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from cohortlens.operators import groups, joins, nested, ranking
    from cohortlens.session import build_session

    logs = os.path.join(scratch, "events")
    os.makedirs(logs, exist_ok=True)
    spark = build_session(master="local[8]", shuffle_partitions=32, extra={
        "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": logs,
        "spark.eventLog.compress": "false",
        "spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
        # data here is ~1/10^6 of a cluster run: scale the partition targets alike
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    })
    base = spark.range(rows).select(
        F.col("id").alias("k"),
        # value 7.0 and entity 1 each hold a third of the rows
        F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise((F.col("id") * 7919 % 100003).cast("double")).alias("v"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 50000 + 2).alias("e"),
        (F.col("id") % 7).alias("g"),
    )
    data = base.write.mode("overwrite").parquet(os.path.join(scratch, "data")) or spark.read.parquet(
        os.path.join(scratch, "data"))
    dims = spark.range(0, 50002).select(F.col("id").alias("e"), (F.col("id") % 13).alias("attr"))

    probes = {
        "naive_global_rank_window": lambda: data.withColumn("r", F.rank().over(Window.orderBy("v"))),
        "rank_rows_scalable": lambda: ranking.rank_rows(data, [("v", False)], out="r"),
        "cume_dist_scalable": lambda: ranking.cume_dist_rows(data, [("v", True)], out="c"),
        "profile_exact_hot_group": lambda: groups.profile(data.withColumn("hg", F.when(F.col("e") == 1, 0)
                                                                            .otherwise(F.col("g"))), "hg", "v"),
        "nested_parts_hot_entity": lambda: nested.collect_sorted(data, "e", ["k", "v"], ["k"], per_part=20000),
        "outer_join_hot_key": lambda: joins.outer_join(dims, data.select("e", "k"), "e"),
        "count_distinct_hot_group": lambda: groups.count_by(data.withColumn("hg", F.when(F.col("e") == 1, 0)
                                                                            .otherwise(F.col("g"))), "hg", distinct="k"),
        "first_value_hot_group": lambda: ranking.first_value_by(data, ["e"], "k", [("v", False), ("k", True)]),
        "top_k_ties_hot_top": lambda: ranking.top_k_with_ties(data.withColumn("v", F.when(F.col("v") == 7.0, 1e9)
                                                                                .otherwise(F.col("v"))), "v", 5),
    }
    for name, build in probes.items():
        spark.sparkContext.setJobGroup(name, name)
        build().write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobGroup("done", "done")
    spark.stop()
    return shares(logs, rows, list(probes))


def shares(logs: str, rows: int, names: list[str]) -> dict:
    stage_group: dict[int, str] = {}
    per_stage: dict[int, list[int]] = defaultdict(list)
    for path in sorted(glob.glob(os.path.join(logs, "**", "*"), recursive=True)):
        if os.path.isdir(path) or os.path.basename(path).startswith("appstatus"):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    grp = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = grp
                elif kind == "SparkListenerTaskEnd":
                    m = ev.get("Task Metrics") or {}
                    n = (m.get("Input Metrics") or {}).get("Records Read", 0) + (
                        m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    per_stage[ev["Stage ID"]].append(n)
    out = {}
    for name in names:
        worst = 0.0
        for sid, counts in per_stage.items():
            total = sum(counts)
            if stage_group.get(sid) == name and total >= rows / 2:
                worst = max(worst, max(counts) / total)
        out[name] = round(worst, 4)
    return out


if __name__ == "__main__":
    scratch = sys.argv[1]
    n = int(sys.argv[2]) if len(sys.argv) > 2 else 1_200_000
    print(json.dumps(run(scratch, n)))
