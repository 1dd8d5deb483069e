"""Plan inspection helpers used by tests and when tuning: they read the
text of ``explain`` output only."""

from __future__ import annotations

import io
import re
from contextlib import redirect_stdout

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def check_plan(df: DataFrame) -> list[str]:
    """Problems in the physical plan: cartesian products, and nested-loop
    joins whose build side is not a one-row aggregate or a small fixed
    lookup."""
    txt = plan_text(df, "extended")
    problems = []
    if "CartesianProduct" in txt:
        problems.append("CartesianProduct")
    lines = txt.splitlines()
    for i, line in enumerate(lines):
        if "BroadcastNestedLoopJoin" in line:
            # allowed when the broadcast side is a global aggregate (one row)
            window = "\n".join(lines[i: i + 40])
            if "HashAggregate(keys=[]" not in window and "ObjectHashAggregate(keys=[]" not in window:
                problems.append(line.strip()[:200])
    return problems


_BOUNDED = ("HashAggregate", "ObjectHashAggregate", "SortAggregate", "TakeOrderedAndProject", "GlobalLimit",
            "CollectLimit", "_cl_pid")


def unbounded_single_partition(df: DataFrame) -> list[str]:
    """Single-partition exchanges fed by raw rows: for each ``Exchange
    SinglePartition`` in the physical plan, walk its subtree and report it
    when a scan is reached before any aggregate, limit or per-partition
    offset table (which bound the rows that reach the one task)."""
    txt = plan_text(df, "extended")
    lines = txt[txt.index("== Physical Plan =="):].splitlines()[1:]

    def depth(line: str) -> int:
        m = re.search(r"[+:]- |\*\(|[A-Z]", line)
        return m.start() if m else len(line)

    problems = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" not in line:
            continue
        d0 = depth(line)
        for child in lines[i + 1:]:
            if child.strip() and depth(child) <= d0:
                break
            if any(b in child for b in _BOUNDED):
                break
            if "FileScan" in child or "Scan ExistingRDD" in child or "LocalTableScan" in child:
                problems.append(line.strip()[:160])
                break
    return problems
