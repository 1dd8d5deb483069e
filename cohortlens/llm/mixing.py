"""Mixing overlapping sources to target weights by min-cost flow (operator 4).

Documents are summed by membership pattern, the set of sources they belong
to.  In the flow network a pattern offers its words once at each of
``max_repeat`` rising costs, a source takes words from the patterns that hold
it, up to its target.  The cheapest fullest flow says how many words each
pattern gives; its documents are repeated whole that many times, and the rest
goes to the first documents in a seeded order.

Only sums per pattern and one cut per pattern meet on the driver, so what it
holds grows with the number of patterns, not documents.  The choice itself is
a function of the row, the plan and the seed.

Cases: null text has size 0; a null source is a source, last in order, as is
a null or empty array of sources; a source named twice in a row counts once; rows
that agree in order key (same id and size) are taken or left together; null
ids are drawn like the empty text; an empty table gives an empty mix.
"""

from __future__ import annotations

import json
from collections import deque
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from cohortlens.llm.common import n_words, ticket, written

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
SEED = 4
#: Rows of a pattern that share a range of the seeded order, about.
RANGE_ROWS = 2000


def source_order(names: set[str | None]) -> list[str | None]:
    """By code point, null last."""
    return sorted(names, key=lambda s: (s is None, s or ""))


def targets(sizes: dict[str | None, int], weights: dict[str | None, float], total: int, max_repeat: int = MAX_REPEAT) -> dict[str | None, float]:
    """Shares of ``total`` by weight, none above ``max_repeat`` times its
    source; what is cut off is shared again by weight among the others."""
    left, weight, out = total, sum(weights[s] for s in sizes), {}
    queue = sorted(sizes, key=lambda s: max_repeat * sizes[s] / weights[s])
    while queue and max_repeat * sizes[queue[0]] * weight <= left * weights[queue[0]]:
        s = queue.pop(0)
        out[s] = float(max_repeat * sizes[s])
        left, weight = left - max_repeat * sizes[s], weight - weights[s]
    return out | {s: left * weights[s] / weight for s in queue}


def route(capacity: dict[str, int], members: dict[str, list], demand: dict[str | None, int], max_repeat: int = MAX_REPEAT) -> dict[tuple, int]:
    """Words that each pattern gives to each source: the fullest flow of least
    cost when the k-th pass over a pattern costs more than the (k-1)-th.

    Successive shortest paths: a path's cost is that of the pass it starts
    with (the other arcs are free), so all paths of one pass are used up,
    shortest first, before the next pass opens.
    """
    flow = {(p, s): 0 for p in capacity for s in members[p] if s in demand}
    holders: dict = {}
    for p, s in flow:
        holders.setdefault(s, []).append(p)
    need = dict(demand)
    for _ in range(max_repeat):
        spare = dict(capacity)
        while True:
            parent: dict = {("p", p): None for p in capacity if spare[p] > 0}
            queue, end = deque(parent), None
            while queue and end is None:
                kind, x = queue.popleft()
                if kind == "p":
                    nexts = [("s", s) for s in members[x] if s in demand]
                else:
                    if need[x] > 0:
                        end = (kind, x)
                        break
                    nexts = [("p", p) for p in holders[x] if flow[p, x] > 0]
                for n in nexts:
                    if n not in parent:
                        parent[n] = (kind, x)
                        queue.append(n)
            if end is None:
                break
            path = [end]
            while parent[path[-1]] is not None:
                path.append(parent[path[-1]])
            path.reverse()
            amount = min([spare[path[0][1]], need[end[1]]] + [flow[path[i + 1][1], path[i][1]] for i in range(1, len(path) - 1, 2)])
            for i in range(0, len(path) - 1, 2):
                flow[path[i][1], path[i + 1][1]] += amount
            for i in range(1, len(path) - 1, 2):
                flow[path[i + 1][1], path[i][1]] -= amount
            spare[path[0][1]] -= amount
            need[end[1]] -= amount
    return flow


@dataclass
class Plan:
    """``passes`` and the cut per pattern; targets and sizes per source; the
    words that each pattern gives to each source."""

    rows: DataFrame
    target: dict[str | None, float]
    size: dict[str | None, int]
    flow: dict[tuple, int]

    def credits(self, spark: SparkSession) -> DataFrame:
        """Per pattern, its sources with their sizes, targets and shares of
        the pattern's words, as an array ``credit``."""
        held: dict[str, list] = {}
        for p, s in self.flow:
            held.setdefault(p, []).append(s)
        rows = []
        for p, names in held.items():
            total = sum(self.flow[p, s] for s in names)
            rows.append((p, [(s, int(self.size[s]), float(self.target[s]), self.flow[p, s] / total if total else 0.0) for s in names]))
        return spark.createDataFrame(rows, "pattern string, credit array<struct<source: string, source_size: long, target: double, share: double>>")


def pattern(members: Column) -> Column:
    """The sources of a row as one text."""
    return F.to_json(F.array_sort(F.array_distinct(members)))


def order_key(id_col: Column, size: Column, seed: int) -> Column:
    return F.struct(ticket(seed, id_col).alias("ticket"), id_col.cast("string").alias("id"), size.cast("long").alias("size"))


def make_plan(slim: DataFrame, weights: tuple[float, ...] | dict = WEIGHTS, total: int | None = None, max_repeat: int = MAX_REPEAT) -> Plan:
    """The plan for ``slim (pattern string, key struct)``, a written table."""
    spark = slim.sparkSession
    slim = slim.select("pattern", "key", F.col("key.size").alias("size"), F.col("key.ticket").alias("ticket"))
    sums = {r["pattern"]: r for r in slim.groupBy("pattern").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()}
    capacity = {p: int(r["size"]) for p, r in sums.items()}
    members = {p: json.loads(p) for p in sums}
    size: dict = {}
    for p, m in members.items():
        for s in m:
            size[s] = size.get(s, 0) + capacity[p]
    order = source_order(set(size))
    share = weights if isinstance(weights, dict) else {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total = sum(capacity.values()) if total is None else total
    target = targets(size, share, total, max_repeat)
    flow = route(capacity, members, {s: int(t) for s, t in target.items()}, max_repeat)

    given = {p: sum(flow.get((p, s), 0) for s in members[p]) for p in capacity}
    passes = {p: given[p] // capacity[p] if capacity[p] else 0 for p in capacity}
    rest = {p: given[p] - passes[p] * capacity[p] for p in capacity}
    most = max([r["n"] for r in sums.values()], default=0)
    shift = 52 - max(0, (most // RANGE_ROWS).bit_length())

    # the range of the seeded order in which each pattern's rest ends, then the row
    quota = spark.createDataFrame([(p, r) for p, r in rest.items() if r > 0], "pattern string, rest long")
    ranges = slim.withColumn("range", F.shiftright("ticket", shift)).groupBy("pattern", "range").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("pattern").orderBy("range")
    ranges = ranges.withColumn("before", F.sum("words").over(ahead) - F.col("words")).join(F.broadcast(quota), "pattern")
    last = ranges.where((F.col("before") < F.col("rest")) & (F.col("before") + F.col("words") >= F.col("rest")))
    inside = slim.withColumn("range", F.shiftright("ticket", shift)).join(F.broadcast(last.select("pattern", "range", "before", "rest")), ["pattern", "range"])
    inside = inside.groupBy("pattern", "range", "before", "rest", "key").agg(F.sum("size").alias("words"))
    upto = F.sum("words").over(Window.partitionBy("pattern", "range").orderBy("key")) + F.col("before")
    chosen = inside.withColumn("upto", upto).where(F.col("upto") - F.col("words") / 2 <= F.col("rest"))
    cuts = {r["pattern"]: r["cut"] for r in chosen.groupBy("pattern").agg(F.max("key").alias("cut")).collect()}
    starts = {r["pattern"]: (r["range"] << shift) - 1 for r in last.select("pattern", "range").collect()}

    def cut(p: str) -> tuple:
        if p in cuts:
            return tuple(cuts[p])
        return (starts[p], None, -1) if p in starts else (-1, None, -1)

    rows = [(p, int(passes[p]), cut(p)) for p in capacity]
    plan = spark.createDataFrame(rows, "pattern string, passes long, cut struct<ticket: long, id: string, size: long>")
    return Plan(plan, target, size, flow)


def copies(passes: Column, key: Column, cut: Column) -> Column:
    """How often a row is taken under the plan."""
    return passes + F.when(key <= cut, 1).otherwise(0)


def memberships(documents: DataFrame, sources: str | list[str]) -> Column:
    """The sources of a row as an array: an array column's entries, a plain
    column's value, or the values of several columns, whose nulls name none.
    A row without any (a null or empty array, all columns null) belongs to the
    null source."""
    if not isinstance(sources, str):
        named = F.filter(F.array(*[F.col(c).cast("string") for c in sources]), lambda s: s.isNotNull())
    elif isinstance(documents.schema[sources].dataType, ArrayType):
        named = F.coalesce(F.col(sources).cast("array<string>"), F.array().cast("array<string>"))
    else:
        return F.array(F.col(sources).cast("string"))
    return F.when(F.size(named) == 0, F.array(F.lit(None).cast("string"))).otherwise(named)


def mix(documents: DataFrame, weights: tuple[float, ...] | dict = WEIGHTS, max_repeat: int = MAX_REPEAT, seed: int = SEED, sources: str | list[str] = "source") -> DataFrame:
    """One row per row of ``documents (doc_id, text, source)``: ``size``,
    ``source_size``, ``target`` (its source's) and ``taken`` words.

    Where ``sources`` is an array column or a list of columns, a document may
    belong to several sources; ``given`` then stands for the source's columns:
    an array of its sources, each with ``source_size``, ``target`` and the part
    of the row's taken words that the flow counts for that source."""
    spark = documents.sparkSession
    one = isinstance(sources, str) and not isinstance(documents.schema[sources].dataType, ArrayType)
    members = memberships(documents, sources)
    slim = documents.select("doc_id", n_words(F.col("text")).alias("size"), members.alias("members"))
    slim = written(slim.select("doc_id", "size", F.col("members")[0].alias("source"), pattern(F.col("members")).alias("pattern"), order_key(F.col("doc_id"), F.col("size"), seed).alias("key")), "sizes")
    plan = make_plan(slim, weights, max_repeat=max_repeat)
    taken = (F.col("size") * copies(F.col("passes"), F.col("key"), F.col("cut"))).alias("taken")
    out = slim.join(F.broadcast(plan.rows), "pattern")
    if one:
        facts = spark.createDataFrame([(s, int(plan.size[s]), float(plan.target[s])) for s in plan.size], "s string, source_size long, target double")
        out = out.join(F.broadcast(facts), F.col("source").eqNullSafe(F.col("s")))
        return out.select("doc_id", "size", "source_size", "target", taken)
    credit = plan.credits(spark)
    out = out.select("doc_id", "size", "pattern", taken).join(F.broadcast(credit), "pattern")
    given = F.transform("credit", lambda c: F.struct(c["source"].alias("source"), c["source_size"].alias("source_size"), c["target"].alias("target"), (c["share"] * F.col("taken")).alias("taken")))
    return out.select("doc_id", "size", "taken", given.alias("given"))


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str | list[str] = "source", weights: tuple[float, ...] | dict = WEIGHTS, max_repeat: int = MAX_REPEAT, seed: int = SEED) -> DataFrame:
    """The mixed documents themselves, with the columns of ``docs``: a row for
    each time it is taken.  ``source_col`` as ``sources`` of ``mix``."""
    own = docs.columns
    names = {c: f"d{i}" for i, c in enumerate(own)}
    named = docs.toDF(*names.values())
    sources = names[source_col] if isinstance(source_col, str) else [names[c] for c in source_col]
    keyed = named.withColumns({
        "pattern": pattern(memberships(named, sources)),
        "key": order_key(F.col(names[id_col]), n_words(F.col(names[text_col])), seed),
    })
    plan = make_plan(written(keyed.select("pattern", "key"), "sizes"), weights, max_repeat=max_repeat)
    taken = keyed.join(F.broadcast(plan.rows), "pattern").withColumn("times", copies(F.col("passes"), F.col("key"), F.col("cut")).cast("int"))
    repeated = taken.where("times > 0").withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return repeated.select(*names.values()).toDF(*own)


#: The query in DuckDB: water-filled targets, then the seeded order per source.
SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         ('0x' || substr(md5('4:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13))::BIGINT AS ticket
  FROM documents),
s AS (SELECT source, SUM(size)::BIGINT AS c, [5, 2, 1][(ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM d GROUP BY source),
o AS (SELECT *, ROW_NUMBER() OVER (ORDER BY 3 * c / w, source NULLS LAST) AS i FROM s),
f AS (SELECT *, (SELECT SUM(c) FROM s)::BIGINT - coalesce(SUM(3 * c) OVER p, 0)::BIGINT AS l,
             (SELECT SUM(w) FROM s)::BIGINT - coalesce(SUM(w) OVER p, 0)::BIGINT AS r
      FROM o WINDOW p AS (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
k AS (SELECT i, l, r FROM f WHERE NOT (3 * c * r <= l * w) ORDER BY i LIMIT 1),
t AS (SELECT f.source, f.c, CASE WHEN k.i IS NULL OR f.i < k.i THEN CAST(3 * f.c AS DOUBLE) ELSE CAST(k.l * f.w AS DOUBLE) / k.r END AS target
      FROM f LEFT JOIN k ON TRUE),
q AS (SELECT *, CASE WHEN c = 0 THEN 0 ELSE CAST(floor(target) AS BIGINT) // c END AS passes FROM t),
x AS (SELECT d.*, q.c, q.target, q.passes, CAST(floor(q.target) AS BIGINT) - q.passes * q.c AS rest,
             SUM(d.size) OVER (PARTITION BY d.source ORDER BY d.ticket, CAST(d.doc_id AS VARCHAR) NULLS FIRST, d.size) AS upto,
             SUM(d.size) OVER (PARTITION BY d.source, d.ticket, d.doc_id, d.size) AS own
      FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, CAST(c AS BIGINT) AS source_size, target,
       CAST(size * (passes + CASE WHEN rest > 0 AND upto - own / 2 <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM x
"""
