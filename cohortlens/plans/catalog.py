"""The question catalogue restated on the driver's tables.

Each entry pairs a Spark query built from cohortlens operators with an
independent SQL statement for DuckDB.  Column names match on both sides;
floating results are rounded on both sides (D4), integers are bigint (D12);
integer columns that can hold NULL (lag ends, outer-join misses, inherited
columns) are reported as double on both sides, so either engine's pandas
conversion gives the same dtype; calendar periods are midnight timestamps
(as PostgreSQL's ``date_trunc`` returns).

Role map: customer = patients (band ``c_mktsegment``, measure
``c_acctbal``), orders = admissions (date ``o_orderdate``, ward
``o_orderpriority``, outcome ``o_orderstatus``), lineitem + part =
prescriptions (drug ``p_name``), events = labs and responses.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.functions import dates as fd
from cohortlens.functions import mathops as fm
from cohortlens.functions import text as ft
from cohortlens.functions.random import stable_uniform, stable_uniform_sql
from cohortlens.functions.sql import register_sql_functions, share_of_total_sql
from cohortlens.operators import distinct, enrich, groups, joins, links, nested, pivots, ranking, rates, stats
from cohortlens.operators import timeseries as ts
from cohortlens.operators._util import join_null_safe
from cohortlens.sources import changes, tables
from cohortlens.sources.scratch import scratch_path, written
from cohortlens.sources.tables import write_snapshot
from cohortlens.streaming import guards


@dataclass(frozen=True)
class Query:
    key: str
    build: Callable[[tables], DataFrame]
    sql: str | None
    ops: str


REGISTRY: dict[str, Query] = {}


def _as_timestamps(df: DataFrame, *cols: str) -> DataFrame:
    """Report calendar periods as midnight timestamps (``timestamp_ntz``):
    PostgreSQL's ``date_trunc`` returns a timestamp, and both engines hand a
    timestamp to pandas as the same datetime type."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def query(key: str, ops: str, sql: str | None):
    def deco(fn: Callable[[tables], DataFrame]):
        REGISTRY[key] = Query(key, fn, sql, ops)
        return fn

    return deco


# --------------------------------------------------------------- time series

@query("moving_avg_monthly", "A34 W14 DT2", """
WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS month, COUNT(*) AS n
           FROM orders GROUP BY 1)
SELECT month, n, ROUND(AVG(n) OVER (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS ma3
FROM m""")
def moving_avg_monthly(t: tables) -> DataFrame:
    m = ts.counts_by_period(t.orders, "o_orderdate", "month", out_period="month")
    return _as_timestamps(ts.moving_average(m, "month", "n", 2, out="ma3"), "month")


@query("month_neighbours", "S1 W7 W8", """
WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS month, COUNT(*) AS n
           FROM orders GROUP BY 1)
SELECT month, n, CAST(LAG(n) OVER (ORDER BY month) AS DOUBLE) AS prev_n,
       CAST(LEAD(n) OVER (ORDER BY month) AS DOUBLE) AS next_n FROM m""")
def month_neighbours(t: tables) -> DataFrame:
    m = ts.counts_by_period(t.orders, "o_orderdate", "month", out_period="month")
    res = ts.neighbours(m, "month", "n", prev="prev_n", next_="next_n")
    # integer columns holding NULL are reported as double on both sides (same
    # pandas dtype from either engine)
    res = res.withColumns({"prev_n": F.col("prev_n").cast("double"), "next_n": F.col("next_n").cast("double")})
    return _as_timestamps(res, "month")


@query("cumulative_daily", "W16 DT3", """
WITH d AS (SELECT CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS day, COUNT(*) AS n FROM orders GROUP BY 1)
SELECT day, n, CAST(SUM(n) OVER (ORDER BY day ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running FROM d""")
def cumulative_daily(t: tables) -> DataFrame:
    d = ts.counts_by_period(t.orders, "o_orderdate", "day", out_period="day")
    return _as_timestamps(ts.cumulative(d, "day", "n", out="running"), "day")


@query("quarter_counts", "A34 DT1", """
SELECT CAST(year(o_orderdate) AS BIGINT) AS year, CAST(quarter(o_orderdate) AS BIGINT) AS quarter, COUNT(*) AS n
FROM orders GROUP BY 1, 2""")
def quarter_counts(t: tables) -> DataFrame:
    o = t.orders
    return o.groupBy(
        F.year("o_orderdate").cast("bigint").alias("year"), F.quarter("o_orderdate").cast("bigint").alias("quarter")
    ).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@query("weekday_mode", "DT1 F9 D8 A18", """
SELECT CAST(dayofweek(o_orderdate) AS BIGINT) AS dow, COUNT(*) AS n FROM orders
WHERE dayofweek(o_orderdate) IN (1, 2, 3, 4, 5)
GROUP BY 1 ORDER BY n DESC, dow ASC LIMIT 1""")
def weekday_mode(t: tables) -> DataFrame:
    counts = ts.weekday_counts(t.orders, "o_orderdate", days=[1, 2, 3, 4, 5])
    return counts.orderBy(F.col("n").desc(), F.col("dow").asc()).limit(1)


@query("day_gap", "W7 W17 W15 F7 DT6 F6", """
WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, COUNT(*) AS n FROM orders
           WHERE o_orderdate >= TIMESTAMP '1997-03-01' AND o_orderdate < TIMESTAMP '1997-04-01' GROUP BY 1)
SELECT CAST(day AS TIMESTAMP) AS day, n, CAST(LAG(day) OVER (ORDER BY day) AS TIMESTAMP) AS prev_day,
       COUNT(*) OVER () AS active_days, CAST(SUM(n) OVER () AS BIGINT) AS range_total,
       CAST(day - LAG(day) OVER (ORDER BY day) AS DOUBLE) AS gap_days
FROM d""")
def day_gap(t: tables) -> DataFrame:
    res = ts.day_gap(t.orders, "o_orderdate", "1997-03-01", "1997-04-01")
    res = res.withColumn("gap_days", F.col("gap_days").cast("double"))  # NULL on the first day
    return _as_timestamps(res, "day", "prev_day")


@query("date_span", "A32 D10", """
SELECT MIN(o_orderdate) AS first_ts, MAX(o_orderdate) AS last_ts,
       CAST(EXTRACT(DAY FROM (MAX(o_orderdate) - MIN(o_orderdate))) AS BIGINT) AS span_days
FROM orders""")
def date_span(t: tables) -> DataFrame:
    return ts.date_span(t.orders, "o_orderdate")


@query("spine_fill", "S4", """
WITH b AS (SELECT CAST(MIN(o_orderdate) AS DATE) AS lo, CAST(MAX(o_orderdate) AS DATE) AS hi FROM orders),
     cal AS (SELECT CAST(g AS DATE) AS day FROM b, generate_series(b.lo, b.hi, INTERVAL 1 DAY) AS s(g)),
     d AS (SELECT CAST(o_orderdate AS DATE) AS day, COUNT(*) AS n FROM orders GROUP BY 1)
SELECT CAST(cal.day AS TIMESTAMP) AS day, COALESCE(d.n, 0) AS n FROM cal LEFT JOIN d ON cal.day = d.day""")
def spine_fill(t: tables) -> DataFrame:
    return _as_timestamps(ts.counts_by_period(t.orders, "o_orderdate", "day", spine=True, out_period="day"), "day")


@query("month_labels", "DT4 D18", """
SELECT o_orderkey, strftime(o_orderdate, '%m') AS mm, monthname(o_orderdate) AS month_name FROM orders""")
def month_labels(t: tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey", F.date_format("o_orderdate", "MM").alias("mm"), F.date_format("o_orderdate", "MMMM").alias("month_name")
    )


@query("age_from_year", "X1 DT7 C2", """
SELECT o_custkey AS c_custkey, CAST(year(MIN(o_orderdate)) AS BIGINT) AS first_year,
       CAST(2005 - year(MIN(o_orderdate)) AS BIGINT) AS years_since
FROM orders GROUP BY o_custkey""")
def age_from_year(t: tables) -> DataFrame:
    first = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.year(F.min("o_orderdate")).cast("bigint").alias("first_year")
    )
    return first.withColumn("years_since", fd.age_as_of("first_year", "2005-01-01"))


# ----------------------------------------------------------- shares and rates

@query("share_by_group", "A15 X3 W12 T13", """
SELECT o_orderpriority, COUNT(*) AS n,
       ROUND(CAST(COUNT(*) AS DOUBLE) * 100.0 / CAST(SUM(COUNT(*)) OVER () AS DOUBLE), 2) AS pct
FROM orders GROUP BY 1""")
def share_by_group(t: tables) -> DataFrame:
    return rates.share_of_total(t.orders, "o_orderpriority")


@query("pct_truncated", "D1 A15", """
SELECT o_orderpriority, COUNT(*) AS n, CAST((100 * COUNT(*)) // (SELECT COUNT(*) FROM orders) AS BIGINT) AS pct
FROM orders GROUP BY 1""")
def pct_truncated(t: tables) -> DataFrame:
    return rates.share_of_total(t.orders, "o_orderpriority", truncate=True)


@query("share_slices", "W13 M11 T11 W1 W12", f"""
WITH g AS (SELECT c_mktsegment, COUNT(*) AS n FROM customer GROUP BY 1),
     w AS (SELECT c_mktsegment, n, SUM(n) OVER () AS total,
                  SUM(n) OVER (ORDER BY c_mktsegment ROWS UNBOUNDED PRECEDING) AS running,
                  ROW_NUMBER() OVER (ORDER BY c_mktsegment) AS slice_no FROM g)
SELECT c_mktsegment, n, ROUND(CAST(n AS DOUBLE) * 100.0 / CAST(total AS DOUBLE), 2) AS pct,
       CAST(slice_no AS BIGINT) AS slice_no,
       ROUND({2 * math.pi!r} * CAST(running AS DOUBLE) / CAST(total AS DOUBLE), 6) AS cum_angle,
       CAST(slice_no AS VARCHAR) || ': ' || c_mktsegment || ' ' || repeat('#', CAST((100 * n) // total AS INTEGER)) AS legend
FROM w""")
def share_slices(t: tables) -> DataFrame:
    from pyspark.sql import Window

    g = rates.share_of_total(t.customer, "c_mktsegment")
    total = F.sum("n").over(Window.partitionBy())  # over the aggregated groups
    w = Window.orderBy("c_mktsegment")
    out = g.withColumns({
        "slice_no": F.row_number().over(w).cast("bigint"),
        "_running": F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)),
        "_total": total,
    })
    return out.select(
        "c_mktsegment", "n", "pct", "slice_no",
        F.round(F.lit(2 * math.pi) * F.col("_running").cast("double") / F.col("_total").cast("double"), 6).alias("cum_angle"),
        F.concat(F.col("slice_no").cast("string"), F.lit(": "), F.col("c_mktsegment"), F.lit(" "),
                 F.repeat(F.lit("#"), F.call_function("div", F.col("n") * 100, F.col("_total")).cast("int"))).alias("legend"),
    )


@query("share_filtered", "A15 F4 J8", """
SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE c_acctbal > 7000) AS n_match,
       ROUND(CAST(COUNT(*) FILTER (WHERE c_acctbal > 7000) AS DOUBLE) * 100.0 / CAST(COUNT(*) AS DOUBLE), 2) AS pct
FROM customer""")
def share_filtered(t: tables) -> DataFrame:
    return rates.share_where(t.customer, F.col("c_acctbal") > 7000)


@query("rate_by_group", "A16 F20 A5 A4", """
SELECT l_linestatus, COUNT(*) AS n, COUNT(*) FILTER (WHERE l_returnflag = 'R') AS n_flag,
       ROUND(CAST(COUNT(*) FILTER (WHERE l_returnflag = 'R') AS DOUBLE) * 100.0 / CAST(COUNT(*) AS DOUBLE), 4) AS rate
FROM lineitem GROUP BY 1""")
def rate_by_group(t: tables) -> DataFrame:
    return rates.conditional_rate(t.lineitem, "l_linestatus", F.col("l_returnflag") == "R")


@query("rate_lowest", "A16 A18 L2", """
SELECT o_orderpriority, COUNT(*) AS n, COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS n_flag,
       ROUND(CAST(COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) * 100.0 / CAST(COUNT(*) AS DOUBLE), 4) AS rate
FROM orders GROUP BY 1 ORDER BY rate ASC, o_orderpriority ASC LIMIT 1""")
def rate_lowest(t: tables) -> DataFrame:
    r = rates.conditional_rate(t.orders, "o_orderpriority", F.col("o_orderstatus") == "F")
    return r.orderBy(F.col("rate").asc(), F.col("o_orderpriority").asc()).limit(1)


@query("multi_rate", "A17 J6", """
SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE l_returnflag = 'R') AS n_returned,
       COUNT(*) FILTER (WHERE l_linestatus = 'O') AS n_open,
       ROUND(CAST(COUNT(*) FILTER (WHERE l_returnflag = 'R') AS DOUBLE) * 100.0 / CAST(COUNT(*) AS DOUBLE), 4) AS pct_returned,
       ROUND(CAST(COUNT(*) FILTER (WHERE l_linestatus = 'O') AS DOUBLE) * 100.0 / CAST(COUNT(*) AS DOUBLE), 4) AS pct_open
FROM lineitem""")
def multi_rate(t: tables) -> DataFrame:
    return rates.multi_rate(t.lineitem, {"returned": F.col("l_returnflag") == "R", "open": F.col("l_linestatus") == "O"})


@query("rate_halves", "J10 W5 F14 M3", """
WITH g AS (SELECT event_type, COUNT(*) AS n, COUNT(*) FILTER (WHERE value > 50) AS n_flag,
                  ROUND(CAST(COUNT(*) FILTER (WHERE value > 50) AS DOUBLE) * 100.0 / CAST(COUNT(*) AS DOUBLE), 4) AS rate
           FROM events GROUP BY 1),
     h AS (SELECT *, NTILE(2) OVER (ORDER BY rate DESC, event_type ASC) AS half FROM g)
SELECT event_type, n, n_flag, rate, CAST(half AS BIGINT) AS half,
       CASE WHEN half = 1 THEN 'high' ELSE 'low' END AS half_label FROM h""")
def rate_halves(t: tables) -> DataFrame:
    g = rates.conditional_rate(t.events, "event_type", F.col("value") > 50)
    # the ranked rows are the aggregated event types (bounded), a plain window suffices
    h = ranking.ntile_rows(g, 2, [("rate", False), ("event_type", True)], out="half", method="window")
    return h.withColumn("half_label", F.when(F.col("half") == 1, F.lit("high")).otherwise(F.lit("low")))


@query("branch_rate_join", "J11 S5 A16", """
WITH a AS (SELECT c_mktsegment, COUNT(*) AS n_customers FROM customer GROUP BY 1),
     b AS (SELECT c_mktsegment, COUNT(*) AS n_negative FROM customer WHERE c_acctbal < 0 GROUP BY 1)
SELECT a.c_mktsegment, a.n_customers, COALESCE(b.n_negative, 0) AS n_negative,
       ROUND(CAST(COALESCE(b.n_negative, 0) AS DOUBLE) * 100.0 / CAST(a.n_customers AS DOUBLE), 4) AS pct
FROM a LEFT JOIN b ON a.c_mktsegment = b.c_mktsegment""")
def branch_rate_join(t: tables) -> DataFrame:
    # the reference joined two aggregated branches; one conditional aggregate
    # gives the same rows (zero where a group has no match) in one pass
    return rates.conditional_rate(
        t.customer, "c_mktsegment", F.col("c_acctbal") < 0, count_col="n_customers", flag_col="n_negative", rate_col="pct"
    )


@query("category_ratio", "A21 T2 F9", """
SELECT COUNT(*) FILTER (WHERE event_type = 'click') AS n_click, COUNT(*) FILTER (WHERE event_type = 'view') AS n_view,
       CAST(COUNT(*) FILTER (WHERE event_type = 'click') AS VARCHAR) || ':' ||
       CAST(COUNT(*) FILTER (WHERE event_type = 'view') AS VARCHAR) AS ratio
FROM events""")
def category_ratio(t: tables) -> DataFrame:
    return rates.category_ratio(t.events.where(F.col("event_type").isin("click", "view")), "event_type", "click", "view")


# ------------------------------------------------------------- counts, modes

@query("count_filtered", "A1 F3", "SELECT COUNT(*) AS n FROM customer WHERE c_mktsegment = 'BUILDING'")
def count_filtered(t: tables) -> DataFrame:
    return groups.count_by(t.customer, where=F.col("c_mktsegment") == "BUILDING")


@query("count_distinct_prefix", "X2 A3 F10", """
SELECT p.p_name, COUNT(DISTINCT o.o_custkey) AS n_customers
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE p.p_name ILIKE 'red' || '%'
GROUP BY 1""")
def count_distinct_prefix(t: tables) -> DataFrame:
    parts = t.part.where(F.col("p_name").ilike(ft.escape_like("red") + "%")).select("p_partkey", "p_name")
    lines = t.lineitem.select("l_orderkey", "l_partkey").join(parts, F.col("l_partkey") == F.col("p_partkey"))
    joined = lines.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return groups.count_by(joined, "p_name", distinct="o_custkey", out="n_customers")


@query("histogram_width_bucket", "A22 M5 D13", """
SELECT CAST(CASE WHEN p_size IS NULL THEN NULL WHEN p_size < 0 THEN 0 WHEN p_size >= 50 THEN 6
                 ELSE floor((p_size - 0) * 5.0 / (50 - 0)) + 1 END AS BIGINT) AS bucket, COUNT(*) AS n
FROM part GROUP BY 1""")
def histogram_width_bucket(t: tables) -> DataFrame:
    return groups.histogram(t.part, "p_size", 0, 50, 5)


@query("top_group", "A18 L2 A2", """
SELECT c_mktsegment, c_nationkey, COUNT(*) AS n FROM customer WHERE c_acctbal >= 5000
GROUP BY 1, 2 ORDER BY n DESC, c_mktsegment ASC, c_nationkey ASC LIMIT 1""")
def top_group(t: tables) -> DataFrame:
    return groups.top_group(t.customer, ["c_mktsegment", "c_nationkey"], where=F.col("c_acctbal") >= 5000)


@query("top_group_in_month", "J3 F7 A18", """
SELECT p.p_name, COUNT(*) AS n
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey JOIN part p ON p.p_partkey = l.l_partkey
WHERE o.o_orderdate >= TIMESTAMP '1998-10-01' AND o.o_orderdate < TIMESTAMP '1998-11-01'
GROUP BY 1 ORDER BY n DESC, p.p_name ASC LIMIT 1""")
def top_group_in_month(t: tables) -> DataFrame:
    o = t.orders.where(
        (F.col("o_orderdate") >= F.lit("1998-10-01").cast("timestamp_ntz"))
        & (F.col("o_orderdate") < F.lit("1998-11-01").cast("timestamp_ntz"))
    ).select("o_orderkey")
    lines = t.lineitem.select("l_orderkey", "l_partkey").join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    named = lines.join(t.part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    return groups.top_group(named, "p_name")


@query("top_per_group", "A19 W4", """
WITH c AS (SELECT p_brand, p_type, COUNT(*) AS n FROM part GROUP BY 1, 2),
     r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY p_brand ORDER BY n DESC, p_type ASC) AS rn FROM c)
SELECT p_brand, p_type, n FROM r WHERE rn = 1""")
def top_per_group(t: tables) -> DataFrame:
    return groups.top_per_group(t.part, "p_brand", "p_type")


@query("first_letter", "A24 T5", """
SELECT left(event_type, 1) AS letter, COUNT(*) AS n FROM events GROUP BY 1""")
def first_letter(t: tables) -> DataFrame:
    return t.events.groupBy(F.left("event_type", F.lit(1)).alias("letter")).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@query("text_bar", "T11 F19", """
WITH c AS (SELECT event_type, COUNT(*) AS n FROM events GROUP BY 1 HAVING COUNT(*) > 100)
SELECT event_type, n, repeat('*', CAST(n * 40 // (SELECT MAX(n) FROM c) AS INTEGER)) AS bar FROM c""")
def text_bar(t: tables) -> DataFrame:
    c = groups.count_by(t.events, "event_type", having=F.col("n") > 100)
    return c.withColumn("bar", ft.text_bar("n", c.agg(F.max("n")).scalar()))


@query("having_many", "F19 J3 A14", """
WITH c AS (SELECT o_custkey AS c_custkey, COUNT(*) AS n_orders FROM orders GROUP BY 1 HAVING COUNT(*) > 15)
SELECT c.c_custkey, cu.c_mktsegment, c.n_orders FROM c JOIN customer cu ON cu.c_custkey = c.c_custkey""")
def having_many(t: tables) -> DataFrame:
    # pre-aggregate before the join (the reference joined first and counted
    # the fan-out)
    c = groups.count_by(t.orders.withColumnRenamed("o_custkey", "c_custkey"), "c_custkey",
                        having=F.col("n_orders") > 15, out="n_orders")
    return c.join(t.customer.select("c_custkey", "c_mktsegment"), on="c_custkey").select("c_custkey", "c_mktsegment", "n_orders")


@query("entity_extremes", "A33", """
SELECT user_id, MAX(value) AS max_value, MAX(ts) AS last_ts FROM events GROUP BY 1""")
def entity_extremes(t: tables) -> DataFrame:
    return t.events.groupBy("user_id").agg(F.max("value").alias("max_value"), F.max("ts").alias("last_ts"))


@query("max_over_groups", "W11 W18", """
SELECT o_orderpriority, o_orderstatus, MAX(o_totalprice) AS max_total FROM orders GROUP BY 1, 2""")
def max_over_groups(t: tables) -> DataFrame:
    # DISTINCT + MAX() OVER (PARTITION BY a, b) is a plain grouped max
    return t.orders.groupBy("o_orderpriority", "o_orderstatus").agg(F.max("o_totalprice").alias("max_total"))


@query("band_avg", "A23 A6", """
WITH c AS (SELECT c_custkey, CASE WHEN c_acctbal IS NULL THEN 'unknown' WHEN c_acctbal <= 0 THEN 'negative'
                                  WHEN c_acctbal <= 5000 THEN 'low' ELSE 'high' END AS band FROM customer)
SELECT band, COUNT(*) AS n_orders, ROUND(AVG(o_totalprice), 4) AS avg_total
FROM orders o JOIN c ON o.o_custkey = c.c_custkey GROUP BY 1""")
def band_avg(t: tables) -> DataFrame:
    c = t.customer.select("c_custkey", groups.band("c_acctbal", [0, 5000], ["negative", "low", "high"]).alias("band"))
    j = t.orders.select("o_custkey", "o_totalprice").join(c, F.col("o_custkey") == F.col("c_custkey"))
    return j.groupBy("band").agg(F.count(F.lit(1)).cast("bigint").alias("n_orders"), F.round(F.avg("o_totalprice"), 4).alias("avg_total"))


@query("two_level_agg", "A20 S6", """
WITH per AS (SELECT o_custkey, AVG(o_totalprice) AS m FROM orders GROUP BY 1)
SELECT c.c_mktsegment, ROUND(AVG(per.m), 4) AS avg_of_means
FROM per JOIN customer c ON c.c_custkey = per.o_custkey GROUP BY 1""")
def two_level_agg(t: tables) -> DataFrame:
    per = t.orders.groupBy("o_custkey").agg(F.avg("o_totalprice").alias("m"))
    j = per.join(t.customer.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    return j.groupBy("c_mktsegment").agg(F.round(F.avg("m"), 4).alias("avg_of_means"))


@query("or_predicate_distinct", "F5 A3", """
SELECT COUNT(DISTINCT o.o_custkey) AS n_customers FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
WHERE (o.o_totalprice > 400000 OR o.o_orderstatus = 'F') AND c.c_mktsegment = 'BUILDING'""")
def or_predicate_distinct(t: tables) -> DataFrame:
    hits = t.orders.where((F.col("o_totalprice") > 400000) | (F.col("o_orderstatus") == "F")).select(
        F.col("o_custkey").alias("c_custkey")
    )
    building = t.customer.where(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    # EXISTS as a semi-join: each customer counted once without a distinct over order rows
    return groups.count_by(building.join(hits, on="c_custkey", how="left_semi"), out="n_customers")


# ---------------------------------------------------------------------- joins

@query("inner_join_avg", "J1 A6 T14 J7 D2", """
SELECT c.c_mktsegment, CAST(CAST(ROUND(AVG(o.o_totalprice)) AS BIGINT) AS VARCHAR) || ' units' AS avg_total
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey GROUP BY 1""")
def inner_join_avg(t: tables) -> DataFrame:
    # the reference's tautological ON h.k = h.k is fixed to a real equi-join
    j = t.orders.select("o_custkey", "o_totalprice").join(
        t.customer.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey")
    )
    avg = F.round(F.avg("o_totalprice")).cast("bigint").cast("string")
    return j.groupBy("c_mktsegment").agg(F.concat(avg, F.lit(" units")).alias("avg_total"))


@query("right_join_view", "S7 J5", """
SELECT c.c_custkey, c.c_mktsegment, o.o_orderkey, o.o_totalprice
FROM orders o RIGHT JOIN customer c ON o.o_custkey = c.c_custkey""")
def right_join_view(t: tables) -> DataFrame:
    o = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    c = t.customer.select("c_custkey", "c_mktsegment")
    # orders RIGHT JOIN customer, written so a customer owning a large share
    # of the orders is still split across tasks
    view = joins.outer_join(c, o, "c_custkey")
    view.createOrReplaceTempView("customer_orders_view")
    return view.select("c_custkey", "c_mktsegment", "o_orderkey", "o_totalprice")


@query("left_join_stats", "J4 A9 A8 M3", """
SELECT ROUND(VAR_SAMP(e.value), 4) AS var_value, ROUND(CORR(e.value, c.c_acctbal), 4) AS corr_value_balance
FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey""")
def left_join_stats(t: tables) -> DataFrame:
    j = t.events.select("user_id", "value").join(
        t.customer.select("c_custkey", "c_acctbal"), F.col("user_id") == F.col("c_custkey"), "left"
    )
    return j.agg(F.round(F.var_samp("value"), 4).alias("var_value"),
                 F.round(F.corr("value", "c_acctbal"), 4).alias("corr_value_balance"))


@query("three_way_join_count", "J3 A5 A14", """
SELECT c.c_mktsegment, o.o_orderstatus,
       CAST(SUM(CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS n_returned,
       CAST(SUM(CASE WHEN l.l_linestatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS n_open
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON c.c_custkey = o.o_custkey
GROUP BY 1, 2""")
def three_way_join_count(t: tables) -> DataFrame:
    # Aggregate lineitem to one row per order before joining (4x fewer rows
    # cross the join), then to one row per (customer, status) before the
    # customer join.
    per_order = t.lineitem.groupBy("l_orderkey").agg(
        F.count_if(F.col("l_returnflag") == "R").alias("r"), F.count_if(F.col("l_linestatus") == "O").alias("o")
    )
    with_order = per_order.join(
        t.orders.select("o_orderkey", "o_custkey", "o_orderstatus"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    per_cust = with_order.groupBy("o_custkey", "o_orderstatus").agg(F.sum("r").alias("r"), F.sum("o").alias("o"))
    j = per_cust.join(t.customer.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    return j.groupBy("c_mktsegment", "o_orderstatus").agg(
        F.sum("r").cast("bigint").alias("n_returned"), F.sum("o").cast("bigint").alias("n_open")
    )


@query("using_join", "J2", """
SELECT custkey, o_orderkey, c_name
FROM (SELECT o_custkey AS custkey, o_orderkey FROM orders) o
JOIN (SELECT c_custkey AS custkey, c_name FROM customer) c USING (custkey)""")
def using_join(t: tables) -> DataFrame:
    o = t.orders.select(F.col("o_custkey").alias("custkey"), "o_orderkey")
    c = t.customer.select(F.col("c_custkey").alias("custkey"), "c_name")
    return o.join(c, on=["custkey"]).select("custkey", "o_orderkey", "c_name")


@query("max_over_join", "J3 W11 W18 A7", """
SELECT o.o_orderpriority, c.c_mktsegment, MAX(l.l_extendedprice) AS max_price
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey
GROUP BY 1, 2""")
def max_over_join(t: tables) -> DataFrame:
    # Q47 shape: DISTINCT + MAX() OVER (PARTITION BY a, b) over a three-way
    # join is a grouped max; lineitem is reduced to one max per order first
    per_order = t.lineitem.groupBy("l_orderkey").agg(F.max("l_extendedprice").alias("m"))
    j = per_order.join(t.orders.select("o_orderkey", "o_custkey", "o_orderpriority"),
                       F.col("l_orderkey") == F.col("o_orderkey"))
    per_cust = j.groupBy("o_custkey", "o_orderpriority").agg(F.max("m").alias("m"))
    jc = per_cust.join(t.customer.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    return jc.groupBy("o_orderpriority", "c_mktsegment").agg(F.max("m").alias("max_price"))


@query("join_or_filter", "J3 F5 F4", """
SELECT c.c_custkey, o.o_orderkey, l.l_linenumber, l.l_quantity, l.l_discount
FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey JOIN lineitem l ON l.l_orderkey = o.o_orderkey
WHERE (l.l_quantity > 45 OR l.l_discount > 0.09) AND c.c_acctbal < 0""")
def join_or_filter(t: tables) -> DataFrame:
    # B23 shape: each side filtered before the joins (the OR stays on lineitem)
    li = t.lineitem.where((F.col("l_quantity") > 45) | (F.col("l_discount") > 0.09)).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    c = t.customer.where(F.col("c_acctbal") < 0).select("c_custkey")
    o = t.orders.select("o_orderkey", "o_custkey").join(c, F.col("o_custkey") == F.col("c_custkey"))
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "c_custkey", "o_orderkey", "l_linenumber", "l_quantity", "l_discount")


@query("outer_made_inner", "J5 J4 A2 D3", """
SELECT l.l_returnflag, COUNT(c.c_custkey) AS n_customer_lines
FROM customer c RIGHT JOIN orders o ON o.o_custkey = c.c_custkey LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
WHERE c.c_acctbal > 5000 AND o.o_orderstatus = 'F'
GROUP BY 1""")
def outer_made_inner(t: tables) -> DataFrame:
    # B8 shape: the WHERE on the customer side makes the RIGHT JOIN inner, so
    # it is written as an inner join; the lineitem side stays outer
    c = t.customer.where(F.col("c_acctbal") > 5000).select("c_custkey")
    o = t.orders.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey")
    co = o.join(c, F.col("o_custkey") == F.col("c_custkey"))
    li = t.lineitem.select("l_orderkey", "l_returnflag")
    j = co.join(li, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return j.groupBy("l_returnflag").agg(F.count("c_custkey").cast("bigint").alias("n_customer_lines"))


@query("correlation", "A8 J1", """
SELECT ROUND(CORR(c.c_acctbal, o.o_totalprice), 4) AS corr
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey""")
def correlation(t: tables) -> DataFrame:
    j = t.orders.select("o_custkey", "o_totalprice").join(
        t.customer.select("c_custkey", "c_acctbal"), F.col("o_custkey") == F.col("c_custkey")
    )
    return stats.correlate(j, "c_acctbal", "o_totalprice")


@query("first_value_group", "W9 J1", """
WITH r AS (SELECT c.c_mktsegment, n.n_name,
                  ROW_NUMBER() OVER (PARTITION BY c.c_mktsegment ORDER BY c.c_acctbal DESC, c.c_custkey ASC) AS rn
           FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey)
SELECT c_mktsegment, n_name AS top_nation FROM r WHERE rn = 1""")
def first_value_group(t: tables) -> DataFrame:
    j = t.customer.select("c_mktsegment", "c_nationkey", "c_acctbal", "c_custkey").join(
        t.nation.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return ranking.first_value_by(j, ["c_mktsegment"], "n_name", [("c_acctbal", False), ("c_custkey", True)],
                                  out="top_nation")


@query("youngest_items", "F17 J1 L6", """
SELECT o.o_orderkey, l.l_linenumber, p.p_name
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey JOIN part p ON p.p_partkey = l.l_partkey
WHERE o.o_orderdate = (SELECT MIN(o_orderdate) FROM orders)""")
def youngest_items(t: tables) -> DataFrame:
    first = links.extreme_rows(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", "min")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey").join(first, F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.join(t.part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey")).select(
        "o_orderkey", "l_linenumber", "p_name"
    )


@query("extreme_rows", "F17 L6", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice = (SELECT MAX(o_totalprice) FROM orders)""")
def extreme_rows(t: tables) -> DataFrame:
    return links.extreme_rows(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), "o_totalprice", "max")


@query("linked_rows", "J13 U3 J14", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, o.o_custkey
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
WHERE o.o_custkey IN (SELECT o2.o_custkey FROM lineitem l2 JOIN orders o2 ON o2.o_orderkey = l2.l_orderkey
                      JOIN part p ON p.p_partkey = l2.l_partkey WHERE p.p_name = 'red plate')""")
def linked_rows(t: tables) -> DataFrame:
    # the seed customers from the few matching lines; all lines meet only orders
    red = t.part.where(F.col("p_name") == "red plate").select("p_partkey")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    o = t.orders.select("o_orderkey", "o_custkey")
    on = F.col("l_orderkey") == F.col("o_orderkey")
    seeds = lines.join(red, F.col("l_partkey") == F.col("p_partkey"), "left_semi").join(o, on).select("o_custkey")
    res = links.linked_rows(lines.join(o, on), "o_custkey", "l_partkey", seeds=seeds)
    return res.select("l_orderkey", "l_linenumber", "l_partkey", "o_custkey")


# ------------------------------------------------------------ stats, profiles

@query("guarded_ratio_mean", "A20 F22 M3 J1 S6 D15", """
SELECT o.o_orderpriority, ROUND(AVG(l.l_discount / NULLIF(l.l_tax, 0)), 4) AS mean_ratio,
       COUNT(*) FILTER (WHERE l.l_tax = 0) AS n_zero_tax
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey GROUP BY 1""")
def guarded_ratio_mean(t: tables) -> DataFrame:
    # Q34 intent: mean of a per-row ratio whose zero denominators give NULL
    li = t.lineitem.select("l_orderkey", fm.safe_ratio("l_discount", "l_tax").alias("r"),
                           (F.col("l_tax") == 0).alias("zero_tax"))
    j = li.join(t.orders.select("o_orderkey", "o_orderpriority"), F.col("l_orderkey") == F.col("o_orderkey"))
    return j.groupBy("o_orderpriority").agg(F.round(F.avg("r"), 4).alias("mean_ratio"),
                                            F.count_if("zero_tax").cast("bigint").alias("n_zero_tax"))


@query("profile_quantiles", "A12 A13 A10", """
SELECT o_orderpriority, ROUND(AVG(o_totalprice), 4) AS mean, ROUND(STDDEV_SAMP(o_totalprice), 4) AS std,
       ROUND(QUANTILE_CONT(o_totalprice, 0.25), 4) AS q1, ROUND(QUANTILE_CONT(o_totalprice, 0.75), 4) AS q3,
       ROUND(QUANTILE_CONT(o_totalprice, 0.75) - QUANTILE_CONT(o_totalprice, 0.25), 4) AS iqr,
       ROUND(AVG(o_totalprice) - 2 * STDDEV_SAMP(o_totalprice), 4) AS lower_2sd,
       ROUND(AVG(o_totalprice) + 2 * STDDEV_SAMP(o_totalprice), 4) AS upper_2sd
FROM orders GROUP BY 1""")
def profile_quantiles(t: tables) -> DataFrame:
    return groups.profile(t.orders, "o_orderpriority", "o_totalprice", method="exact")


@query("spread", "A10 A11 M4 A6", """
SELECT ROUND(AVG(value), 4) AS mean, ROUND(STDDEV_SAMP(value), 4) AS std_samp, ROUND(VAR_SAMP(value), 4) AS var_samp,
       ROUND(VAR_POP(value), 4) AS var_pop FROM events""")
def spread(t: tables) -> DataFrame:
    return stats.spread(t.events, "value")


@query("variance_by_hand", "A11 J6 M4", """
WITH m AS (SELECT AVG(value) AS mu FROM events)
SELECT ROUND(AVG(power(e.value - m.mu, 2)), 4) AS var_pop_by_hand, ROUND(sqrt(AVG(power(e.value - m.mu, 2))), 4) AS std_pop
FROM events e CROSS JOIN m""")
def variance_by_hand(t: tables) -> DataFrame:
    # the reference's form: cross join to a one-row mean (broadcast, one row)
    mu = t.events.agg(F.avg("value").alias("mu"))
    d = t.events.select("value").crossJoin(F.broadcast(mu)).select(F.pow(F.col("value") - F.col("mu"), 2).alias("sq"))
    return d.agg(F.round(F.avg("sq"), 4).alias("var_pop_by_hand"), F.round(F.sqrt(F.avg("sq")), 4).alias("std_pop"))


@query("between_range", "F6 F4 F5", """
SELECT c_custkey, c_acctbal, c_acctbal BETWEEN 1000 AND 2000 AS in_band
FROM customer WHERE NOT (c_acctbal BETWEEN 0 AND 500)""")
def between_range(t: tables) -> DataFrame:
    c = t.customer.where(~F.col("c_acctbal").between(0, 500))
    return c.select("c_custkey", "c_acctbal", F.col("c_acctbal").between(1000, 2000).alias("in_band"))


@query("min_max_avg", "A6 A7", """
SELECT ROUND(MIN(l_extendedprice), 4) AS min_value, ROUND(MAX(l_extendedprice), 4) AS max_value,
       ROUND(AVG(l_extendedprice), 4) AS avg_value FROM lineitem WHERE l_returnflag = 'R'""")
def min_max_avg(t: tables) -> DataFrame:
    return stats.min_max_avg(t.lineitem.where(F.col("l_returnflag") == "R"), "l_extendedprice")


# --------------------------------------------------------------------- pivots

@query("pivot_fixed", "A25 F22", """
SELECT o_orderpriority, COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS n_F,
       COUNT(*) FILTER (WHERE o_orderstatus = 'O') AS n_O, COUNT(*) FILTER (WHERE o_orderstatus = 'P') AS n_P
FROM orders GROUP BY 1""")
def pivot_fixed(t: tables) -> DataFrame:
    return pivots.pivot_counts(t.orders, "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query("pivot_year_outcome", "A26 A34", """
SELECT CAST(year(o_orderdate) AS BIGINT) AS year, COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS n_F,
       COUNT(*) FILTER (WHERE o_orderstatus = 'O') AS n_O, COUNT(*) FILTER (WHERE o_orderstatus = 'P') AS n_P
FROM orders GROUP BY 1""")
def pivot_year_outcome(t: tables) -> DataFrame:
    o = t.orders.withColumn("year", F.year("o_orderdate").cast("bigint"))
    return pivots.pivot_counts(o, "year", "o_orderstatus", ["F", "O", "P"])


@query("flag_counts_pivot", "A27 U1 F15", """
SELECT CAST(year(l_shipdate) AS BIGINT) AS ship_year, 'returned' AS flag, COUNT(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1
UNION
SELECT CAST(year(l_shipdate) AS BIGINT), 'open', COUNT(*) FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1
UNION
SELECT CAST(year(l_shipdate) AS BIGINT), 'bulk', COUNT(*) FROM lineitem WHERE l_quantity > 25 GROUP BY 1
UNION
SELECT CAST(year(l_shipdate) AS BIGINT), 'discounted', COUNT(*) FROM lineitem WHERE l_discount > 0.05 GROUP BY 1""")
def flag_counts_pivot(t: tables) -> DataFrame:
    li = t.lineitem.withColumn("ship_year", F.year("l_shipdate").cast("bigint"))
    return pivots.flag_counts(li, "ship_year", {
        "returned": F.col("l_returnflag") == "R",
        "open": F.col("l_linestatus") == "O",
        "bulk": F.col("l_quantity") > 25,
        "discounted": F.col("l_discount") > 0.05,
    })


@query("union_distinct", "U1", """
SELECT n_name FROM nation WHERE n_regionkey IN (0, 1)
UNION
SELECT n_name FROM nation WHERE n_name LIKE '%1%'""")
def union_distinct(t: tables) -> DataFrame:
    n = t.nation
    a = n.where(F.col("n_regionkey").isin(0, 1)).select("n_name")
    b = n.where(F.col("n_name").like("%1%")).select("n_name")
    return a.union(b).distinct()


@query("union_all", "U2", """
SELECT n_name, 'region_0_1' AS branch FROM nation WHERE n_regionkey IN (0, 1)
UNION ALL
SELECT n_name, 'has_1' AS branch FROM nation WHERE n_name LIKE '%1%'""")
def union_all(t: tables) -> DataFrame:
    n = t.nation
    a = n.where(F.col("n_regionkey").isin(0, 1)).select("n_name", F.lit("region_0_1").alias("branch"))
    b = n.where(F.col("n_name").like("%1%")).select("n_name", F.lit("has_1").alias("branch"))
    return a.unionByName(b)


# -------------------------------------------------------------------- ranking

@query("rank_desc", "W3 F8 L1", """
SELECT c_custkey, c_acctbal, RANK() OVER (ORDER BY c_acctbal DESC) AS rnk FROM customer WHERE c_acctbal IS NOT NULL""")
def rank_desc(t: tables) -> DataFrame:
    c = t.customer.where(F.col("c_acctbal").isNotNull()).select("c_custkey", "c_acctbal")
    return ranking.rank_rows(c, [("c_acctbal", False)], out="rnk")


@query("topk_then_nth", "W3 W4 L4", """
WITH top AS (SELECT user_id, event_id FROM (SELECT user_id, event_id, RANK() OVER (ORDER BY value DESC) AS r
                                            FROM events WHERE value IS NOT NULL) WHERE r <= 5)
SELECT c.c_custkey, c.c_acctbal FROM top JOIN customer c ON c.c_custkey = top.user_id
ORDER BY c.c_acctbal DESC, c.c_custkey ASC, top.event_id ASC OFFSET 1 LIMIT 1""")
def topk_then_nth(t: tables) -> DataFrame:
    top = ranking.top_k_with_ties(t.events.select("user_id", "event_id", "value"), "value", 5)
    j = top.join(t.customer.select("c_custkey", "c_acctbal"), F.col("user_id") == F.col("c_custkey"))
    return j.orderBy(F.col("c_acctbal").desc(), F.col("c_custkey").asc(), F.col("event_id").asc()).offset(1).limit(1).select(
        "c_custkey", "c_acctbal"
    )


@query("nth_value_5", "W10 L7 D19", """
SELECT p_retailprice AS nth_price FROM part ORDER BY p_retailprice DESC NULLS LAST OFFSET 4 LIMIT 1""")
def nth_value_5(t: tables) -> DataFrame:
    return ranking.nth_highest(t.part, "p_retailprice", 5, out="nth_price")


@query("ntile_quartiles", "W5", """
SELECT c_custkey, c_acctbal, NTILE(4) OVER (ORDER BY c_acctbal ASC NULLS LAST, c_custkey ASC) AS quartile FROM customer""")
def ntile_quartiles(t: tables) -> DataFrame:
    c = t.customer.select("c_custkey", "c_acctbal")
    return ranking.ntile_rows(c, 4, [("c_acctbal", True), ("c_custkey", True)], out="quartile")


@query("cume_dist", "W6 J1 F8", """
SELECT event_id, value, ROUND(CUME_DIST() OVER (ORDER BY value), 6) AS cume_dist
FROM events WHERE event_type = 'purchase' AND value IS NOT NULL""")
def cume_dist(t: tables) -> DataFrame:
    e = t.events.where((F.col("event_type") == "purchase") & F.col("value").isNotNull()).select("event_id", "value")
    r = ranking.cume_dist_rows(e, [("value", True)], out="cume_dist")
    return r.withColumn("cume_dist", F.round("cume_dist", 6))


@query("serial_number", "W2 C3 X5", """
SELECT c_custkey, ROW_NUMBER() OVER (ORDER BY c_custkey) AS serial_number FROM customer""")
def serial_number(t: tables) -> DataFrame:
    return ranking.serial_number(t.customer.select("c_custkey"), [("c_custkey", True)])


@query("stable_sample", "L5 D20", f"""
SELECT c_custkey, c_name FROM customer ORDER BY {stable_uniform_sql('c_custkey', 11)} ASC, c_custkey ASC LIMIT 10""")
def stable_sample(t: tables) -> DataFrame:
    return ranking.stable_sample(t.customer.select("c_custkey", "c_name"), "c_custkey", 10, seed=11)


# ----------------------------------------------------------------------- text

@query("like_two_part", "F10", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 's%r%'")
def like_two_part(t: tables) -> DataFrame:
    return t.part.where(F.col("p_name").like("s%r%")).select("p_partkey", "p_name")


@query("ilike_contains", "F10 F1", "SELECT p_partkey, p_name AS widget_name FROM part WHERE p_name ILIKE '%WIDGET%'")
def ilike_contains(t: tables) -> DataFrame:
    return t.part.where(F.col("p_name").ilike("%WIDGET%")).select("p_partkey", F.col("p_name").alias("widget_name"))


@query("regex_any", "F12", "SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '(?i)(ring|plate)')")
def regex_any(t: tables) -> DataFrame:
    return t.part.where(F.col("p_name").rlike("(?i)(ring|plate)")).select("p_partkey", "p_name")


@query("second_word", "T3 F16 D7", """
SELECT DISTINCT split_part(p_name, ' ', 2) AS second_word FROM part WHERE split_part(p_name, ' ', 2) <> ''""")
def second_word(t: tables) -> DataFrame:
    return t.part.select(ft.word("p_name", 2).alias("second_word")).where(F.col("second_word").isNotNull()).distinct()


@query("name_length", "T6 F13", """
SELECT p_partkey, p_name, CAST(length(p_name) AS BIGINT) AS name_len FROM part WHERE length(p_name) > 10""")
def name_length(t: tables) -> DataFrame:
    return t.part.select("p_partkey", "p_name", ft.char_count("p_name").alias("name_len")).where(F.col("name_len") > 10)


@query("bits_chars", "T6 T7", """
SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars, CAST(bit_length(text) AS BIGINT) AS n_bits FROM documents""")
def bits_chars(t: tables) -> DataFrame:
    d = t.documents
    return d.select("doc_id", ft.char_count("text").alias("n_chars"), ft.bit_count("text").alias("n_bits"))


@query("reverse_palindrome", "T8 T9 L3", """
SELECT p_brand, reverse(p_brand) AS reversed, p_brand = reverse(p_brand) AS is_palindrome
FROM (SELECT DISTINCT p_brand FROM part)""")
def reverse_palindrome(t: tables) -> DataFrame:
    b = t.part.select("p_brand").distinct()
    return b.select("p_brand", F.reverse("p_brand").alias("reversed"), ft.is_palindrome("p_brand").alias("is_palindrome"))


@query("concat_null_safe", "T1 F22 D5", """
SELECT c.c_custkey, concat(COALESCE(CAST(c.c_custkey AS VARCHAR), ''), ';', COALESCE(c.c_mktsegment, ''), ';',
                           COALESCE(n.n_name, '')) AS txt
FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey""")
def concat_null_safe(t: tables) -> DataFrame:
    j = t.customer.select("c_custkey", "c_mktsegment", "c_nationkey").join(
        t.nation.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    return j.select("c_custkey", ft.join_text(["c_custkey", "c_mktsegment", "n_name"], ";").alias("txt"))


@query("update_returning", "C5 T10", """
SELECT p_partkey, upper(p_name) AS p_name, p_brand, p_type, p_size, p_retailprice FROM part""")
def update_returning(t: tables) -> DataFrame:
    return enrich.apply_update(t.part, {"p_name": F.upper("p_name")})


# ----------------------------------------------------------------------- math

@query("even_odd", "M7 F9 F14", """
SELECT p_partkey, p_size, CASE WHEN p_size % 2 = 0 THEN 'even' WHEN p_size IS NOT NULL THEN 'odd' END AS parity,
       p_size IN (1, 2, 3, 5, 8, 13, 21, 34) AS is_fib FROM part""")
def even_odd(t: tables) -> DataFrame:
    return t.part.select("p_partkey", "p_size", fm.parity("p_size").alias("parity"),
                         F.col("p_size").isin(1, 2, 3, 5, 8, 13, 21, 34).alias("is_fib"))


@query("gcd_lcm", "M6 D14", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, CAST(p.p_size AS BIGINT) AS p_size, CAST(l.l_quantity AS BIGINT) AS qty,
       CAST(gcd(CAST(p.p_size AS BIGINT), CAST(l.l_quantity AS BIGINT)) AS BIGINT) AS gcd_v,
       CAST(lcm(CAST(p.p_size AS BIGINT), CAST(l.l_quantity AS BIGINT)) AS BIGINT) AS lcm_v
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey""")
def gcd_lcm(t: tables) -> DataFrame:
    j = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity").join(
        t.part.select("p_partkey", "p_size"), F.col("l_partkey") == F.col("p_partkey")
    )
    j = j.select("l_orderkey", "l_linenumber", "l_partkey", F.col("p_size").cast("bigint").alias("p_size"),
                 F.col("l_quantity").cast("bigint").alias("qty"))
    return fm.with_gcd_lcm(j, "p_size", "qty", gcd_out="gcd_v", lcm_out="lcm_v")


@query("quotient_no_slash", "M9 M8", """
SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS x, CAST(l_linenumber AS BIGINT) AS y,
       CASE WHEN l_linenumber <> 0 THEN CAST(l_quantity AS BIGINT) // l_linenumber END AS q,
       CAST(CASE WHEN l_linenumber = 0 THEN 0 ELSE CAST(l_quantity AS BIGINT) - least(CAST(l_quantity AS BIGINT), l_linenumber) END AS BIGINT) AS capped
FROM lineitem""")
def quotient_no_slash(t: tables) -> DataFrame:
    x, y = F.col("l_quantity").cast("bigint"), F.col("l_linenumber").cast("bigint")
    return t.lineitem.select("l_orderkey", "l_linenumber", x.alias("x"), y.alias("y"),
                             fm.quotient(x, y).alias("q"), fm.remainder_capped(x, y).alias("capped"))


@query("column_difference", "M10 F2", """
SELECT l_orderkey, l_linenumber, ROUND(l_extendedprice - l_extendedprice * (1 - l_discount), 4) AS diff FROM lineitem""")
def column_difference(t: tables) -> DataFrame:
    e = F.col("l_extendedprice")
    return t.lineitem.select("l_orderkey", "l_linenumber", F.round(e - e * (1 - F.col("l_discount")), 4).alias("diff"))


# --------------------------------------------------------------------- nested

_PART = nested.DEFAULT_PER_PART


@query("records_per_entity", "A30 R2", """
WITH r AS (SELECT o_custkey AS c_custkey, o_orderkey, o_orderstatus,
                  (ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 4 AS part FROM orders)
SELECT c_custkey, part, COUNT(*) AS n,
       CAST(to_json(list({'o_orderkey': o_orderkey, 'o_orderstatus': o_orderstatus} ORDER BY o_orderkey)) AS VARCHAR) AS records_json
FROM r GROUP BY 1, 2""")
def records_per_entity(t: tables) -> DataFrame:
    # four records a part, so that most customers span several
    o = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    res = nested.records_per_entity(o, "c_custkey", ["o_orderkey", "o_orderstatus"], ["o_orderkey"], per_part=4)
    return res.select("c_custkey", "part", "n", F.col("records_json").cast("string").alias("records_json"))


@query("json_per_entity", "A31 R3 D17", f"""
WITH r AS (SELECT *, (ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // {_PART} AS part FROM events)
SELECT user_id, part, COUNT(*) AS n,
       '[' || string_agg('{{"event_id":' || CAST(event_id AS VARCHAR)
                         || ',"ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')
                         || '","user_id":' || CAST(user_id AS VARCHAR)
                         || ',"event_type":"' || event_type
                         || '","value":' || CAST(value AS VARCHAR)
                         || ',"props":"' || replace(props, '"', '\\"') || '"}}', ',' ORDER BY event_id) || ']' AS rows_json
FROM r GROUP BY 1, 2""")
def json_per_entity(t: tables) -> DataFrame:
    return nested.json_per_entity(t.events, "user_id", ["event_id"])


@query("entity_digest", "X4 A28 T2 J15", f"""
WITH l AS (SELECT l.l_orderkey, COUNT(*) AS n_lines, MAX(p.p_name) AS last_part
           FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey GROUP BY 1),
     r AS (SELECT c.c_custkey, o.o_orderkey, o.o_orderstatus || ',' || c.c_mktsegment || ',' || l.n_lines || ',' || l.last_part AS txt,
                  (ROW_NUMBER() OVER (PARTITION BY c.c_custkey ORDER BY o.o_orderkey) - 1) // {_PART} AS part
           FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey JOIN l ON l.l_orderkey = o.o_orderkey)
SELECT c_custkey, part, COUNT(*) AS n, string_agg(txt, ';' ORDER BY o_orderkey) AS digest FROM r GROUP BY 1, 2""")
def entity_digest(t: tables) -> DataFrame:
    # lines are summed per order before they meet orders and customers
    lines = t.lineitem.select("l_orderkey", "l_partkey").join(
        t.part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    lines = lines.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_lines"), F.max("p_name").alias("last_part"))
    c = t.customer.select("c_custkey", "c_mktsegment")
    o = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderstatus")
    o = o.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).drop("l_orderkey")
    return nested.entity_digest([c, o], "c_custkey", ["o_orderstatus", "c_mktsegment", "n_lines", "last_part"], ["o_orderkey"])


@query("array_text", "A29 T12 R1", f"""
WITH r AS (SELECT *, (ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // {_PART} AS part FROM events)
SELECT user_id, part, COUNT(*) AS n, string_agg(event_type, '' ORDER BY event_id) AS types FROM r GROUP BY 1, 2""")
def array_text(t: tables) -> DataFrame:
    return nested.joined_text(t.events, "user_id", "event_type", ["event_id"], sep="", out="types")


# --------------------------------------------------------------------- enrich

_SEGMENT_BANDS = {  # invented age-style bands per segment, inclusive bounds
    "AUTOMOBILE": (21, 29), "BUILDING": (30, 39), "FURNITURE": (40, 49), "HOUSEHOLD": (50, 59), "MACHINERY": (60, 110),
}


@query("band_value", "C1 D20 M1 M2", f"""
WITH b(seg, lo, hi) AS (VALUES {", ".join(f"('{k}', {lo}, {hi})" for k, (lo, hi) in _SEGMENT_BANDS.items())})
SELECT c.c_custkey, c.c_mktsegment,
       CAST(b.lo + floor({stable_uniform_sql('c.c_custkey', 3)} * (b.hi - b.lo + 1)) AS BIGINT) AS value
FROM customer c LEFT JOIN b ON b.seg = c.c_mktsegment""")
def band_value(t: tables) -> DataFrame:
    c = t.customer.select("c_custkey", "c_mktsegment")
    return enrich.band_value(c, "c_mktsegment", "c_custkey", bands=_SEGMENT_BANDS, seed=3)


_STATUS_LABELS = {"F": "finished", "O": "open", "P": "partial"}


@query("code_labels", "C4 F14", """
SELECT o_orderkey, o_orderstatus,
       CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' WHEN 'P' THEN 'partial' END AS status_label
FROM orders""")
def code_labels(t: tables) -> DataFrame:
    return enrich.code_labels(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", _STATUS_LABELS,
                              out="status_label")


@query("add_drop_column", "C6 C7 S10 S2 X6 X7", """
SELECT c_custkey, c_name, c_nationkey, c_mktsegment, TIMESTAMP '2005-01-01 00:00:00' AS as_of FROM customer""")
def add_drop_column(t: tables) -> DataFrame:
    c = enrich.add_if_missing(t.customer, "as_of", F.lit("2005-01-01").cast("timestamp_ntz"))
    c = enrich.add_if_missing(c, "as_of", F.lit("1900-01-01").cast("timestamp_ntz"))  # already there: unchanged
    return enrich.drop_if_present(c, "c_acctbal")


@query("update_from_join", "J12 C2", """
WITH f AS (SELECT o_custkey, CAST(year(MIN(o_orderdate)) AS BIGINT) AS first_year FROM orders
           WHERE o_orderdate >= TIMESTAMP '1999-01-01' GROUP BY 1)
SELECT c.c_custkey, COALESCE(f.first_year, CAST(-1 AS BIGINT)) AS first_year
FROM customer c LEFT JOIN f ON f.o_custkey = c.c_custkey""")
def update_from_join(t: tables) -> DataFrame:
    base = t.customer.select("c_custkey", F.lit(-1).cast("bigint").alias("first_year"))
    recent = t.orders.where(F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz"))
    src = recent.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.year(F.min("o_orderdate")).cast("bigint").alias("first_year"))
    return enrich.update_from(base, src, "c_custkey", ["first_year"])


@query("stack_child", "S9 C8", """
SELECT c_custkey, c_mktsegment, NULL::DOUBLE AS n_orders FROM customer
UNION ALL BY NAME
SELECT c.c_custkey, c.c_mktsegment, CAST(COUNT(*) AS DOUBLE) AS n_orders
FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey GROUP BY 1, 2""")
def stack_child(t: tables) -> DataFrame:
    # a parent scan holds all parents and all child rows
    parent = t.customer.select("c_custkey", "c_mktsegment")
    per_customer = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).cast("bigint").alias("n_orders"))
    child = parent.join(per_customer, on="c_custkey")
    # the child-only column is NULL on parent rows: reported as double
    return enrich.stack_child(parent, child).withColumn("n_orders", F.col("n_orders").cast("double"))


@query("inline_rows_appended", "S3 C8 S1", """
SELECT r_regionkey, r_name FROM region UNION ALL SELECT * FROM (VALUES (100, 'ATLANTIS'), (101, NULL)) v(k, n)""")
def inline_rows_appended(t: tables) -> DataFrame:
    from pyspark.sql import types as T

    from cohortlens.sources.tables import inline_rows

    given = t.region.select("r_regionkey", "r_name")
    schema = T.StructType([T.StructField("r_regionkey", given.schema["r_regionkey"].dataType), T.StructField("r_name", T.StringType())])
    return given.unionByName(inline_rows(t.spark, [(100, "ATLANTIS"), (101, None)], schema))


@query("sink_round_trip", "S8", """
SELECT o_orderkey, o_orderstatus, CAST(year(o_orderdate) AS BIGINT) AS order_year FROM orders""")
def sink_round_trip(t: tables) -> DataFrame:
    import uuid

    from cohortlens.session import ensure_checkpoint_dir
    from cohortlens.sources.tables import write_snapshot

    path = f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/snapshot-{uuid.uuid4().hex}"
    years = t.orders.select("o_orderkey", "o_orderstatus", F.year("o_orderdate").cast("bigint").alias("order_year"))
    return write_snapshot(years, path, partition_by=["order_year"])


# ------------------------------------------------------- lookups and guards

@query("range_lookup", "J9", f"""
WITH g AS (SELECT c_mktsegment, COUNT(*) AS n FROM customer GROUP BY 1),
     b AS (SELECT c_mktsegment AS slice,
                  CAST(SUM(n) OVER (ORDER BY c_mktsegment ROWS UNBOUNDED PRECEDING) AS DOUBLE)
                  / CAST((SELECT COUNT(*) FROM customer) AS DOUBLE) AS upper FROM g),
     u AS (SELECT c_custkey, {stable_uniform_sql('c_custkey', 7)} AS u FROM customer)
SELECT u.c_custkey, (SELECT b.slice FROM b WHERE b.upper >= u.u ORDER BY b.upper LIMIT 1) AS slice FROM u""")
def range_lookup(t: tables) -> DataFrame:
    bounds = links.cumulative_bounds(t.customer, "c_mktsegment", out_label="slice")
    u = t.customer.select("c_custkey", stable_uniform("c_custkey", 7).alias("u"))
    return links.range_lookup(u, "u", bounds, "upper", "slice").select("c_custkey", "slice")


@query("lookup_or_report", "G4 J14 F18", """
SELECT 2 * c.c_custkey AS c_custkey, CAST(o.o_orderkey AS DOUBLE) AS o_orderkey, o.o_totalprice,
       CASE WHEN o.o_orderkey IS NULL THEN 'not found' ELSE 'found' END AS status
FROM customer c LEFT JOIN orders o ON o.o_custkey = 2 * c.c_custkey""")
def lookup_or_report(t: tables) -> DataFrame:
    # ids spread over twice the range of keys: about half of them have no order
    ids = t.customer.select((F.col("c_custkey") * 2).alias("c_custkey"))
    orders = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    res = guards.lookup_or_report(orders, "c_custkey", ids, ["o_orderkey", "o_totalprice"])
    return res.withColumn("o_orderkey", F.col("o_orderkey").cast("double"))  # NULL when not found


@query("delete_guard", "G2", """
SELECT o_orderkey FROM orders EXCEPT SELECT o_orderkey FROM orders WHERE o_totalprice > 25000""")
def delete_guard(t: tables) -> DataFrame:
    nxt = t.orders.where(F.col("o_totalprice") > 25000)
    return guards.delete_guard(t.orders, nxt, "o_orderkey")


@query("constrained_ingest", "G3", """
SELECT CASE WHEN COALESCE(value > 8, FALSE) THEN 'accepted' ELSE 'value_gt_8' END AS outcome, COUNT(*) AS n
FROM events GROUP BY 1""")
def constrained_ingest(t: tables) -> DataFrame:
    # the (accepted, rejected) split is guards.constrained_ingest; its counts in one pass:
    return guards.ingest_summary(t.events, {"value_gt_8": F.col("value") > 8})


@query("alerts", "G1", """
SELECT event_id, user_id, 'WARNING: value ' || CAST(value AS VARCHAR) || ' above 100 for user ' || CAST(user_id AS VARCHAR) AS message
FROM events WHERE value > 100""")
def alerts(t: tables) -> DataFrame:
    msg = F.concat(F.lit("WARNING: value "), F.col("value").cast("string"), F.lit(" above 100 for user "),
                   F.col("user_id").cast("string"))
    return guards.alerts(t.events, F.col("value") > 100, msg, keep=["event_id", "user_id"])


# ------------------------------------- sets, closures, change sets, streams

@query("distinct_rollup", "A3 X2 A34", """
SELECT strftime(o_orderdate, '%Y-%m') AS period, COUNT(DISTINCT o_custkey) AS n_distinct FROM orders GROUP BY 1
UNION ALL SELECT strftime(o_orderdate, '%Y'), COUNT(DISTINCT o_custkey) FROM orders GROUP BY 1""")
def distinct_rollup(t: tables) -> DataFrame:
    # one stored table of sets per month; the years are merged from it, not from the rows
    months = t.orders.select(F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.date_format("o_orderdate", "yyyy").alias("year"), "o_custkey")
    sets = written(distinct.distinct_sets(months, ["year", "month"], "o_custkey"), "sets")
    by_month = distinct.set_sizes(sets, ["month"]).withColumnRenamed("month", "period")
    by_year = distinct.set_sizes(distinct.merged_sets(sets, ["year"]), ["year"]).withColumnRenamed("year", "period")
    return by_month.unionByName(by_year)


_LARGE = 395_000  # orders above it link their customers


@query("linked_closure", "J13 U3", f"""
WITH RECURSIVE links AS (
  SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS item FROM orders WHERE o_totalprice > {_LARGE}),
r(o_custkey, hop) AS (
  SELECT (SELECT min(o_custkey) FROM links), 0::BIGINT
  UNION SELECT b.o_custkey, r.hop + 1 FROM r JOIN links a ON a.o_custkey = r.o_custkey JOIN links b ON b.item = a.item WHERE r.hop < 60)
SELECT o_custkey, min(hop) AS hop FROM r GROUP BY 1""")
def linked_closure(t: tables) -> DataFrame:
    # customers with large orders on the same day, from the first of them on
    links_of = t.orders.where(F.col("o_totalprice") > _LARGE).select("o_custkey", F.to_date("o_orderdate").alias("item"))
    seeds = links_of.agg(F.min("o_custkey").alias("o_custkey"))
    return links.linked_closure(links_of, "o_custkey", "item", seeds)


@query("month_patch", "C2 J12 C5", """
WITH best AS (
  SELECT l_orderkey, l_linestatus, l_extendedprice,
         ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) AS rn FROM lineitem)
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS order_month,
       CASE WHEN strftime(o_orderdate, '%Y-%m') = '1995-03' AND rn = 1 THEN l_linestatus ELSE o_orderstatus END AS o_orderstatus
FROM orders LEFT JOIN best ON l_orderkey = o_orderkey AND rn = 1""")
def month_patch(t: tables) -> DataFrame:
    # orders of one month take the status of their dearest line; other months' files stay as they are
    path = scratch_path(t.spark, "orders-by-month")
    month = F.date_format("o_orderdate", "yyyy-MM").alias("order_month")
    snapshot = write_snapshot(t.orders.select("o_orderkey", "o_orderstatus", month), path, partition_by=["order_month"])
    march = t.orders.where((F.col("o_orderdate") >= "1995-03-01") & (F.col("o_orderdate") < "1995-04-01")).select("o_orderkey", month)
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linestatus", "l_extendedprice", "l_linenumber")
    best = changes.one_match(lines.join(march, "o_orderkey"), "o_orderkey", [-F.col("l_extendedprice"), F.col("l_linenumber")])
    return changes.patch_snapshot(snapshot, path, best, "o_orderkey", "order_month", {"o_orderstatus": "l_linestatus"})


@query("alert_once", "G1 G3", """
SELECT DISTINCT user_id, 'WARNING: values above 100 for user ' || CAST(user_id AS VARCHAR) AS message FROM events WHERE value > 100""")
def alert_once(t: tables) -> DataFrame:
    # events arrive in several batches, each of them delivered twice
    arriving, sink = scratch_path(t.spark, "arriving"), scratch_path(t.spark, "alerts")
    for _ in range(2):
        t.events.repartition(3, "event_id").write.mode("append").parquet(arriving)
    message = F.concat(F.lit("WARNING: values above 100 for user "), F.col("user_id").cast("string"))
    guards.alert_once_stream(t.spark, arriving, t.events.schema, F.col("value") > 100, "user_id", message, sink, event_key="event_id", files_per_batch=2)
    return t.spark.read.schema(f"user_id {t.events.schema['user_id'].dataType.simpleString()}, message string").parquet(sink)


@query("publish_change", "G2 G3 S8", """
SELECT o_orderkey, o_totalprice * 2 AS o_totalprice FROM orders WHERE o_totalprice > 25000""")
def publish_change(t: tables) -> DataFrame:
    # a new version is guarded, split by its rule, published and read back
    new = t.orders.select("o_orderkey", (F.col("o_totalprice") * 2).alias("o_totalprice"))
    rules = {"price_gt_50000": F.col("o_totalprice") > 50000}
    done = guards.publish_snapshot(t.orders, new, scratch_path(t.spark, "orders-published"), "o_orderkey", rules=rules, forbid_deletes=False)
    if done["deleted"] != done["rejected"]:  # order keys are unique: what a rule refuses is what the guard misses
        raise ValueError(f"publish: {done}")
    return t.spark.read.schema(new.schema).parquet(done["path"])


@query("stratified_sample", "L5 M2 D20", f"""
SELECT o_orderkey, o_orderstatus FROM (
  SELECT o_orderkey, o_orderstatus,
         ROW_NUMBER() OVER (PARTITION BY o_orderstatus ORDER BY {stable_uniform_sql('o_orderkey', 11)}, o_orderkey) AS rn FROM orders)
WHERE rn <= 25""")
def stratified_sample(t: tables) -> DataFrame:
    return ranking.stratified_sample(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", "o_orderkey", 25, seed=11)


@query("nth_value_records", "W10 D19", """
SELECT c_custkey, c_acctbal, NTH_VALUE(c_acctbal, 5) OVER (ORDER BY c_acctbal DESC NULLS LAST) AS nth_c_acctbal FROM customer""")
def nth_value_records(t: tables) -> DataFrame:
    return ranking.nth_value_rows(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal", 5, frame="default")


@query("sql_current_age", "X1 DT7", """
SELECT o_orderkey, CAST(1999 - year(o_orderdate) AS BIGINT) AS age FROM orders""")
def sql_current_age(t: tables) -> DataFrame:
    register_sql_functions(t.spark)
    t.orders.createOrReplaceTempView("orders_for_age")
    return t.spark.sql("SELECT o_orderkey, CAST(current_age(year(o_orderdate), DATE'1999-06-30') AS BIGINT) AS age FROM orders_for_age")


@query("sql_unique_per_prefix", "X2 A3 F10", """
SELECT p_name AS drug_name, COUNT(DISTINCT o_custkey) AS n_patients
FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey WHERE p_name ILIKE 'r%' GROUP BY 1""")
def sql_unique_per_prefix(t: tables) -> DataFrame:
    given = t.lineitem.select("l_orderkey", "l_partkey").join(t.part.select("p_partkey", "p_name"), F.col("p_partkey") == F.col("l_partkey"))
    given = given.join(t.orders.select("o_orderkey", "o_custkey"), F.col("o_orderkey") == F.col("l_orderkey"))
    given.select(F.col("o_custkey").alias("inpatient_number"), F.col("p_name").alias("drug_name")).createOrReplaceTempView("prescribed")
    register_sql_functions(t.spark, prescriptions_view="prescribed")
    return t.spark.sql("SELECT drug_name, n_patients FROM unique_patients_per_drug('R')")


@query("sql_share", "X3 T13 A15", """
SELECT o_orderpriority AS group_value, COUNT(*) AS n, ROUND(COUNT(*)::DOUBLE * 100.0 / (SELECT COUNT(*) FROM orders), 2) AS pct
FROM orders GROUP BY 1""")
def sql_share(t: tables) -> DataFrame:
    t.orders.createOrReplaceTempView("orders_for_share")
    return share_of_total_sql(t.spark, "orders_for_share", "o_orderpriority")


# ------------------------------------------------------------ plain filters

@query("oxygen_style_filter", "F3 F7 F11", """
SELECT o_orderkey, o_orderpriority FROM orders
WHERE o_orderstatus <> 'P' AND o_orderdate >= TIMESTAMP '1997-02-01' AND o_orderdate < TIMESTAMP '1997-03-01'""")
def oxygen_style_filter(t: tables) -> DataFrame:
    # Q31 shape on data that holds the text sentinel (status P is spelled
    # 'null' first): cleaned to NULL (F11), and a half-open month on the raw
    # timestamp so the range reaches the scan
    from cohortlens.sources import clean_sentinels

    status = F.when(F.col("o_orderstatus") == "P", "null").otherwise(F.col("o_orderstatus"))
    o = clean_sentinels(t.orders.select("o_orderkey", "o_orderpriority", status.alias("o_orderstatus"), "o_orderdate"),
                        ["o_orderstatus"])
    return o.where(
        F.col("o_orderstatus").isNotNull()
        & (F.col("o_orderdate") >= F.lit("1997-02-01").cast("timestamp_ntz"))
        & (F.col("o_orderdate") < F.lit("1997-03-01").cast("timestamp_ntz"))
    ).select("o_orderkey", "o_orderpriority")


@query("text_against_number", "F21 F3", """
SELECT l_orderkey, l_linenumber FROM lineitem WHERE CAST(l_linenumber AS VARCHAR) = '1'""")
def text_against_number(t: tables) -> DataFrame:
    # a flag kept as a number, asked for as text: the declared type decides
    return t.lineitem.where(F.col("l_linenumber") == F.lit("1")).select("l_orderkey", "l_linenumber")


@query("letters_by_place", "T4 F13", """
SELECT p_partkey, g.i AS place, substring(p_name, CAST(g.i AS INTEGER), 1) AS letter
FROM part, generate_series(1, 3) AS g(i)""")
def letters_by_place(t: tables) -> DataFrame:
    p = t.part.select("p_partkey", "p_name", F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(3).cast("bigint"))).alias("place"))
    return p.select("p_partkey", "place", F.substring("p_name", F.col("place").cast("int"), F.lit(1)).alias("letter"))


@query("days_to_today", "DT5 DT6", """
SELECT o_orderkey, CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(now() AT TIME ZONE 'UTC' AS DATE)) AS BIGINT) AS days
FROM orders""")
def days_to_today(t: tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.datediff(F.current_date(), F.col("o_orderdate").cast("date")).cast("bigint").alias("days"))


# -------------------------------------------------- NULLs derived from columns

def _status():
    return F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status")


@query("null_counts", "A2 A15 F22", """
WITH s AS (SELECT o_orderpriority, nullif(o_orderstatus, 'P') AS status FROM orders)
SELECT o_orderpriority, COUNT(*) AS n, COUNT(status) AS n_status, COUNT(DISTINCT status) AS n_kinds,
       ROUND(CAST(COUNT(status) AS DOUBLE) * 100.0 / CAST(COUNT(*) AS DOUBLE), 4) AS pct FROM s GROUP BY 1""")
def null_counts(t: tables) -> DataFrame:
    s = t.orders.select("o_orderpriority", _status())
    known, all_ = F.count("status"), F.count(F.lit(1))
    return s.groupBy("o_orderpriority").agg(
        all_.alias("n"), known.alias("n_status"), F.count_distinct("status").alias("n_kinds"),
        F.round(known.cast("double") * 100.0 / all_.cast("double"), 4).alias("pct"))


@query("null_ranks", "W3 W5 D3", """
WITH s AS (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status FROM orders)
SELECT o_orderkey, status, RANK() OVER (ORDER BY status DESC NULLS LAST) AS rnk,
       CAST(NTILE(4) OVER (ORDER BY status NULLS LAST, o_orderkey) AS BIGINT) AS tile FROM s""")
def null_ranks(t: tables) -> DataFrame:
    s = t.orders.select("o_orderkey", _status())
    tiled = ranking.ntile_rows(s, 4, [("status", True), ("o_orderkey", True)], out="tile")
    # three values: their ranks come from one count
    return join_null_safe(tiled, ranking.rank_keys(s, [("status", False)]), ["status"])


@query("first_value_record", "W9 J5 D3", """
WITH s AS (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status, o_orderpriority, o_totalprice FROM orders)
SELECT o_orderkey, status, FIRST_VALUE(o_orderpriority) OVER (PARTITION BY status ORDER BY o_totalprice DESC, o_orderkey) AS top_priority
FROM s""")
def first_value_record(t: tables) -> DataFrame:
    # on every record: one row per group, joined back with NULL as a group
    s = t.orders.select("o_orderkey", _status(), "o_orderpriority", "o_totalprice")
    top = ranking.first_value_by(s, ["status"], "o_orderpriority", [("o_totalprice", False), ("o_orderkey", True)], out="top_priority")
    return join_null_safe(s.select("o_orderkey", "status"), top, ["status"], "left")


@query("null_keys_joined", "J2 T2 D5", """
WITH l AS (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status FROM orders),
     r AS (SELECT nullif(o_orderstatus, 'P') AS status, COUNT(*) AS n FROM orders GROUP BY 1)
SELECT o_orderkey, l.status || ':' || n AS txt, concat(l.status, ':', n) AS kept FROM l JOIN r USING (status)""")
def null_keys_joined(t: tables) -> DataFrame:
    # NULL keys meet nothing under USING; || with NULL is NULL
    s = t.orders.select("o_orderkey", _status())
    n = s.groupBy("status").agg(F.count(F.lit(1)).cast("string").alias("n"))
    j = s.join(n, on="status")
    return j.select("o_orderkey", F.concat("status", F.lit(":"), "n").alias("txt"), ft.join_text(["status", "n"], ":").alias("kept"))


@query("threshold_list", "F4", "SELECT c_custkey FROM customer WHERE c_acctbal < 0")
def threshold_list(t: tables) -> DataFrame:
    # Q49 shape: the ids below a threshold
    return t.customer.where(F.col("c_acctbal") < 0).select("c_custkey")


@query("flagged_count_two_keys", "J1 A2 A14 L1", """
SELECT o.o_orderpriority, o.o_orderstatus, COUNT(*) AS n_returned
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey WHERE l.l_returnflag = 'R' GROUP BY 1, 2""")
def flagged_count_two_keys(t: tables) -> DataFrame:
    # B16 shape: flagged rows counted per two categories of the joined side;
    # the flag filter and a per-order count run before the join
    per_order = t.lineitem.where(F.col("l_returnflag") == "R").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("r"))
    j = per_order.join(t.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus"),
                       F.col("l_orderkey") == F.col("o_orderkey"))
    return j.groupBy("o_orderpriority", "o_orderstatus").agg(F.sum("r").cast("bigint").alias("n_returned"))


# ------------------------------------------------------------------ registry

def build(spark: SparkSession, key: str, sf_dir: str) -> DataFrame:
    return REGISTRY[key].build(tables(spark, sf_dir))


def query_functions() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: (lambda spark, sf_dir, _k=k: build(spark, _k, sf_dir)) for k in REGISTRY}


def oracle_statements() -> dict[str, str]:
    return {k: q.sql.strip() for k, q in REGISTRY.items() if q.sql}


# Which reference questions each
# key restates on the driver tables.
RESTATES: dict[str, str] = {
    "moving_avg_monthly": "Q30", "month_neighbours": "Q39", "cumulative_daily": "B20", "quarter_counts": "B25",
    "weekday_mode": "Q50", "day_gap": "Q16", "date_span": "Q23", "spine_fill": "Q36", "month_labels": "Q67",
    "age_from_year": "Q2 Q3", "share_by_group": "Q4 Q37", "pct_truncated": "Q4 Q8", "share_slices": "Q6",
    "share_filtered": "Q8", "rate_by_group": "B19 Q54", "rate_lowest": "Q9 Q53", "multi_rate": "B24",
    "rate_halves": "Q61", "branch_rate_join": "B22", "category_ratio": "Q46", "count_filtered": "Q5 B10",
    "count_distinct_prefix": "Q18", "histogram_width_bucket": "Q7", "top_group": "Q76 Q58 B9",
    "top_group_in_month": "B13", "top_per_group": "Q12", "first_letter": "Q25", "text_bar": "Q51",
    "having_many": "Q41", "entity_extremes": "Q32", "max_over_groups": "Q47", "band_avg": "Q74",
    "two_level_agg": "Q34 B21", "or_predicate_distinct": "Q68 Q29", "inner_join_avg": "Q11 Q14 B11 B12",
    "right_join_view": "Q17", "left_join_stats": "Q52", "three_way_join_count": "B15 B14", "using_join": "Q40",
    "max_over_join": "Q47", "join_or_filter": "B23", "outer_made_inner": "B8", "correlation": "Q15",
    "first_value_group": "B2", "youngest_items": "Q55", "extreme_rows": "Q48", "linked_rows": "Q80",
    "guarded_ratio_mean": "Q34", "profile_quantiles": "B6", "spread": "Q72 Q65", "variance_by_hand": "Q65",
    "between_range": "Q16 Q7", "min_max_avg": "B18", "pivot_fixed": "Q21", "pivot_year_outcome": "B1",
    "flag_counts_pivot": "Q21", "union_distinct": "Q21", "union_all": "Q6", "rank_desc": "Q45",
    "topk_then_nth": "Q71", "nth_value_5": "B3", "ntile_quartiles": "B4", "cume_dist": "B5",
    "serial_number": "Q10", "stable_sample": "Q43", "like_two_part": "Q20", "ilike_contains": "Q27",
    "regex_any": "Q79", "second_word": "Q19", "name_length": "Q44", "bits_chars": "Q69",
    "reverse_palindrome": "Q57 Q64", "concat_null_safe": "Q63 B7", "update_returning": "Q78", "even_odd": "Q38",
    "gcd_lcm": "Q60", "quotient_no_slash": "Q24", "column_difference": "B17", "records_per_entity": "Q26",
    "json_per_entity": "Q77", "entity_digest": "Q40", "array_text": "Q6", "band_value": "Q1",
    "code_labels": "Q13 Q12", "add_drop_column": "Q70 Q73", "update_from_join": "Q2 Q13", "stack_child": "Q35",
    "range_lookup": "Q6", "lookup_or_report": "Q42", "delete_guard": "Q22", "constrained_ingest": "Q56",
    "inline_rows_appended": "Q35", "sink_round_trip": "Q35", "text_against_number": "Q51 B5", "letters_by_place": "Q25",
    "days_to_today": "Q16", "null_counts": "B2", "null_ranks": "B4", "first_value_record": "B2", "null_keys_joined": "B7",
    "distinct_rollup": "B7", "linked_closure": "Q80", "month_patch": "Q2 Q13", "alert_once": "Q75", "publish_change": "Q22",
    "stratified_sample": "Q43", "nth_value_records": "B3", "sql_current_age": "Q1", "sql_unique_per_prefix": "Q20",
    "sql_share": "Q6", "alerts": "Q75", "oxygen_style_filter": "Q31", "threshold_list": "Q49", "flagged_count_two_keys": "B16",
}
