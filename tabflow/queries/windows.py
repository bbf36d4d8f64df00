"""Window queries (survey 2.6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabflow.operators.aggregates import decimal_sum
from tabflow.operators.windows import (daily_series, moving_average, range_window_sum, share_of_total,
                                       top_n_per_group, with_next, with_previous, with_ranks)
from tabflow.operators.ranking import ranks_skew_safe, ranks_within_groups
from tabflow.queries.registry import query, tbl

# total order for lineitem rows (l_orderkey, l_linenumber alone is not unique)
LINE_TIES = ["l_orderkey", "l_linenumber", "l_partkey"]


@query("win_top3", "W1", sql="""
SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_extendedprice, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY l_suppkey
         ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey) AS rank
  FROM lineitem) WHERE rank <= 3
""")
def win_top3(spark, sf):
    li = tbl(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey",
                                           "l_extendedprice")
    return top_n_per_group(li, ["l_suppkey"], [F.desc("l_extendedprice"), *LINE_TIES], 3)


_RANKS_SQL = """
SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_quantity,
       row_number() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC, l_orderkey, l_linenumber, l_partkey) AS row_number,
       rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC) AS rank,
       dense_rank() OVER (PARTITION BY l_suppkey ORDER BY l_quantity DESC) AS dense_rank
FROM lineitem
"""


@query("win_ranks", "W2", sql=_RANKS_SQL)
def win_ranks(spark, sf):
    """row_number vs rank vs dense_rank on tied quantities."""
    li = tbl(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return ranks_within_groups(li, ["l_suppkey"], "l_quantity", True, [F.asc(c) for c in LINE_TIES])


@query("win_ranks_skew_safe", "W2 D13", sql="""
SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC, l_orderkey, l_linenumber,
                             l_partkey, l_suppkey, l_extendedprice, l_discount, l_tax, l_linestatus, l_shipdate) AS row_number,
       rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC) AS rank,
       dense_rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC) AS dense_rank
FROM lineitem
""")
def win_ranks_skew_safe(spark, sf):
    """The range-partitioned rank path on a key of three values, with all payload columns."""
    li = tbl(spark, sf, "lineitem")
    ties = [*LINE_TIES, *[c for c in li.columns if c not in (*LINE_TIES, "l_quantity", "l_returnflag")]]
    return ranks_skew_safe(li, ["l_returnflag"], "l_quantity", True, [F.asc(c) for c in ties])


@query("win_ranks_window", "W2", sql=_RANKS_SQL)
def win_ranks_window(spark, sf):
    """Same ranks through ``with_ranks``, the window functions."""
    li = tbl(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return with_ranks(li, ["l_suppkey"], [F.desc("l_quantity")], [F.asc(c) for c in LINE_TIES])


def _daily(spark, sf):
    return daily_series(tbl(spark, sf, "events"), "ts",
                        [F.count(F.lit(1)).alias("n_events"), decimal_sum("value").alias("revenue")])


_DAILY_SQL = """
WITH d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n_events, round(sum(value), 2) AS revenue
           FROM events GROUP BY 1)
"""


@query("win_lag_pct", "W3", sql=_DAILY_SQL + """
SELECT day, n_events, revenue, lag(revenue) OVER (ORDER BY day) AS prev_revenue,
       revenue - lag(revenue) OVER (ORDER BY day) AS delta_revenue,
       CASE WHEN lag(revenue) OVER (ORDER BY day) <> 0
            THEN 100.0 * (revenue - lag(revenue) OVER (ORDER BY day)) / lag(revenue) OVER (ORDER BY day)
       END AS pct_revenue
FROM d
""")
def win_lag_pct(spark, sf):
    """Previous day, difference, % change on a pre-aggregated daily series."""
    return with_previous(_daily(spark, sf), "day", "revenue")


@query("win_lead", "W4", sql=_DAILY_SQL + """
SELECT day, n_events, revenue, lead(revenue) OVER (ORDER BY day) AS next_revenue FROM d
""")
def win_lead(spark, sf):
    return with_next(_daily(spark, sf), "day", "revenue")


@query("win_moving_avg", "W5", sql=_DAILY_SQL + """
SELECT day, n_events, revenue,
       round(sum(revenue) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 2)
         / count(revenue) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS ma7_revenue
FROM d
""")
def win_moving_avg(spark, sf):
    return moving_average(_daily(spark, sf), "day", "revenue", rows=7, scale=2)


@query("win_share_of_total", "W6", sql="""
WITH ranked AS (
  SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_extendedprice,
         row_number() OVER (PARTITION BY l_suppkey
                            ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey) AS rank,
         round(sum(l_extendedprice) OVER (PARTITION BY l_suppkey), 2) AS group_total
  FROM lineitem)
SELECT r.l_suppkey, r.l_orderkey, r.l_linenumber, r.l_partkey, r.l_extendedprice, r.rank,
       r.group_total, 100.0 * r.l_extendedprice / r.group_total AS share_pct, s.s_name
FROM ranked r LEFT JOIN supplier s ON r.l_suppkey = s.s_suppkey
WHERE r.rank <= 3
""")
def win_share_of_total(spark, sf):
    """Share of the supplier total for its top-3 lines, plus supplier name."""
    li = tbl(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey",
                                           "l_extendedprice")
    top = top_n_per_group(li, ["l_suppkey"], [F.desc("l_extendedprice"), *LINE_TIES], 3)
    totals = li.groupBy("l_suppkey").agg(decimal_sum("l_extendedprice").alias("group_total"))
    su = tbl(spark, sf, "supplier").select("s_suppkey", "s_name")
    return (top.join(totals, on="l_suppkey", how="inner")
            .withColumn("share_pct", F.lit(100.0) * F.col("l_extendedprice") / F.col("group_total"))
            .join(su, F.col("l_suppkey") == su.s_suppkey, "left").drop("s_suppkey"))


@query("win_share_rows", "W6", sql="""
SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_extendedprice,
       round(sum(l_extendedprice) OVER (PARTITION BY l_suppkey), 2) AS group_total,
       100.0 * l_extendedprice / round(sum(l_extendedprice) OVER (PARTITION BY l_suppkey), 2) AS share_pct
FROM lineitem
""")
def win_share_rows(spark, sf):
    """Every row's share of its group total (group totals joined back)."""
    li = tbl(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey",
                                           "l_extendedprice")
    return share_of_total(li, ["l_suppkey"], "l_extendedprice", scale=2)


@query("win_top5_per_month", "W7", sql="""
WITH m AS (SELECT CAST(month(l_shipdate) AS INTEGER) AS ship_month, l_suppkey,
                  round(sum(l_extendedprice), 2) AS revenue
           FROM lineitem GROUP BY 1, 2)
SELECT ship_month, l_suppkey, revenue, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY ship_month ORDER BY revenue DESC, l_suppkey) AS rank FROM m)
WHERE rank <= 5
""")
def win_top5_per_month(spark, sf):
    """Aggregate first (month x supplier), then top-5 per month."""
    m = (tbl(spark, sf, "lineitem")
         .groupBy(F.month("l_shipdate").alias("ship_month"), "l_suppkey")
         .agg(decimal_sum("l_extendedprice").alias("revenue")))
    return top_n_per_group(m, ["ship_month"], [F.desc("revenue"), F.asc("l_suppkey")], 5)


@query("win_range_7d", "W8", sql="""
WITH d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n_events, round(sum(value), 2) AS revenue
           FROM events WHERE event_type = 'purchase' AND value > 20 GROUP BY 1)
SELECT day, n_events, revenue,
       round(sum(revenue) OVER (ORDER BY day RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW), 2) AS sum7d_revenue,
       count(*) OVER (ORDER BY day RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) AS n7d_days
FROM d
""")
def win_range_7d(spark, sf):
    """Calendar 7-day window (value range on the day number), gap-safe."""
    ev = tbl(spark, sf, "events").filter((F.col("event_type") == "purchase") & (F.col("value") > 20))
    d = daily_series(ev, "ts", [F.count(F.lit(1)).alias("n_events"),
                                decimal_sum("value").alias("revenue")])
    out = range_window_sum(d, "day", "revenue", days=7)
    return out.withColumn("sum7d_revenue", F.round("sum7d_revenue", 2))  # sums of cents
