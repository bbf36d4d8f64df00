"""Aggregation queries (survey 2.5) and text counts (G11-G12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabflow.functions.text import distinct_words, word_counts
from tabflow.operators.aggregates import count_by, decimal_mean, decimal_sum, group_stats, top_k
from tabflow.operators.relational import lookup_join
from tabflow.queries.registry import query, tbl
from tabflow.sources.tables import register_views


@query("agg_global", "G1", sql="""
SELECT count(*) AS n_rows, avg(l_quantity) AS avg_qty, max(l_extendedprice) AS max_price,
       round(sum(l_extendedprice), 2) AS sum_price, min(l_shipdate) AS first_ship
FROM lineitem
""")
def agg_global(spark, sf):
    return tbl(spark, sf, "lineitem").agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg("l_quantity").alias("avg_qty"),
        F.max("l_extendedprice").alias("max_price"),
        decimal_sum("l_extendedprice").alias("sum_price"), F.min("l_shipdate").alias("first_ship"))


@query("agg_count_by", "G2", sql="""
SELECT o_orderpriority, count(*) AS n_orders FROM orders GROUP BY o_orderpriority
""")
def agg_count_by(spark, sf):
    return count_by(tbl(spark, sf, "orders"), ["o_orderpriority"], "n_orders")


@query("agg_zone_stats", "G3", sql="""
SELECT l_suppkey, count(*) AS n_lines, round(sum(l_extendedprice), 2) AS revenue,
       round(sum(l_discount), 2) / count(l_discount) AS avg_discount, avg(l_quantity) AS avg_quantity
FROM lineitem GROUP BY l_suppkey
""")
def agg_zone_stats(spark, sf):
    return group_stats(tbl(spark, sf, "lineitem"), ["l_suppkey"], [
        F.count(F.lit(1)).alias("n_lines"), decimal_sum("l_extendedprice").alias("revenue"),
        decimal_mean("l_discount").alias("avg_discount"), F.avg("l_quantity").alias("avg_quantity")])


@query("agg_count_distinct", "G4", sql="""
SELECT o_orderpriority, count(DISTINCT o_custkey) AS n_customers, count(*) AS n_orders
FROM orders GROUP BY o_orderpriority
""")
def agg_count_distinct(spark, sf):
    od = tbl(spark, sf, "orders")
    return od.groupBy("o_orderpriority").agg(F.countDistinct("o_custkey").alias("n_customers"),
                                             F.count(F.lit(1)).alias("n_orders"))


@query("agg_two_keys", "G5", sql="""
SELECT o_orderstatus, o_orderpriority, count(*) AS n_orders
FROM orders GROUP BY o_orderstatus, o_orderpriority
ORDER BY o_orderstatus, n_orders DESC
""")
def agg_two_keys(spark, sf):
    return (count_by(tbl(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"], "n_orders")
            .orderBy("o_orderstatus", F.desc("n_orders")))


_HOUR_SQL = """
SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n_events,
       round(sum(value), 2) / count(value) AS avg_value
FROM events WHERE event_type = 'purchase' GROUP BY 1
"""


@query("agg_by_hour", "G6", sql=_HOUR_SQL)
def agg_by_hour(spark, sf):
    ev = tbl(spark, sf, "events").filter(F.col("event_type") == "purchase")
    return ev.groupBy(F.hour("ts").alias("hour")).agg(F.count(F.lit(1)).alias("n_events"),
                                                       decimal_mean("value").alias("avg_value"))


@query("sql_agg_by_hour", "G6 L6", sql=_HOUR_SQL)
def sql_agg_by_hour(spark, sf):
    """SQL twin of agg_by_hour (same optimized plan, see tests)."""
    register_views(spark, sf, ["events"])
    return spark.sql("""
        SELECT HOUR(ts) AS hour, COUNT(*) AS n_events,
               CAST(SUM(CAST(value AS DECIMAL(28,2))) AS DOUBLE) / COUNT(value) AS avg_value
        FROM events WHERE event_type = 'purchase' GROUP BY HOUR(ts)
    """)


@query("daily_series", "G7", sql="""
SELECT CAST(ts AS DATE) AS day, count(*) AS n_events, round(sum(value), 2) AS total_value
FROM events GROUP BY 1
""")
def daily_series_q(spark, sf):
    from tabflow.operators.windows import daily_series
    return daily_series(tbl(spark, sf, "events"), "ts", [
        F.count(F.lit(1)).alias("n_events"), decimal_sum("value").alias("total_value")])


@query("agg_median", "G8", sql="""
SELECT l_returnflag, quantile_disc(l_extendedprice, 0.5) AS median_price, count(*) AS n_lines
FROM lineitem GROUP BY l_returnflag
""")
def agg_median(spark, sf):
    return group_stats(tbl(spark, sf, "lineitem"), ["l_returnflag"], [
        F.percentile_approx("l_extendedprice", 0.5, 1_000_000).alias("median_price"),
        F.count(F.lit(1)).alias("n_lines")])


@query("agg_having_topk", "G9", sql="""
SELECT l_suppkey, count(*) AS n_lines, round(sum(l_discount), 2) / count(l_discount) AS avg_discount
FROM lineitem GROUP BY l_suppkey HAVING count(*) >= 600
ORDER BY avg_discount DESC, l_suppkey LIMIT 10
""")
def agg_having_topk(spark, sf):
    """HAVING-style floor on the group size, then a global top-10."""
    stats = group_stats(tbl(spark, sf, "lineitem"), ["l_suppkey"],
                        [F.count(F.lit(1)).alias("n_lines"), decimal_mean("l_discount").alias("avg_discount")],
                        having=F.col("n_lines") >= 600)
    return top_k(stats, [F.desc("avg_discount"), F.asc("l_suppkey")], 10)


@query("agg_key_counts", "G10", sql="""
SELECT c_nationkey, count(*) AS n_customers FROM customer
WHERE c_nationkey IS NOT NULL GROUP BY c_nationkey ORDER BY c_nationkey
""")
def agg_key_counts(spark, sf):
    """Key counts with null keys excluded, sorted by key (reduceByKey + sortByKey)."""
    return (count_by(tbl(spark, sf, "customer"), ["c_nationkey"], "n_customers", drop_null_keys=True)
            .orderBy("c_nationkey"))


_WORDS_SQL = """
WITH w AS (SELECT unnest(regexp_split_to_array(lower(text), '\\s+')) AS word FROM documents)
"""


@query("word_count", "G11", sql=_WORDS_SQL + "SELECT word, count(*) AS n FROM w WHERE word <> '' GROUP BY word")
def word_count(spark, sf):
    return word_counts(tbl(spark, sf, "documents"), "text")


@query("word_count_top", "G11 S2", sql=_WORDS_SQL + """
SELECT word, count(*) AS n FROM w WHERE word <> '' GROUP BY word ORDER BY n DESC, word LIMIT 5
""")
def word_count_top(spark, sf):
    return top_k(word_counts(tbl(spark, sf, "documents"), "text"), [F.desc("n"), F.asc("word")], 5)


@query("word_distinct", "G12", sql=_WORDS_SQL + "SELECT count(DISTINCT word) AS n_distinct FROM w WHERE word <> ''")
def word_distinct(spark, sf):
    return distinct_words(tbl(spark, sf, "documents"), "text")


@query("weekday_mean", "G14", sql="""
SELECT CAST(dayofweek(o.o_orderdate) + 1 AS INTEGER) AS weekday,
       avg(date_diff('second', o.o_orderdate, l.l_shipdate)) / 86400.0 AS mean_days_to_ship,
       count(*) AS n_lines
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey GROUP BY 1
""")
def weekday_mean(spark, sf):
    """Mean order-to-ship delay by weekday of the order (1 = Sunday).

    Line items are pre-aggregated per order before the join (count and the
    sum of ship times in epoch seconds, exact integers), so the join sees one
    row per order: sum(ship - ordered) = sum(ship) - n * ordered."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    od = tbl(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    per_order = (tbl(spark, sf, "lineitem")
                 .groupBy("l_orderkey")
                 .agg(F.count(F.lit(1)).alias("n"),
                      F.sum(F.timestamp_diff("SECOND", epoch, F.col("l_shipdate"))).alias("ship_s")))
    j = od.join(per_order, od.o_orderkey == per_order.l_orderkey, "inner")
    delay = F.col("ship_s") - F.col("n") * F.timestamp_diff("SECOND", epoch, F.col("o_orderdate"))
    return j.groupBy(F.dayofweek("o_orderdate").alias("weekday")).agg(
        (F.sum(delay) / F.sum("n") / 86400.0).alias("mean_days_to_ship"),
        F.sum("n").alias("n_lines"))


@query("top_pairs", "G14", sql="""
SELECT s.s_nationkey AS from_nation, c.c_nationkey AS to_nation, count(*) AS n_lines
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
GROUP BY 1, 2 ORDER BY n_lines DESC, from_nation, to_nation LIMIT 10
""")
def top_pairs(spark, sf):
    """Top-10 (supplier nation -> customer nation) flows."""
    li = tbl(spark, sf, "lineitem").select("l_orderkey", "l_suppkey")
    od = tbl(spark, sf, "orders").select("o_orderkey", "o_custkey")
    cu = tbl(spark, sf, "customer").select("c_custkey", "c_nationkey")
    su = tbl(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    j = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    j = lookup_join(j, cu, left_on="o_custkey", right_on="c_custkey", how="inner")
    j = lookup_join(j, su, left_on="l_suppkey", right_on="s_suppkey", how="inner")
    pairs = j.groupBy(F.col("s_nationkey").alias("from_nation"), F.col("c_nationkey").alias("to_nation")) \
        .agg(F.count(F.lit(1)).alias("n_lines"))
    return top_k(pairs, [F.desc("n_lines"), F.asc("from_nation"), F.asc("to_nation")], 10)


Z_THRESHOLD = 1.75


@query("anomaly_zscore", "G14", sql="""
WITH s AS (SELECT l_suppkey, avg(l_extendedprice) AS mu, stddev_samp(l_extendedprice) AS sd
           FROM lineitem GROUP BY l_suppkey)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice,
       round((l.l_extendedprice - s.mu) / s.sd, 9) AS zscore
FROM lineitem l JOIN s ON l.l_suppkey = s.l_suppkey
WHERE s.sd > 0 AND abs((l.l_extendedprice - s.mu) / s.sd) >= 1.75
""")
def anomaly_zscore(spark, sf):
    """Price anomalies: |z| >= 1.75 against the supplier's mean and stddev
    (prices are bounded, the largest |z| is about 1.9). Group stats are
    partial aggregates joined back (no window over a group)."""
    li = tbl(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                           "l_extendedprice")
    stats = li.groupBy("l_suppkey").agg(F.avg("l_extendedprice").alias("mu"),
                                        F.stddev_samp("l_extendedprice").alias("sd"))
    z = (F.col("l_extendedprice") - F.col("mu")) / F.col("sd")
    return (li.join(stats, on="l_suppkey", how="inner").filter(F.col("sd") > 0)
            .withColumn("zscore", z).filter(F.abs(F.col("zscore")) >= Z_THRESHOLD)
            .withColumn("zscore", F.round("zscore", 9))
            .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "zscore"))


@query("best_rated_min_votes", "G14", sql="""
SELECT l.l_partkey, p.p_name, count(*) AS n_votes, avg(l.l_quantity) / 5 AS avg_rating
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY l.l_partkey, p.p_name HAVING count(*) >= 40
ORDER BY avg_rating DESC, l.l_partkey LIMIT 10
""")
def best_rated_min_votes(spark, sf):
    """Best-rated items with a vote floor (a line's rating = quantity / 5,
    on a 0-10 scale)."""
    li = tbl(spark, sf, "lineitem").select("l_partkey", "l_quantity")
    stats = group_stats(li, ["l_partkey"], [F.count(F.lit(1)).alias("n_votes"),
                                            (F.avg("l_quantity") / 5).alias("avg_rating")],
                        having=F.col("n_votes") >= 40)
    pa = tbl(spark, sf, "part").select("p_partkey", "p_name")
    best = top_k(stats, [F.desc("avg_rating"), F.asc("l_partkey")], 10)
    return (best.join(pa, best.l_partkey == pa.p_partkey, "left")
            .select("l_partkey", "p_name", "n_votes", "avg_rating"))
