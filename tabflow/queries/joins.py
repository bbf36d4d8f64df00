"""Join queries (survey 2.4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabflow.functions.columns import half_open
from tabflow.operators.aggregates import decimal_sum, pivot_counts
from tabflow.operators.relational import lookup_join
from tabflow.operators.skew import salted_agg, skew_report
from tabflow.queries.registry import query, tbl
from tabflow.sources.tables import register_views


@query("join_inner_lookup", "D1", sql="""
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, s.s_name, s.s_nationkey, l.l_extendedprice
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
""")
def join_inner_lookup(spark, sf):
    li = tbl(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                           "l_extendedprice")
    su = tbl(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return (lookup_join(li, su, left_on="l_suppkey", right_on="s_suppkey", how="inner")
            .drop("s_suppkey"))


@query("join_left_lookup", "D2", sql="""
SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, c.c_name, c.c_mktsegment
FROM orders o LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment = 'BUILDING') c
  ON o.o_custkey = c.c_custkey
""")
def join_left_lookup(spark, sf):
    """Left lookup then project (keeps every order; null labels when unmatched)."""
    od = tbl(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    cu = tbl(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING") \
        .select("c_custkey", "c_name", "c_mktsegment")
    return (lookup_join(od, cu, left_on="o_custkey", right_on="c_custkey", how="left")
            .select("o_orderkey", "o_custkey", "o_totalprice", "c_name", "c_mktsegment"))


@query("join_left_anti", "D3", sql="""
SELECT c.* FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey
                  AND o.o_orderpriority = '1-URGENT'
                  AND o.o_orderdate >= TIMESTAMP '1996-01-01 00:00:00'
                  AND o.o_orderdate < TIMESTAMP '1997-01-01 00:00:00')
""")
def join_left_anti(spark, sf):
    """Customers with no urgent order in 1996."""
    urgent = (tbl(spark, sf, "orders")
              .filter((F.col("o_orderpriority") == "1-URGENT")
                      & half_open("o_orderdate", "1996-01-01", "1997-01-01"))
              .select("o_custkey"))
    cu = tbl(spark, sf, "customer")
    return cu.join(urgent, cu.c_custkey == urgent.o_custkey, "left_anti")


@query("join_using", "D4", sql="""
SELECT o.o_orderkey AS order_key, o.o_orderdate, o.o_orderpriority, l.l_linenumber, l.l_partkey,
       l.l_suppkey, l.l_extendedprice
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
""")
def join_using(spark, sf):
    """Inner join USING one same-named key (a single key column in the output)."""
    od = tbl(spark, sf, "orders").select(F.col("o_orderkey").alias("order_key"), "o_orderdate",
                                         "o_orderpriority")
    li = tbl(spark, sf, "lineitem").select(F.col("l_orderkey").alias("order_key"), "l_linenumber",
                                           "l_partkey", "l_suppkey", "l_extendedprice")
    return od.join(li, on="order_key", how="inner")


@query("join_three_way", "D5", sql="""
SELECT n.n_name, r.r_name, s.s_name, count(*) AS n_lines, round(sum(l.l_extendedprice), 2) AS revenue
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY n.n_name, r.r_name, s.s_name
""")
def join_three_way(spark, sf):
    """Chain of lookups (supplier -> nation -> region) after pre-aggregating
    the facts per supplier, so the joins see one row per supplier."""
    per_supp = (tbl(spark, sf, "lineitem").groupBy("l_suppkey")
                .agg(F.count(F.lit(1)).alias("n_lines"), F.sum(F.col("l_extendedprice").cast("decimal(28,2)")).alias("rev")))
    su = tbl(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    na = tbl(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    rg = tbl(spark, sf, "region").select("r_regionkey", "r_name")
    j = (lookup_join(per_supp, su, left_on="l_suppkey", right_on="s_suppkey", how="inner")
         .join(na, F.col("s_nationkey") == F.col("n_nationkey"), "inner")
         .join(rg, F.col("n_regionkey") == F.col("r_regionkey"), "inner"))
    return (j.groupBy("n_name", "r_name", "s_name")
            .agg(F.sum("n_lines").alias("n_lines"), F.sum("rev").cast("double").alias("revenue")))


@query("join_full_outer", "D6", sql="""
WITH b AS (SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'),
     m AS (SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total
           FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01 00:00:00'
             AND o_orderdate < TIMESTAMP '1996-04-01 00:00:00' GROUP BY o_custkey)
SELECT b.c_custkey, b.c_name, m.o_custkey, m.n_orders, m.total
FROM b FULL OUTER JOIN m ON b.c_custkey = m.o_custkey
""")
def join_full_outer(spark, sf):
    b = tbl(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_name")
    m = (tbl(spark, sf, "orders").filter(half_open("o_orderdate", "1996-01-01", "1996-04-01"))
         .groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"),
                                   decimal_sum("o_totalprice").alias("total")))
    return b.join(m, b.c_custkey == m.o_custkey, "full_outer")


@query("join_right_outer", "D6", sql="""
SELECT c.c_custkey, c.c_name, o.o_orderkey, o.o_custkey
FROM (SELECT * FROM customer WHERE c_mktsegment = 'BUILDING') c
RIGHT JOIN (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01 00:00:00'
            AND o_orderdate < TIMESTAMP '1996-02-01 00:00:00') o ON c.c_custkey = o.o_custkey
""")
def join_right_outer(spark, sf):
    c = tbl(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_name")
    o = tbl(spark, sf, "orders").filter(half_open("o_orderdate", "1996-01-01", "1996-02-01")) \
        .select("o_orderkey", "o_custkey")
    return c.join(o, c.c_custkey == o.o_custkey, "right")


_BY_TYPE_SQL = """
SELECT p.p_type, count(*) AS n_lines, round(sum(l.l_extendedprice), 2) AS revenue
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY p.p_type
"""


def _lines_by_part_type(spark, sf, strategy):
    li = tbl(spark, sf, "lineitem").select("l_partkey", "l_extendedprice")
    pa = tbl(spark, sf, "part").select("p_partkey", "p_type")
    j = lookup_join(li, pa, left_on="l_partkey", right_on="p_partkey", how="inner", strategy=strategy)
    return j.groupBy("p_type").agg(F.count(F.lit(1)).alias("n_lines"),
                                   decimal_sum("l_extendedprice").alias("revenue"))


@query("join_broadcast", "D7", sql=_BY_TYPE_SQL)
def join_broadcast(spark, sf):
    """Broadcast hash join, only after the part table's size is proven bounded."""
    return _lines_by_part_type(spark, sf, "broadcast")


@query("join_sortmerge", "D8", sql=_BY_TYPE_SQL)
def join_sortmerge(spark, sf):
    """Sort-merge join by per-join hint (no session-wide threshold change)."""
    return _lines_by_part_type(spark, sf, "merge")


@query("sql_agg_join", "D9", sql="""
SELECT s.s_name, s.s_nationkey, a.l_suppkey, a.n_lines, a.revenue
FROM (SELECT l_suppkey, count(*) AS n_lines, round(sum(l_extendedprice), 2) AS revenue
      FROM lineitem GROUP BY l_suppkey) a
LEFT JOIN supplier s ON a.l_suppkey = s.s_suppkey
""")
def sql_agg_join(spark, sf):
    register_views(spark, sf, ["lineitem", "supplier"])
    return spark.sql("""
        SELECT s.s_name, s.s_nationkey, a.l_suppkey, a.n_lines, a.revenue
        FROM (SELECT l_suppkey, COUNT(*) AS n_lines, ROUND(SUM(l_extendedprice), 2) AS revenue
              FROM lineitem GROUP BY l_suppkey) AS a
        LEFT JOIN supplier AS s ON a.l_suppkey = s.s_suppkey
    """)


@query("rollup_region_revenue", "D10", sql="""
WITH per_supp AS (SELECT l_suppkey, count(*) AS n, sum(l_extendedprice) AS rev FROM lineitem GROUP BY l_suppkey)
SELECT r.r_name, count(*) AS n_suppliers, CAST(sum(p.n) AS BIGINT) AS n_lines, round(sum(p.rev), 2) AS revenue
FROM per_supp p JOIN supplier s ON p.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY r.r_name
""")
def rollup_region_revenue(spark, sf):
    """Aggregate -> join -> aggregate to a coarser level, carrying exact
    decimal sums until the end."""
    per_supp = (tbl(spark, sf, "lineitem").groupBy("l_suppkey")
                .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("l_extendedprice").cast("decimal(28,2)")).alias("rev")))
    su = tbl(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    na = tbl(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    rg = tbl(spark, sf, "region").select("r_regionkey", "r_name")
    j = (per_supp.join(su, per_supp.l_suppkey == su.s_suppkey, "inner")
         .join(na, F.col("s_nationkey") == F.col("n_nationkey"), "inner")
         .join(rg, F.col("n_regionkey") == F.col("r_regionkey"), "inner"))
    return j.groupBy("r_name").agg(F.count(F.lit(1)).alias("n_suppliers"),
                                   F.sum("n").alias("n_lines"),
                                   F.sum("rev").cast("double").alias("revenue"))


@query("crosstab_pivot", "D12", sql="""
SELECT o.o_orderpriority,
       count(*) FILTER (WHERE l.l_returnflag = 'A') AS "A",
       count(*) FILTER (WHERE l.l_returnflag = 'N') AS "N",
       count(*) FILTER (WHERE l.l_returnflag = 'R') AS "R"
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
GROUP BY o.o_orderpriority
""")
def crosstab_pivot(spark, sf):
    """Lines per (order priority x return flag). The line counts per flag are
    pre-aggregated per order (map-side partial aggregation, output already
    hash-partitioned on the order key), so the join sees one row per order
    and only the orders side is shuffled for it."""
    flags = ["A", "N", "R"]
    od = tbl(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    per_order = pivot_counts(tbl(spark, sf, "lineitem").select("l_orderkey", "l_returnflag"),
                             ["l_orderkey"], "l_returnflag", flags)
    j = od.join(per_order, od.o_orderkey == per_order.l_orderkey, "inner")
    return j.groupBy("o_orderpriority").agg(*[F.sum(f).cast("bigint").alias(f) for f in flags])


@query("crosstab_pivot_api", "D12", sql="""
SELECT o_orderstatus,
       count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS "1-URGENT",
       count(*) FILTER (WHERE o_orderpriority = '2-HIGH') AS "2-HIGH",
       count(*) FILTER (WHERE o_orderpriority = '3-MEDIUM') AS "3-MEDIUM",
       count(*) FILTER (WHERE o_orderpriority = '4-NOT SPECIFIED') AS "4-NOT SPECIFIED",
       count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS "5-LOW"
FROM orders GROUP BY o_orderstatus
""")
def crosstab_pivot_api(spark, sf):
    """The same cross-tab with ``groupBy().pivot(col, values)``."""
    values = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    out = (tbl(spark, sf, "orders").groupBy("o_orderstatus")
           .pivot("o_orderpriority", values).agg(F.count(F.lit(1))))
    return out.select("o_orderstatus", *[F.coalesce(F.col(f"`{v}`"), F.lit(0)).cast("bigint").alias(v)
                                         for v in values])


@query("skew_salted_agg", "D13", sql="""
SELECT l_returnflag, count(*) AS n_lines, round(sum(l_extendedprice), 2) AS revenue,
       min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price
FROM lineitem GROUP BY l_returnflag
""")
def skew_salted_agg(spark, sf):
    """A key holding a third of all rows (return flag), aggregated in two
    salted stages; equals the plain aggregate."""
    li = tbl(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                           "l_returnflag", "l_extendedprice")
    out = salted_agg(li, ["l_returnflag"], [("count", "*", "n_lines"), ("sum", "l_extendedprice", "revenue"),
                                            ("min", "l_extendedprice", "min_price"),
                                            ("max", "l_extendedprice", "max_price")],
                     salts=16, salt_cols=["l_orderkey", "l_linenumber", "l_partkey"])
    return out.withColumn("revenue", F.round("revenue", 2))


@query("skew_report", "D13", sql="""
WITH c AS (SELECT l_returnflag, l_linestatus, count(*) AS n_rows FROM lineitem GROUP BY 1, 2)
SELECT l_returnflag, l_linestatus, n_rows,
       100.0 * n_rows / (SELECT sum(n_rows) FROM c) AS share_pct,
       n_rows * (SELECT count(*) FROM c) / (SELECT sum(n_rows) FROM c) AS ratio_to_mean
FROM c
""")
def skew_report_q(spark, sf):
    li = tbl(spark, sf, "lineitem").select("l_returnflag", "l_linestatus")
    return skew_report(li, ["l_returnflag", "l_linestatus"])
