"""Data-quality queries (survey 2.3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabflow.functions.columns import half_open
from tabflow.operators.quality import (dedupe_by_key, distinct_rows, drop_nulls, fill_nulls,
                                       profile_numeric, step_counts, within_bounds)
from tabflow.operators.relational import orphans
from tabflow.queries.registry import query, tbl


def _customers_with_month_orders(spark, sf):
    """customer LEFT JOIN orders of January 1996: nulls for customers without one."""
    cu = tbl(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    od = (tbl(spark, sf, "orders").filter(half_open("o_orderdate", "1996-01-01", "1996-02-01"))
          .select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"))
    return cu.join(od, cu.c_custkey == od.o_custkey, "left")


_LEFT_JAN96 = """
FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey
 AND o.o_orderdate >= TIMESTAMP '1996-01-01 00:00:00' AND o.o_orderdate < TIMESTAMP '1996-02-01 00:00:00'
"""


@query("dq_drop_null", "Q1", sql=f"""
SELECT c.c_custkey, c.c_name, c.c_nationkey, o.o_orderkey, o.o_custkey, o.o_totalprice, o.o_orderstatus
{_LEFT_JAN96}
WHERE o.o_orderkey IS NOT NULL AND o.o_totalprice IS NOT NULL
""")
def dq_drop_null(spark, sf):
    return drop_nulls(_customers_with_month_orders(spark, sf), ["o_orderkey", "o_totalprice"])


@query("dq_fill_null", "Q2", sql=f"""
SELECT c.c_custkey, c.c_name, c.c_nationkey, coalesce(o.o_orderkey, -1) AS o_orderkey,
       coalesce(o.o_custkey, -1) AS o_custkey, coalesce(o.o_totalprice, 0.0) AS o_totalprice,
       coalesce(o.o_orderstatus, 'none') AS o_orderstatus
{_LEFT_JAN96}
""")
def dq_fill_null(spark, sf):
    return fill_nulls(_customers_with_month_orders(spark, sf),
                      {"o_orderkey": -1, "o_custkey": -1, "o_totalprice": 0.0, "o_orderstatus": "none"})


@query("dq_distinct_rows", "Q3", sql="""
SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem
""")
def dq_distinct_rows(spark, sf):
    return distinct_rows(tbl(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus"))


@query("dq_dedupe_key", "Q4", sql="""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey
                               ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders) WHERE rn = 1
""")
def dq_dedupe_key(spark, sf):
    """Latest order per customer; the survivor does not depend on partitioning."""
    od = tbl(spark, sf, "orders")
    return dedupe_by_key(od, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])


@query("dq_bounds", "Q5", sql="""
SELECT * FROM lineitem
WHERE l_quantity >= 5 AND l_quantity <= 45
  AND l_extendedprice > 1000 AND l_extendedprice < 90000
  AND l_discount >= 0.01 AND l_discount < 0.09
""")
def dq_bounds(spark, sf):
    return within_bounds(tbl(spark, sf, "lineitem"), {
        "l_quantity": (5, 45, "both"),
        "l_extendedprice": (1000, 90000, "neither"),
        "l_discount": (0.01, 0.09, "left"),
    })


_STEPS_SQL = """
SELECT 0 AS step_no, 'raw' AS step, count(*) AS n_rows FROM lineitem
UNION ALL SELECT 1, 'positive_quantity', count(*) FROM lineitem WHERE l_quantity > 0
UNION ALL SELECT 2, 'price_in_bounds', count(*) FROM lineitem
  WHERE l_quantity > 0 AND l_extendedprice >= 1000 AND l_extendedprice <= 90000
UNION ALL SELECT 3, 'shipped_before_2001', count(*) FROM lineitem
  WHERE l_quantity > 0 AND l_extendedprice >= 1000 AND l_extendedprice <= 90000
    AND l_shipdate < TIMESTAMP '2001-01-01 00:00:00'
UNION ALL SELECT 4, 'small_discount', count(*) FROM lineitem
  WHERE l_quantity > 0 AND l_extendedprice >= 1000 AND l_extendedprice <= 90000
    AND l_shipdate < TIMESTAMP '2001-01-01 00:00:00' AND l_discount <= 0.06
"""


@query("dq_step_counts", "Q6", sql=_STEPS_SQL)
def dq_step_counts(spark, sf):
    """Rows left after each cumulative cleaning step, from ONE scan."""
    c = F.col
    return step_counts(tbl(spark, sf, "lineitem"), [
        ("positive_quantity", c("l_quantity") > 0),
        ("price_in_bounds", c("l_extendedprice").between(1000, 90000)),
        ("shipped_before_2001", c("l_shipdate") < F.lit("2001-01-01 00:00:00").cast("timestamp_ntz")),
        ("small_discount", c("l_discount") <= 0.06),
    ])


@query("profile_numeric", "Q7", sql="\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count({c}) AS n, avg({c}) AS mean, stddev_samp({c}) AS stddev, "
    f"min({c}) AS min_value, max({c}) AS max_value FROM lineitem"
    for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")))
def profile_numeric_q(spark, sf):
    return profile_numeric(tbl(spark, sf, "lineitem"),
                           ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


@query("orphan_keys", "Q9", sql="""
SELECT l.l_partkey, count(*) AS n_lines
FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey AND p.p_size <= 40)
GROUP BY l.l_partkey
""")
def orphan_keys(spark, sf):
    """Facts whose key is missing from a (filtered) lookup, counted per key."""
    li = tbl(spark, sf, "lineitem").select("l_partkey")
    parts = tbl(spark, sf, "part").filter(F.col("p_size") <= 40)
    return (orphans(li, parts, "l_partkey", "p_partkey")
            .groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n_lines")))


@query("profile_summary", "Q7")
def profile_summary(spark, sf):
    """``summary()`` with quartiles (string-typed, as Spark returns it); the
    typed profile is ``profile_numeric``."""
    li = tbl(spark, sf, "lineitem").select("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    return li.summary("count", "mean", "stddev", "min", "25%", "50%", "75%", "max")
