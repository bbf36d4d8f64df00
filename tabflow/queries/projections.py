"""Projections, filters and derived columns (survey 2.2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabflow.functions.codes import decode, decode_many
from tabflow.functions.columns import (band, days_between, half_open, miles_to_km, minutes_between,
                                      safe_ratio)
from tabflow.operators.aggregates import decimal_mean
from tabflow.queries.registry import query, tbl

# Stand-in code tables for the star schema (order status, part type groups).
ORDER_STATUS = {"F": "fulfilled", "O": "open", "P": "partial"}
ORDER_STATUS_DEFAULT = "unknown"
RETURN_FLAG = {"A": "accepted", "N": "none", "R": "returned"}
RETURN_FLAG_DEFAULT = "unknown"
PART_GROUPS = {"budget": ["ECONOMY", "STANDARD"], "promo": ["PROMO"], "bulk": ["LARGE", "MEDIUM"]}
PART_GROUP_DEFAULT = "other"


@query("project_cols", "B1", sql="SELECT l_orderkey, l_partkey, l_suppkey, l_quantity FROM lineitem")
def project_cols(spark, sf):
    cols = ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity"]
    return tbl(spark, sf, "lineitem").select(*cols)


@query("project_expr", "B2", sql="""
SELECT l_orderkey AS order_key, l_linenumber AS line_no, l_extendedprice AS amount,
       l_extendedprice * l_discount AS discount_amount, 100 * l_discount AS discount_pct
FROM lineitem
""")
def project_expr(spark, sf):
    return tbl(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias("line_no"),
        F.col("l_extendedprice").alias("amount"),
        F.expr("l_extendedprice * l_discount").alias("discount_amount"),
        F.expr("100 * l_discount").alias("discount_pct"))


@query("derive_cols", "B3 B15 B16", sql="""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       l_extendedprice * (1 - l_discount) AS net_price,
       l_extendedprice * (1 - l_discount) * (1 + l_tax) AS gross_price,
       'lineitem' AS source_table, trim(l_returnflag) AS flag
FROM lineitem
""")
def derive_cols(spark, sf):
    li = tbl(spark, sf, "lineitem")
    return (li.withColumns({
                "net_price": F.col("l_extendedprice") * (1 - F.col("l_discount")),
                "source_table": F.lit("lineitem"),
                "flag": F.trim(F.col("l_returnflag")),
            })
            .withColumn("gross_price", F.col("net_price") * (1 + F.col("l_tax")))
            .drop("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                  "l_linestatus", "l_shipdate"))


@query("filter_valid", "B4", sql="""
SELECT * FROM lineitem
WHERE l_quantity > 0 AND l_extendedprice > 0 AND l_discount <= 0.05
""")
def filter_valid(spark, sf):
    c = F.col
    return tbl(spark, sf, "lineitem").filter(
        (c("l_quantity") > 0) & (c("l_extendedprice") > 0) & (c("l_discount") <= 0.05))


@query("filter_or_not", "B5", sql="""
SELECT * FROM lineitem
WHERE (l_returnflag = 'R' OR l_linestatus = 'O') AND NOT (l_discount > 0.08)
""")
def filter_or_not(spark, sf):
    c = F.col
    return tbl(spark, sf, "lineitem").where(
        ((c("l_returnflag") == "R") | (c("l_linestatus") == "O")) & ~(c("l_discount") > 0.08))


@query("filter_isin_notnull", "B6", sql="""
SELECT * FROM orders
WHERE o_custkey IS NOT NULL AND o_orderpriority IN ('1-URGENT', '2-HIGH')
  AND o_totalprice BETWEEN 10000 AND 200000
""")
def filter_isin_notnull(spark, sf):
    c = F.col
    return tbl(spark, sf, "orders").filter(
        c("o_custkey").isNotNull() & c("o_orderpriority").isin("1-URGENT", "2-HIGH")
        & c("o_totalprice").between(10000, 200000))


@query("filter_time_range", "B7", sql="""
SELECT * FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-01-01 00:00:00' AND o_orderdate < TIMESTAMP '1996-02-01 00:00:00'
""")
def filter_time_range(spark, sf):
    return tbl(spark, sf, "orders").filter(half_open("o_orderdate", "1996-01-01", "1996-02-01"))


@query("band_counts", "B8", sql="""
SELECT CASE WHEN l_quantity < 10 THEN 'small' WHEN l_quantity < 30 THEN 'medium' ELSE 'large' END AS size_band,
       count(*) AS n_rows
FROM lineitem GROUP BY 1
""")
def band_counts(spark, sf):
    li = tbl(spark, sf, "lineitem")
    return (li.groupBy(band("l_quantity", [10, 30], ["small", "medium", "large"]).alias("size_band"))
            .agg(F.count(F.lit(1)).alias("n_rows")))


@query("safe_ratio", "B9 B11", sql="""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN l_quantity > 0 THEN l_extendedprice / l_quantity END AS unit_price,
       CASE WHEN l_tax > 0 THEN l_discount / l_tax END AS discount_per_tax,
       l_quantity * 1.60934 AS quantity_km
FROM lineitem
""")
def safe_ratio_q(spark, sf):
    li = tbl(spark, sf, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        safe_ratio("l_extendedprice", "l_quantity").alias("unit_price"),
        safe_ratio("l_discount", "l_tax").alias("discount_per_tax"),
        miles_to_km("l_quantity").alias("quantity_km"))


@query("order_to_ship_days", "B10", sql="""
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
       date_diff('second', o.o_orderdate, l.l_shipdate) / 60.0 AS minutes_to_ship,
       date_diff('second', o.o_orderdate, l.l_shipdate) / 86400.0 AS days_to_ship
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
""")
def order_to_ship_days(spark, sf):
    li = tbl(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    od = tbl(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    return j.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    minutes_between("o_orderdate", "l_shipdate").alias("minutes_to_ship"),
                    days_between("o_orderdate", "l_shipdate").alias("days_to_ship"))


@query("decode_status", "B12", sql="""
SELECT CASE o_orderstatus WHEN 'F' THEN 'fulfilled' WHEN 'O' THEN 'open' WHEN 'P' THEN 'partial'
       ELSE 'unknown' END AS status_label, count(*) AS n_orders
FROM orders GROUP BY 1
""")
def decode_status(spark, sf):
    od = tbl(spark, sf, "orders")
    return (od.groupBy(decode("o_orderstatus", ORDER_STATUS, ORDER_STATUS_DEFAULT).alias("status_label"))
            .agg(F.count(F.lit(1)).alias("n_orders")))


@query("decode_many_to_one", "B13", sql="""
SELECT CASE WHEN p_type IN ('ECONOMY', 'STANDARD') THEN 'budget' WHEN p_type IN ('PROMO') THEN 'promo'
            WHEN p_type IN ('LARGE', 'MEDIUM') THEN 'bulk' ELSE 'other' END AS part_group,
       count(*) AS n_parts, round(sum(p_retailprice), 2) / count(p_retailprice) AS avg_price
FROM part GROUP BY 1
""")
def decode_many_to_one(spark, sf):
    p = tbl(spark, sf, "part")
    return (p.groupBy(decode_many("p_type", PART_GROUPS, PART_GROUP_DEFAULT).alias("part_group"))
            .agg(F.count(F.lit(1)).alias("n_parts"), decimal_mean("p_retailprice").alias("avg_price")))


@query("band_with_null", "B14", sql="""
WITH aged AS (
  SELECT CASE WHEN year(o_orderdate) > 1995 AND year(o_orderdate) <= 2000
              THEN 2001 - year(o_orderdate) END AS age_years
  FROM orders)
SELECT CASE WHEN age_years IS NULL THEN 'unknown' WHEN age_years < 2 THEN '0-1'
            WHEN age_years < 4 THEN '2-3' ELSE '4+' END AS age_band,
       count(*) AS n_orders
FROM aged GROUP BY 1
""")
def band_with_null(spark, sf):
    """Age from a year with a plausibility window; implausible -> null ->
    'unknown' band, which is tested first."""
    y = F.year("o_orderdate")
    age = F.when((y > 1995) & (y <= 2000), F.lit(2001) - y)
    od = tbl(spark, sf, "orders").select(age.alias("age_years"))
    return (od.groupBy(band("age_years", [2, 4], ["0-1", "2-3", "4+"], null_label="unknown").alias("age_band"))
            .agg(F.count(F.lit(1)).alias("n_orders")))
