"""Sort / top-k / distinct / sampling (survey 2.7) and scalar functions (2.8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabflow.operators.aggregates import decimal_mean, decimal_sum, group_stats, top_k
from tabflow.operators.relational import lookup_join
from tabflow.operators.sampling import hash_split, sample_seeded
from tabflow.queries.registry import query, tbl

FLAGSHIP_SQL = """
SELECT a.l_suppkey, s.s_name, n.n_name, a.n_lines, a.revenue, a.net_revenue, a.avg_discount, a.avg_quantity
FROM (SELECT l_suppkey, count(*) AS n_lines, round(sum(l_extendedprice), 2) AS revenue,
             round(sum(l_extendedprice * (1 - l_discount)), 4) AS net_revenue,
             round(sum(l_discount), 2) / count(l_discount) AS avg_discount, avg(l_quantity) AS avg_quantity
      FROM lineitem
      WHERE l_quantity > 0 AND l_extendedprice > 0 AND l_discount >= 0 AND l_discount <= 1
      GROUP BY l_suppkey) a
LEFT JOIN supplier s ON a.l_suppkey = s.s_suppkey
LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
ORDER BY a.revenue DESC, a.l_suppkey LIMIT 10
"""


def supplier_revenue_report(spark, sf, k: int = 10):
    """Flagship report: clean facts -> per-supplier stats -> supplier/nation
    lookup -> top-k by revenue. The facts are aggregated before any join, so
    the lookups only ever see one row per supplier; the final top-k is a
    TakeOrderedAndProject (per-partition top-k, merged)."""
    c = F.col
    li = (tbl(spark, sf, "lineitem")
          .filter((c("l_quantity") > 0) & (c("l_extendedprice") > 0) & c("l_discount").between(0, 1)))
    stats = group_stats(li, ["l_suppkey"], [
        F.count(F.lit(1)).alias("n_lines"),
        decimal_sum("l_extendedprice").alias("revenue"),
        decimal_sum(c("l_extendedprice") * (1 - c("l_discount")), 4).alias("net_revenue"),
        decimal_mean("l_discount").alias("avg_discount"), F.avg("l_quantity").alias("avg_quantity")])
    top = top_k(stats, [F.desc("revenue"), F.asc("l_suppkey")], k)
    su = tbl(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    na = tbl(spark, sf, "nation").select("n_nationkey", "n_name")
    j = lookup_join(top, su, left_on="l_suppkey", right_on="s_suppkey", how="left")
    j = lookup_join(j, na, left_on="s_nationkey", right_on="n_nationkey", how="left")
    out = j.select("l_suppkey", "s_name", "n_name", "n_lines", "revenue", "net_revenue",
                   "avg_discount", "avg_quantity")
    # ordered output of k rows: a second top-k (no range-partition sampling job)
    return top_k(out, [F.desc("revenue"), F.asc("l_suppkey")], k)


@query("topk_revenue", "S2 P4 S1", sql=FLAGSHIP_SQL)
def topk_revenue(spark, sf):
    return supplier_revenue_report(spark, sf)


@query("sort_multi_key", "S1", sql="""
SELECT o_orderkey, o_orderpriority, o_orderdate, o_totalprice FROM orders
ORDER BY o_orderpriority ASC, o_orderdate DESC, o_orderkey ASC
""")
def sort_multi_key(spark, sf):
    """Global multi-key sort (range-partitioned exchange, then local sorts)."""
    od = tbl(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate", "o_totalprice")
    return od.orderBy(F.asc("o_orderpriority"), F.desc("o_orderdate"), F.asc("o_orderkey"))


@query("distinct_values", "S4", sql="SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct_values(spark, sf):
    return tbl(spark, sf, "orders").select("o_orderstatus", "o_orderpriority").distinct()


@query("limit_rows", "S3", sql="SELECT * FROM orders ORDER BY o_orderkey LIMIT 20")
def limit_rows(spark, sf):
    """First 20 orders by key (ordered first, so the rows are not arbitrary)."""
    return tbl(spark, sf, "orders").orderBy("o_orderkey").limit(20)


@query("sample_seeded", "S5")
def sample_seeded_q(spark, sf):
    return sample_seeded(tbl(spark, sf, "lineitem"), 0.2, seed=42)


@query("hash_split", "S6", sql="""
SELECT * FROM lineitem
WHERE CAST('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey)), 1, 8) AS BIGINT) % 100 < 80
""")
def hash_split_q(spark, sf):
    """Train side (80 %) of a deterministic hash split of lineitem."""
    train, _ = hash_split(tbl(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey"], 80)
    return train


@query("scalar_dates", "2.8", sql="""
SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(month(ts) AS INTEGER) AS month,
       CAST(ts AS DATE) AS day, CAST(dayofweek(ts) + 1 AS INTEGER) AS weekday,
       CAST(floor(epoch(ts)) AS BIGINT) AS unix_seconds
FROM events
""")
def scalar_dates(spark, sf):
    ev = tbl(spark, sf, "events")
    return ev.select("event_id", F.hour("ts").alias("hour"), F.month("ts").alias("month"),
                     F.to_date("ts").alias("day"), F.dayofweek("ts").alias("weekday"),
                     F.floor(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                                              F.col("ts")) / 1_000_000).cast("bigint").alias("unix_seconds"))


@query("scalar_strings", "2.8", sql="""
SELECT doc_id, upper(trim(lang)) AS lang_upper, upper(trim(source)) AS source_upper,
       CAST(len(string_split(text, ' ')) AS INTEGER) AS n_blank_tokens,
       CAST(length(text) AS INTEGER) AS n_chars
FROM documents
""")
def scalar_strings(spark, sf):
    d = tbl(spark, sf, "documents")
    return d.select("doc_id", F.upper(F.trim("lang")).alias("lang_upper"),
                    F.upper(F.trim("source")).alias("source_upper"),
                    F.size(F.split("text", " ")).alias("n_blank_tokens"),
                    F.length("text").alias("n_chars"))
