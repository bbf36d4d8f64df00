"""Composite-job queries (survey 2.12)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tabflow.jobs import star
from tabflow.operators.aggregates import decimal_mean, decimal_sum
from tabflow.operators.quality import distinct_rows, drop_nulls, within_bounds
from tabflow.operators.upsert import upsert_layer
from tabflow.operators.versioned import create_versioned, upsert_versioned
from tabflow.functions.columns import safe_ratio
from tabflow.queries.registry import query, tbl
from tabflow.schemas import DRIVER
from tabflow.session import shared_path
from tabflow.sources.files import read_delimited, read_layer, write_layer
from tabflow.sources.tables import spread

_STATUS_CASE = ("CASE o_orderstatus WHEN 'F' THEN 'fulfilled' WHEN 'O' THEN 'open' "
                "WHEN 'P' THEN 'partial' ELSE 'unknown' END")
_FLAG_CASE = ("CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'N' THEN 'none' "
              "WHEN 'R' THEN 'returned' ELSE 'unknown' END")


@query("gold_by_nation", "P1 G4", sql="""
SELECT c.c_nationkey, count(DISTINCT o.o_orderkey) AS n_orders
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY c.c_nationkey
""")
def gold_by_nation(spark, sf):
    return star.gold_by_nation(star.silver_layer(spark, sf))


@query("gold_status_by_priority", "P1 D4 G5", sql=f"""
SELECT {_STATUS_CASE} AS status_label, {_FLAG_CASE} AS flag_label, count(*) AS n_lines
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey GROUP BY 1, 2
""")
def gold_status_by_priority(spark, sf):
    return star.gold_status_by_flag(star.silver_layer(spark, sf))


@query("gold_top5_month", "P1 W7", sql="""
WITH per AS (SELECT CAST(month(o.o_orderdate) AS INTEGER) AS order_month, c.c_nationkey,
                    count(DISTINCT o.o_orderkey) AS n_orders
             FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2)
SELECT order_month, c_nationkey, n_orders, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY order_month ORDER BY n_orders DESC, c_nationkey) AS rank FROM per)
WHERE rank <= 5
""")
def gold_top5_month(spark, sf):
    return star.gold_top5_month(star.silver_layer(spark, sf))


@query("gold_three_way", "P1 D5", sql=f"""
SELECT c.c_mktsegment, {_FLAG_CASE} AS flag_label, count(*) AS n_lines
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN lineitem l ON o.o_orderkey = l.l_orderkey
GROUP BY 1, 2
""")
def gold_three_way(spark, sf):
    return star.gold_three_way(star.silver_layer(spark, sf))


@query("ingest_summary", "P2 A2 A4 A6 Q1 Q3 Q5 B9 A9 A13 G3", sql="""
WITH clean AS (
  SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_returnflag, l_shipdate
  FROM lineitem
  WHERE l_extendedprice IS NOT NULL AND l_quantity IS NOT NULL AND l_returnflag IS NOT NULL),
priced AS (
  SELECT *, round(l_extendedprice / l_quantity, 0) AS unit_price, CAST(month(l_shipdate) AS INTEGER) AS ship_month
  FROM clean WHERE l_extendedprice > 0 AND l_quantity > 0 AND l_returnflag IN ('A', 'N'))
SELECT ship_month, l_returnflag, count(*) AS n_lines, avg(unit_price) AS avg_unit_price,
       min(unit_price) AS min_unit_price, max(unit_price) AS max_unit_price
FROM priced WHERE unit_price >= 1000 AND unit_price <= 50000
GROUP BY ship_month, l_returnflag
""")
def ingest_summary(spark, sf):
    """Raw gzip CSV (bronze) -> declared schema -> keep the needed columns ->
    drop rows missing a key field -> drop identical rows -> positive values
    and two kinds only -> guarded unit price, rounded -> inclusive bounds ->
    month partition column -> Parquet partitioned by month -> read back with
    the declared schema -> rows and unit-price stats per (month, kind)."""
    c = F.col
    raw_path = shared_path(spark, "bronze-lineitem-csv")
    (tbl(spark, sf, "lineitem").write.mode("overwrite").option("header", True)
     .option("compression", "gzip").csv(raw_path))
    raw = spread(read_delimited(spark, raw_path, DRIVER["lineitem"]))  # gzip: one split per file
    keep = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag",
            "l_shipdate"]
    present = distinct_rows(drop_nulls(raw.select(*keep), ["l_extendedprice", "l_quantity", "l_returnflag"]))
    priced = (present.filter((c("l_extendedprice") > 0) & (c("l_quantity") > 0)
                             & c("l_returnflag").isin("A", "N"))
              .withColumn("unit_price", F.round(safe_ratio("l_extendedprice", "l_quantity"), 0)))
    clean = within_bounds(priced, {"unit_price": (1000, 50000, "both")}) \
        .withColumn("ship_month", F.month("l_shipdate"))
    silver = shared_path(spark, "silver-lineitem-by-month")
    write_layer(clean, silver, partition_by=["ship_month"])
    back = read_layer(spark, silver, clean.schema)
    return back.groupBy("ship_month", "l_returnflag").agg(
        F.count(F.lit(1)).alias("n_lines"), F.avg("unit_price").alias("avg_unit_price"),
        F.min("unit_price").alias("min_unit_price"), F.max("unit_price").alias("max_unit_price"))


@query("ingest_orders_summary", "P2 A2 A4 A6 Q1 Q3 Q5 G8", sql="""
WITH clean AS (
  SELECT DISTINCT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority FROM orders
  WHERE o_orderkey IS NOT NULL AND o_totalprice IS NOT NULL AND o_orderpriority IS NOT NULL
    AND o_totalprice >= 1000 AND o_totalprice <= 500000)
SELECT o_orderpriority, count(*) AS n_orders, round(sum(o_totalprice), 2) / count(o_totalprice) AS avg_price,
       quantile_disc(o_totalprice, 0.5) AS median_price, round(sum(o_totalprice), 2) AS total_price
FROM clean GROUP BY o_orderpriority
""")
def ingest_orders_summary(spark, sf):
    """The same ingestion shape on orders: raw gzip CSV -> declared schema ->
    prune, drop nulls, dedupe, bounds -> Parquet partitioned by priority ->
    read back -> per-partition price summary (mean, median, total)."""
    raw_path = shared_path(spark, "bronze-orders-csv")
    (tbl(spark, sf, "orders").write.mode("overwrite").option("header", True)
     .option("compression", "gzip").csv(raw_path))
    raw = spread(read_delimited(spark, raw_path, DRIVER["orders"]))  # gzip: one split per file
    keep = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"]
    clean = within_bounds(distinct_rows(drop_nulls(raw.select(*keep), ["o_orderkey", "o_totalprice",
                                                                       "o_orderpriority"])),
                          {"o_totalprice": (1000, 500000, "both")})
    silver = shared_path(spark, "silver-orders")
    write_layer(clean, silver, partition_by=["o_orderpriority"])
    back = read_layer(spark, silver, clean.schema)
    return back.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n_orders"), decimal_mean("o_totalprice").alias("avg_price"),
        F.percentile_approx("o_totalprice", 0.5, 1_000_000).alias("median_price"),
        decimal_sum("o_totalprice").alias("total_price"))


_UPSERTED = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00'
UNION ALL
SELECT o_orderkey, o_custkey, 'F' AS o_orderstatus, o_totalprice + 2 AS o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01 00:00:00'
"""


def _order_changes(base):
    """Two versions of every order from 2000 on: status -> 'F', price +1 then +2."""
    recent = base.filter(F.col("o_orderdate") >= F.lit("2000-01-01 00:00:00").cast("timestamp_ntz"))
    versions = [recent.withColumns({"o_orderstatus": F.lit("F"), "o_totalprice": F.col("o_totalprice") + v,
                                    "change_seq": F.lit(v)}) for v in (1, 2)]
    return versions[0].unionByName(versions[1])


@query("upsert_latest", "P3", sql=_UPSERTED)
def upsert_latest(spark, sf):
    """Base layer = orders partitioned by status. The latest version of each changed
    order wins and only the touched status partitions are rewritten in place."""
    path = shared_path(spark, "orders-upsert")
    base = tbl(spark, sf, "orders")
    write_layer(base, path, partition_by=["o_orderstatus"])
    upsert_layer(spark, path, _order_changes(base), ["o_orderkey"], [F.desc("change_seq")], ["o_orderstatus"],
                 schema=DRIVER["orders"])
    return read_layer(spark, path, DRIVER["orders"])


@query("upsert_by_name", "P3", sql=_UPSERTED)
def upsert_by_name(spark, sf):
    """The same upsert into a table that is read by name and switched in one catalog call."""
    base = tbl(spark, sf, "orders")
    database = f"orders_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{shared_path(spark, database)}'")
    create_versioned(base, f"{database}.orders", ["o_orderstatus"])
    upsert_versioned(spark, f"{database}.orders", _order_changes(base), ["o_orderkey"], [F.desc("change_seq")])
    return spark.table(f"{database}.orders")
