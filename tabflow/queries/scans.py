"""Scans, sources and sinks (survey 2.1)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabflow.operators.aggregates import decimal_sum
from tabflow.queries.registry import query, tbl
from tabflow.schemas import DRIVER
from tabflow.session import shared_path
from tabflow.sources.files import format_report, read_delimited, read_json, read_layer, write_layer
from tabflow.sources.tables import TABLES, register_views

_COUNTED = TABLES


@query("scan_parquet_count", "A1", sql="\n UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in _COUNTED))
def scan_parquet_count(spark, sf):
    out = None
    for t in _COUNTED:
        part = tbl(spark, sf, t).agg(F.count(F.lit(1)).alias("n_rows")) \
            .select(F.lit(t).alias("table_name"), "n_rows")
        out = part if out is None else out.unionByName(part)
    return out


@query("scan_pruned", "A6", sql="""
SELECT l_orderkey, l_suppkey, l_extendedprice, l_shipdate FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1999-01-01 00:00:00'
""")
def scan_pruned(spark, sf):
    # 4 of 11 columns: ReadSchema holds only these, the date filter is pushed.
    return (tbl(spark, sf, "lineitem")
            .select("l_orderkey", "l_suppkey", "l_extendedprice", "l_shipdate")
            .filter(F.col("l_shipdate") >= F.lit("1999-01-01 00:00:00").cast("timestamp_ntz")))


@query("csv_roundtrip", "A2 A12", sql="SELECT * FROM orders")
def csv_roundtrip(spark, sf):
    """Write orders as ';' CSV with header, read back with the declared
    positional schema; the header is validated against the schema names."""
    path = shared_path(spark, "csv-roundtrip")
    (tbl(spark, sf, "orders").write.mode("overwrite").option("header", True)
     .option("sep", ";").csv(path))
    return read_delimited(spark, path, DRIVER["orders"], sep=";")


@query("json_roundtrip", "A5", sql="SELECT * FROM customer")
def json_roundtrip(spark, sf):
    path = shared_path(spark, "json-roundtrip")
    tbl(spark, sf, "customer").write.mode("overwrite").json(path)
    return read_json(spark, path, DRIVER["customer"])


PROPS = T.StructType([T.StructField("k", T.LongType(), True)])


@query("json_props_agg", "A8", sql="""
SELECT event_type, count(*) AS n_events,
       CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS sum_k,
       max(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS max_k,
       count(json_extract_string(props, '$.k')) AS n_with_k
FROM events GROUP BY event_type
""")
def json_props_agg(spark, sf):
    """Parse the JSON property column with a declared struct, then aggregate."""
    ev = tbl(spark, sf, "events").select("event_type", F.from_json("props", PROPS).alias("p"))
    return ev.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_events"), F.sum("p.k").alias("sum_k"),
        F.max("p.k").alias("max_k"), F.count("p.k").alias("n_with_k"))


def _orders_layer(spark, sf):
    path = shared_path(spark, "orders-by-priority")
    write_layer(tbl(spark, sf, "orders"), path, partition_by=["o_orderpriority"])
    return read_layer(spark, path, DRIVER["orders"])


@query("partitioned_roundtrip", "A9 A10", sql="SELECT * FROM orders")
def partitioned_roundtrip(spark, sf):
    return _orders_layer(spark, sf)


@query("partition_counts", "A13 Q8", sql="""
SELECT o_orderpriority, count(*) AS n_rows, round(sum(o_totalprice), 2) AS sum_totalprice
FROM orders GROUP BY o_orderpriority
""")
def partition_counts(spark, sf):
    """Read-back reconciliation: rows and money per partition of the layer."""
    return _orders_layer(spark, sf).groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n_rows"), decimal_sum("o_totalprice").alias("sum_totalprice"))


@query("pruned_scan", "L5", sql="""
SELECT l_linestatus, count(*) AS n_rows, sum(l_quantity) AS sum_qty
FROM lineitem
WHERE l_returnflag = 'R' AND l_shipdate >= TIMESTAMP '1998-01-01 00:00:00'
GROUP BY l_linestatus
""")
def pruned_scan(spark, sf):
    """Partition pruning (l_returnflag folder) + pushed data filter + 3 columns."""
    path = shared_path(spark, "lineitem-by-flag")
    write_layer(tbl(spark, sf, "lineitem"), path, partition_by=["l_returnflag"])
    li = read_layer(spark, path, DRIVER["lineitem"])
    return (li.filter((F.col("l_returnflag") == "R")
                      & (F.col("l_shipdate") >= F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")))
            .groupBy("l_linestatus")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("l_quantity").alias("sum_qty")))


@query("range_even_squares", "A14 U3", sql="""
SELECT l_linenumber, CAST(l_linenumber AS BIGINT) * l_linenumber AS square, count(*) AS n_rows
FROM lineitem WHERE l_linenumber % 2 = 0 GROUP BY l_linenumber
""")
def range_even_squares(spark, sf):
    """map / filter re-aimed as columns: keep even numbers, square them."""
    li = tbl(spark, sf, "lineitem").select("l_linenumber")
    return (li.filter(F.col("l_linenumber") % 2 == 0)
            .groupBy("l_linenumber")
            .agg((F.col("l_linenumber").cast("bigint") * F.col("l_linenumber")).alias("square"),
                 F.count(F.lit(1)).alias("n_rows")))


@query("sql_show_views", "A16", sql="\n UNION ALL ".join(
    f"SELECT '{t}' AS view_name, count(*) AS n_rows FROM {t}" for t in _COUNTED))
def sql_show_views(spark, sf):
    """Register every table as a session view, list the views with SHOW VIEWS and count
    the rows of each through SQL on the view."""
    names = register_views(spark, sf)
    counts = spark.sql("\n UNION ALL ".join(f"SELECT '{t}' AS view_name, count(*) AS n_rows FROM {t}" for t in names))
    listed = spark.sql("SHOW VIEWS").where("isTemporary").select(F.col("viewName").alias("view_name"))
    return counts.join(listed, "view_name", "left_semi")


@query("format_report", "A18 L4")
def format_report_q(spark, sf):
    """Bytes on disk, files and rows read back for each format x codec."""
    return format_report(tbl(spark, sf, "orders"), shared_path(spark, "formats"))


@query("json_scalar_access", "A8 2.8", sql="""
SELECT event_id, json_extract_string(props, '$.k') AS k_text,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS k_struct,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS k_variant
FROM events
""")
def json_scalar_access(spark, sf):
    """Three ways to read one JSON field: path extraction (string), a
    declared struct, and the VARIANT type (``parse_json`` + ``variant_get``)."""
    ev = tbl(spark, sf, "events").select("event_id", "props")
    return ev.select(
        "event_id",
        F.get_json_object("props", "$.k").alias("k_text"),
        F.from_json("props", PROPS)["k"].alias("k_struct"),
        F.variant_get(F.parse_json("props"), "$.k", "bigint").alias("k_variant"))
