"""The bronze -> silver -> gold job on the star-schema tables.

Stand-ins: orders = accidents, customer = places, lineitem = users. Bronze is
the Parquet input; silver is cleaned, decoded and written once (orders
partitioned by order year), which cuts the lineage; gold re-reads silver.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.functions.codes import decode
from tabflow.operators.quality import dedupe_by_key, distinct_rows
from tabflow.operators.windows import top_n_per_group
from tabflow.session import input_bytes, shared_path
from tabflow.sources.files import read_layer, write_bucketed, write_layer
from tabflow.sources.tables import table, table_path

# Stand-in code tables (fixed): order status and return flag labels.
STATUS_LABELS = {"F": "fulfilled", "O": "open", "P": "partial"}
FLAG_LABELS = {"A": "accepted", "N": "none", "R": "returned"}
UNKNOWN = "unknown"


def clean_orders(df: DataFrame) -> DataFrame:
    c = F.col
    kept = (df.filter(c("o_orderkey").isNotNull() & c("o_custkey").isNotNull()
                      & F.month("o_orderdate").between(1, 12))
            .withColumns({"status_label": decode("o_orderstatus", STATUS_LABELS, UNKNOWN),
                          "order_year": F.year("o_orderdate"),
                          "order_month": F.month("o_orderdate")}))
    return dedupe_by_key(kept, ["o_orderkey"], [F.desc("o_orderdate")])


def clean_customers(df: DataFrame) -> DataFrame:
    kept = df.filter(F.col("c_custkey").isNotNull()).withColumn("c_mktsegment", F.trim("c_mktsegment"))
    return dedupe_by_key(kept, ["c_custkey"], [F.asc("c_name")])


def clean_lines(df: DataFrame) -> DataFrame:
    """Line items have no reliable natural key (two different lines can share
    order, line number, part and supplier), so only fully identical rows are
    removed: a key-based dedupe would drop real records."""
    kept = (df.filter(F.col("l_orderkey").isNotNull() & F.col("l_returnflag").isin("A", "N", "R"))
            .withColumn("flag_label", decode("l_returnflag", FLAG_LABELS, UNKNOWN)))
    return distinct_rows(kept)


def buckets_for(size: int, target: int = 256 << 20, least: int = 32) -> int:
    """A power of two, at least ``least``, that keeps a bucket of ``size`` bytes of input near ``target``:
    layers of different sizes then have counts that divide each other."""
    return max(least, 1 << (max(1, -(-size // target)) - 1).bit_length())


def build_silver(spark: SparkSession, sf_dir: str, root: str | None = None,
                 buckets: int | None = None) -> dict[str, DataFrame]:
    """Clean and write the silver layer; return it read back from storage.

    Orders and line items are bucketed on the order key with the same bucket
    count, so the gold joins between them read co-partitioned files and need
    no shuffle; customers are a plain layer (a lookup of the orders). ``buckets`` is
    a property of the stored layer, apart from the session's shuffle setting; its
    default grows with the line items (``buckets_for``).
    """
    buckets = buckets or buckets_for(input_bytes(spark, table_path(sf_dir, "lineitem")))
    root = root or shared_path(spark, "silver")
    tag = uuid.uuid4().hex[:8]
    orders = clean_orders(table(spark, sf_dir, "orders"))
    # dealt out by the bucket key first: the removal of identical rows and the buckets share one shuffle
    lines = clean_lines(table(spark, sf_dir, "lineitem").repartition(buckets, "l_orderkey"))
    customers = clean_customers(table(spark, sf_dir, "customer"))
    write_layer(customers, f"{root}/customer")
    names = [f"silver_orders_{tag}", f"silver_lineitem_{tag}"]
    return {
        "orders": write_bucketed(orders, names[0], f"{root}/orders", "o_orderkey", buckets,
                                 partition_by=["order_year"]),
        "lineitem": write_bucketed(lines, names[1], f"{root}/lineitem", "l_orderkey", buckets),
        "customer": read_layer(spark, f"{root}/customer", customers.schema),
        "__tables": names,
    }


def silver_layer(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The silver layer of ``sf_dir`` as its files are now."""
    return build_silver(spark, sf_dir)


def gold_by_nation(s: dict[str, DataFrame]) -> DataFrame:
    j = s["orders"].join(s["customer"].select("c_custkey", "c_nationkey"),
                         F.col("o_custkey") == F.col("c_custkey"), "inner")
    return j.groupBy("c_nationkey").agg(F.countDistinct("o_orderkey").alias("n_orders"))


def gold_status_by_flag(s: dict[str, DataFrame]) -> DataFrame:
    j = s["orders"].select("o_orderkey", "status_label").join(
        s["lineitem"].select("l_orderkey", "flag_label"), F.col("o_orderkey") == F.col("l_orderkey"), "inner")
    return j.groupBy("status_label", "flag_label").agg(F.count(F.lit(1)).alias("n_lines"))


def gold_top5_month(s: dict[str, DataFrame]) -> DataFrame:
    j = s["orders"].select("o_orderkey", "o_custkey", "order_month").join(
        s["customer"].select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"), "inner")
    per = j.groupBy("order_month", "c_nationkey").agg(F.countDistinct("o_orderkey").alias("n_orders"))
    return top_n_per_group(per, ["order_month"], [F.desc("n_orders"), F.asc("c_nationkey")], 5, "rank")


def gold_three_way(s: dict[str, DataFrame]) -> DataFrame:
    j = (s["orders"].select("o_orderkey", "o_custkey")
         .join(s["customer"].select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"), "inner")
         .join(s["lineitem"].select("l_orderkey", "flag_label"), F.col("o_orderkey") == F.col("l_orderkey"), "inner"))
    return j.groupBy("c_mktsegment", "flag_label").agg(F.count(F.lit(1)).alias("n_lines"))
