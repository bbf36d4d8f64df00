"""What scans read: less with each pruning step, and less for either column of a z-ordered layer."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabflow.operators.zorder import write_zordered
from tabflow.plans.cost import COUNTED_READS, scan_cost
from tabflow.queries.registry import query, tbl
from tabflow.schemas import DRIVER
from tabflow.session import input_bytes, shared_path
from tabflow.sources.tables import table_path

SINCE = "2001-01-01"


def _block(spark, sf, least: int) -> int:
    """Row group size: the default, or a small part of a small table, so that it has several, but
    not less than ``least``: footers and page indexes of tiny row groups outweigh what is skipped."""
    return min(128 << 20, max(least, input_bytes(spark, table_path(sf, "lineitem")) // 64))


def _lines(spark, sf):
    """Lines with their ship day: Spark skips Parquet row groups by a date, but not by a ``timestamp_ntz``."""
    return tbl(spark, sf, "lineitem").withColumn("ship_day", F.to_date("l_shipdate"))


@query("bytes_read", "L5 A6 A9", sql=f"""
WITH li AS (SELECT count(*) AS n, CAST(count_if(l_returnflag = 'R') AS BIGINT) AS r,
                   CAST(count_if(l_returnflag = 'R' AND l_shipdate >= DATE '{SINCE}') AS BIGINT) AS s FROM lineitem)
SELECT 0 AS step_no, 'full scan' AS step, n AS n_rows, CAST(NULL AS BOOLEAN) AS fewer_bytes FROM li
UNION ALL SELECT 1, 'one partition', r, true FROM li UNION ALL SELECT 2, 'pushed filter', s, true FROM li
UNION ALL SELECT 3, 'one column', s, true FROM li
""")
def bytes_read(spark, sf):
    """Rows of each step and whether its scan read fewer bytes than the step before (measured)."""
    path = shared_path(spark, "lineitem-by-flag-and-date")
    lines = _lines(spark, sf)
    (lines.repartitionByRange("l_returnflag", "ship_day").sortWithinPartitions("l_returnflag", "ship_day")
     .write.partitionBy("l_returnflag").option("parquet.block.size", _block(spark, sf, 32 << 10)).parquet(path))
    li = spark.read.schema(lines.schema).options(**COUNTED_READS).parquet(path)
    part = li.where("l_returnflag = 'R'")
    since = part.where(f"ship_day >= DATE '{SINCE}'")
    out, last = None, None
    for i, (step, df) in enumerate((("full scan", li), ("one partition", part), ("pushed filter", since), ("one column", since.select("ship_day")))):
        cost = scan_cost(df).bytes_read
        row = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(i).alias("step_no"), F.lit(step).alias("step"), "n_rows",
            F.lit(None if last is None else cost < last).cast("boolean").alias("fewer_bytes"))
        out, last = (row if out is None else out.unionByName(row)), cost
    return out


@query("zorder_layer", "A9 L5 L3", sql="SELECT * FROM lineitem")
def zorder_layer(spark, sf):
    """Lines stored in z-order of part and ship date, read back whole."""
    path = shared_path(spark, "lineitem-z")
    write_zordered(tbl(spark, sf, "lineitem"), path, ["l_partkey", "l_shipdate"])
    return spark.read.schema(DRIVER["lineitem"]).parquet(path)


@query("zorder_rows_read", "A9 L5", sql="""
WITH b AS (SELECT quantile_disc(l_partkey, 0.05) AS p, quantile_disc(CAST(l_shipdate AS DATE), 0.05) AS d FROM lineitem)
SELECT 'l_partkey' AS filtered, count(*) AS n_rows, true AS under_half FROM lineitem, b WHERE l_partkey <= p
UNION ALL SELECT 'ship_day', count(*), true FROM lineitem, b WHERE CAST(l_shipdate AS DATE) <= d
""")
def zorder_rows_read(spark, sf):
    """A filter on either column of the z-ordered layer: its rows, and whether the scan read under half of all (measured)."""
    path, cols, out = shared_path(spark, "lineitem-z"), ["l_partkey", "ship_day"], None
    li = _lines(spark, sf).select("l_orderkey", *cols)
    write_zordered(li, path, cols, block_bytes=_block(spark, sf, 4 << 10))
    z = spark.read.schema(li.schema).options(**COUNTED_READS).parquet(path)
    twentieth = "CAST(percentile_disc(0.05) WITHIN GROUP (ORDER BY {}) AS bigint)"
    low = z.agg(F.expr(twentieth.format("l_partkey")).alias("l_partkey"),
                F.date_from_unix_date(F.expr(twentieth.format("unix_date(ship_day)")).cast("int")).alias("ship_day"),
                F.count(F.lit(1)).alias("n")).first()
    for c in cols:
        held = z.where(F.col(c) <= F.lit(low[c]))
        row = held.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(c).alias("filtered"), "n_rows", F.lit(2 * scan_cost(held).rows_read < low["n"]).alias("under_half"))
        out = row if out is None else out.unionByName(row)
    return out
