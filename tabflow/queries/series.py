"""Long series in many tasks, statistics from daily sketches, samples that no partitioning changes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabflow.operators.sampling import bottom_k_sample
from tabflow.operators.sketches import distinct_error, merge_sketches, rank_error, sketch_groups, sketch_values
from tabflow.operators.slices import halo_windows, range_sums
from tabflow.queries.registry import query, tbl
from tabflow.session import shared_path


@query("halo_lag_moving", "W3 W4 W5", sql="""
SELECT event_id, ts, value, lag(value) OVER w AS prev_value, lead(event_id, 2) OVER w AS later_event,
       CAST(sum(CAST(value AS DECIMAL(28,2))) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS DOUBLE)
         / count(value) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS ma7_value
FROM events WINDOW w AS (ORDER BY ts NULLS FIRST, event_id NULLS FIRST)
""")
def halo_lag_moving(spark, sf):
    """Previous value, event after next and moving average of all events in one order, in many tasks."""
    ev = tbl(spark, sf, "events").select("event_id", "ts", "value")

    def frames(w):
        week = w.rowsBetween(-6, 0)
        total = F.sum(F.col("value").cast("decimal(28,2)")).over(week).cast("double")
        return {"prev_value": F.lag("value").over(w), "later_event": F.lead("event_id", 2).over(w),
                "ma7_value": F.when(F.count("value").over(week) > 0, total / F.count("value").over(week))}

    return halo_windows(ev, ["ts", "event_id"], frames, before=6, after=2)


@query("range_sum_rows", "W8", sql="""
SELECT event_id, event_type, ts, value, CAST(sum(CAST(value AS DECIMAL(28,2))) OVER w AS DOUBLE) AS sum_value, count(*) OVER w AS n_rows
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts NULLS FIRST RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW)
""")
def range_sum_rows(spark, sf):
    """Sum and rows of each event's last seven days within its type, a key of a few values, in many tasks."""
    ev = tbl(spark, sf, "events").select("event_id", "event_type", "ts", "value")
    out = range_sums(ev, "ts", "value", F.make_dt_interval(F.lit(7)), ["event_type"], sum_col="sum_value", count_col="n_rows")
    return out.withColumn("sum_value", F.col("sum_value").cast("double"))


@query("sketch_months", "G4 G8 P2", sql="""
WITH m AS (SELECT date_trunc('month', o_orderdate)::DATE AS month, count(*) AS n_orders, count(DISTINCT o_custkey) AS n_customers
           FROM orders GROUP BY 1)
SELECT month, n_orders, n_customers, true AS customers_close, true AS median_close FROM m
UNION ALL SELECT CAST(NULL AS DATE), count(*), count(DISTINCT o_custkey), true, true FROM orders
""")
def sketch_months(spark, sf):
    """Customers and median price by month and in all (null month), merged from a layer of daily sketches,
    beside the exact counts: whether the estimates lie within five sigma, and three times the rank error."""
    orders = tbl(spark, sf, "orders").select("o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("day"))
    path = shared_path(spark, "orders-by-day-sketches")
    sketch_groups(orders, ["day"], ["o_custkey"], ["o_totalprice"]).write.parquet(path)
    days = spark.read.parquet(path).withColumn("month", F.trunc("day", "month"))
    months = merge_sketches(days, ["month"])
    rows = orders.withColumn("month", F.trunc("day", "month"))
    names = ["o_custkey_distinct", "o_totalprice_median"]
    by_month = sketch_values(months).select(F.col("month").alias("m"), *names)  # one row for each month
    in_all = sketch_values(merge_sketches(months))  # one row, read as scalar sub-queries
    beside = (rows.join(by_month, F.col("month").eqNullSafe(F.col("m"))),
              orders.select(F.lit(None).cast("date").alias("month"), "o_custkey", "o_totalprice",
                            *[in_all.select(c).scalar().alias(c) for c in names]))
    slack = F.lit(3 * rank_error()) * F.col("n") + 1
    far = F.abs(F.col(names[0]) - F.col("n_customers"))
    out = [df.groupBy("month", *names).agg(
        F.count(F.lit(1)).alias("n_orders"), F.countDistinct("o_custkey").alias("n_customers"), F.count("o_totalprice").alias("n"),
        F.count_if(F.col("o_totalprice") < F.col(names[1])).alias("below"), F.count_if(F.col("o_totalprice") <= F.col(names[1])).alias("upto"))
        .select("month", "n_orders", "n_customers",
                (far <= F.lit(5 * distinct_error()) * F.col("n_customers") + 1).alias("customers_close"),
                ((F.col("below") - slack <= F.col("n") / 2) & (F.col("upto") + slack >= F.col("n") / 2)).alias("median_close"))
        for df in beside]
    return out[0].unionByName(out[1])


@query("sample_bottom_k", "S5 S6", sql="""
SELECT * EXCLUDE (no) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY
    md5(concat_ws('|', coalesce(CAST(l_orderkey AS VARCHAR), '~'), coalesce(CAST(l_linenumber AS VARCHAR), '~'), coalesce(CAST(l_partkey AS VARCHAR), '~'))),
    l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS no
  FROM lineitem) WHERE no <= 200
""")
def sample_bottom_k(spark, sf):
    """200 lines of each flag and status, the same in any engine and partitioning."""
    return bottom_k_sample(tbl(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], ["l_orderkey", "l_linenumber", "l_partkey"], 200)
