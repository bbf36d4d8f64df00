"""Benchmark of the headline queries.

Runs on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` (default 8) and prints ONE JSON line. Each query is
run once to warm up, then 5 times; the median is reported. Results are fully
computed through the ``noop`` sink (no driver collect).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tabflow.plans.cache import cached  # noqa: E402
from tabflow.queries import all_queries  # noqa: E402
from tabflow.session import get_session  # noqa: E402
from tabflow.sources.tables import table  # noqa: E402
from tabflow.functions.codes import decode  # noqa: E402
from tabflow.functions.udfs import upper_pandas, upper_udf  # noqa: E402
from tabflow.jobs.star import FLAG_LABELS as FLAGS, STATUS_LABELS, UNKNOWN  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPS = int(os.environ.get("BENCH_REPS", "5"))
# Optional: stage/task times go to a Spark event log in this folder (no UI).
EVENT_LOG_DIR = os.environ.get("BENCH_EVENT_LOG_DIR")


def run(df):
    df.write.format("noop").mode("overwrite").save()


def timed(fn, reps=REPS):
    fn()  # warm-up
    times = []
    for _ in range(reps):
        t0 = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t0)
    return statistics.median(times)


def order_lines(spark):
    """orders JOIN lineitem (accident x user stand-in) with decoded labels."""
    od = table(spark, SF_DIR, "orders").select(
        "o_orderkey", decode("o_orderstatus", STATUS_LABELS, UNKNOWN).alias("status_label"))
    li = table(spark, SF_DIR, "lineitem").select(
        "l_orderkey", decode("l_returnflag", FLAGS, UNKNOWN).alias("flag_label"))
    return od.join(li, od.o_orderkey == li.l_orderkey, "inner")


def two_key_count(j):
    return j.groupBy("status_label", "flag_label").agg(F.count(F.lit(1)).alias("n_lines"))


def main():
    conf = {"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"}
    if EVENT_LOG_DIR:
        conf.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": EVENT_LOG_DIR})
    spark = get_session("bench", master=f"local[{CPUS}]", shuffle_partitions=max(8, 2 * CPUS), conf=conf)
    qs = all_queries()
    results = {}

    j = order_lines(spark)
    results["join_2key_count_nocache"] = timed(lambda: run(two_key_count(j)))
    with cached(order_lines(spark)) as jc:
        results["join_2key_count_cached"] = timed(lambda: run(two_key_count(jc)))

    def distinct_per_group():
        run(table(spark, SF_DIR, "orders").groupBy("o_orderpriority")
            .agg(F.countDistinct("o_orderkey").alias("n_orders")))
    results["distinct_per_group"] = timed(distinct_per_group)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    results["distinct_per_group_aqe_off"] = timed(distinct_per_group)
    spark.conf.set("spark.sql.adaptive.enabled", "true")

    def plain_agg():
        li = table(spark, SF_DIR, "lineitem")
        run(li.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_lines"),
                                           F.round(F.sum("l_extendedprice"), 2).alias("revenue"),
                                           F.min("l_extendedprice").alias("min_price"),
                                           F.max("l_extendedprice").alias("max_price")))
    results["skew_plain_agg"] = timed(plain_agg)

    for name in ("topk_revenue", "join_broadcast", "join_sortmerge", "skew_salted_agg",
                 "agg_zone_stats", "win_top3", "win_lag_pct", "word_count", "dq_dedupe_key",
                 "crosstab_pivot", "agg_median", "win_ranks_window", "win_ranks_skew_safe"):
        results[name] = timed(lambda n=name: run(qs[n](spark, SF_DIR)))
    # jobs that write and read again, and the three forms of one function, fewer times
    for name in ("stream_update_counts", "gold_three_way", "ingest_summary", "upsert_latest"):
        results[name] = timed(lambda n=name: run(qs[n](spark, SF_DIR)), 2)
    names = table(spark, SF_DIR, "lineitem").select(F.concat_ws(" ", "l_returnflag", "l_linestatus").alias("s"))
    for label, fn in (("native", F.upper), ("row_udf", upper_udf), ("pandas_udf", upper_pandas)):
        results[f"upper_{label}"] = timed(lambda f=fn: run(names.select(f("s").alias("u"))), 3)

    sf = os.path.basename(SF_DIR.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_median_query_time", "value": round(sum(results.values()), 3),
                      "unit": "sec", "queries": {k: round(v, 3) for k, v in results.items()},
                      "sf": float(sf) if sf.replace(".", "").isdigit() else sf, "cpus": CPUS}))
    spark.stop()


if __name__ == "__main__":
    main()
