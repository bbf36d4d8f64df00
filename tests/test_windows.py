from datetime import date

import pytest
from pyspark.sql import functions as F

from tabflow.operators.ranking import ranks_skew_safe, ranks_within_groups
from tabflow.operators.windows import (moving_average, range_window_sum, share_of_total, top_n_per_group,
                                       with_next, with_previous, with_ranks)


@pytest.fixture
def ties(spark):
    # amounts 90, 80, 70, 70, 70, 60 in zone 1; two rows in zone 2
    data = [(1, i, a) for i, a in enumerate([90.0, 80.0, 70.0, 70.0, 70.0, 60.0])] + [(2, 0, 5.0), (2, 1, 5.0)]
    return spark.createDataFrame(data, "zone int, trip int, amount double")


def test_rank_patterns_on_ties(ties):
    out = with_ranks(ties, ["zone"], [F.desc("amount")], [F.asc("trip")])
    z1 = [(r.row_number, r.rank, r.dense_rank) for r in out.filter("zone = 1").orderBy("row_number").collect()]
    assert [x[1] for x in z1] == [1, 2, 3, 3, 3, 6]
    assert [x[2] for x in z1] == [1, 2, 3, 3, 3, 4]
    assert [x[0] for x in z1] == [1, 2, 3, 4, 5, 6]


def test_top_n_exactly_n_per_group(ties):
    out = top_n_per_group(ties, ["zone"], [F.desc("amount"), F.asc("trip")], 3)
    counts = {r.zone: r["count"] for r in out.groupBy("zone").count().collect()}
    assert counts == {1: 3, 2: 2}


def test_skew_safe_ranks_equal_window_ranks_on_a_hot_group(spark):
    # one key holds ~a third of the rows, with many tied values
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 97 == 1, F.lit(None))
         .otherwise(F.col("id") % 50).alias("k"),
        F.when(F.col("id") % 89 == 5, F.lit(None)).otherwise((F.col("id") % 17).cast("double")).alias("v"),
        F.col("id"))
    expect = with_ranks(rows, ["k"], [F.desc("v")], [F.asc("id")])
    got = ranks_skew_safe(rows, ["k"], "v", True, [F.asc("id")], partitions=7)
    cols = ["k", "id", "v", "row_number", "rank", "dense_rank"]

    def same(a, b):
        a, b = a.select(*cols), b.select(*cols)
        return a.count() == b.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0

    assert same(got, expect)
    assert same(ranks_within_groups(rows, ["k"], "v", True, [F.asc("id")], spread=True), expect)
    assert same(ranks_within_groups(rows, ["k"], "v", True, [F.asc("id")]), expect)


@pytest.mark.parametrize("partitions", [3, 16])
def test_skew_safe_ranks_with_payload_columns(spark, partitions):
    line = spark.read.parquet("/root/testdata/sf0.1/lineitem.parquet").withColumn("rid", F.monotonically_increasing_id())
    from tabflow.session import cut_lineage

    line = cut_lineage(line)
    got = ranks_skew_safe(line, ["l_returnflag"], "l_quantity", True, [F.asc("rid")], partitions=partitions)
    expect = with_ranks(line, ["l_returnflag"], [F.desc("l_quantity")], [F.asc("rid")]) \
        .select("rid", *[F.col(c).alias(f"w_{c}") for c in ("row_number", "rank", "dense_rank")])
    wrong = got.join(expect, "rid").where("row_number <> w_row_number or rank <> w_rank or dense_rank <> w_dense_rank")
    assert got.count() == line.count() and wrong.count() == 0


def test_lag_lead_first_and_last_null(spark):
    s = spark.createDataFrame([(date(2024, 1, d), float(v)) for d, v in [(1, 100), (2, 110), (3, 0), (4, 50)]],
                              "day date, revenue double")
    out = with_next(with_previous(s, "day", "revenue"), "day", "revenue").orderBy("day").collect()
    assert out[0].prev_revenue is None and out[0].pct_revenue is None
    assert out[1].pct_revenue == pytest.approx(10.0)
    assert out[3].pct_revenue is None  # previous value 0 -> no percent
    assert out[3].next_revenue is None and out[0].next_revenue == 110.0


def test_moving_average_and_range_frame_gap_safe(spark):
    days = [1, 2, 3, 10, 11]
    s = spark.createDataFrame([(date(2024, 1, d), 1.0) for d in days], "day date, v double")
    ma = {r.day.day: r.ma3_v for r in moving_average(s, "day", "v", rows=3).collect()}
    assert ma[10] == 1.0
    rng = {r.day.day: (r.sum7d_v, r.n7d_days) for r in range_window_sum(s, "day", "v", days=7).collect()}
    assert rng[3] == (3.0, 3) and rng[10] == (1.0, 1) and rng[11] == (2.0, 2)


def test_share_of_total_sums_to_100(ties, spark):
    ties = ties.unionByName(spark.createDataFrame([(None, 9, 3.0), (None, 10, 1.0)], ties.schema))
    out = share_of_total(ties, ["zone"], "amount")
    assert out.count() == ties.count()  # the null group is kept, as a window would
    assert sorted(r.share_pct for r in out.filter("zone IS NULL").collect()) == [25.0, 75.0]
    sums = {r.zone: r.s for r in out.groupBy("zone").agg(F.sum("share_pct").alias("s")).collect()}
    assert sums[1] == pytest.approx(100.0) and sums[2] == pytest.approx(100.0)
