"""Sliced frames against plain windows, sketches against exact rows, samples across partitionings."""

import datetime
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tabflow.operators import slices as S
from tabflow.operators.sampling import bottom_k_sample
from tabflow.operators.sketches import distinct_error, merge_sketches, rank_error, sketch_groups, sketch_values

T0 = datetime.datetime(2024, 3, 30, 22)


def series(spark, n=400, kind="timestamp_ntz"):
    """A key with most rows, null keys, null times, ties and null values."""
    r = random.Random(5)
    rows = [(i, r.choice(["hot"] * 6 + ["b", None]), None if r.random() < 0.05 else T0 + datetime.timedelta(hours=r.randrange(120)),
             None if r.random() < 0.2 else r.randrange(-500, 500) / 100) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, k string, ts timestamp_ntz, v double")
    return df.withColumn("ts", F.col("ts").cast(kind)).repartition(5)


def same(a, b):
    cols = sorted(a.columns)
    rows = [sorted(map(str, df.select(*cols).collect())) for df in (a, b)]
    assert rows[0] == rows[1]


def frames(w):
    return {"back": F.lag("v", 3).over(w), "ahead": F.lead("id", 2).over(w), "n": F.count("v").over(w.rowsBetween(-5, 1)),
            "top": F.max("v").over(w.rowsBetween(-5, 0))}


@pytest.mark.parametrize("n,slices,keys", [(400, 7, []), (400, 7, ["k"]), (40, 32, ["k"]), (12, 12, []), (1, 8, ["k"]), (0, 8, [])])
def test_row_frames_equal_the_plain_window(spark, n, slices, keys):
    df = series(spark, n)
    w = (Window.partitionBy(*keys) if keys else Window).orderBy("ts", "id")
    same(S.halo_windows(df, ["ts", "id"], frames, before=5, after=2, keys=keys, slices=slices), df.withColumns(frames(w)))


def test_slices_follow_the_order_and_share_the_rows(spark):
    df = S.with_slice(series(spark, 4000), ["ts", "id"], 8)
    parts = df.groupBy("__slice").agg(F.count("*").alias("n"), F.min(F.struct("ts", "id")).alias("lo"), F.max(F.struct("ts", "id")).alias("hi")).orderBy("__slice").collect()
    assert len(parts) == 8 and max(p.n for p in parts) < 4000 / 3
    lowest = [(p.lo.ts or datetime.datetime.min, p.lo.id) for p in parts]
    highest = [(p.hi.ts or datetime.datetime.min, p.hi.id) for p in parts]
    assert all(h < lo for h, lo in zip(highest, lowest[1:]))


def test_no_exchange_to_a_single_task(spark):
    plan = S.halo_windows(series(spark), ["ts", "id"], frames, 5, 2, slices=8)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "date"])
@pytest.mark.parametrize("n,slices,keys", [(400, 9, []), (400, 9, ["k"]), (30, 30, ["k"]), (0, 4, [])])
def test_range_sums_equal_the_plain_window(spark, kind, n, slices, keys):
    df = series(spark, n, kind)
    days = 2 if kind == "date" else None
    back = F.make_dt_interval(F.lit(2)) if days is None else F.lit(days)
    out = S.range_sums(df, "ts", "v", back, keys, sum_col="s", count_col="n", slices=slices)
    number = F.unix_date("ts") if kind == "date" else F.timestamp_diff("SECOND", F.lit("1970-01-01").cast(kind), F.col("ts"))
    w = (Window.partitionBy(*keys) if keys else Window).orderBy(number).rangeBetween(-2 if kind == "date" else -2 * 86400, 0)
    same(out, df.withColumn("s", F.sum(F.col("v").cast("decimal(28,2)")).over(w).cast("decimal(38,2)")).withColumn("n", F.count("*").over(w)))


def test_range_sums_in_a_zone_with_a_clock_change(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        df = series(spark, 300, "timestamp")
        w = Window.orderBy("ts", "id")
        same(S.halo_windows(df, ["ts", "id"], frames, 5, 2, slices=9), df.withColumns(frames(w)))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_sketches_merge_in_any_order_within_their_error(spark):
    df = spark.range(60000).select((F.col("id") % 30).alias("day"), (F.xxhash64("id") % 9000).alias("u"), F.sqrt("id").alias("v"))
    days = sketch_groups(df, ["day"], ["u"], ["v"])
    exact = df.agg(F.countDistinct("u").alias("u")).first().u
    weeks = merge_sketches(days, [(F.col("day") % 4).alias("week")])
    for layer in (days, weeks, days.where("day < 9").unionByName(merge_sketches(days.where("day >= 9"), ["day"]))):
        got = sketch_values(merge_sketches(layer), {"median": 0.5, "p90": 0.9}).first()
        assert got.n_rows == 60000 and abs(got.u_distinct / exact - 1) < 5 * distinct_error()
        for value, rank in ((got.v_median, 0.5), (got.v_p90, 0.9)):
            assert abs(value**2 / 60000 - rank) < 3 * rank_error()
    assert days.select(F.max(F.length("v_kll")).alias("n")).first().n < 64 << 10


def test_sketches_of_nulls_and_of_no_rows(spark):
    df = spark.createDataFrame([(1, None, None), (1, None, float("nan")), (2, "x", 4.0), (None, "y", None)], "g int, u string, v double")
    got = {r.g: r for r in sketch_values(merge_sketches(sketch_groups(df, ["g"], ["u"], ["v"]), ["g"])).collect()}
    assert (got[1].n_rows, got[1].u_distinct, got[1].v_median) == (2, 0, None)
    assert (got[2].u_distinct, got[2].v_median) == (1, 4.0) and (got[None].u_distinct, got[None].v_median) == (1, None)
    assert sketch_groups(df.limit(0), ["g"], ["u"], ["v"]).count() == 0


def test_bottom_k_is_the_same_in_any_partitioning_and_merges(spark):
    rows = [(i, "hot" if i % 3 else None, i % 50) for i in range(3000)] + [(5, "hot", 9)] * 3 + [(None, "small", None)]
    df = spark.createDataFrame(rows, "id long, g string, x int")
    one = bottom_k_sample(df.coalesce(1), ["g"], ["id"], 40)
    many = bottom_k_sample(df.repartition(64), ["g"], ["id"], 40, salts=3)
    same(one, many)
    assert {r.g: r["count"] for r in one.groupBy("g").count().collect()} == {"hot": 40, None: 40, "small": 1}
    halves = [bottom_k_sample(df.where(c), ["g"], ["id"], 40) for c in ("x < 20", "not coalesce(x < 20, false)")]
    same(bottom_k_sample(halves[0].unionByName(halves[1]), ["g"], ["id"], 40), one)
    same(bottom_k_sample(df, ["g"], ["id"], 5000), df)
    assert bottom_k_sample(df.limit(0), ["g"], ["id"], 3).count() == 0
