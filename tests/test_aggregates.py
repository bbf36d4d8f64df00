from pyspark.sql import functions as F

from tabflow.operators.aggregates import (count_by, decimal_mean, decimal_sum, distinct_count_by, group_stats,
                                          median_by, pivot_counts, top_k)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_median_lower_middle_like_quantile_disc(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 3.0), ("a", 4.0), ("b", 7.0)], "k string, x double")
    assert _rows(median_by(df, ["k"], "x", "m")) == [("a", 2.0), ("b", 7.0)]


def test_pivot_counts_fixed_values(spark):
    df = spark.createDataFrame([(1, "A"), (1, "N"), (1, "A"), (2, "R")], "k int, f string")
    assert _rows(pivot_counts(df, ["k"], "f", ["A", "N", "R"])) == [(1, 2, 1, 0), (2, 0, 0, 1)]


def test_having_and_top_k(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    stats = group_stats(df, ["k"], [F.count(F.lit(1)).alias("n"), F.sum("v").alias("s")],
                        having=F.col("n") >= 15)
    assert {r.k for r in stats.collect()} == {0, 1}
    top = top_k(stats, [F.desc("s"), F.asc("k")], 1).collect()
    assert [r.k for r in top] == [1]


def test_counts_and_distinct_counts(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), (None, 3)], "k string, v int")
    assert _rows(count_by(df, ["k"], drop_null_keys=True)) == [("a", 3)]
    assert {r.k: r.d for r in distinct_count_by(df, ["k"], "v", "d").collect()} == {"a": 2, None: 1}


def test_decimal_sum_is_order_independent(spark):
    vals = [0.1, 0.2, 0.3, 1234.56, 0.07] * 200
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    a = df.repartition(1).agg(decimal_sum("x").alias("s"), decimal_mean("x").alias("m")).first()
    b = df.repartition(13).agg(decimal_sum("x").alias("s"), decimal_mean("x").alias("m")).first()
    assert a.s == b.s == round(sum(vals), 2) and a.m == b.m
