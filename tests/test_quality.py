import pytest
from pyspark.sql import functions as F

from tabflow.operators.quality import (dedupe_by_key, distinct_rows, drop_nulls, fill_nulls, profile_numeric,
                                       step_counts, within_bounds)
from tabflow.operators.relational import orphans


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_dedupe_survivor_independent_of_partitioning(spark):
    data = [("a", 1, "x"), ("a", 1, "y"), ("a", 0, "z"), ("b", 5, "q"), ("b", 5, "p")]
    base = spark.createDataFrame(data, "k string, v int, s string")
    results = set()
    for n in (1, 3, 7):
        shuffled = base.repartition(n).orderBy(F.rand(seed=n))
        results.add(tuple(_rows(dedupe_by_key(shuffled, ["k"], [F.desc("v")]))))
    assert len(results) == 1
    assert list(results)[0] == (("a", 1, "x"), ("b", 5, "p"))


def test_dedupe_plan_uses_partial_group_limit(spark):
    from tabflow.plans.explain import explain_text
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    text = explain_text(dedupe_by_key(df, ["k"], [F.desc("v")]))
    assert text.count("WindowGroupLimit") >= 2  # partial (before Exchange) and final


def test_within_bounds_mixed_ends(spark):
    df = spark.createDataFrame([(1000.0, 9), (50000.0, 10), (999.0, 10), (2000.0, 9)], "p double, s int")
    out = within_bounds(df, {"p": (1000, 50000, "both"), "s": (9, None, "neither")})
    assert _rows(out) == [(50000.0, 10)]


def test_null_handling(spark):
    df = spark.createDataFrame([(1, None), (None, "x"), (3, "y")], "a int, b string")
    assert drop_nulls(df).count() == 1
    assert drop_nulls(df, ["a"]).count() == 2
    assert _rows(fill_nulls(df, {"a": 0, "b": "none"})) == [(0, "x"), (1, "none"), (3, "y")]


def test_distinct_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b")], "a int, b string")
    assert distinct_rows(df).count() == 2


def test_step_counts_shrink_monotonically(spark):
    df = spark.range(100).withColumn("x", F.col("id") % 10)
    out = step_counts(df, [("ge2", F.col("x") >= 2), ("lt8", F.col("x") < 8), ("even", F.col("id") % 2 == 0)])
    rows = [(r.step_no, r.step, r.n_rows) for r in out.orderBy("step_no").collect()]
    assert rows == [(0, "raw", 100), (1, "ge2", 80), (2, "lt8", 60), (3, "even", 30)]


def test_profile_numeric(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "x double")
    r = profile_numeric(df, ["x"]).first()
    assert (r.n, r.mean, r.min_value, r.max_value) == (3, 2.0, 1.0, 3.0)
    assert r.stddev == pytest.approx(1.0)


def test_orphans(spark):
    facts = spark.createDataFrame([(1,), (2,), (2,), (5,)], "k int")
    lookup = spark.createDataFrame([(1,), (2,), (2,)], "id int")
    assert _rows(orphans(facts, lookup, "k", "id")) == [(5,)]


def test_dedupe_breaks_ties_on_arrays_binary_and_maps(spark):
    from tabflow.operators.quality import dedupe_by_key

    rows = [(1, [3, 1], bytearray(b"b"), {"x": 2}), (1, [2, 9], bytearray(b"c"), {"x": 1}), (1, [2, 9], bytearray(b"a"), {"x": 3}),
            (1, [2, 9], bytearray(b"a"), {"x": 2})]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "k int, a array<int>, b binary, m map<string,int>").repartition(3)
        got = dedupe_by_key(df, ["k"], []).collect()
        assert [(r.a, bytes(r.b), r.m) for r in got] == [([2, 9], b"a", {"x": 2})]
