from pyspark.sql import functions as F

from tabflow.operators.sampling import hash_split
from tabflow.operators.skew import salted_agg, skew_report


def test_salted_agg_equals_plain(spark):
    df = spark.range(5000).select(F.when(F.col("id") < 3000, F.lit("hot")).otherwise(
        (F.col("id") % 7).cast("string")).alias("k"), (F.col("id") * 1.5).alias("v"), "id")
    plain = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"),
                                F.min("v").alias("lo"), F.max("v").alias("hi"))
    salted = salted_agg(df, ["k"], [("count", "*", "n"), ("sum", "v", "s"), ("min", "v", "lo"),
                                    ("max", "v", "hi")], salts=8, salt_cols=["id"])
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, salted.select(*plain.columns).collect()))


def test_skew_report_shares(spark):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 2 + [("c",)] * 2, "k string")
    out = {r.k: (r.n_rows, r.share_pct, r.ratio_to_mean) for r in skew_report(df, ["k"]).collect()}
    assert out["a"] == (6, 60.0, 1.8)


def test_hash_split_disjoint_complete_and_stable(spark):
    df = spark.range(10000).withColumn("k2", F.col("id") % 13)
    train, test = hash_split(df, ["id", "k2"], 80)
    assert train.count() + test.count() == 10000
    assert train.join(test, "id").count() == 0
    train2, _ = hash_split(df.repartition(5), ["id", "k2"], 80)
    assert train.exceptAll(train2).count() == 0
    assert 7500 < train.count() < 8500


def test_salted_join_equals_the_plain_join(spark):
    from tabflow.operators.skew import hot_keys, salted_join

    facts = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, None)
                                     .otherwise(F.col("id") % 40).alias("k"), F.col("id"))
    lookup = spark.createDataFrame([(i, f"n{i}") for i in range(0, 60, 2)] + [(None, "null"), (0, "again")], "code long, name string")
    assert hot_keys(facts, "k", 0.1) == [0]
    for how in ("inner", "left", "left_semi"):
        got = salted_join(facts, lookup, "k", "code", F.col("id"), salts=4, least_share=0.1, how=how)
        want = facts.join(lookup, facts["k"] == lookup["code"], how)
        assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_pivot_counts_with_other_leaves_no_row_out(spark):
    from tabflow.operators.aggregates import pivot_counts

    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, None), (2, "c")], "k int, v string")
    out = {r.k: (r.a, r.rest) for r in pivot_counts(df, ["k"], "v", ["a"], other="rest").collect()}
    assert out == {1: (1, 2), 2: (0, 1)}


def test_balanced_join_equals_the_plain_join_and_evens_its_tasks(spark):
    from tabflow.operators.skew import balanced_join, rows_per_task, shuffled_join
    from tabflow.plans.explain import join_strategies

    facts = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 5 == 1, None)
                                      .otherwise(F.col("id") % 900).alias("k"), F.col("id"), F.lit("x").alias("name"))
    lookup = spark.range(0, 1000, 2).select(F.col("id").alias("code"), F.concat(F.lit("n"), "id").alias("name")) \
        .unionByName(spark.createDataFrame([(None, "null"), (7, "hot"), (7, "hot again")], "code long, name string"))
    for how in ("inner", "left", "left_semi"):
        got = balanced_join(facts, lookup, "k", "code", F.xxhash64("id"), tasks=16, how=how)
        want = facts.join(lookup, facts["k"] == lookup["code"], how)
        assert got.columns == want.columns and got.count() == want.count()
        if how != "left_semi":  # both sides have a column called name
            named = [f"c{i}" for i in range(len(want.columns))]
            got, want = got.toDF(*named), want.toDF(*named)
        assert got.exceptAll(want).count() == 0
        assert "SortMergeJoin" in join_strategies(got)
    largest = lambda df: rows_per_task(df).agg(F.max("n_rows")).first()[0]
    before = shuffled_join(facts, lookup, "k", "code", 16)
    after = balanced_join(facts, lookup, "k", "code", F.xxhash64("id"), tasks=16)
    assert join_strategies(before) == ["SortMergeJoin"]
    assert largest(before) >= 20000 and largest(after) < 0.2 * largest(before)
    left = balanced_join(facts, lookup, "k", "code", F.xxhash64("id"), tasks=16, how="left")
    assert largest(left) < 3 * left.count() / 16  # null keys are spread too


def test_balanced_join_of_empty_sides(spark):
    from tabflow.operators.skew import balanced_join, task_balance

    facts = spark.createDataFrame([], "k long, id long")
    lookup = spark.createDataFrame([(1, "a")], "code long, name string")
    assert balanced_join(facts, lookup, "k", "code", F.xxhash64("id"), tasks=4, how="left").count() == 0
    some = spark.createDataFrame([(1, 1), (None, 2)], "k long, id long")
    assert balanced_join(some, lookup.limit(0), "k", "code", F.xxhash64("id"), tasks=4, how="left").count() == 2
    assert tuple(task_balance(facts, "none", 4).first()) == ("none", 0, 0, None)
