import pytest

from tabflow.operators.relational import broadcast_if_bounded, chain_joins, join_null_safe, lookup_join


@pytest.fixture
def frames(spark):
    facts = spark.createDataFrame([(1, 10.0), (2, 20.0), (3, 30.0), (None, 40.0)], "k int, v double")
    lookup = spark.createDataFrame([(1, "one"), (2, "two"), (None, "none")], "k int, name string")
    return facts, lookup


def test_using_join_keeps_one_key_column(frames):
    facts, lookup = frames
    out = lookup_join(facts, lookup, on="k", how="left")
    assert out.columns == ["k", "v", "name"]
    names = {r.v: r.name for r in out.collect()}
    assert names == {10.0: "one", 20.0: "two", 30.0: None, 40.0: None}  # SQL: null never matches


def test_differently_named_keys_and_strategies(frames, spark):
    facts, lookup = frames
    lk = lookup.withColumnRenamed("k", "id")
    for strategy in ("auto", "broadcast", "merge"):
        out = lookup_join(facts, lk, left_on="k", right_on="id", how="inner", strategy=strategy)
        assert sorted(r.name for r in out.collect()) == ["one", "two"]
    with pytest.raises(ValueError):
        lookup_join(facts, lk, left_on="k", right_on="id", strategy="nested")
    with pytest.raises(ValueError):
        lookup_join(facts, lk, left_on="k")


def test_broadcast_if_bounded(frames):
    _, lookup = frames
    assert broadcast_if_bounded(lookup, max_rows=10)[1] is True
    assert broadcast_if_bounded(lookup, max_rows=2)[1] is False


def test_chain_and_null_safe_joins(frames, spark):
    facts, lookup = frames
    extra = spark.createDataFrame([(1, "x"), (2, "y")], "k int, tag string")
    chained = chain_joins(facts, [(lookup, "k", "inner"), (extra, "k", "left")])
    assert sorted((r.k, r.tag) for r in chained.collect()) == [(1, "x"), (2, "y")]
    ns = join_null_safe(facts, lookup, ["k"])
    assert sorted((r.v, r.name) for r in ns.collect()) == [(10.0, "one"), (20.0, "two"), (40.0, "none")]
    assert ns.columns == ["k", "v", "name"]
