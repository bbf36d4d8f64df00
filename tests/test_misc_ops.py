from pyspark import StorageLevel
from pyspark.sql import functions as F

from tabflow.plans.cache import cached
from tabflow.sources.files import read_layer, write_text
from tabflow.sources.tables import table


def test_several_files_as_one_table_with_merged_schema(spark, tmp_path):
    jan = spark.createDataFrame([(1, 2.0)], "id long, fare double")
    feb = spark.createDataFrame([(2, 3.0, 0.5)], "id long, fare double, fee double")  # new column
    jan.write.parquet(str(tmp_path / "m=01"))
    feb.write.parquet(str(tmp_path / "m=02"))
    both = read_layer(spark, [str(tmp_path / "m=01"), str(tmp_path / "m=02")], merge_schema=True)
    rows = sorted(tuple(r) for r in both.select("id", "fare", "fee").collect())
    assert rows == [(1, 2.0, None), (2, 3.0, 0.5)]


def test_text_sink(spark, tmp_path):
    path = str(tmp_path / "txt")
    write_text(spark.range(5), path, "id")
    assert sorted(r.value for r in spark.read.text(path).collect()) == ["0", "1", "2", "3", "4"]


def test_drop_and_schema_introspection(spark, sf):
    od = table(spark, sf, "orders")
    assert "o_orderpriority" not in od.drop("o_orderpriority").columns
    assert dict(od.dtypes)["o_orderdate"] == "timestamp_ntz"
    assert od.schema["o_totalprice"].dataType.typeName() == "double"


def test_small_driver_side_actions_on_aggregates(spark, sf):
    li = table(spark, sf, "lineitem")
    counts = li.groupBy("l_returnflag").count()
    assert sum(r["count"] for r in counts.collect()) == li.count()  # bounded: one row per flag
    total = li.agg(F.sum("l_quantity")).first()[0]
    sub = li.select(F.sum("l_quantity")).scalar()  # scalar sub-query as a Column
    assert total == li.limit(1).select(sub.alias("s")).first().s
    assert len(li.orderBy("l_orderkey", "l_linenumber", "l_partkey").take(3)) == 3


def test_chosen_storage_level(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey")
    with cached(df, StorageLevel.DISK_ONLY) as c:
        assert c.storageLevel.useDisk and not c.storageLevel.useMemory


def test_cut_lineage_uses_reliable_checkpoint(spark, sf):
    from tabflow.plans.explain import explain_text
    from tabflow.session import checkpoint_root, cut_lineage
    df = table(spark, sf, "orders").groupBy("o_orderstatus").count()
    cut = cut_lineage(df)
    assert checkpoint_root(spark)  # reliable checkpoint folder is set
    text = explain_text(cut)
    assert "Scan parquet" not in text and "HashAggregate" not in text  # lineage truncated
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, df.collect()))


def test_shared_path_is_below_checkpoint_root(spark):
    from tabflow.session import checkpoint_root, shared_path
    a, b = shared_path(spark, "x"), shared_path(spark, "x")
    assert a != b and a.startswith(checkpoint_root(spark).rstrip("/"))


def test_shuffle_partition_sizing(spark, sf):
    from tabflow.session import input_bytes, shuffle_partitions_for
    assert shuffle_partitions_for(100 * 1024 ** 4) == 409_600  # 100 TB
    assert shuffle_partitions_for(10 * 1024 ** 4) == 40_960
    assert shuffle_partitions_for(1000) == 8
    import os
    path = f"{sf}/lineitem.parquet"
    assert input_bytes(spark, path) == os.path.getsize(path)


def test_event_time_ignores_session_time_zone(spark):
    from tabflow.streaming.files import event_time, wall_clock
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-02 03:04:05.123456' AS ts")
        r = df.select(F.unix_micros(event_time("ts")).alias("us"),
                      wall_clock(event_time("ts")).alias("back")).first()
        assert r.us == 1704164645123456  # the wall clock read as UTC
        assert str(r.back) == "2024-01-02 03:04:05.123456"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_spread_only_when_under_split(spark, sf):
    from tabflow.sources.tables import spread
    one = table(spark, sf, "documents")
    assert one.rdd.getNumPartitions() == 1
    assert spread(one, 8).rdd.getNumPartitions() == 8
    many = spark.range(0, 1000, 1, 16)
    assert spread(many, 8) is many


def test_feed_records_have_a_bounded_number_of_stations(spark):
    from pyspark.sql import functions as F

    from tabflow.queries.reports import feed_records

    stations = spark.range(20_000).select(F.col("id").alias("l_suppkey"), F.create_map(F.lit("A"), F.lit(1)).alias("counts"))
    assert [r["n"] for r in feed_records(stations).select(F.size("stations").alias("n")).collect()] == [1000] * 20
