"""Measured scans and the z-order layout."""

import datetime

import pytest
from pyspark.sql import functions as F

from tabflow.operators.zorder import with_cell, write_zordered
from tabflow.plans.cost import COUNTED_READS, scan_cost


def test_scan_cost_counts_bytes_rows_and_restores_the_job_group(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100000).select("id", F.xxhash64("id").alias("h")).repartition(4).write.parquet(path)
    df = spark.read.options(**COUNTED_READS).parquet(path)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", "mine")
    full, one = scan_cost(df), scan_cost(df.select("id"))
    assert spark.sparkContext.getLocalProperty("spark.jobGroup.id") == "mine"
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert full.rows_read == one.rows_read == 100000 and full.tasks >= 1
    assert full.bytes_read > 100000 * 8 > one.bytes_read > 0
    twice = scan_cost(df.join(df.select(F.col("id").alias("other")), F.col("id") == F.col("other")))
    assert twice.rows_read >= 100000 and twice.bytes_read >= full.bytes_read


def test_cell_interleaves_quantile_numbers(spark):
    df = spark.range(256).select((F.col("id") % 16).alias("x"), F.floor(F.col("id") / 16).alias("y"))
    got = {(r.x, r.y): r.cell for r in with_cell(df, ["x", "y"], bits=2, error=0.0, out="cell").collect()}
    for (x, y), cell in got.items():
        nx, ny = x // 4, y // 4
        near = {cell == sum((((a >> i) & 1) << (2 * i + 1)) | (((b >> i) & 1) << (2 * i)) for i in range(2))
                for a in {nx, (x + 1) // 4} for b in {ny, (y + 1) // 4}}  # a value on a cut may count to either side
        assert True in near, (x, y, cell)
    assert len(set(got.values())) == 16


def test_zorder_reads_fewer_rows_for_both_columns_than_a_sort_by_one(spark, tmp_path):
    df = spark.range(200000).select(F.pmod(F.xxhash64("id"), F.lit(10000)).alias("a"),
                                    F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10000)).cast("double").alias("b"), "id")
    z, line = str(tmp_path / "z"), str(tmp_path / "line")
    write_zordered(df, z, ["a", "b"], files=4, block_bytes=64 * 1024)
    df.repartitionByRange(4, "a").sortWithinPartitions("a").write.option("parquet.block.size", 64 * 1024).parquet(line)
    rows = {}
    for path in (z, line):
        for c in ("a", "b"):
            held = spark.read.options(**COUNTED_READS).parquet(path).where(F.col(c) < (500 if c == "a" else 500.0))
            rows[path, c] = scan_cost(held).rows_read
    assert rows[line, "b"] > 0.9 * 200000  # sorted by one column, nothing is skipped for the other
    assert rows[z, "a"] < 0.35 * 200000 and rows[z, "b"] < 0.35 * 200000
    back = spark.read.parquet(z)
    assert back.columns == df.columns and back.count() == 200000 and back.exceptAll(df).count() == 0


def test_zorder_of_nulls_nan_ties_times_and_empty_tables(spark, tmp_path):
    day, at = datetime.date(2024, 1, 2), datetime.datetime(2024, 1, 2, 3)
    rows = [(None, None, None, None), (float("nan"), day, at, {"k": 1}), (1.0, None, at, None)] + [(2.0, day, None, {})] * 50
    schema = "x double, d date, t timestamp_ntz, m map<string,int>"
    for i, data in enumerate((rows, [], [(None, None, None, None)] * 3)):
        df = spark.createDataFrame(data, schema)
        write_zordered(df, str(tmp_path / str(i)), ["x", "d", "t"], bits=3)
        back = spark.read.schema(schema).parquet(str(tmp_path / str(i)))
        assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    one = with_cell(spark.createDataFrame([(7, 1)] * 9, "x int, id int"), ["x"], out="cell")
    assert one.select("cell").distinct().count() == 1 and one.count() == 9
    with pytest.raises(ValueError):
        with_cell(spark.createDataFrame([("a",)], "s string"), ["s"])


def test_a_cell_with_a_third_of_all_rows_is_spread_over_files(spark, tmp_path):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 1000).alias("a"), "id")
    write_zordered(df, str(tmp_path / "hot"), ["a"], files=12)
    files = spark.read.parquet(str(tmp_path / "hot")).groupBy(F.input_file_name().alias("f")).count()
    assert files.agg(F.max("count")).first()[0] < 2 * 30000 / 12
