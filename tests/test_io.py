import gzip

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabflow.sources.files import (format_report, read_csv_inferred, read_delimited, read_layer, write_layer,
                                   write_report)

SCHEMA = T.StructType([T.StructField("code_postal", T.StringType()), T.StructField("prix", T.DoubleType()),
                       T.StructField("date_mutation", T.DateType()), T.StructField("pieces", T.IntegerType())])


def _write(path, text, gz=False):
    if gz:
        with gzip.open(path, "wt", encoding="utf-8") as f:
            f.write(text)
    else:
        path.write_text(text, encoding="utf-8")


def test_read_delimited_schema_and_leading_zero(spark, tmp_path):
    p = tmp_path / "a.csv"
    _write(p, "code_postal;prix;date_mutation;pieces\n01000;250000.5;2024-03-01;3\n75001;;2024-03-02;x\n")
    df = read_delimited(spark, str(p), SCHEMA, sep=";", date_format="yyyy-MM-dd")
    rows = df.orderBy("code_postal").collect()
    assert rows[0].code_postal == "01000" and rows[0].prix == 250000.5 and rows[0].pieces == 3
    assert rows[1].prix is None and rows[1].pieces is None  # empty + malformed -> null (permissive)


def test_inferred_schema_loses_leading_zero(spark, tmp_path):
    p = tmp_path / "b.csv"
    _write(p, "code_postal,prix\n01000,1.5\n")
    assert read_csv_inferred(spark, str(p)).first().code_postal == 1000


def test_header_mismatch_fails_loudly(spark, tmp_path):
    p = tmp_path / "moved.csv"
    _write(p, "prix;code_postal;date_mutation;pieces\n1.0;01000;2024-01-01;2\n")
    with pytest.raises(Exception):
        read_delimited(spark, str(p), SCHEMA, sep=";").collect()


def test_corrupt_records_are_kept_and_counted(spark, tmp_path):
    p = tmp_path / "c.csv"
    _write(p, "code_postal;prix;date_mutation;pieces\n01000;1.0;2024-01-01;2\n02000;abc;2024-01-01;2\n")
    df = read_delimited(spark, str(p), SCHEMA, sep=";", keep_corrupt=True).cache()
    assert df.filter(F.col("_corrupt_record").isNotNull()).count() == 1
    df.unpersist()


def test_gzip_and_latin1(spark, tmp_path):
    p = tmp_path / "d.csv.gz"
    _write(p, "code_postal;prix;date_mutation;pieces\n01000;1.0;2024-01-01;2\n", gz=True)
    assert read_delimited(spark, str(p), SCHEMA, sep=";", partitions=4).count() == 1
    q = tmp_path / "e.csv"
    q.write_bytes("code_postal;prix;date_mutation;pieces\nCrépy;1.0;2024-01-01;2\n".encode("latin-1"))
    assert read_delimited(spark, str(q), SCHEMA, sep=";", encoding="ISO-8859-1").first().code_postal == "Crépy"


def test_partitioned_layer_keeps_declared_partition_type(spark, tmp_path):
    df = spark.createDataFrame([("01", 1), ("06", 2), ("75", 3)], "dep string, n int")
    path = str(tmp_path / "layer")
    write_layer(df, path, partition_by=["dep"])
    inferred = spark.read.parquet(path)
    assert dict(inferred.dtypes)["dep"] == "int"  # discovery re-types all-digit values
    back = read_layer(spark, path, df.schema)
    assert sorted(r.dep for r in back.collect()) == ["01", "06", "75"]
    assert back.filter("dep = '06'").count() == 1


def test_save_modes(spark, tmp_path):
    df = spark.range(3)
    path = str(tmp_path / "modes")
    write_layer(df, path)
    write_layer(df, path, mode="append")
    assert spark.read.parquet(path).count() == 6
    write_layer(df, path, mode="ignore")
    assert spark.read.parquet(path).count() == 6
    with pytest.raises(Exception):
        write_layer(df, path, mode="error")
    write_layer(df, path, mode="overwrite")
    assert spark.read.parquet(path).count() == 3


def test_write_report_keeps_every_row_in_order(spark, tmp_path):
    path = tmp_path / "rep"
    write_report(spark.range(10).groupBy((F.col("id") % 2).alias("k")).count(), str(path))
    assert len(list(path.glob("part-*.csv"))) == 1
    write_report(spark.range(1000), str(tmp_path / "big"), order_by=[F.desc("id")])
    lines = next((tmp_path / "big").glob("part-*.csv")).read_text().split()
    assert lines == ["id", *[str(i) for i in range(999, -1, -1)]]
    write_report(spark.range(1000), str(tmp_path / "many"), order_by=["id"], single_file=False)
    assert spark.read.option("header", True).csv(str(tmp_path / "many")).count() == 1000


def test_format_report(spark, tmp_path):
    df = spark.range(2000).select("id", (F.col("id") * 1.5).alias("x"), F.lit("abc").alias("s"))
    rep = format_report(df, str(tmp_path / "fmt"), [("csv", "none"), ("parquet", "zstd"), ("orc", "snappy"),
                                                    ("json", "gzip")])
    rows = {(r.format, r.codec): r for r in rep.collect()}
    assert all(r.rows_back == 2000 for r in rows.values())
    assert rows[("parquet", "zstd")].bytes < rows[("csv", "none")].bytes
