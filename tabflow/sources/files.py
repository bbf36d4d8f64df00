"""File readers and writers: delimited text, JSON, Parquet/ORC layers and
small reports, plus a format/codec size report computed by Spark itself."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT_COL = "_corrupt_record"


def read_delimited(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
                   sep: str = ",", encoding: str = "UTF-8", header: bool = True,
                   date_format: str | None = None, timestamp_format: str | None = None,
                   validate_header: bool = True, keep_corrupt: bool = False,
                   partitions: int | None = None) -> DataFrame:
    """CSV with an explicit, *positional* schema.

    ``validate_header`` makes Spark compare every file's header with the
    schema names (``enforceSchema=false``), so a moved column fails instead of
    silently shifting values. ``keep_corrupt`` adds ``_corrupt_record`` (the
    raw line of rows whose fields did not parse; they are null otherwise).
    Gzip files are read transparently but are not splittable: pass
    ``partitions`` to spread rows after the scan.
    """
    st = schema
    if keep_corrupt:
        st = T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COL, T.StringType(), True)])
    reader = (spark.read.schema(st).option("header", header).option("sep", sep)
              .option("encoding", encoding).option("mode", "PERMISSIVE"))
    if header and validate_header:
        reader = reader.option("enforceSchema", False)
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COL)
    if date_format:
        reader = reader.option("dateFormat", date_format)
    if timestamp_format:
        reader = reader.option("timestampNTZFormat", timestamp_format)
    df = reader.csv(path if isinstance(path, str) else list(path))
    return df.repartition(partitions) if partitions else df


def read_csv_inferred(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Inferred types: two passes over the file; only for small lookup files."""
    return spark.read.option("header", True).option("sep", sep).option("inferSchema", True).csv(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_layer(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None,
               fmt: str = "parquet", merge_schema: bool = False) -> DataFrame:
    """Read a layer (one or more folders); partition columns take the declared type."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if merge_schema:
        reader = reader.option("mergeSchema", True)
    return reader.load(path if isinstance(path, str) else list(path))


def write_layer(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite",
                fmt: str = "parquet", compression: str | None = None,
                dynamic_overwrite: bool = False) -> None:
    """Write a layer. ``mode`` is overwrite/append/error/ignore.

    ``dynamic_overwrite`` replaces only the partitions present in ``df``. Rows are
    gathered by partition value first, which AQE splits where one value is large,
    so a folder gets files by its size and not one from every task.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if compression:
        writer = writer.option("compression", compression)
    if dynamic_overwrite:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)


def write_report(df: DataFrame, path: str, fmt: str = "csv", header: bool = True,
                 order_by: Sequence = (), single_file: bool = True) -> None:
    """Write an aggregated result, ordered by ``order_by`` when given.

    ``single_file`` is for reports that someone opens: one task writes the one
    file, whatever its size. Without it the files are ranges of the order, as
    many as Spark's partitions. No row is refused or left out either way."""
    if single_file:
        df = df.repartition(1)
        df = df.sortWithinPartitions(*order_by) if order_by else df
    elif order_by:
        df = df.orderBy(*order_by)
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", header)
    writer.save(path)


def write_text(df: DataFrame, path: str, col: str) -> None:
    df.select(F.col(col).cast("string").alias("value")).write.mode("overwrite").text(path)


def files_size(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """Bytes on disk, file count and rows of a written folder in one job:
    rows are grouped per file (``_metadata``), then summed."""
    per_file = (spark.read.format(fmt).option("header", fmt == "csv").load(path)
                .groupBy(F.col("_metadata.file_path").alias("f"))
                .agg(F.max("_metadata.file_size").alias("s"), F.count(F.lit(1)).alias("r")))
    return per_file.agg(F.sum("s").cast("bigint").alias("bytes"),
                        F.count(F.lit(1)).cast("bigint").alias("files"),
                        F.sum("r").cast("bigint").alias("rows_back"))


def format_report(df: DataFrame, root: str,
                  variants: Sequence[tuple[str, str]] = (("csv", "none"), ("csv", "gzip"),
                                                        ("json", "none"), ("json", "gzip"),
                                                        ("parquet", "snappy"), ("parquet", "zstd"),
                                                        ("parquet", "gzip"), ("parquet", "none"),
                                                        ("orc", "snappy"), ("orc", "zstd"))) -> DataFrame:
    """Write ``df`` once per (format, codec) and report bytes on disk, file
    count and rows read back. Every number is computed by a Spark job."""
    spark = df.sparkSession
    parts = []
    for fmt, codec in variants:
        path = f"{root.rstrip('/')}/{fmt}_{codec}"
        write_layer(df, path, fmt=fmt, compression=codec)
        parts.append(files_size(spark, path, fmt)
                     .select(F.lit(fmt).alias("format"), F.lit(codec).alias("codec"),
                             "bytes", "files", "rows_back"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int,
                   partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as an external table hashed into ``buckets`` files on
    ``key`` (sorted within each bucket) and return it read back.

    Two tables bucketed the same way on their join keys join without a
    shuffle on either side, so the partitioning paid once at write time is
    reused by every later join on that key. Rows are dealt out by the key into
    as many tasks first, so a bucket is one file (one for each partition value)."""
    writer = (df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
              .option("path", path))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)
