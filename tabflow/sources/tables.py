"""Access to the star-schema tables stored as one Parquet file each.

Reads are lazy; Catalyst prunes columns and pushes filters into the scan, so
callers should select only what they need right after ``table``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> list[str]:
    """Register each table as a temp view (session lifetime) and return names."""
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(name)
    return list(names)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin ``df`` over the cluster only when its scan yields fewer
    partitions than there are task slots (one unsplittable file, one row
    group, a gzip file). A large input already has many more splits than
    slots and is returned unchanged, so no shuffle is added at scale."""
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df
