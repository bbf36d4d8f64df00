"""Incremental upsert for Parquet layers (Parquet has no MERGE).

Latest change per key wins; only the partitions touched by a change (its new
partition and the partition of the row it replaces) are rewritten. The
merged partitions are first staged in the shared folder, which cuts the
lineage (so the overwrite never reads the files it is replacing) and lets a
retried job restart from the staged copy.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.operators.quality import dedupe_by_key
from tabflow.session import shared_path
from tabflow.sources.files import read_layer, write_layer


def latest_changes(changes: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    return dedupe_by_key(changes, keys, order_by)


def _matched(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join on ``cols`` where null matches null."""
    r = right.select(*[F.col(c).alias(f"__r_{c}") for c in cols])
    cond = reduce(and_, [left[c].eqNullSafe(r[f"__r_{c}"]) for c in cols])
    return left.join(r, cond, how)


def merge_rows(base: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Base rows without a change, plus the changes (same columns by name)."""
    return _matched(base, changes, keys, "left_anti").unionByName(changes.select(*base.columns))


def upsert_layer(spark: SparkSession, path: str, changes: DataFrame, keys: Sequence[str],
                 order_by: Sequence[Column], partition_by: Sequence[str], schema=None) -> None:
    """Apply ``changes`` to the partitioned layer at ``path`` in place.

    Keys and partition values match null-safely, so a null partition is one
    like any other. The overwrite and the removal of emptied partitions are two
    steps: a run that stops between them leaves rows that moved in their old
    partition too, and is recovered by running the same upsert again (it finds
    those rows as old versions and removes them)."""
    base = read_layer(spark, path, schema)
    latest = latest_changes(changes, keys, order_by).select(*base.columns)
    # partitions hit by a change: where the new rows go and where the old ones were
    old_parts = _matched(base, latest, keys, "left_semi").select(*partition_by)
    touched = latest.select(*partition_by).unionByName(old_parts).distinct()
    affected = _matched(base, touched, partition_by, "left_semi")
    merged = merge_rows(affected, latest, keys)
    stage = shared_path(spark, "upsert-stage")
    write_layer(merged, stage, partition_by=partition_by)
    staged = read_layer(spark, stage, base.schema)
    # partitions whose rows all moved elsewhere: dynamic overwrite would leave
    # their old files, so they are removed explicitly (one row per partition)
    emptied = _matched(touched, staged.select(*partition_by).distinct(), partition_by, "left_anti") \
        .collect()  # before the overwrite: it reads the current layer
    write_layer(staged, path, partition_by=partition_by, dynamic_overwrite=True)
    for row in emptied:
        _delete_partition(spark, path, [(c, row[c]) for c in partition_by])


def _delete_partition(spark: SparkSession, path: str, values) -> None:
    """Remove one partition folder ``path/c1=v1/c2=v2`` through the Hadoop
    file system of the layer (works for any storage Spark can write)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    utils = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    folder = path.rstrip("/") + "".join(
        f"/{c}={utils.DEFAULT_PARTITION_NAME() if v is None else utils.escapePathName(str(v))}"
        for c, v in values)
    target = jvm.org.apache.hadoop.fs.Path(folder)
    target.getFileSystem(conf).delete(target, True)
