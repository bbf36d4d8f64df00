"""Ranks within groups that stay correct and balanced when one group holds
a large share of all rows.

A plain ``Window.partitionBy(key)`` sends every row of a group to one task.
Here rows are range-partitioned on (key, order columns) instead, so a hot
group is cut into value ranges spread over many tasks. Each task ranks its
slice locally; per-slice totals (at most one row per key and range
partition) give the offsets of the earlier slices of the same group:

    rows before  = rows before in my slice + rows in earlier slices of my group

``rank`` and ``dense_rank`` are computed on distinct (key, value) pairs with
their counts (partially aggregated first), ``row_number`` on the rows
themselves under a total order (value + tie-breakers).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabflow.operators.relational import join_null_safe
from tabflow.session import cut_lineage


def prefix_counts(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                  weight: str | None = None, partitions: int | None = None) -> DataFrame:
    """Adds ``__n_before`` (sum of ``weight``, or rows, strictly before the
    row in its group under ``order``) and ``__d_before`` (rows strictly
    before). ``order`` must be a total order within each group."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    w_col = F.col(weight) if weight else F.lit(1)
    # the slices are fixed once: a second evaluation may sample other range bounds,
    # and its slice numbers would not belong to the same rows
    ranged = cut_lineage(df.withColumn("__w", w_col.cast("bigint"))
                         .repartitionByRange(n, *[F.col(k).asc() for k in keys], *order)
                         .withColumn("__pid", F.spark_partition_id()))
    slice_w = (Window.partitionBy("__pid", *keys).orderBy(*order)
               .rowsBetween(Window.unboundedPreceding, -1))
    local = (ranged.withColumn("__n_local", F.coalesce(F.sum("__w").over(slice_w), F.lit(0)))
             .withColumn("__d_local", F.count(F.lit(1)).over(slice_w)))
    totals = ranged.groupBy(*keys, "__pid").agg(F.sum("__w").alias("__pn"),
                                               F.count(F.lit(1)).alias("__pd"))
    off_w = Window.partitionBy(*keys).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (totals.withColumn("__n_off", F.coalesce(F.sum("__pn").over(off_w), F.lit(0)))
               .withColumn("__d_off", F.coalesce(F.sum("__pd").over(off_w), F.lit(0)))
               .select(*keys, "__pid", "__n_off", "__d_off"))
    return (join_null_safe(local, offsets, [*keys, "__pid"])
            .withColumn("__n_before", (F.col("__n_local") + F.col("__n_off")).cast("bigint"))
            .withColumn("__d_before", (F.col("__d_local") + F.col("__d_off")).cast("bigint"))
            .drop("__w", "__pid", "__n_local", "__d_local", "__n_off", "__d_off"))


def ranks_skew_safe(df: DataFrame, keys: Sequence[str], value: str, descending: bool,
                    tie_breakers: Sequence[Column], partitions: int | None = None) -> DataFrame:
    """``row_number``, ``rank`` and ``dense_rank`` within ``keys`` ordered by
    ``value`` (then ``tie_breakers`` for ``row_number``), all bigint.

    Same results as the window functions, without a per-group task."""
    v_order = F.col(value).desc() if descending else F.col(value).asc()
    # rank / dense_rank on distinct (key, value) with counts
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__c"))
    by_value = (prefix_counts(counts, keys, [v_order], weight="__c", partitions=partitions)
                .select(*keys, value, (F.col("__n_before") + 1).alias("rank"),
                        (F.col("__d_before") + 1).alias("dense_rank")))
    # row_number on the rows, total order = value + tie-breakers
    rows = (prefix_counts(df, keys, [v_order, *tie_breakers], partitions=partitions)
            .withColumn("row_number", F.col("__n_before") + 1)
            .drop("__n_before", "__d_before"))
    return join_null_safe(rows, by_value, [*keys, value])


def ranks_within_groups(df: DataFrame, keys: Sequence[str], value: str, descending: bool,
                        tie_breakers: Sequence[Column], spread: bool = False) -> DataFrame:
    """Ranks by window functions, whose sort spills, or with ``spread`` by the
    range-partitioned path for data with a hot group; both give the same ranks."""
    from tabflow.operators.windows import with_ranks

    if spread:
        return ranks_skew_safe(df, keys, value, descending, tie_breakers)
    return with_ranks(df, keys, [F.col(value).desc() if descending else F.col(value).asc()], tie_breakers)
