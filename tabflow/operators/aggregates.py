"""Grouped statistics. All aggregates used here are partial-aggregatable
(map-side combine before the shuffle), so a hot key costs one row per map
task, not one task holding the whole key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def decimal_sum(col, scale: int = 2) -> Column:
    """Exact sum, as double, of a column holding values with at most ``scale``
    decimals (money, rates): each value is summed as a decimal, so the result
    does not depend on the order of the partial sums or on their size."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c.cast(f"decimal(28,{scale})")).cast("double")


def decimal_mean(col, scale: int = 2) -> Column:
    """Mean from the exact ``decimal_sum``: order-independent to the last bit."""
    c = F.col(col) if isinstance(col, str) else col
    return decimal_sum(c, scale) / F.count(c)


def group_stats(df: DataFrame, keys: Sequence[str | Column], aggs: Sequence[Column],
                having: Column | None = None) -> DataFrame:
    """``GROUP BY keys`` with ``aggs`` and an optional post-aggregation filter."""
    out = df.groupBy(*keys).agg(*aggs)
    return out if having is None else out.filter(having)


def top_k(df: DataFrame, order_by: Sequence[Column], k: int) -> DataFrame:
    """Global top-k (TakeOrderedAndProject: per-partition top-k, then merge)."""
    return df.orderBy(*order_by).limit(k)


def count_by(df: DataFrame, keys: Sequence[str], name: str = "n",
             drop_null_keys: bool = False) -> DataFrame:
    if drop_null_keys:
        for k in keys:
            df = df.filter(F.col(k).isNotNull())
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def distinct_count_by(df: DataFrame, keys: Sequence[str], col: str, name: str) -> DataFrame:
    """Exact distinct count per group. Spark plans it as partial aggregates on
    (keys, col), a shuffle on (keys, col) and a second one on keys carrying only
    partial counts, so a hot group is spread over its distinct values."""
    return df.groupBy(*keys).agg(F.countDistinct(col).alias(name))


def median_by(df: DataFrame, keys: Sequence[str], col: str, name: str,
              accuracy: int = 10_000) -> DataFrame:
    """Median per group with a bounded-size quantile sketch (partial-aggregatable).

    Rank error is at most n / ``accuracy``; the result is exact while a group
    holds fewer than ``accuracy`` rows. The sketch grows with ``accuracy`` for
    every group, so raise it only when there are few groups (the registered
    median queries use 1,000,000 over 3-5 groups)."""
    return df.groupBy(*keys).agg(F.percentile_approx(col, 0.5, accuracy).alias(name))


def pivot_counts(df: DataFrame, row_keys: Sequence[str], pivot_col: str,
                 values: Sequence, name_fmt: str = "{}", other: str | None = None) -> DataFrame:
    """Cross-tab of row counts. ``values`` must be given: it avoids an extra
    job to discover them and fixes the output schema. With ``other``, a column of
    that name counts the rows of every other value, so that no row is left out."""
    aggs = [F.count_if(F.col(pivot_col) == F.lit(v)).cast("bigint").alias(name_fmt.format(v))
            for v in values]
    if other is not None:
        aggs.append(F.count_if(~F.coalesce(F.col(pivot_col).isin(*values), F.lit(False))).cast("bigint").alias(other))
    return df.groupBy(*row_keys).agg(*aggs)
