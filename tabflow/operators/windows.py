"""Window operators: per-group top-N and ranks, previous/next values, moving
averages over row or value ranges, and shares of a group total.

Global (unpartitioned) windows are only applied to series that were first
aggregated to one row per period (``daily_series``), so they stay small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabflow.functions.columns import day_number
from tabflow.operators.aggregates import decimal_sum
from tabflow.operators.relational import join_null_safe


def top_n_per_group(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], n: int,
                    rank_col: str = "rank", fn: str = "row_number") -> DataFrame:
    """Rows ranked 1..n within each group.

    ``order_by`` must be a total order for ``row_number`` (add tie-breakers).
    Spark 4 plans ``rank <= n`` with a partial ``WindowGroupLimit`` before the
    shuffle, so every map task ships at most n rows per group.
    """
    rank_fn = {"row_number": F.row_number, "rank": F.rank, "dense_rank": F.dense_rank}[fn]
    w = Window.partitionBy(*keys).orderBy(*order_by)
    return (df.withColumn(rank_col, rank_fn().over(w))
            .filter(F.col(rank_col) <= n)
            .withColumn(rank_col, F.col(rank_col).cast("bigint")))


def with_ranks(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column],
               tie_breakers: Sequence[Column]) -> DataFrame:
    """Adds ``row_number`` (total order incl. tie-breakers), ``rank`` and
    ``dense_rank`` (ties share a rank; rank skips, dense_rank does not).

    A group is sorted in one task, which spills to disk. For data with a hot
    group, ``ranking.ranks_skew_safe`` gives the same ranks from value ranges
    that are spread over many tasks.
    """
    w_ties = Window.partitionBy(*keys).orderBy(*order_by)
    w_total = Window.partitionBy(*keys).orderBy(*order_by, *tie_breakers)
    return (df.withColumn("row_number", F.row_number().over(w_total).cast("bigint"))
            .withColumn("rank", F.rank().over(w_ties).cast("bigint"))
            .withColumn("dense_rank", F.dense_rank().over(w_ties).cast("bigint")))


def daily_series(df: DataFrame, ts: str, aggs: Sequence[Column], day_col: str = "day") -> DataFrame:
    """One row per calendar day (partial + final aggregation)."""
    return df.groupBy(F.to_date(F.col(ts)).alias(day_col)).agg(*aggs)


def with_previous(series: DataFrame, order_col: str, value_col: str,
                  keys: Sequence[str] = ()) -> DataFrame:
    """Previous value, difference and percent change (null for the first row
    and when the previous value is 0)."""
    w = Window.partitionBy(*keys).orderBy(order_col) if keys else Window.orderBy(order_col)
    prev = F.lag(value_col, 1).over(w)
    return (series.withColumn(f"prev_{value_col}", prev)
            .withColumn(f"delta_{value_col}", F.col(value_col) - F.col(f"prev_{value_col}"))
            .withColumn(f"pct_{value_col}",
                        F.when(F.col(f"prev_{value_col}") != 0,
                               F.lit(100.0) * F.col(f"delta_{value_col}") / F.col(f"prev_{value_col}"))))


def with_next(series: DataFrame, order_col: str, value_col: str, keys: Sequence[str] = ()) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(order_col) if keys else Window.orderBy(order_col)
    return series.withColumn(f"next_{value_col}", F.lead(value_col, 1).over(w))


def moving_average(series: DataFrame, order_col: str, value_col: str, rows: int = 7,
                   keys: Sequence[str] = (), out: str | None = None, scale: int | None = None) -> DataFrame:
    """Average over the current row and the ``rows - 1`` preceding rows.
    With ``scale`` (values have at most that many decimals) the frame sum is
    the exact decimal sum, divided once."""
    base = Window.partitionBy(*keys).orderBy(order_col) if keys else Window.orderBy(order_col)
    w = base.rowsBetween(-(rows - 1), Window.currentRow)
    mean = (F.avg(value_col).over(w) if scale is None else
            F.sum(F.col(value_col).cast(f"decimal(28,{scale})")).over(w).cast("double") / F.count(value_col).over(w))
    return series.withColumn(out or f"ma{rows}_{value_col}", mean)


def range_window_sum(series: DataFrame, date_col: str, value_col: str, days: int = 7,
                     keys: Sequence[str] = (), out: str | None = None) -> DataFrame:
    """Sum and average over the calendar window [day - days + 1, day] (gap-safe:
    a missing day shortens the window instead of reaching further back)."""
    dn = day_number(F.col(date_col))
    base = Window.partitionBy(*keys).orderBy(dn) if keys else Window.orderBy(dn)
    w = base.rangeBetween(-(days - 1), 0)
    name = out or f"sum{days}d_{value_col}"
    return (series.withColumn(name, F.sum(value_col).over(w))
            .withColumn(f"n{days}d_days", F.count(F.lit(1)).over(w).cast("bigint")))


def share_of_total(df: DataFrame, keys: Sequence[str], value_col: str,
                   total_col: str = "group_total", share_col: str = "share_pct",
                   scale: int | None = None) -> DataFrame:
    """Each row's percent of its group total.

    Totals come from a partial-aggregated ``groupBy`` joined back on the keys,
    not from an unordered window: a window would pull every row of a group
    into one task, while the join of group totals is small (one row per
    group) and AQE splits a skewed key on the fact side. ``scale``: the value
    has at most that many decimals; the total is then the exact decimal sum.
    """
    total = F.sum(value_col) if scale is None else decimal_sum(value_col, scale)
    totals = df.groupBy(*keys).agg(total.alias(total_col))
    return (join_null_safe(df, totals, list(keys))
            .withColumn(share_col, F.when(F.col(total_col) != 0,
                                          F.lit(100.0) * F.col(value_col) / F.col(total_col))))
