"""Distinct counts and quantiles kept as mergeable sketches beside a layer.

A day's sketches are written once, of bounded size; a month or the total comes from merging them,
in any order, without reading rows again.

* Distinct values: HyperLogLog of 2^``lg_k`` registers, relative error ``distinct_error`` (one sigma).
* Quantiles: KLL of size ``k``, rank error ``rank_error`` (99 % of the time).

Nulls are in neither sketch; a group without any value has 0 distinct values and null quantiles.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 12
KLL_K = 800


def distinct_error(lg_k: int = LG_K) -> float:
    """One sigma of the relative error of a merged HyperLogLog sketch."""
    return 1.04 / 2 ** (lg_k / 2)


def rank_error(k: int = KLL_K) -> float:
    """Error of a KLL quantile's rank, as a share of all rows, at 99 %."""
    return 2.296 / k**0.9723


def sketch_groups(df: DataFrame, keys: Sequence[str | Column], distinct: Sequence[str] = (), quantiles: Sequence[str] = (),
                  lg_k: int = LG_K, k: int = KLL_K) -> DataFrame:
    """One row for each group: ``n_rows``, ``<c>_hll`` for each distinct column, ``<c>_kll`` and ``<c>_n``
    (values counted) for each quantile column. Tasks build partial sketches before the shuffle."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for c in distinct:
        aggs.append(F.hll_sketch_agg(F.col(f"`{c}`").cast("string"), lg_k).alias(f"{c}_hll"))
    for c in quantiles:
        number = F.col(f"`{c}`").cast("double")
        number = F.when(~F.isnan(number), number)
        aggs += [F.kll_sketch_agg_double(number, k).alias(f"{c}_kll"), F.count(number).alias(f"{c}_n")]
    return df.groupBy(*keys).agg(*aggs)


def _sketched(layer: DataFrame, ending: str) -> list[str]:
    return [c[: -len(ending)] for c in layer.columns if c.endswith(ending)]


def merge_sketches(layer: DataFrame, keys: Sequence[str | Column] = (), k: int = KLL_K) -> DataFrame:
    """The sketches of ``layer`` (rows of ``sketch_groups`` or of this function) merged by ``keys``."""
    aggs = [F.sum("n_rows").alias("n_rows")]
    aggs += [F.hll_union_agg(f"{c}_hll").alias(f"{c}_hll") for c in _sketched(layer, "_hll")]
    for c in _sketched(layer, "_kll"):
        aggs += [F.kll_merge_agg_double(f"{c}_kll", k).alias(f"{c}_kll"), F.sum(f"{c}_n").alias(f"{c}_n")]
    return layer.groupBy(*keys).agg(*aggs)


def sketch_values(layer: DataFrame, ranks: Mapping[str, float] = {"median": 0.5}) -> DataFrame:  # noqa: B006 - never changed
    """The sketches read: ``<c>_distinct`` and ``<c>_<name>`` for each named rank; other columns stay."""
    out = {f"{c}_distinct": F.coalesce(F.hll_sketch_estimate(f"{c}_hll"), F.lit(0)) for c in _sketched(layer, "_hll")}
    for c in _sketched(layer, "_kll"):
        for name, rank in ranks.items():
            out[f"{c}_{name}"] = F.when(F.col(f"{c}_n") > 0, F.kll_sketch_get_quantile_double(f"{c}_kll", F.lit(rank)))
    gone = [f"{c}_hll" for c in _sketched(layer, "_hll")] + [f"{c}{e}" for c in _sketched(layer, "_kll") for e in ("_kll", "_n")]
    return layer.withColumns(out).drop(*gone)
