"""Joins with an explicit, checked strategy.

Broadcasting is only done for a side whose row count has been *proven* to be
below a bound (``bounded``: a ``limit(n + 1).count()`` that stops reading as
soon as the bound is exceeded). Beyond the bound the join falls back to a
shuffle sort-merge join, which AQE may still turn into a broadcast at run
time from real shuffle sizes, and whose skewed partitions AQE splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rough per-value widths (bytes) used to turn a row bound into a byte bound.
_WIDTH = {"string": 48, "binary": 48, "array": 64, "map": 96, "struct": 64}
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def _row_width(df: DataFrame) -> int:
    width = 0
    for field in df.schema.fields:
        width += _WIDTH.get(field.dataType.typeName(), 8)
    return max(width, 8)


def estimated_bytes(df: DataFrame) -> float | None:
    """Catalyst's size estimate of ``df`` (from file sizes, no job run). None when there
    is no real estimate: Catalyst's stand-in for unknown sizes
    (``spark.sql.defaultSizeInBytes``, e.g. data that came from an RDD)."""
    est = float(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    unknown = df.sparkSession.conf.get("spark.sql.defaultSizeInBytes", None)
    unknown_bytes = float(unknown) if unknown and unknown.isdigit() else float(2 ** 63 - 1)
    return None if est >= 0.5 * unknown_bytes else est


def bounded(df: DataFrame, max_rows: int, max_bytes: int | None = None) -> bool:
    """True when ``df`` is proven to have at most ``max_rows`` rows.

    First Catalyst's file-size estimate (no job): data grows when decoded, so
    an estimate already above ``max_bytes`` rules the side out at once, which
    keeps the check cheap on a huge table. Otherwise the rows are counted on
    a zero-column projection (Parquet reads row counts, not column data) with
    every task stopping after ``max_rows + 1`` rows."""
    if max_bytes is not None:
        est = estimated_bytes(df)
        if est is not None and est > max_bytes:
            return False
    return df.select(F.lit(1).alias("__one")).limit(max_rows + 1).count() <= max_rows


def broadcast_if_bounded(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                         max_bytes: int = DEFAULT_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Broadcast-hint ``df`` only if its row count and estimated bytes are bounded."""
    rows_cap = min(max_rows, max(1, max_bytes // _row_width(df)))
    if bounded(df, rows_cap, max_bytes):
        return F.broadcast(df), True
    return df, False


def lookup_join(facts: DataFrame, lookup: DataFrame, on: str | Sequence[str] | None = None,
                how: str = "left", left_on: str | Sequence[str] | None = None,
                right_on: str | Sequence[str] | None = None, strategy: str = "auto",
                max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Join a fact table to a lookup table.

    ``on``: same-named key(s) (USING join, one key column in the output).
    ``left_on``/``right_on``: differently named keys (both kept).
    ``strategy``: ``auto`` (let Catalyst/AQE choose from statistics),
    ``broadcast`` (checked bound; falls back to merge when exceeded) or
    ``merge`` (sort-merge hint, e.g. for two large sides).
    """
    if strategy not in ("auto", "broadcast", "merge"):
        raise ValueError(f"unknown strategy {strategy!r}")
    if strategy == "broadcast":
        lookup, ok = broadcast_if_bounded(lookup, max_broadcast_rows)
        if not ok:
            lookup = lookup.hint("merge")
    elif strategy == "merge":
        lookup = lookup.hint("merge")
    if on is not None:
        return facts.join(lookup, on=on if isinstance(on, str) else list(on), how=how)
    if left_on is None or right_on is None:
        raise ValueError("give on= or both left_on= and right_on=")
    lk = [left_on] if isinstance(left_on, str) else list(left_on)
    rk = [right_on] if isinstance(right_on, str) else list(right_on)
    cond: Column | None = None
    for a, b in zip(lk, rk):
        c = facts[a] == lookup[b]
        cond = c if cond is None else cond & c
    return facts.join(lookup, cond, how)


def join_null_safe(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Inner join on same-named ``cols`` where null matches null, keeping one
    copy of each key column (group-by and window semantics treat null as a
    key of its own; a plain equi-join would drop those rows)."""
    r = right.select(*[F.col(c).alias(f"__r_{c}") if c in cols else F.col(c) for c in right.columns])
    cond: Column | None = None
    for c in cols:
        e = left[c].eqNullSafe(r[f"__r_{c}"])
        cond = e if cond is None else cond & e
    return left.join(r, cond, "inner").drop(*[f"__r_{c}" for c in cols])


def orphans(facts: DataFrame, lookup: DataFrame, left_on: str, right_on: str) -> DataFrame:
    """Fact rows whose key has no match in ``lookup`` (left anti join; the
    lookup keys need no de-duplication, so no extra shuffle)."""
    keys = lookup.select(F.col(right_on).alias("__k"))
    return facts.join(keys, facts[left_on] == keys["__k"], "left_anti")


def chain_joins(base: DataFrame, steps: Sequence[tuple[DataFrame, str | Sequence[str], str]]) -> DataFrame:
    """Apply several USING joins in sequence: ``[(df, on, how), ...]``."""
    out = base
    for other, on, how in steps:
        out = out.join(other, on=on if isinstance(on, str) else list(on), how=how)
    return out
