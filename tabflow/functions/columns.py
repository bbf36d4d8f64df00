"""Derived-column helpers. Everything here is a native Spark expression, so
it stays inside whole-stage codegen and works identically in streaming."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MILE_TO_KM = 1.60934


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def band(col, edges: Sequence[float], labels: Sequence[str], null_label: str | None = None) -> Column:
    """Threshold bands, first match wins: ``col < edges[i]`` -> ``labels[i]``.

    ``labels`` has one more entry than ``edges``; the last one is the
    ``otherwise`` label. A null input gets ``null_label`` (checked first) or
    stays null when none is given.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("band needs len(labels) == len(edges) + 1")
    if list(edges) != sorted(edges):
        raise ValueError("band edges must be ascending")
    c = _col(col)
    expr = None
    if null_label is not None:
        expr = F.when(c.isNull(), F.lit(null_label))
    for edge, label in zip(edges, labels):
        cond = c < F.lit(edge)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    otherwise = F.lit(labels[-1])
    if null_label is None:
        # keep null for null input instead of falling into the last band
        return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(expr.otherwise(otherwise))
    return expr.otherwise(otherwise)


def safe_ratio(num, den) -> Column:
    """``num / den`` when ``den > 0``, else null (never raises under ANSI)."""
    n, d = _col(num), _col(den)
    return F.when(d > 0, n / d)


def minutes_between(start, end) -> Column:
    """Minutes from ``start`` to ``end``; works for TIMESTAMP and TIMESTAMP_NTZ."""
    return F.timestamp_diff("SECOND", _col(start), _col(end)) / F.lit(60.0)


def days_between(start, end) -> Column:
    return F.timestamp_diff("SECOND", _col(start), _col(end)) / F.lit(86400.0)


def miles_to_km(col) -> Column:
    return _col(col) * F.lit(MILE_TO_KM)


def day_number(ts) -> Column:
    """Days since 1970-01-01; a gap-safe ordering key for value-range frames."""
    return F.datediff(F.to_date(_col(ts)), F.lit("1970-01-01").cast("date"))


def in_range(col, lo=None, hi=None, closed: str = "both") -> Column:
    """Range predicate with explicit end semantics.

    ``closed`` is one of ``both`` ([lo, hi]), ``neither`` ((lo, hi)),
    ``left`` ([lo, hi)) or ``right`` ((lo, hi]). A missing bound is open-ended.
    """
    if closed not in ("both", "neither", "left", "right"):
        raise ValueError(f"bad closed={closed!r}")
    c = _col(col)
    preds = []
    if lo is not None:
        preds.append(c >= F.lit(lo) if closed in ("both", "left") else c > F.lit(lo))
    if hi is not None:
        preds.append(c <= F.lit(hi) if closed in ("both", "right") else c < F.lit(hi))
    if not preds:
        return c.isNotNull()
    out = preds[0]
    for p in preds[1:]:
        out = out & p
    return out


def half_open(col, start: str, end: str) -> Column:
    """``start <= col < end`` with string bounds (cast by Spark to the column type)."""
    c = _col(col)
    return (c >= F.lit(start)) & (c < F.lit(end))
