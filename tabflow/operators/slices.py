"""Frames over one long ordered series, without a single task that holds it.

``Window.orderBy`` alone, or a hot partition key, sends the whole series to one task. Here the
rows are cut into slices of the order (keys first, then the order columns), a slice is a task's
share, and what a frame needs from outside its slice is carried there:

* ``halo_windows``: row frames (lag, lead, moving averages). A slice gets the last ``before``
  rows in front of it and the first ``after`` rows behind it.
* ``range_sums``: frames by value. Sums are differences of running sums, so a frame that spans
  many slices costs two rows for each value, not a copy of the rows in the frame.

The cuts are rows of a bounded sample (smallest hashes, the same in every evaluation); they decide
the balance, never the result. Order columns ascend, nulls first. The input is evaluated once for
the cuts, once for the totals of the slices and again for the result, so it should be a table or cheap.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tabflow.operators.relational import join_null_safe

_SLICE, _OWN, _NO = "__slice", "__own", "__no"


def _place(names: Sequence[str]) -> Column:
    return F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])


def _to_text(c: Column, kind: str) -> Column:
    """Text from which ``_from_text`` makes the same value in any session time zone."""
    return (F.unix_micros(c) if kind == "timestamp" else c).cast("string")


def _from_text(text: str | None, kind: str) -> Column:
    if kind == "timestamp":
        return F.timestamp_micros(F.lit(text).cast("bigint"))
    return F.lit(text).cast(kind)


def with_slice(df: DataFrame, order: Sequence[str], slices: int | None = None, per_slice: int = 32) -> DataFrame:
    """Add ``__slice``, 0 to ``slices`` - 1 in the order of ``order`` (default: the shuffle partitions).

    The cuts come from the ``slices`` * ``per_slice`` rows of smallest hash; they pass through the
    driver as text of the order columns. The slice is found by halving, in column functions only."""
    n = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    types = [df.schema[c].dataType.simpleString() for c in order]
    names = [f"c{i}" for i in range(len(order))]
    at = df.select(*[F.col(f"`{c}`").alias(a) for a, c in zip(names, order)])
    few = at.orderBy(F.xxhash64(*names), *names).limit(n * per_slice)
    w = Window.orderBy(*names)  # over the sample only
    tile = few.withColumn("t", F.ntile(n).over(w)).groupBy("t").agg(F.min(F.struct(*names)).alias("p")).where("t > 1")
    first = tile.select("p.*").distinct().orderBy(*names).select(*[_to_text(F.col(c), t).alias(c) for c, t in zip(names, types)])
    cuts = [F.struct(*[_from_text(v, t).alias(a) for a, v, t in zip(names, row, types)]) for row in first.collect()]
    if not cuts:
        return df.withColumn(_SLICE, F.lit(0))
    bounds, place = F.array(*cuts), _place(order)
    df = df.withColumn(_SLICE, F.lit(0))
    for bit in reversed(range(len(cuts).bit_length())):
        df = df.withColumn(_SLICE, F.col(_SLICE) + F.when(place >= F.get(bounds, F.col(_SLICE) + F.lit(2**bit - 1)), 2**bit).otherwise(0))
    return df


def _reached(counts: Mapping[int, int], reach: int, forward: bool) -> list[tuple[int, int, int]]:
    """(slice, slice that needs its edge, rows between the two) for frames of ``reach`` rows."""
    order = sorted(counts) if forward else sorted(counts, reverse=True)
    out = []
    for i, needs in enumerate(order):
        between = 0
        for giver in reversed(order[:i]):
            if between >= reach:
                break
            out.append((giver, needs, between))
            between += counts[giver]
    return out


def _carried(sliced: DataFrame, order: Sequence[str], counts: Mapping[int, int], reach: int, forward: bool) -> DataFrame:
    """The ``reach`` rows next to each slice, under the number of the slice that needs them. Only the
    edges of slices are repeated: ``reach`` rows for each slice, whatever the size of the series."""
    w = Window.partitionBy(_SLICE).orderBy(*[F.col(f"`{c}`").desc() if forward else F.col(f"`{c}`").asc() for c in order])
    edges = sliced.withColumn(_NO, F.row_number().over(w)).where(F.col(_NO) <= reach)
    # at most ``reach`` givers for each slice, usually one
    links = sliced.sparkSession.createDataFrame(_reached(counts, reach, forward), f"{_SLICE} int, __needs int, __between long")
    return (edges.join(F.broadcast(links), _SLICE).where(F.col(_NO) + F.col("__between") <= reach)
            .withColumn(_SLICE, F.col("__needs")).drop(_NO, "__needs", "__between"))


def halo_windows(df: DataFrame, order: Sequence[str], frames: Callable[[WindowSpec], Mapping[str, Column]],
                 before: int = 0, after: int = 0, keys: Sequence[str] = (), slices: int | None = None) -> DataFrame:
    """``df`` with the columns ``frames(w)``, as over ``Window.partitionBy(keys).orderBy(order)``.

    ``order`` must be a total order within ``keys``. The frames may look at most ``before`` rows back and
    ``after`` rows ahead (``F.lag(c, before)``, ``w.rowsBetween(-before, after)``). A null key is a key."""
    place = [*keys, *order]
    sliced = with_slice(df, place, slices)
    counts = {r[0]: r[1] for r in sliced.groupBy(_SLICE).count().collect()}  # one row for each slice
    spread = sliced.withColumn(_OWN, F.lit(True))
    for reach, forward in ((before, True), (after, False)):
        if reach and len(counts) > 1:
            spread = spread.unionByName(_carried(sliced, place, counts, reach, forward).withColumn(_OWN, F.lit(False)))
    w = Window.partitionBy(_SLICE, *[F.col(f"`{k}`") for k in keys]).orderBy(*[F.col(f"`{c}`") for c in order])
    return spread.withColumns(dict(frames(w))).where(_OWN).drop(_OWN, _SLICE)


def range_sums(df: DataFrame, order: str, value: str, preceding: Column, keys: Sequence[str] = (), scale: int = 2,
               sum_col: str = "range_sum", count_col: str = "range_rows", slices: int | None = None) -> DataFrame:
    """``df`` with the sum of ``value`` and the number of rows over the frame
    ``RANGE BETWEEN preceding PRECEDING AND CURRENT ROW`` of ``order`` within ``keys``.

    Values have at most ``scale`` decimals and are summed as decimals, so a difference of running sums is
    exact. Rows are first summed for each value of ``order``, so ties meet as one row. A frame without any
    non-null value has a null sum; rows whose order value is null are each other's frame."""
    at, of, side = f"`{order}`", "__of", "__side"
    number = F.col(f"`{value}`").cast(f"decimal(28,{scale})")
    sums = {"__s": F.coalesce(F.sum(number), F.lit(0)).cast(f"decimal(38,{scale})"),
            "__r": F.count(F.lit(1)), "__c": F.count(number)}
    groups = [F.col(f"`{k}`") for k in keys]
    points = df.groupBy(*groups, F.col(at)).agg(*[e.alias(n) for n, e in sums.items()])
    kind = df.schema[order].dataType
    starts = points.select(*groups, (F.col(at) - preceding).cast(kind).alias(order), F.col(at).alias(of), F.lit(0).alias(side),
                           *[F.lit(0).cast(points.schema[n].dataType).alias(n) for n in sums])
    # a frame's start comes before the rows of its value, so its running sum leaves them in the frame
    marks = points.select(*groups, F.col(at), F.col(at).alias(of), F.lit(1).alias(side), *sums).unionByName(starts)
    place = [*keys, order, side]
    sliced = with_slice(marks, place, slices)
    totals = sorted(sliced.groupBy(_SLICE).agg(*[F.sum(n).alias(n) for n in sums]).collect())  # one row for each slice
    names = list(sums)
    back = [list(accumulate((row[n] for row in totals), initial=0)) for n in names]
    offsets = df.sparkSession.createDataFrame(
        [(row[_SLICE], *[str(b[i]) for b in back]) for i, row in enumerate(totals)],
        f"{_SLICE} int, " + ", ".join(f"{n}_off string" for n in names))
    w = Window.partitionBy(_SLICE).orderBy(*[F.col(f"`{c}`") for c in place]).rowsBetween(Window.unboundedPreceding, 0)
    running = (sliced.withColumns({n: F.sum(n).over(w).cast(points.schema[n].dataType) for n in names}).join(F.broadcast(offsets), _SLICE)
               .withColumns({n: F.col(n) + F.col(f"{n}_off").cast(points.schema[n].dataType) for n in names}))
    between = [(F.max(F.when(F.col(side) == 1, F.col(n))) - F.max(F.when(F.col(side) == 0, F.col(n)))).alias(n) for n in names]
    found = (running.groupBy(*groups, F.col(of)).agg(*between)
             .select(*groups, F.col(of).alias(order), F.when(F.col("__c") > 0, F.col("__s")).alias(sum_col), F.col("__r").alias(count_col)))
    return join_null_safe(df, found, [*keys, order])
