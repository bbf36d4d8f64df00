"""Data-quality operators: null handling, de-duplication, bounds, step counts
and column profiles. Counts are gathered in one pass (conditional aggregates
or ``Observation``) instead of one re-scan per count."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabflow.functions.columns import in_range

def _orderable(dtype: T.DataType) -> bool:
    """Whether Spark can sort the type: all but maps (and what holds one) and variants."""
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(how="any", subset=list(subset) if subset else None)


def fill_nulls(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.na.fill(dict(values))


def distinct_rows(df: DataFrame) -> DataFrame:
    """Remove fully identical rows (one shuffle on all columns)."""
    return df.dropDuplicates()


def dedupe_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """Keep one row per key: the first under ``order_by``, then every other
    column ascending as tie-breaker (maps by their JSON text), so the survivor is the same
    under any partitioning or file order.

    Planned as ``row_number() = 1``: Spark inserts a partial
    ``WindowGroupLimit`` before the shuffle, so each map task forwards at most
    one row per key and a hot key never lands whole in one task.
    """
    named = set(keys)
    ties = [(F.col(f.name) if _orderable(f.dataType) else F.to_json(F.struct(f.name))).asc_nulls_last()
            for f in df.schema.fields if f.name not in named]
    w = Window.partitionBy(*keys).orderBy(*order_by, *ties)
    return (df.withColumn("__rn", F.row_number().over(w))
            .filter(F.col("__rn") == 1).drop("__rn"))


def within_bounds(df: DataFrame, bounds: Mapping[str, tuple]) -> DataFrame:
    """One conjunctive filter from ``{col: (lo, hi, closed)}`` (``closed`` as in
    ``in_range``); pushed into the Parquet scan where the source allows."""
    pred: Column | None = None
    for col, spec in bounds.items():
        lo, hi, closed = (list(spec) + ["both"])[:3]
        p = in_range(col, lo, hi, closed)
        pred = p if pred is None else pred & p
    return df if pred is None else df.filter(pred)


def step_counts(df: DataFrame, steps: Sequence[tuple[str, Column]],
                first_step: str = "raw") -> DataFrame:
    """Row count before and after each cumulative cleaning step, in one scan.

    Returns ``(step_no int, step string, n_rows bigint)``: step 0 is the input,
    step i keeps rows passing predicates 1..i.
    """
    aggs = [F.count(F.lit(1)).alias("c0")]
    acc: Column | None = None
    for i, (_, pred) in enumerate(steps, start=1):
        acc = pred if acc is None else acc & pred
        aggs.append(F.count_if(F.coalesce(acc, F.lit(False))).alias(f"c{i}"))
    wide = df.agg(*aggs)
    names = [first_step] + [name for name, _ in steps]
    rows = [F.struct(F.lit(i).alias("step_no"), F.lit(n).alias("step"),
                     F.col(f"c{i}").cast("bigint").alias("n_rows"))
            for i, n in enumerate(names)]
    return wide.select(F.explode(F.array(*rows)).alias("s")).select("s.*")


def observe_counts(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter that fills during the next action (e.g. a write)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def profile_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Typed profile, one row per column: count, mean, stddev, min, max (one scan)."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__stddev"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"),
                     F.col(f"{c}__count").cast("bigint").alias("n"),
                     F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__stddev").alias("stddev"),
                     F.col(f"{c}__min").alias("min_value"), F.col(f"{c}__max").alias("max_value"))
            for c in cols]
    return wide.select(F.explode(F.array(*rows)).alias("p")).select("p.*")
