"""Skew handling at the user level: measure key skew and salt hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How each partial aggregate is merged in the second stage.
_MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def salted_agg(df: DataFrame, keys: Sequence[str], aggs: Sequence[tuple[str, str, str]],
               salts: int = 32, salt_cols: Sequence[str] | None = None) -> DataFrame:
    """Two-stage aggregation with a salt: ``aggs`` = ``[(fn, col, out), ...]``
    with fn in sum/count/min/max. Stage 1 groups by (keys, salt), so a hot key
    is spread over ``salts`` reducers; stage 2 merges at most ``salts`` rows
    per key. The salt is a hash of row columns, so it is deterministic and
    retried tasks produce the same split. Equals the unsalted result.
    """
    cols = list(salt_cols) if salt_cols else [c for c in df.columns if c not in keys]
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(salts)))
    first = []
    for fn, col, out in aggs:
        if fn == "count":
            first.append(F.count(F.col(col) if col != "*" else F.lit(1)).alias(out))
        elif fn in _MERGE:
            first.append(getattr(F, fn)(F.col(col)).alias(out))
        else:
            raise ValueError(f"salted_agg supports sum/count/min/max, not {fn!r}")
    stage1 = salted.groupBy(*keys, "__salt").agg(*first)
    second = [_MERGE[fn](F.col(out)).alias(out) for fn, _, out in aggs]
    return stage1.groupBy(*keys).agg(*second)


def skew_report(df: DataFrame, keys: Sequence[str], top: int | None = None) -> DataFrame:
    """Rows per key with share of all rows and ratio to the mean key size.

    The grand totals are a scalar sub-query (one value broadcast to all
    tasks), not a cross join or a global window.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    total = counts.select(F.sum("n_rows")).scalar()
    n_keys = counts.select(F.count(F.lit(1))).scalar()
    out = (counts
           .withColumn("share_pct", F.lit(100.0) * F.col("n_rows") / total)
           .withColumn("ratio_to_mean", F.col("n_rows") * n_keys / total))
    if top is not None:
        key_order: list[Column] = [F.col(k).asc() for k in keys]
        out = out.orderBy(F.col("n_rows").desc(), *key_order).limit(top)
    return out


def hot_keys(df: DataFrame, key: str, least_share: float) -> list:
    """Keys that hold at least ``least_share`` of all rows: at most 1 / least_share of them."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = df.count()
    return [r[key] for r in counts.where(F.col("n") >= least_share * total).select(key).collect()]


def largest_share(df: DataFrame, keys: Sequence[str], stage: str) -> DataFrame:
    """(stage, largest_share): the share of all rows that the largest key holds."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg((F.max("n") / F.sum("n")).alias("largest_share")).select(F.lit(stage).alias("stage"), "largest_share")


def salted_join(facts: DataFrame, lookup: DataFrame, left_on: str, right_on: str, spread_by: Column,
                salts: int = 32, least_share: float = 0.01, how: str = "inner") -> DataFrame:
    """Join on a skewed key: rows of hot keys (measured, at most 1 / ``least_share``) are
    dealt over ``salts`` by a hash of ``spread_by``, and the lookup rows of those keys
    are repeated once per salt. Other keys join as they are. Same rows as the plain join;
    ``how`` is inner, left or left_semi, which repeat no unmatched lookup row."""
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"salted_join supports inner, left and left_semi, not {how!r}")
    hot = hot_keys(facts, left_on, least_share)
    is_hot = lambda c: F.col(c).isin(hot) if hot else F.lit(False)
    left = facts.withColumn("__salt", F.when(is_hot(left_on), F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")).otherwise(0))
    right = lookup.withColumn("__rsalt", F.explode(
        F.when(is_hot(right_on), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    joined = left.join(right, (left[left_on] == right[right_on]) & (left["__salt"] == right["__rsalt"]), how)
    return joined.drop("__salt", "__rsalt")


def rows_per_task(df: DataFrame) -> DataFrame:
    """(task, n_rows): rows in each task of the stage that ends in ``df``. The count is
    partial in that same stage, so it measures the shuffle before it and adds none of
    its size. Tasks without rows are not listed."""
    return df.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n_rows"))


def task_balance(df: DataFrame, stage: str, tasks: int) -> DataFrame:
    """One row: rows, the largest task's rows, and its ratio to the mean of ``tasks`` tasks."""
    total, largest = F.coalesce(F.sum("n_rows"), F.lit(0)), F.coalesce(F.max("n_rows"), F.lit(0))
    return rows_per_task(df).agg(total.alias("n_rows"), largest.alias("largest_task")).select(
        F.lit(stage).alias("stage"), "n_rows", "largest_task",
        F.when(F.col("n_rows") > 0, F.col("largest_task") * F.lit(float(tasks)) / F.col("n_rows")).alias("over_mean"))


def join_tasks(df: DataFrame, tasks: int | None = None) -> int:
    """Tasks of a join between two shuffled sides: Spark raises any number to the session's shuffle setting."""
    return max(tasks or 1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def shuffled_join(facts: DataFrame, lookup: DataFrame, left_on: str, right_on: str, tasks: int | None = None,
                  how: str = "inner") -> DataFrame:
    """Sort-merge join of two sides that are both too large to broadcast, dealt over ``join_tasks`` by the key alone."""
    tasks = join_tasks(facts, tasks)
    left, right = facts.repartition(tasks, left_on), lookup.repartition(tasks, right_on)
    return left.join(right.hint("merge"), left[left_on] == right[right_on], how)


def balanced_join(facts: DataFrame, lookup: DataFrame, left_on: str, right_on: str, spread_by: Column,
                  tasks: int | None = None, pieces: int = 4, how: str = "inner") -> DataFrame:
    """Sort-merge join of two large sides on a skewed key of ``facts``, no task much above the mean.

    Keys are counted once. One that holds n of N rows is cut into ``pieces`` * n * ``tasks`` / N
    salts, pieces of a quarter of a mean task by default, and only its lookup rows are
    repeated, once for each of its salts. Only keys above a mean task are cut, fewer than
    ``tasks``, so the list of them has a proven bound. ``spread_by`` is a whole number that
    differs between the rows of a key (``F.xxhash64`` of some columns). Rows with a null key
    match nothing: an inner or semi join leaves them out before the shuffle, a left join deals them over
    all tasks. ``how`` is inner, left or left_semi, which repeat no unmatched lookup row. The
    result is the plain join's, repeated rows and columns of equal names included."""
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"balanced_join supports inner, left and left_semi, not {how!r}")
    spark = facts.sparkSession
    tasks = join_tasks(facts, tasks)
    if how != "left":
        facts = facts.where(F.col(left_on).isNotNull())
    counts = facts.where(F.col(left_on).isNotNull()).groupBy(F.col(left_on).alias("__hot")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.select(F.sum("n")).scalar()
    salts = F.ceil(F.col("n") * F.lit(pieces * tasks) / total).cast("int")
    hot = counts.where(F.col("n") * F.lit(tasks) > total).select("__hot", salts.alias("__salts")).collect()
    cut = F.broadcast(spark.createDataFrame(hot, f"__hot {facts.schema[left_on].dataType.simpleString()}, __salts int"))
    own = F.when(F.col(left_on).isNull(), F.lit(tasks)).otherwise(F.coalesce("__salts", F.lit(1)))
    left = facts.join(cut, facts[left_on] == cut["__hot"], "left") \
        .withColumn("__salt", F.pmod(spread_by, own).cast("int")).drop("__hot", "__salts") \
        .repartition(tasks, left_on, "__salt")
    right = lookup.join(cut, lookup[right_on] == cut["__hot"], "left") \
        .withColumn("__rsalt", F.explode(F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1))).drop("__hot", "__salts") \
        .repartition(tasks, right_on, "__rsalt")
    joined = left.join(right.hint("merge"), (left[left_on] == right[right_on]) & (left["__salt"] == right["__rsalt"]), how)
    return joined.drop("__salt", "__rsalt")
