"""Reproducible sampling and splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sample_seeded(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Bernoulli sample (reproducible for a fixed input partitioning)."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def key_md5(cols: Sequence[str]):
    """MD5 of the key's text (columns joined by ``|``, null as ``~``), the same in any engine."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in cols])
    return F.md5(text.cast("binary"))


def hash_bucket(cols: Sequence[str], buckets: int = 100):
    """Bucket 0 to buckets - 1 from the MD5 of the key's text, the same in any engine."""
    return F.conv(F.substring(key_md5(cols), 1, 8), 16, 10).cast("long") % buckets


def bottom_k_sample(df: DataFrame, groups: Sequence[str], key_cols: Sequence[str], k: int, salts: int = 64) -> DataFrame:
    """``k`` rows of each group (all of a smaller one): those whose key has the smallest MD5.

    The same rows whatever the partitioning, and mergeable: the sample of a union is the sample of the
    samples. Rows of one key (ties) go by their other columns, so only identical rows are interchangeable.
    A group is dealt over ``salts`` by its MD5 and cut to ``k`` rows in each (before the shuffle below 1,000
    rows), so a task of the last step sees at most ``k * salts`` rows of a group. A null group is a group."""
    ties = [F.col(f"`{c}`") for c, t in df.dtypes if c not in key_cols and not t.startswith(("map", "variant"))]
    rows = df.withColumn("__md5", key_md5(key_cols))
    order = ["__md5", *[F.col(f"`{c}`") for c in key_cols], *ties]
    by = [F.col(f"`{g}`") for g in groups]
    salt = F.conv(F.substring("__md5", 1, 4), 16, 10).cast("long") % salts
    for part in ([*by, salt], by):
        rows = rows.withColumn("__no", F.row_number().over(Window.partitionBy(*part).orderBy(*order))).where(F.col("__no") <= k).drop("__no")
    return rows.drop("__md5")


def hash_split(df: DataFrame, key_cols: Sequence[str], train_pct: int = 80) -> tuple[DataFrame, DataFrame]:
    """Deterministic train/test split on a hash of the key columns: the same
    row lands on the same side whatever the partitioning or file order."""
    b = hash_bucket(key_cols)
    return df.filter(b < train_pct), df.filter(b >= train_pct)
