"""Scoped caching: fill with one action, always release."""

from __future__ import annotations

import contextlib

from pyspark import StorageLevel
from pyspark.sql import DataFrame


@contextlib.contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK, fill: bool = True):
    """``with cached(df) as c: ...`` persists ``df`` (spilling to disk rather
    than recomputing), optionally fills it with one count, and unpersists on
    exit. Lost cached blocks are recomputed from lineage by Spark."""
    df.persist(level)
    try:
        if fill:
            df.count()
        yield df
    finally:
        df.unpersist()
