"""Jump consistent hashing: stable keys to shards without a ring table."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabflow.llm.common import running

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_STEP = np.uint64(2862933555777941757)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unsigned 64-bit key by jump consistent hashing. A key's next
    jump target depends on the key alone, so one more shard takes keys only into
    itself and every other key stays."""
    key = keys.astype(np.uint64).copy()
    at = np.full(len(key), -1, np.int64)
    to = np.zeros(len(key), np.int64)
    live = np.arange(len(key))
    while len(live):
        at[live] = to[live]
        k = key[live] * _STEP + np.uint64(1)
        key[live] = k
        to[live] = ((at[live] + 1) * (2147483648.0 / ((k >> np.uint64(33)).astype(np.float64) + 1.0))).astype(np.int64)
        live = live[to[live] < shards]
    return at


def shard_of(key: Column, shards: int) -> Column:
    """Shard of a 64-bit key column (null keys count as key 0)."""
    if shards < 1:
        raise ValueError("shards must be at least 1")

    @F.pandas_udf("int")
    def place(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(np.int64).view(np.uint64), shards).astype(np.int32))

    return place(F.coalesce(key.cast("long"), F.lit(0).cast("long")))


def shard_documents(docs: DataFrame, shards: int = 24, key: str = "doc_id", text: str = "text",
                    buckets: int = 256) -> DataFrame:
    """One row per document: key, size (UTF-8 bytes + 8), text_crc32, law ``key``,
    shard, slot (gapless from 0 in its shard) and grown_shard (with one shard more).

    Only key, size and checksum are shuffled, never texts. Slots come from
    ``running``, which cuts each shard into hash buckets. A null text has size 8 and
    checksum 0, as an empty one; a null key is placed as key 0; repeated rows take one slot
    each; other columns are ignored; an empty table gives no rows."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        (F.octet_length(body) + 8).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        shard_of(F.col(key), shards).alias("shard"),
        shard_of(F.col(key), shards + 1).alias("grown_shard"))
    placed = running(rows, ["shard"], ["doc_id", "text_crc32", "size"], buckets=buckets, name="slots")
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                         F.col("before").cast("long").alias("slot"), "grown_shard")
