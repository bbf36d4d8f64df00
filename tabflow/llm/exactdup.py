"""Exact duplicates: heavy digests found by Misra-Gries leave without a shuffle."""

from __future__ import annotations

import sys
from collections import Counter

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.llm.common import lean, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def misra_gries(held: Counter, rows: list, k: int) -> Counter:
    """``held`` with ``rows`` added and cut back to ``k`` counters.

    All counters go down by the (k+1)-th largest and those at zero go. Each such step
    takes its amount from k + 1 counters or more, so after n rows a counter is at most
    n / (k + 1) below its key's true count."""
    held.update(rows)
    if len(held) > k:
        less = held.most_common(k + 1)[-1][1]
        held = Counter({key: c - less for key, c in held.items() if c > less})
    return held


def heavy(digests: DataFrame, column: str, k: int) -> DataFrame:
    """(column, n): the true counts of at most k + 1 keys, among them every key
    of more than 2 / (k + 1) of all rows.

    Each task keeps ``k`` counters. Sums of the tasks' counters are below the true counts
    by N / (k + 1) at most, and together at most N, so at most k + 1 keys have a sum of
    N / (k + 1) or more, and every key with twice that is one of them. Their true counts
    come from a second pass over the digests, which joins the bounded list map-side."""

    def scan(batches):
        held, rows = Counter(), 0
        for b in batches:
            rows += b.num_rows
            held = misra_gries(held, b.column(0).to_pylist(), k)
        keys = list(held)
        yield pa.record_batch([pa.array([*keys, None], pa.binary()), pa.array([held[x] for x in keys] + [rows], pa.int64())],
                              [column, "c"])

    summary = digests.select(column).mapInArrow(lean(scan), f"{column} binary, c long") \
        .groupBy(column).agg(F.sum("c").alias("c"))
    summary = written(summary, "counters")
    total = summary.where(F.col(column).isNull()).select("c").first()
    bound = (total[0] if total else 0) / (k + 1)
    likely = summary.where(F.col(column).isNotNull() & (F.col("c") >= F.lit(bound))).select(column)
    return digests.join(F.broadcast(likely), column).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", counters: int = 4096,
                     carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 (hex) and the ``carry`` columns of
    every row: texts are equal when identical after lower-casing A-Z, and of equal texts
    the row with the largest doc_id stays.

    1. One pass over the texts writes their SHA-256 digests with a row number. 2. Misra-Gries
    counters in each task find the digests of more than 2 / (``counters`` + 1) of all rows;
    their counts are verified in a second pass. 3. The verified winners (at most
    ``counters`` + 1 rows of 32 bytes) and what stays of each are broadcast: their rows are
    decided map-side and never shuffled. 4. The other digests are pre-aggregated, shuffled and
    joined back; none of them has more than that share of the rows.

    A null text counts as empty. A null doc_id ranks below every other. Of rows that repeat
    both the text and the largest doc_id exactly one is kept. Other columns are ignored unless
    carried; an empty table gives no rows."""
    clash = {"doc_id", "keep_id", "group_size", "kept", "text_sha256"} & set(carry)
    if clash:
        raise ValueError(f"columns of the result can't be carried: {sorted(clash)}")
    more = [f"_c{i}" for i in range(len(carry))]
    folded = F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), UPPER, LOWER)
    rows = written(
        docs.select(F.col(id_column).cast("long").alias("doc_id"), F.unhex(F.sha2(folded, 256)).alias("d"),
                    F.monotonically_increasing_id().alias("row"), *[F.col(c).alias(m) for c, m in zip(carry, more)]), "digests")
    winners = heavy(rows.select("d"), "d", counters)
    first = F.max(F.struct("doc_id", "row")).alias("top")
    # of the winners only their number of rows and the one that stays: still one row per winner
    winners = written(rows.join(F.broadcast(winners), "d").groupBy("d", "n").agg(first), "winners")
    light = rows.join(F.broadcast(winners.select("d")), "d", "left_anti")
    group = light.groupBy("d").agg(F.count(F.lit(1)).alias("n"), first).where("n > 1")
    every = rows.join(F.broadcast(winners), "d").select("doc_id", "row", "d", *more, "n", "top") \
        .unionByName(light.join(group, "d", "left").select("doc_id", "row", "d", *more, "n", "top"))
    alone = F.col("top").isNull()
    return every.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("top.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("top.row"))).alias("kept"), F.lower(F.hex("d")).alias("text_sha256"),
        *[F.col(m).alias(c) for c, m in zip(carry, more)])
