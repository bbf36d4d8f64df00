"""Read physical plans as text, to assert what Catalyst chose: pushed
filters, pruned read schemas, join strategies and shuffle counts."""

from __future__ import annotations

import contextlib
import io
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def explain_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def explain_sql(spark: SparkSession, sql: str, mode: str = "FORMATTED") -> str:
    """``EXPLAIN <mode> <sql>`` evaluated by Spark SQL."""
    return spark.sql(f"EXPLAIN {mode} {sql}").first()[0]


def physical_section(text: str) -> str:
    """Operator tree part of a formatted plan (before the per-node details)."""
    head = text.split("\n\n(1)")[0]
    return head


def count_exchanges(df: DataFrame) -> int:
    """Number of shuffle exchanges in the final physical plan (broadcasts excluded)."""
    tree = physical_section(explain_text(df, "formatted"))
    return len(re.findall(r"(?<![A-Za-z])Exchange\b", tree))


def join_strategies(df: DataFrame) -> list[str]:
    tree = physical_section(explain_text(df, "formatted"))
    return re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)", tree)


def assert_plan(df: DataFrame, contains: Sequence[str] = (), absent: Sequence[str] = (),
                mode: str = "formatted") -> str:
    text = explain_text(df, mode)
    for needle in contains:
        if needle not in text:
            raise AssertionError(f"plan lacks {needle!r}:\n{text}")
    for needle in absent:
        if needle in text:
            raise AssertionError(f"plan has {needle!r}:\n{text}")
    return text


def same_plan(a: DataFrame, b: DataFrame) -> bool:
    """True when two DataFrames (e.g. SQL text and API twin) compute the same
    result per Catalyst's canonicalised plans."""
    return a.sameSemantics(b)
