"""Upsert into a partitioned table that no reader sees half done.

Two catalog objects: a managed table ``<name>__files`` partitioned by a
generation number and the table's own partition columns, and the view
``<name>`` that readers use, whose predicate lists the partitions that count
now. An upsert writes the partitions it touches under a fresh generation, where
no reader looks, and then replaces the view's text: one catalog call, the only
switch. Before it every reader finds the old rows, after it the new ones. What
a run that stopped early has written is no part of the view and goes with the
next ``retire``.

Only partition values (catalog metadata, one entry a partition) reach the
driver, so partition by columns of few values, as any layer. One writer at a
time; readers need no lock. An empty text as a partition value is stored as
null, as Spark does in every partitioned table.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.operators.upsert import _matched, latest_changes, merge_rows
from tabflow.session import shared_path

GENERATION = "__generation"
_NULL = "__HIVE_DEFAULT_PARTITION__"

# a partition: (generation, values of the partition columns as text or None)
Partition = tuple[int, tuple[str | None, ...]]


def _ident(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def _files(name: str) -> str:
    return f"{name}__files"


def _quoted(value: str | None) -> str:
    if value is None:
        return "null"
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _partition_types(spark: SparkSession, name: str) -> dict[str, str]:
    """The table's own partition columns with their types, in order."""
    types = dict(spark.table(_files(name)).dtypes)
    listed = [c.name for c in spark.catalog.listColumns(_files(name)) if c.isPartition and c.name != GENERATION]
    return {c: types[c] for c in listed}


def _holds(types: dict[str, str], values: Sequence[str | None]) -> str:
    return " AND ".join(f"`{c}` <=> CAST({_quoted(v)} AS {t})" for (c, t), v in zip(types.items(), values))


def _predicate(types: dict[str, str], partitions: Sequence[Partition]) -> str:
    by_generation: dict[int, list[str]] = {}
    for generation, values in sorted(partitions, key=lambda p: (p[0], [v or "" for v in p[1]])):
        by_generation.setdefault(generation, []).append(f"({_holds(types, values)})")
    return " OR ".join(f"(`{GENERATION}` = {g} AND ({' OR '.join(held)}))" for g, held in by_generation.items()) or "false"


def partitions(spark: SparkSession, name: str) -> list[Partition]:
    """Every stored partition, also those no reader sees."""
    out = []
    for row in spark.sql(f"SHOW PARTITIONS {_ident(_files(name))}").collect():
        values = [unquote(part.split("=", 1)[1]) for part in row[0].split("/")]
        out.append((int(values[0]), tuple(None if v == _NULL else v for v in values[1:])))
    return out


def current(spark: SparkSession, name: str) -> list[Partition]:
    """The stored partitions that hold under the view's own predicate."""
    stored = partitions(spark, name)
    if not stored:
        return []
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {_ident(name)}").where("col_name = 'View Text'").first()
    predicate = described["data_type"].split(" WHERE ", 1)[1]
    types = _partition_types(spark, name)
    rows = [(i, g, *values) for i, (g, values) in enumerate(stored)]
    fields = ", ".join(f"`{c}` string" for c in types)
    listed = spark.createDataFrame(rows, f"__i int, `{GENERATION}` bigint, {fields}")
    typed = listed.select("__i", GENERATION, *[F.col(f"`{c}`").cast(t).alias(c) for c, t in types.items()])
    return [stored[r[0]] for r in typed.where(predicate).select("__i").collect()]


def _view_text(spark: SparkSession, name: str, columns: Sequence[str], parts: Sequence[Partition]) -> str:
    chosen = ", ".join(f"`{c}`" for c in columns)
    return f"SELECT {chosen} FROM {_ident(_files(name))} WHERE {_predicate(_partition_types(spark, name), parts)}"


def _write(df: DataFrame, name: str, types: Sequence[str], generation: int) -> None:
    """Append ``df`` as partitions of ``generation``; rows are gathered by partition
    first, which AQE splits where one value is large."""
    data = [c for c in df.columns if c not in types]
    (df.hint("rebalance", *[F.col(c) for c in types])
     .select(*data, F.lit(generation).cast("bigint").alias(GENERATION), *types)
     .write.insertInto(_files(name)))


def _switch(spark: SparkSession, name: str, columns: Sequence[str], parts: Sequence[Partition]) -> None:
    """Readers see ``parts`` from here on: one replaced view text, one catalog call."""
    spark.sql(f"ALTER VIEW {_ident(name)} AS {_view_text(spark, name, columns, parts)}")


def create_versioned(df: DataFrame, name: str, partition_by: Sequence[str]) -> DataFrame:
    """Store ``df`` as table ``name`` and return it read by name."""
    spark, by = df.sparkSession, list(partition_by)
    if not by or len(by) == len(df.columns):
        raise ValueError("a versioned table needs partition columns and at least one other")
    types = dict(df.dtypes)
    columns = [c for c in df.columns if c not in by]
    declared = ", ".join([f"`{c}` {types[c]}" for c in columns] + [f"`{GENERATION}` bigint"] + [f"`{c}` {types[c]}" for c in by])
    spark.sql(f"CREATE TABLE {_ident(_files(name))} ({declared}) USING parquet "
              f"PARTITIONED BY (`{GENERATION}`, {', '.join(f'`{c}`' for c in by)})")
    _write(df, name, by, 0)
    spark.sql(f"CREATE VIEW {_ident(name)} AS {_view_text(spark, name, df.columns, partitions(spark, name))}")
    return spark.table(name)


def upsert_versioned(spark: SparkSession, name: str, changes: DataFrame, keys: Sequence[str],
                     order_by: Sequence[Column]) -> None:
    """The latest change of each key replaces or joins the rows of ``name``.

    Keys and partition values match null-safely. The base is read twice: its keys
    and partition columns to find where replaced rows are, then whole touched
    partitions, pruned by literal values. Each touched partition is written once.
    Partitions that the last upsert replaced are dropped at the start of this one,
    so whoever reads while it switches keeps the files of the rows planned."""
    retire(spark, name)
    types = _partition_types(spark, name)
    base = spark.table(name)
    columns = base.columns
    stage = shared_path(spark, "latest-changes")  # the change set is deduplicated once, used twice
    latest_changes(changes, keys, order_by).select(*columns).write.parquet(stage)
    latest = spark.read.schema(base.schema).parquet(stage)
    replaced = _matched(base.select(*dict.fromkeys([*keys, *types])), latest, keys, "left_semi").select(*types)
    as_text = [F.nullif(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in types]
    touched = {tuple(r) for r in latest.select(*types).unionByName(replaced).select(*as_text).distinct().collect()}
    if not touched:
        return
    kept = [p for p in current(spark, name) if p[1] not in touched]
    generation = 1 + max((g for g, _ in partitions(spark, name)), default=-1)
    affected = base.where(" OR ".join(f"({_holds(types, values)})" for values in sorted(touched, key=lambda v: [x or "" for x in v])))
    _write(merge_rows(affected, latest, keys), name, list(types), generation)
    fresh = [p for p in partitions(spark, name) if p[0] == generation]
    _switch(spark, name, columns, kept + fresh)


def retire(spark: SparkSession, name: str) -> int:
    """Drop the stored partitions, files included, that are no part of the view; their number."""
    held = set(current(spark, name))
    old = [p for p in partitions(spark, name) if p not in held]
    types = _partition_types(spark, name)
    if old:
        specs = ", ".join("PARTITION (" + ", ".join(
            [f"`{GENERATION}` = {g}"] + [f"`{c}` = {_quoted(v)}" for c, v in zip(types, values)]) + ")" for g, values in old)
        spark.sql(f"ALTER TABLE {_ident(_files(name))} DROP IF EXISTS {specs}")
    return len(old)
