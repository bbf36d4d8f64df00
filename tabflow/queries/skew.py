"""Task sizes of a skewed join between two large tables, before and after it is balanced."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabflow.operators.skew import balanced_join, shuffled_join, task_balance
from tabflow.queries.registry import query, tbl

TASKS = 256  # at least the session's shuffle setting, so that the SQL can name it
PIECES = 4

# Murmur3 constants that Spark's hash partitioning uses (fixed values)
_C1, _C2, _ADD, _F1, _F2, _SEED = 0xCC9E2D51, 0x1B873593, 0xE6546B64, 0x85EBCA6B, 0xC2B2AE35, 42


def _rotl(x: str, bits: int) -> str:
    return f"((({x}) << {bits}) % 4294967296 + (({x}) >> {32 - bits}))"


def _steps(sql: str, exprs: list[tuple[str, str]]) -> str:
    """Each (column, expression) as a sub-query of its own, so that later ones can name it."""
    for col, expr in exprs:
        sql = f"SELECT * EXCLUDE ({col}), {expr} AS {col} FROM ({sql})"
    return sql


def _mix(word: str) -> list[tuple[str, str]]:
    return [("a", f"({word}) * {_C1} % 4294967296"), ("a", f"{_rotl('a', 15)} * {_C2} % 4294967296"), ("h", "xor(h, a)"),
            ("h", f"({_rotl('h', 13)} * 5 + {_ADD}) % 4294967296")]


def _finish(length: int) -> list[tuple[str, str]]:
    return [("h", f"xor(h, {length})"), ("h", f"xor(h, h >> 16) * {_F1} % 4294967296"),
            ("h", f"xor(h, h >> 13) * {_F2} % 4294967296"), ("h", "xor(h, h >> 16)")]


def _task_of(rows: str, salted: bool) -> str:
    """DuckDB SQL: ``rows`` (k UBIGINT, s UBIGINT) with the task of Spark's hash partitioning by k, or by k and s."""
    steps = _mix("k % 4294967296") + _mix("k >> 32") + _finish(8)
    if salted:
        steps += _mix("s") + _finish(4)
    placed = _steps(f"SELECT *, CAST(0 AS UBIGINT) AS a, CAST({_SEED} AS UBIGINT) AS h FROM ({rows})", steps)
    signed = "CAST(h AS BIGINT) - CASE WHEN h >= 2147483648 THEN 4294967296 ELSE 0 END"
    return f"SELECT *, (({signed}) % {TASKS} + {TASKS}) % {TASKS} AS task FROM ({placed})"


_BOOKED = "SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE l_orderkey END AS booked, l_partkey FROM lineitem WHERE l_orderkey IS NOT NULL"


@query("skew_join_tasks", "D13", sql=f"""
WITH li AS ({_BOOKED}),
c AS (SELECT booked, count(*) AS n FROM li GROUP BY 1),
t AS (SELECT sum(n) AS total FROM c),
hot AS (SELECT booked, CAST(ceil(CAST(n * {PIECES * TASKS} AS DOUBLE) / total) AS BIGINT) AS salts FROM c, t WHERE n * {TASKS} > total),
keyed AS (SELECT CAST(li.booked AS UBIGINT) AS k, CAST(l_partkey % coalesce(salts, 1) AS UBIGINT) AS s
          FROM li LEFT JOIN hot ON li.booked = hot.booked JOIN orders ON o_orderkey = li.booked),
groups AS (SELECT k, s, count(*) AS n FROM keyed GROUP BY 1, 2),
tasks AS (SELECT 'by key' AS stage, task, sum(n) AS n FROM ({_task_of('SELECT * FROM groups', False)}) GROUP BY task
          UNION ALL SELECT 'balanced', task, sum(n) FROM ({_task_of('SELECT * FROM groups', True)}) GROUP BY task)
SELECT stage, CAST(sum(n) AS BIGINT) AS n_rows, CAST(max(n) AS BIGINT) AS largest_task,
       CAST(max(n) AS DOUBLE) * {TASKS} / CAST(sum(n) AS DOUBLE) AS over_mean FROM tasks GROUP BY stage
""")
def skew_join_tasks(spark, sf):
    """Returned lines are booked on one order, a third of all rows. Lines joined to orders
    by a sort-merge join: the largest task dealt by the key alone, and after balancing."""
    li = tbl(spark, sf, "lineitem").where("l_orderkey IS NOT NULL").select(
        F.when(F.col("l_returnflag") == "R", F.lit(1).cast("bigint")).otherwise(F.col("l_orderkey")).alias("booked"),
        "l_partkey", "l_extendedprice")
    orders = tbl(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    plain = shuffled_join(li, orders, "booked", "o_orderkey", TASKS)
    even = balanced_join(li, orders, "booked", "o_orderkey", F.col("l_partkey"), TASKS, PIECES)
    return task_balance(plain, "by key", TASKS).unionByName(task_balance(even, "balanced", TASKS))


@query("skew_balanced_join", "D13 D8", sql=f"""
SELECT o_orderpriority, count(*) AS n_lines, count(DISTINCT booked) AS n_orders
FROM ({_BOOKED}) JOIN orders ON o_orderkey = booked GROUP BY 1
""")
def skew_balanced_join(spark, sf):
    """The rows of the balanced join, counted by priority; tasks from the session's shuffle setting."""
    li = tbl(spark, sf, "lineitem").where("l_orderkey IS NOT NULL").select(
        F.when(F.col("l_returnflag") == "R", F.lit(1).cast("bigint")).otherwise(F.col("l_orderkey")).alias("booked"), "l_partkey")
    joined = balanced_join(li, tbl(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), "booked", "o_orderkey",
                           F.xxhash64("l_partkey"))
    return joined.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_lines"), F.countDistinct("booked").alias("n_orders"))
