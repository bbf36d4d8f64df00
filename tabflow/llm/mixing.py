"""Mixing sources to target weights by min-cost flow over membership patterns."""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabflow.llm.common import running

WORDS = r"[^\x20\x09-\x0D]+"


def word_count(text: str = "text"):
    """Number of words ``[^\\x20\\x09-\\x0D]+`` of a text column; 0 for null."""
    squeezed = F.trim(F.regexp_replace(F.col(text), r"[\x20\x09-\x0D]+", " "))
    return F.when(F.coalesce(squeezed, F.lit("")) == "", F.lit(0)).otherwise(
        F.length(squeezed) - F.length(F.replace(squeezed, F.lit(" "), F.lit(""))) + 1).cast("long")


def targets(sizes: list[int], weights: list[float], total: float, limit: float = 2.0) -> list[float]:
    """Shares of ``total`` by weight, none above ``limit`` times its size: sources fill
    up in the order of limit * size / weight, the rest share what is left."""
    out = [0.0] * len(sizes)
    order = sorted(range(len(sizes)), key=lambda i: (limit * sizes[i] / weights[i], i))
    left, load = float(total), float(sum(weights))
    for n, i in enumerate(order):
        if limit * sizes[i] < left / load * weights[i]:
            out[i] = float(limit * sizes[i])
            left, load = left - out[i], load - weights[i]
        else:
            for j in order[n:]:
                out[j] = left / load * weights[j]
            break
    return out


def route(patterns: list[tuple[tuple[int, ...], int]], quotas: list[int], repeats: int = 2) -> list[list[int]]:
    """Words of each pattern's 1st, 2nd, ... repetition that the mix takes.

    Successive shortest paths (Bellman-Ford with a queue) on pattern -> source ->
    quota. A pattern has one arc per repetition, each as large as its words; the k-th
    costs k - 1 a word, so convex costs fill first uses before any repetition."""
    n_p, n_s = len(patterns), len(quotas)
    sink = 1 + n_p + n_s
    graph: list[list[int]] = [[] for _ in range(sink + 1)]
    arcs: list[list[int]] = []  # [to, capacity, cost]; the reverse arc is the index xor 1

    def arc(u: int, v: int, capacity: int, cost: int) -> int:
        for a, b, c, w in ((u, v, capacity, cost), (v, u, 0, -cost)):
            graph[a].append(len(arcs))
            arcs.append([b, c, w])
        return len(arcs) - 2

    used = [[arc(0, 1 + p, size, k) for k in range(repeats)] for p, (_, size) in enumerate(patterns)]
    for p, (members, size) in enumerate(patterns):
        for s in members:
            arc(1 + p, 1 + n_p + s, repeats * size, 0)
    for s, quota in enumerate(quotas):
        arc(1 + n_p + s, sink, quota, 0)
    while True:
        cost: list[float] = [float("inf")] * (sink + 1)
        via = [-1] * (sink + 1)
        cost[0], queue, queued = 0, deque([0]), [False] * (sink + 1)
        while queue:
            u = queue.popleft()
            queued[u] = False
            for e in graph[u]:
                v, capacity, w = arcs[e]
                if capacity > 0 and cost[u] + w < cost[v]:
                    cost[v], via[v] = cost[u] + w, e
                    if not queued[v]:
                        queued[v] = True
                        queue.append(v)
        if via[sink] < 0:
            break
        path, v = [], sink
        while v:
            path.append(via[v])
            v = arcs[via[v] ^ 1][0]
        step = min(arcs[e][1] for e in path)
        for e in path:
            arcs[e][1] -= step
            arcs[e ^ 1][1] += step
    return [[arcs[e ^ 1][1] for e in row] for row in used]


def mix_sources(docs: DataFrame, id_column: str = "doc_id", text: str = "text", sources: str = "source",
                weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, limit: int = 2,
                seed: int = 17, buckets: int = 1024, keep_source: bool = False) -> DataFrame:
    """One row per document with size (words), source_size, target, copies and taken,
    and with ``keep_source`` its pattern as one string (``s`` and the source, ``n`` for null).

    ``sources`` is a string column or an array of the sources a document belongs to;
    a document's pattern is its sorted distinct set of sources. Sizes are summed by
    pattern in Spark. The driver holds only the pattern table (one row per distinct
    set of sources, however many documents there are) and solves the flow there.
    Documents of a pattern are then ordered by a seeded hash and taken while the
    middle of their words lies below the flow of each repetition, so the words taken
    differ from the flow by less than one document.

    Sources are ordered by code point, null last, and take ``weights`` in turn; a null
    or empty set is the null source. source_size and target are summed over the
    document's sources. A null or empty text has size 0. Repeated rows count and are
    taken one by one; an empty table gives no rows; other columns are ignored."""
    spark = docs.sparkSession
    member = F.col(sources)
    if not isinstance(docs.schema[sources].dataType, T.ArrayType):
        member = F.array(member.cast("string"))
    empty = F.array(F.lit(None).cast("string"))
    member = F.when(member.isNull() | (F.size(member) == 0), empty).otherwise(F.array_sort(F.array_distinct(member)))
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), word_count(text).alias("size"),
                       member.alias("pattern"))
    table = sorted(((tuple(r["pattern"]), int(r["words"])) for r in
                    rows.groupBy("pattern").agg(F.sum("size").alias("words")).collect()),
                   key=lambda r: tuple((s is None, s or "") for s in r[0]))
    names = sorted({s for members, _ in table for s in members}, key=lambda s: (s is None, s or ""))
    at = {s: i for i, s in enumerate(names)}
    sizes = [sum(w for members, w in table if s in members) for s in names]
    weight = [float(weights[i % len(weights)]) for i in range(len(names))]
    goal = targets(sizes, weight, share * sum(w for _, w in table), float(limit))
    flows = route([(tuple(at[s] for s in members), w) for members, w in table],
                  [round(g) for g in goal], limit)
    plan = spark.createDataFrame(
        [(list(members), sum(sizes[at[s]] for s in members), float(sum(goal[at[s]] for s in members)), flow)
         for (members, _), flow in zip(table, flows)],
        "pattern array<string>, source_size long, target double, flow array<long>")
    order = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    key = F.concat_ws("\1", F.transform("pattern", lambda s: F.coalesce(F.concat(F.lit("s"), s), F.lit("n"))))
    placed = running(rows.select("doc_id", "size", key.alias("pk"), order.alias("seeded")),
                     ["pk"], ["seeded"], "size", buckets, "mix")
    plan = plan.select(key.alias("pk"), "source_size", "target", "flow")
    copies = F.size(F.filter("flow", lambda f: (F.col("before") * 2 + F.col("size") <= f * 2) & (f > 0)))
    return (placed.join(plan, "pk").withColumn("copies", copies.cast("int"))
            .select("doc_id", "size", "source_size", "target",
                    (F.col("size") * F.col("copies")).cast("long").alias("taken"), "copies",
                    *[F.col("pk").alias("source")] * keep_source))
