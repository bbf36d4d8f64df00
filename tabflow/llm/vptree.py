"""Nearest neighbours by inner product with vantage-point trees, one per shard."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabflow.llm.common import keyed, lean

cloudpickle.register_pickle_by_value(sys.modules[__name__])


ROUNDING = 1e-12  # of the squared norms


def usable(column: str):
    """A vector takes part when it has components, all finite and not all zero."""
    v = F.col(column)
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & (F.size(v) > 0) & F.coalesce(ok, F.lit(False)) & F.exists(v, lambda x: x != 0)


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products summed left to right in double precision."""
    out = np.zeros(len(a))
    for j in range(a.shape[1]):
        out += a[:, j] * b[:, j]
    return out


class VantageTree:
    """A vantage-point tree over distinct rows of ``points`` with leaves of ``leaf``.

    With ``largest`` the last component lifts all points to that squared norm: distance
    prunes, and the inner product of the others, which no large vector blurs, ranks."""

    def __init__(self, points: np.ndarray, leaf: int = 128, seed: int = 5, largest: float | None = None):
        self.points, self.leaf, self.largest = points, leaf, largest
        self.rng = np.random.default_rng(seed)
        self.nodes: list[tuple] = []
        self.root = self._build(np.arange(len(points)))

    def _build(self, rows: np.ndarray) -> int:
        at = len(self.nodes)
        self.nodes.append(())
        if len(rows) <= self.leaf:
            self.nodes[at] = (rows,)
            return at
        pick = int(self.rng.integers(len(rows)))
        vantage, others = rows[pick], np.delete(rows, pick)
        far = np.linalg.norm(self.points[others] - self.points[vantage], axis=1)
        half = len(others) // 2
        order = np.argpartition(far, half)
        radius = float(far[order[half]])
        inner = self._build(others[order[:half]])
        outer = self._build(others[order[half:]])
        self.nodes[at] = (vantage, radius, inner, outer)
        return at

    def search(self, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """Rows and distances (negative inner products) of the ``k`` nearest points of each query. A child is left
        out when the triangle inequality puts it beyond ``factor`` times the k-th
        distance so far; factor one is exact, less prunes more."""
        k = min(k, len(self.points))
        best = np.full((len(queries), k), np.inf)
        rows = np.full((len(queries), k), -1, np.int64)
        norms, own = (self.points ** 2).sum(axis=1), (queries ** 2).sum(axis=1)

        def offer(active: np.ndarray, candidates: np.ndarray) -> None:
            if self.largest is None:
                far = own[active, None] + norms[candidates] - 2 * queries[active] @ self.points[candidates].T
                far = np.sqrt(np.maximum(far, 0))
            else:
                far = -(queries[active, :-1] @ self.points[candidates, :-1].T)
            d = np.concatenate([best[active], far], axis=1)
            r = np.concatenate([rows[active], np.broadcast_to(candidates, far.shape)], axis=1)
            cut = np.argpartition(d, k - 1, axis=1)[:, :k]
            best[active] = np.take_along_axis(d, cut, 1)
            rows[active] = np.take_along_axis(r, cut, 1)

        def visit(node: int, active: np.ndarray) -> None:
            if not len(active):
                return
            n = self.nodes[node]
            if len(n) == 1:
                offer(active, n[0])
                return
            vantage, radius, inner, outer = n
            offer(active, np.array([vantage]))
            to = np.linalg.norm(queries[active] - self.points[vantage], axis=1)
            near = to < radius
            slack = 1e-9 * (1 + to)
            visit(inner, active[near])
            visit(outer, active[~near])
            worst = best[active].max(axis=1)
            reach = factor * (worst if self.largest is None else self.reach(own[active], -worst)) + slack
            visit(outer, active[near & (to + reach >= radius)])
            visit(inner, active[~near & (to - reach <= radius)])

        visit(self.root, np.arange(len(queries)))
        return rows, best

    def reach(self, own, product):
        """Distance, rounded up, of a point with this inner product to a query of squared norm ``own``."""
        whole = own + self.largest
        return np.sqrt(np.maximum(whole - 2 * product, 0) + ROUNDING * whole)

    def at_least(self, query: np.ndarray, product: float) -> np.ndarray:
        """Rows of all points whose inner product with the query may be ``product`` or more."""
        out, todo, reach = [], [self.root], float(self.reach((query ** 2).sum(), product))
        while todo:
            n = self.nodes[todo.pop()]
            if len(n) == 1:
                out.append(n[0])
                continue
            vantage, radius, inner, outer = n
            to = float(np.linalg.norm(query - self.points[vantage]))
            slack = 1e-9 * (1 + to)
            out.append(np.array([vantage]))
            if to - reach - slack <= radius:
                todo.append(inner)
            if to + reach + slack >= radius:
                todo.append(outer)
        return np.concatenate(out)


def _vectors(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    if isinstance(flat, pa.ChunkedArray):
        flat = pa.concat_arrays(flat.chunks)
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(flat), -1)


def search_shards(groups, largest: dict[int, float], k: int, factor: float, leaf: int, block: int, slack: int = 12):
    """For each shard: index its vectors, then stream the queries that follow them.

    Inner product becomes distance by one more component, sqrt(largest - |x|**2) for
    points and 0 for queries; ``largest`` is by dimension. Equal vectors are one point with
    its smallest ids, and where the last candidate ties with the k-th, all points of that
    score are taken, so that ties go to the smallest ids however many there are."""
    names = ["query_id", "vec_id", "score"]
    for t in groups:
        kind = t.column("kind").to_numpy()
        indexed = t.filter(pa.array(kind == 0))
        asked = t.filter(pa.array(kind == 1))
        if not indexed.num_rows or not asked.num_rows:
            continue
        ids, x = indexed.column("vec_id").to_numpy(), _vectors(indexed.column("v"))
        points, copy = np.unique(x, axis=0, return_inverse=True)
        order = np.lexsort((ids, copy.ravel()))
        first = np.searchsorted(copy.ravel()[order], np.arange(len(points) + 1))
        ids = ids[order]
        top = largest[points.shape[1]]
        lift = np.sqrt(np.maximum(top - (points ** 2).sum(axis=1), 0))
        tree = VantageTree(np.column_stack([points, lift]), leaf, largest=top)
        for at in range(0, asked.num_rows, block):
            part = asked.slice(at, block)
            qid, q = part.column("vec_id").to_numpy(), _vectors(part.column("v"))
            lifted = np.column_stack([q, np.zeros(len(q))])
            rows, _ = tree.search(lifted, k + slack, factor)
            out: list[list] = [[], [], []]
            for i in range(len(q)):
                hit = rows[i][rows[i] >= 0]
                score = dots(np.broadcast_to(q[i], (len(hit), q.shape[1])), points[hit])
                if factor >= 1 and k < len(hit) < len(points):
                    # one of the points may be the query's own
                    least = np.sort(score)[-k - 1]
                    margin = ROUNDING * np.sqrt((q[i] ** 2).sum() * top)
                    if score.min() >= least - margin:
                        hit = tree.at_least(lifted[i], least - margin)
                        score = dots(np.broadcast_to(q[i], (len(hit), q.shape[1])), points[hit])
                        near = score >= least
                        hit, score = hit[near], score[near]
                # at most k + 1 ids of each point can be among the k nearest others
                own = [ids[first[p]:min(first[p + 1], first[p] + k + 1)] for p in hit]
                found = np.concatenate(own)
                value = np.repeat(score, [len(o) for o in own])
                keep = found != qid[i]
                found, value = found[keep], value[keep]
                first_k = np.lexsort((found, -value))[:k]
                for col, v in zip(out, (np.full(len(first_k), qid[i]), found[first_k], value[first_k])):
                    col.append(v)
            yield pa.record_batch([pa.array(np.concatenate(c)) for c in out], names)


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, factor: float = 1.0, shard_rows: int = 4096,
            leaf: int = 128, block: int = 1024, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` largest inner products in double
    precision of each row whose id is divisible by ``every``, among all other rows.

    Every usable row is indexed in one of ceil(rows / shard_rows) trees per dimension;
    each query visits every tree of its dimension in blocks, and its k best per
    tree are merged by a partial rank. With ``factor`` 1 the result is exact.

    Vectors that are null, empty, zero or hold null or non-finite components take no
    part; only vectors of the same length are compared; rows without an id are not
    used. Ties go to the smaller vec_id; repeated ids are candidates each, but never of a
    query with their own id. Other columns are ignored; an empty table gives no rows."""
    spark = vectors.sparkSession
    rows = vectors.where(F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.where(usable("v")).withColumn("dim", F.size("v"))
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    sizes = {r["dim"]: (r["n"], r["top"]) for r in
             rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.max(square).alias("top")).collect()}
    largest = {d: top for d, (_, top) in sizes.items()}
    shards = {d: max(1, -(-n // shard_rows)) for d, (n, _) in sizes.items()}
    count = F.element_at(F.create_map(*[F.lit(x) for pair in shards.items() for x in pair]), F.col("dim")) \
        if shards else F.lit(1)
    own = F.pmod(F.xxhash64("vec_id"), count).cast("int")
    indexed = rows.withColumn("shard", own).withColumn("kind", F.lit(0))
    asked = rows.where(F.col("vec_id") % every == 0) \
        .withColumn("shard", F.explode(F.sequence(F.lit(0), count - 1))).withColumn("kind", F.lit(1))
    parts = max(1, min(sum(shards.values()), 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    found = (indexed.unionByName(asked).select("dim", "shard", "kind", "vec_id", "v")
             .repartition(parts, "dim", "shard").sortWithinPartitions("dim", "shard", "kind", "vec_id")
             .mapInArrow(lean(lambda it: search_shards(keyed(it, ["dim", "shard"]), largest, k, factor, leaf, block)),
                         "query_id long, vec_id long, score double"))
    rank = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
