"""Helpers shared by the corpus operators: written intermediates, gapless running
positions without a single-task window, streamed key groups, word hashing,
a bounded key bitmap and connected components."""

from __future__ import annotations

import ctypes
import gc
import sys
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabflow.session import shared_path

# executors run these functions by value and need no installed copy
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MUL = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0x100000001B3)
_POWERS = np.ones(1, np.uint64)
_INVERSES = np.ones(1, np.uint64)


GROUP, GROUP_BYTES = 512, 1 << 22


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the cluster's shared folder, read back: the
    work runs once, and a lost executor re-reads instead of recomputing."""
    spark = df.sparkSession
    # Arrow batches are cut by bytes too, so that long texts don't fill a worker
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(GROUP_BYTES))
    path = shared_path(spark, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._written_at = path
    return table


def dropped(*tables: DataFrame) -> None:
    """Deletes tables that ``written`` gave, when all that reads them has been written itself."""
    for table in tables:
        context = table.sparkSession.sparkContext
        target = context._jvm.org.apache.hadoop.fs.Path(table._written_at)
        target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def brief_shuffles(spark: SparkSession):
    """Within it, the shuffle files of a query go when the query ends, and not only when the
    driver happens to collect its garbage. For work that runs no DataFrame object twice."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def parts(batches, rows: int = GROUP, size: int = GROUP_BYTES):
    """Record batches of at most ``rows`` rows and about ``size`` bytes of text (one row, if
    that alone is longer), so that a task works on little text at a time."""
    for b in batches:
        long = np.zeros(b.num_rows, np.int64)
        for c in b.columns:
            if pa.types.is_string(c.type) or pa.types.is_binary(c.type):
                long += pc.binary_length(c).fill_null(0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(long), 0
        while at < b.num_rows:
            room = size + (int(ends[at - 1]) if at else 0)
            stop = min(at + rows, max(at + 1, int(np.searchsorted(ends, room, "right"))))
            yield b.slice(at, stop - at)
            at = stop


def lean(fn):
    """``fn`` over batches, giving freed memory back when its task ends: a worker process
    serves many stages and would else keep the largest one's memory."""

    def run(batches):
        try:
            yield from fn(batches)
        finally:
            gc.collect()  # functions sent by value hold themselves in cycles, and their tables with them
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return run


def running(df: DataFrame, group: list[str], order: list[str], value: str | None = None,
            buckets: int = 256, name: str = "running") -> DataFrame:
    """Adds ``before``: the sum of ``value`` (rows, if None) over the rows of the same
    group that come earlier. The order is (bucket of a hash of ``order``, ``order``).

    A group is cut into ``buckets`` hash buckets, each summed by its own window, and
    the bucket totals (groups x buckets rows) give the offsets, so no task holds a hot
    group. Identical rows are counted before the shuffle and expanded afterwards, so
    a row repeated without end is one row in its window."""
    cols = df.columns
    weight = F.col(value).cast("long") if value else F.lit(1).cast("long")
    packed = written(
        df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_m"))
        .withColumn("_b", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
        .withColumn("_w", weight), name)
    # null group values join as a key of their own
    keys = [F.coalesce(F.col(g).cast("string"), F.lit("\0")).alias(f"_g{i}") for i, g in enumerate(group)]
    packed = packed.select("*", *keys)
    gk = [f"_g{i}" for i in range(len(group))]
    totals = packed.groupBy(*gk, "_b").agg(F.sum(F.col("_w") * F.col("_m")).alias("_t"))
    across = Window.partitionBy(*gk).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*gk, "_b", F.coalesce(F.sum("_t").over(across), F.lit(0)).alias("_o"))
    within = Window.partitionBy(*gk, "_b").orderBy(*order, *[c for c in cols if c not in order]) \
        .rowsBetween(Window.unboundedPreceding, -1)
    out = packed.withColumn("_i", F.coalesce(F.sum(F.col("_w") * F.col("_m")).over(within), F.lit(0)))
    return (out.join(offsets, [*gk, "_b"])
            .withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_m") - 1)))
            .select(*cols, (F.col("_o") + F.col("_i") + F.col("_k") * F.col("_w")).alias("before")))


def keyed(batches, keys: list[str]):
    """Tables of whole key groups from record batches sorted by ``keys``: the last
    group of a batch waits for the next one."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cut = last_start(batch, keys)
        if held:
            same = all(held[-1].column(k)[held[-1].num_rows - 1] == batch.column(k)[0] for k in keys)
            if not same:
                yield pa.Table.from_batches(held)
                held = []
            elif cut == 0:
                held.append(batch)
                continue
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def last_start(batch: pa.RecordBatch, keys: list[str]) -> int:
    """Row at which the last key group of a sorted batch begins."""
    change = np.zeros(max(0, batch.num_rows - 1), bool)
    for k in keys:
        col = batch.column(k).to_numpy(zero_copy_only=False)
        change |= col[1:] != col[:-1]
    hits = np.flatnonzero(change)
    return int(hits[-1]) + 1 if len(hits) else 0


def starts_of(*cols: np.ndarray) -> np.ndarray:
    """Start rows of the groups of sorted columns, and the row count at the end."""
    n = len(cols[0])
    change = np.ones(n, bool)
    if n:
        change[1:] = False
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(change), n)


def by_key(df: DataFrame, keys: list[str], sort: list[str], fn, schema: str) -> DataFrame:
    """``fn(tables of whole key groups) -> record batches`` over ``df`` dealt out by
    ``keys`` and sorted by ``keys`` and ``sort``. The sort spills; only whole groups
    of one Arrow batch and the group that spans into the next are in memory."""
    return (df.repartition(*keys).sortWithinPartitions(*keys, *sort)
            .mapInArrow(lean(lambda it: fn(keyed(it, keys))), schema))


# --- words and shingles -------------------------------------------------------

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


CHUNK = 1 << 16


def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base modulo 2**64 and of its inverse, up to the chunk's length."""
    global _POWERS, _INVERSES
    if len(_POWERS) < CHUNK:
        for name, base in (("_POWERS", _BASE), ("_INVERSES", np.uint64(pow(int(_BASE), -1, 1 << 64)))):
            steps = np.full(CHUNK, base, np.uint64)
            steps[0] = 1
            globals()[name] = np.cumprod(steps)
    return _POWERS, _INVERSES


def words(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts, byte ends and 64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+``
    of UTF-8 bytes: differences of one running polynomial, shifted to a common origin.

    A text is read CHUNK bytes at a time; the running sum, the scale of the powers and an open
    word go on to the next chunk, so what is held beside the words is that of one chunk."""
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        none = np.empty(0, np.int64)
        return none, none, np.empty(0, np.uint64)
    power, inverse = _powers()
    begins, ends, hashes = [], [], []
    carry, scale, back, inside, since = np.uint64(0), 1, 1, 0, None
    for at in range(0, len(raw), CHUNK):
        part = raw[at:at + CHUNK]
        m, final = len(part), at + CHUNK >= len(raw)
        state = np.empty(m + 1 + final, np.int8)
        state[0] = inside
        np.logical_not(_SPACE[part], out=state[1:m + 1].view(bool))
        if final:
            state[-1] = 0
        inside = state[-1]
        step = np.diff(state)
        begin, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        total = np.empty(m + 1, np.uint64)
        total[0] = 0
        np.cumsum((part + np.uint64(1)) * power[:m], out=total[1:])
        first, shift = total[begin], inverse[begin]
        if at:
            total = total * np.uint64(scale) + carry
            first, shift = total[begin], shift * np.uint64(back)
        if since is not None:  # the word that the last chunk ended in
            first, shift = np.append(since[0], first), np.append(since[1], shift)
        n = len(end)
        hashes.append((total[end] - first[:n]) * shift[:n])
        since = (first[n:], shift[n:]) if len(first) > n else None
        begins.append(begin + at)
        ends.append(end + at)
        if not final:
            carry = total[-1]
            scale = scale * int(power[-1]) * int(_BASE) & 0xFFFFFFFFFFFFFFFF
            back = back * int(inverse[-1]) * int(inverse[1]) & 0xFFFFFFFFFFFFFFFF
    if len(begins) == 1:
        return begins[0], ends[0], mix(hashes[0])
    return np.concatenate(begins), np.concatenate(ends), mix(np.concatenate(hashes))


def bounds(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and byte ends of the words of UTF-8 bytes."""
    inside = np.zeros(len(data) + 2, np.int8)
    np.logical_not(_SPACE[np.frombuffer(data, np.uint8)], out=inside[1:-1].view(bool))
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of all runs of ``k`` consecutive words, in order."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * MUL + h[j:j + n]
    return mix(out)


def texts(column: pa.Array):
    """UTF-8 bytes of each text of an Arrow string column; None for null."""
    for value in column.cast(pa.large_binary()) if not pa.types.is_binary(column.type) else column:
        yield value.as_py()


# --- bounded key bitmap -------------------------------------------------------

BITMAP_BITS = 1 << 25


def bitmap(ids: DataFrame, column: str, bits: int = BITMAP_BITS) -> np.ndarray:
    """A bit for each hash class that a key of ``ids`` falls into. Its size is fixed
    by ``bits`` (4 MB) whatever the number of keys; a full map only filters nothing."""
    slot = F.pmod(F.xxhash64(F.col(column).cast("long")), F.lit(bits))
    rows = (ids.select(F.shiftright(slot, 6).cast("int").alias("i"),
                       F.expr(f"shiftleft(1L, cast(pmod(pmod(xxhash64(cast(`{column}` as bigint)), {bits}L), 64) as int))").alias("b"))
            .groupBy("i").agg(F.expr("bit_or(b)").alias("b"))).toArrow()
    out = np.zeros(bits >> 6, np.uint64)
    out[rows["i"].to_numpy()] = rows["b"].to_numpy().view(np.uint64)
    return out


def in_bitmap(df: DataFrame, column: str, marks: np.ndarray) -> DataFrame:
    """Rows whose key may be in the bitmap, dropped before any shuffle of their texts."""
    bits = len(marks) << 6
    held = df.sparkSession.sparkContext.broadcast(marks)
    names = df.columns
    slotted = df.withColumn("_slot", F.pmod(F.xxhash64(F.col(column).cast("long")), F.lit(bits)))

    def keep(batches):
        marks = held.value
        for b in batches:
            slot = b.column("_slot").to_numpy().astype(np.int64)
            hit = (marks[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1)
            yield b.filter(pa.array(hit.astype(bool))).select(names)

    return slotted.mapInArrow(lean(keep), df.schema)


# --- connected components -----------------------------------------------------

def forest(i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Edges (node, root) with the same connectivity as the pairs (i, j)."""
    nodes, flat = np.unique(np.concatenate([i, j]), return_inverse=True)
    a, b = flat[:len(i)], flat[len(i):]
    root = np.arange(len(nodes))
    while True:
        low = root.copy()
        np.minimum.at(low, root[a], root[b])
        np.minimum.at(low, root[b], root[a])
        low = low[low]
        while not np.array_equal(low, low[low]):
            low = low[low]
        new = low[root]
        if np.array_equal(new, root):
            break
        root = new
    away = np.flatnonzero(root != np.arange(len(nodes)))
    return np.column_stack([nodes[away], nodes[root[away]]])


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of an edge.

    Alternating large-star and small-star steps: each round is two aggregations and
    two joins, which Spark partitions and splits; the links never reach the driver,
    only their count and checksum do. Rounds grow with the logarithm of the graph."""
    pair = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    pair, seen = written(pair, "links"), None
    while True:
        both = pair.unionByName(pair.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        pair = written(
            small.where(F.col("v") > F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = tuple(pair.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first())
        if now == seen:
            break
        seen = now
    return pair.select(F.col("u").alias("node"), F.col("v").alias("component")) \
        .unionByName(pair.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
