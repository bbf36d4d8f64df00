"""N-gram Jaccard self-join by a blocked sparse product of documents and n-grams."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.llm.common import (bitmap, brief_shuffles, by_key, components, dropped, forest, grams, in_bitmap, lean, mix,
                                parts, starts_of, texts, words, written)

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SKETCHES, SKETCH_SIZE = 6, 2
BLOCK = 512
_SEEDS = mix(np.arange(1, SKETCHES * SKETCH_SIZE + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
PAIR_BLOCK = 1 << 18
#: A column that may form more pairs is crowded; any other forms at most 32 pairs an entry.
COLUMN_PAIRS = 1 << 10
BLOCK_ELEMENTS = 1 << 18


def shingles(data: bytes | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``k``-word shingles of a text, A-Z lower-cased;
    the whole sequence as one if it has fewer words; empty without words."""
    if not data:
        return np.empty(0, np.uint64)
    _, _, h = words(data.translate(_LOWER))
    if not len(h):
        return h
    return np.unique(grams(h, min(k, len(h))))


def digest(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums over a set: equal sets, and only those but for chance, agree."""
    with np.errstate(over="ignore"):
        return (int(np.sum(mix(s ^ np.uint64(0xA5A5)), dtype=np.uint64).astype(np.int64)),
                int(np.sum(mix(s * np.uint64(3)), dtype=np.uint64).astype(np.int64)))


def prefix_size(n, num: int, den: int):
    """Two sets with Jaccard >= num/den share one of the first n - ceil(n num/den) + 1
    elements of each, in any one order of all elements."""
    return n - (n * num + den - 1) // den + 1


def _frequent(docs: DataFrame, k: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of most documents, and their rank by count: about ``most`` of them.

    Each block of rows counts all its n-grams and sends those of two documents or more;
    sums over the corpus decide, and a histogram of the sums sets the least count that
    keeps to ``most``, which bounds the list. It only orders n-grams, so that those of
    shared passages come last: the result is the same for any list."""

    def count(batches):
        for b in parts(batches, 1 << 14, 1 << 24):
            sets = [shingles(t, k) for t in texts(b.column("text"))]
            every = np.sort(np.concatenate(sets)) if sets else np.empty(0, np.uint64)
            cut = starts_of(every)
            c = np.diff(cut)
            often = np.flatnonzero(c > 1)
            yield pa.record_batch([pa.array(every[cut[:-1][often]].view(np.int64)), pa.array(c[often].astype(np.int64))], ["h", "c"])

    counted = written(docs.select("text").mapInArrow(lean(count), "h long, c long").groupBy("h").agg(F.sum("c").alias("c")), "frequent")
    # counts by their leading binary digits: a few hundred rows, however many n-grams
    level = F.floor(F.log2("c") * 8).cast("int")
    room, least = most, 1 << 30
    for r in counted.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("level").desc()).collect():
        if r["n"] > room:
            break
        room, least = room - r["n"], r["level"]
    rows = counted.where(level >= least).toArrow()
    dropped(counted)
    h, c = rows["h"].to_numpy().view(np.uint64), rows["c"].to_numpy()
    order = np.argsort(h)
    rank = np.empty(len(h), np.int32)
    rank[np.lexsort((h, c))] = np.arange(len(h))
    return h[order], rank[order]


def _sketched(docs: DataFrame, k: int, num: int, den: int, frequent) -> DataFrame:
    """Per row its set's size and digests, its prefix in the order (frequent last, by
    count; else by hash) and its min-hash sketches."""
    held = docs.sparkSession.sparkContext.broadcast(frequent)

    def sketch(batches):
        often, rank = held.value
        for b in parts(batches):
            rows: list[list] = [[] for _ in range(5)]
            for t in texts(b.column("text")):
                s = shingles(t, k)
                first, keys = s[:prefix_size(len(s), num, den)] if len(s) else s, []
                if len(s):
                    if len(often):
                        at = np.minimum(np.searchsorted(often, s), len(often) - 1)
                        hit = often[at] == s
                        late = s[hit][np.argsort(rank[at[hit]])]
                        first = np.concatenate([s[~hit], late])[:len(first)]
                    low = [mix(s ^ seed).min() for seed in _SEEDS]
                    for j in range(SKETCHES):
                        key = np.array([j + 1], np.uint64)
                        for m in low[j * SKETCH_SIZE:(j + 1) * SKETCH_SIZE]:
                            key = mix(key * np.uint64(31) + m)
                        keys.append(1 + int(key[0] % np.uint64(0x7FFFFFFE)))
                a, c = digest(s)
                for col, v in zip(rows, (len(s), a, c, first.tobytes(), keys)):
                    col.append(v)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32()))
            yield pa.record_batch([b.column("doc_id"), *[pa.array(c, t) for c, t in zip(rows, types)]],
                                  ["doc_id", "n", "rid", "check", "prefix", "sketches"])

    return docs.mapInArrow(lean(sketch), "doc_id long, n long, rid long, check long, prefix binary, sketches array<int>")


def _columns(prefixes: DataFrame) -> DataFrame:
    """(h, rid, n, comp, sketches): the prefix part of the incidence matrix, a row per entry."""
    more = [f"k{j}" for j in range(SKETCHES)]

    def entries(batches):
        for b in batches:
            for part in parts([b], 256):
                h = [np.frombuffer(p, np.int64) for p in part.column("prefix").to_pylist()]
                size = [len(x) for x in h]
                yield pa.record_batch(
                    [pa.array(np.concatenate(h)), *[pa.array(np.repeat(part.column(c).to_numpy(), size)) for c in ("rid", "n", "comp", *more)]],
                    ["h", "rid", "n", "comp", *more])

    return prefixes.mapInArrow(lean(entries), "h long, rid long, n long, comp long, " + ", ".join(f"{m} int" for m in more))


def _size_blocks(n: np.ndarray) -> np.ndarray:
    """The block of each row of a column sorted by size: at most BLOCK rows, and about
    BLOCK_ELEMENTS elements (one row, if that alone has more)."""
    if not len(n):
        return np.empty(0, np.int64)
    row, element = np.arange(len(n)) // BLOCK, (np.cumsum(n) - n) // BLOCK_ELEMENTS
    return np.append(0, np.cumsum((np.diff(row) > 0) | (np.diff(element) > 0)))


def _crowded(h, rid, n, comp, num: int, den: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Which rows stay in the product, and the rows (h, rid, comp, side, block, first, last)
    of the crowded columns: all of a column's nodes (side 0) and those outside its largest
    component (side 1) in blocks by size, with the other side's blocks whose sizes allow the
    bound. A column of one component forms no pair and goes."""
    stays, rows = np.ones(len(h), bool), []
    cut = starts_of(h)
    for c in np.flatnonzero(np.diff(cut) ** 2 > 2 * COLUMN_PAIRS):
        a, b = cut[c], cut[c + 1]
        size = n[a:b]
        _, which, count = np.unique(comp[a:b], return_inverse=True, return_counts=True)
        outer = which != np.argmax(count)
        fit = int((np.searchsorted(size, size * den // num, "right") - np.arange(1, b - a + 1)).sum())
        if outer.any() and min(fit, int(outer.sum()) * int(b - a)) <= COLUMN_PAIRS:
            continue
        stays[a:b] = False
        sides = [np.arange(a, b), a + np.flatnonzero(outer)]
        blocks = [_size_blocks(n[at]) for at in sides]
        cuts = [starts_of(x) for x in blocks]
        low, high = ([n[at[x]] for at, x in zip(sides, ends)] for ends in ([x[:-1] for x in cuts], [x[1:] - 1 for x in cuts]))
        for side, (at, block) in enumerate(zip(sides, blocks)):
            first = np.searchsorted(high[1 - side], (low[side] * num + den - 1) // den, "left")[block]
            last = np.searchsorted(low[1 - side], high[side] * den // num, "right")[block] - 1
            some = first <= last
            at = at[some]
            rows.append(np.column_stack([h[at], rid[at], comp[at], np.full(len(at), side), block[some], first[some], last[some]]))
    return stays, rows


_PAIR, _ENTRY = ["x", "y", "overlap", "nx", "ny"], ["h", "rid", "comp", "side", "block", "first", "last"]


def _product(groups, num: int, den: int):
    """The product of the block's columns with themselves: overlap counts of the pairs
    of different components whose sizes allow the bound, summed within the block. Pairs
    that agree in a sketch are left out, as their whole sets have been compared. Crowded
    columns form no pairs here: their entries come out instead, each once or twice.

    Columns are sorted by size, so the partners of a row end at the first that is
    too large; step d pairs every row with the one d places on, for all columns at once."""
    held: list[np.ndarray] = []
    waiting = 0

    def flush():
        pairs = np.concatenate(held)
        pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
        cut = starts_of(pairs[:, 0], pairs[:, 1])
        head = pairs[cut[:-1]]
        sums = np.add.reduceat(pairs[:, 2], cut[:-1])
        return out(_PAIR, (head[:, 0], head[:, 1], sums, head[:, 3], head[:, 4]))

    def out(names, columns):
        of = dict(zip(names, columns))
        return pa.record_batch([pa.array(of[c]) if c in of else pa.nulls(len(columns[0]), pa.int64()) for c in [*_PAIR, *_ENTRY]],
                               [*_PAIR, *_ENTRY])

    for t in groups:
        h, rid, n, comp = (t.column(c).to_numpy() for c in ("h", "rid", "n", "comp"))
        keys = [t.column(f"k{j}").to_numpy() for j in range(SKETCHES)]
        stays, crowded = _crowded(h, rid, n, comp, num, den)
        if crowded:
            yield out(_ENTRY, np.concatenate(crowded).T)
        if not stays.all():
            h, rid, n, comp, *keys = (c[stays] for c in (h, rid, n, comp, *keys))
        row = np.flatnonzero(h[1:] == h[:-1])
        d = 1
        while len(row):
            other = row + d
            row = row[other < len(h)]
            other = row + d
            fits = (h[row] == h[other]) & (n[row] * den >= n[other] * num)
            row, other = row[fits], other[fits]
            new = comp[row] != comp[other]
            for k in keys:
                new &= (k[row] != k[other]) | (k[row] == 0)
            if new.any():
                i, j = row[new], other[new]
                held.append(np.column_stack([rid[i], rid[j], np.ones(len(i), np.int64), n[i], n[j]]))
                waiting += len(i)
                if waiting > PAIR_BLOCK:
                    yield flush()
                    held, waiting = [], 0
            d += 1
    if held:
        yield flush()


def _sets(asked: DataFrame, nodes: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """(rid, s): the whole sets of the nodes in ``asked``. Texts are read again, and only
    those that may be of such a node are shuffled."""
    asked = written(asked.select("rid").distinct().join(nodes.select("rid", "doc_id"), "rid"), "asked")
    marks = bitmap(asked, "doc_id")

    def whole(batches):
        for b in parts(batches, 256):
            sets = [shingles(t, k) for t in texts(b.column("text"))]
            yield pa.record_batch([pa.array([digest(s)[0] for s in sets], pa.int64()),
                                   pa.array([s.tobytes() for s in sets], pa.binary())], ["rid", "s"])

    sets = in_bitmap(docs, "doc_id", marks).join(asked.select("doc_id").distinct(), "doc_id", "left_semi") \
        .select("text").mapInArrow(lean(whole), "rid long, s binary")
    sets = written(sets.join(asked.select("rid").distinct(), "rid", "left_semi").dropDuplicates(["rid"]), "sets")
    dropped(asked)
    return sets


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (x, y) whose whole sets reach the bound."""
    both = pairs.join(sets.select(F.col("rid").alias("x"), F.col("s").alias("sx")), "x") \
        .join(sets.select(F.col("rid").alias("y"), F.col("s").alias("sy")), "y").select("x", "y", "sx", "sy")

    def check(batches):
        for b in parts(batches, 256):
            good = []
            for sx, sy in zip(b.column("sx"), b.column("sy")):
                a, c = np.frombuffer(sx.as_buffer(), np.uint64), np.frombuffer(sy.as_buffer(), np.uint64)
                if len(a) > len(c):
                    a, c = c, a
                at = np.minimum(np.searchsorted(c, a), len(c) - 1)
                same = int((c[at] == a).sum())
                good.append(same * den >= num * (len(a) + len(c) - same))
            yield b.select(["x", "y"]).filter(pa.array(good, pa.bool_()))

    return written(both.mapInArrow(lean(check), "x long, y long"), "verified")


def overlaps(left: list[np.ndarray], right: list[np.ndarray], width: int = 2048) -> np.ndarray:
    """Sizes of all intersections of the sets of two blocks: the product of their
    incidence matrices, ``width`` columns at a time, over columns that both blocks have."""
    a, b = np.concatenate(left), np.concatenate(right)
    both = np.intersect1d(a, b)
    out = np.zeros((len(left), len(right)), np.float32)
    cells = []
    for sets, flat in ((left, a), (right, b)):
        row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        col = np.searchsorted(both, flat)
        hit = np.flatnonzero(both[np.minimum(col, len(both) - 1)] == flat) if len(both) else col[:0]
        order = hit[np.argsort(col[hit], kind="stable")]
        cells.append((row[order], col[order]))
    for at in range(0, len(both), width):
        blocks = []
        for (row, col), sets in zip(cells, (left, right)):
            part = slice(*np.searchsorted(col, (at, at + width)))
            m = np.zeros((len(sets), min(width, len(both) - at)), np.float32)
            m[row[part], col[part] - at] = 1
            blocks.append(m)
        out += blocks[0] @ blocks[1].T
    return out


def _group_blocks(member: DataFrame, center: DataFrame, label: DataFrame) -> DataFrame:
    """(tab, sketch, lo, hi, side, rid, comp): the nodes of each sketch group in pairs of
    blocks, all on the left and those outside the component of the group's typical node on
    the right; a node on both sides of one pair is one row (side 2).

    The typical node has been compared with the whole group and is left out, and so are
    groups whose other nodes are of one component, as all of two nodes."""
    placed = member.join(center.select("tab", "sketch", F.col("c.rid").alias("typical")), ["tab", "sketch"]).join(label, "rid", "left") \
        .select("tab", "sketch", "rid", "typical", F.coalesce("component", "rid").alias("comp"))
    everyone = written(placed, "placed")
    main = everyone.where("rid = typical").select("tab", "sketch", F.col("comp").alias("main"))
    placed = everyone.where("rid <> typical").join(main, ["tab", "sketch"]).withColumn("outer", F.col("comp") != F.col("main"))
    size = placed.groupBy("tab", "sketch").agg(F.count(F.lit(1)).alias("m"), F.count_if("outer").alias("o"), F.min("comp").alias("first"),
                                               F.max("comp").alias("last")).where("o > 0 and first <> last")
    blocks = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    placed = placed.join(size, ["tab", "sketch"]).withColumn("a", blocks("m")).withColumn("b", blocks("o"))
    mine = lambda c: F.pmod(F.xxhash64("rid"), F.col(c)).cast("int")
    left = placed.withColumn("lo", mine("a")).withColumn("hi", F.explode(F.sequence(F.lit(0), F.col("b") - 1))) \
        .withColumn("side", F.when(F.col("outer") & (F.col("hi") == mine("b")), 2).otherwise(0))
    right = placed.where("outer").withColumn("hi", mine("b")).withColumn("lo", F.explode(F.sequence(F.lit(0), F.col("a") - 1))) \
        .where(F.col("lo") != mine("a")).withColumn("side", F.lit(1))
    columns = ["tab", "sketch", "lo", "hi", "side", "rid", "comp"]
    out = written(left.select(*columns).unionByName(right.select(*columns)), "blocks")
    dropped(everyone)
    return out


def _block_pairs(groups, keys: list[str], num: int, den: int):
    """A forest of the links between the two sides of each pair of blocks; a row of side 2
    is on both."""
    for t in groups:
        key = [t.column(c).to_numpy() for c in keys]
        rid, comp, side = (t.column(c).to_numpy() for c in ("rid", "comp", "side"))
        s = t.column("s")
        edges = []
        cut = starts_of(*key)
        for a, b in zip(cut[:-1], cut[1:]):
            rows = np.arange(a, b)
            left, right = rows[side[a:b] != 1], rows[side[a:b] != 0]
            if not len(left) or not len(right):
                continue
            sets = [[np.frombuffer(s[int(i)].as_buffer(), np.uint64) for i in part] for part in (left, right)]
            same = overlaps(*sets)
            size = [np.array([len(x) for x in part]) for part in sets]
            union = size[0][:, None] + size[1][None] - same
            i, j = np.nonzero((same * den >= num * union) & (comp[left][:, None] != comp[right][None]))
            if len(i):
                edges.append(rid[forest(left[i], right[j])])
        e = np.concatenate(edges) if edges else np.empty((0, 2), np.int64)
        yield pa.record_batch([pa.array(e[:, 0]), pa.array(e[:, 1])], ["x", "y"])


def near_duplicates(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, frequent: int = 1 << 19,
                    id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id for every row: documents link when
    den * |intersection| >= num * |union| of their distinct ``k``-word shingles, and a
    component is named by its smallest doc_id.

    1. Equal sets are one node. 2. Nodes that agree in a min-hash sketch are a group. Each
    is checked against the group's most typical node, so that tight groups of near copies
    become components by as many checks as nodes; the others are compared with the whole
    group in pairs of blocks, where a product of incidence matrices gives all overlaps
    and a forest of links leaves. 3. The product of the incidence matrix's prefix
    columns counts overlaps between nodes of different components that no sketch has
    brought together, block by block and then summed; a pair goes when what it can still
    share stays below the bound its two sizes set. A column whose pairs would be many, as
    that of a large group of texts not quite alike, forms none: its nodes are compared by
    whole sets as in step 2, block against block, so what is written grows with a column's
    entries, not with their square. 4. The pairs left are checked on
    whole sets. By the prefix bound every link is between nodes of one component, of one
    sketch or of one prefix column, so none is lost; frequent n-grams come last in the
    order, so common lines form no pairs.

    A text that is null, empty or without words has no shingles and links with nothing. A
    null doc_id has component null. Repeated rows, and rows that repeat an id, are documents
    each. Other columns are ignored; an empty table gives no rows."""
    with brief_shuffles(docs.sparkSession):
        return _grouped(docs, k, num, den, frequent, id_column, text)


def _grouped(docs: DataFrame, k: int, num: int, den: int, frequent: int, id_column: str, text: str) -> DataFrame:
    """The work of ``near_duplicates``; a written table goes when its last reader is written."""
    every = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = every.where(F.col("doc_id").isNotNull())
    sketched = written(_sketched(rows, k, num, den, _frequent(rows, k, frequent)), "sketched")
    nodes = sketched.where("n > 0").groupBy("rid", "check", "n").agg(F.min(F.struct("doc_id", "sketches")).alias("m"))
    nodes = written(nodes.select("rid", "n", "m.doc_id", "m.sketches"), "nodes")

    member = nodes.select("rid", "n", F.posexplode("sketches").alias("tab", "sketch"))
    shared = written(member.groupBy("tab", "sketch").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "sketches")
    member = written(member.join(shared, ["tab", "sketch"]), "members")
    dropped(shared)
    sets = _sets(member, nodes, rows, k)

    # the most typical node of a group is the one whose sketches most nodes share
    typical = member.groupBy("rid").agg(F.sum("m").alias("shared"))
    center = member.join(typical, "rid").groupBy("tab", "sketch").agg(F.max_by(F.struct("rid", "n"), F.struct("shared", "rid")).alias("c"))
    stars = member.join(center, ["tab", "sketch"]).where(f"rid <> c.rid and n * {num} <= c.n * {den} and c.n * {num} <= n * {den}")
    first = _verified(stars.select(F.col("c.rid").alias("x"), F.col("rid").alias("y")).distinct(), sets, num, den)
    label = components(first, "x", "y").withColumnRenamed("node", "rid")

    # nodes outside the component of their group's typical node against the others of the group
    blocks = _group_blocks(member, center, label)
    needed = in_bitmap(sets, "rid", bitmap(blocks, "rid"))
    pair = ["tab", "sketch", "lo", "hi"]
    within = written(by_key(blocks.join(needed, "rid"), pair, ["side", "rid"], lambda g: _block_pairs(g, pair, num, den), "x long, y long"), "within")
    dropped(blocks, sets)
    near = first.unionByName(within)
    label = components(near, "x", "y").withColumnRenamed("node", "rid")

    groups = member.groupBy("rid").agg(F.map_from_entries(F.collect_list(F.struct("tab", "sketch"))).alias("own"))
    attributes = nodes.join(label, "rid", "left").join(groups, "rid", "left") \
        .select("rid", "doc_id", "n", F.coalesce("component", "rid").alias("comp"),
                *[F.coalesce(F.try_element_at("own", F.lit(j)), F.lit(0)).alias(f"k{j}") for j in range(SKETCHES)])
    # a prefix is shuffled here only, with its node's row; equal rows are one before it is
    prefixes = sketched.where("n > 0").select("rid", "doc_id", "prefix").dropDuplicates(["rid", "doc_id"]).join(attributes, ["rid", "doc_id"])
    product = written(by_key(_columns(prefixes), ["h"], ["n", "rid"], lambda g: _product(g, num, den),
                             ", ".join(f"{c} long" for c in [*_PAIR, *_ENTRY])), "product")
    rest = lambda n: f"(({n} * {num} + {den - 1}) div {den} - 1)"  # noqa: E731  n less its prefix
    pairs = product.where("h is null").groupBy("x", "y").agg(F.sum("overlap").alias("overlap"), F.first("nx").alias("nx"), F.first("ny").alias("ny")) \
        .where(f"(overlap + greatest({rest('nx')}, {rest('ny')})) * {num + den} >= {num} * (nx + ny)")
    pairs = written(pairs.select("x", "y"), "candidates")
    crowded = product.where("h is not null").select(*_ENTRY)
    ids = pairs.select(F.col("x").alias("rid")).union(pairs.select("y")).union(crowded.select("rid"))
    sets = _sets(ids, nodes, rows, k)
    dropped(nodes, member)
    second = _verified(pairs, sets, num, den)

    # crowded columns: their nodes against those outside the largest component, as above
    crowded = crowded.withColumn("other", F.explode(F.sequence("first", "last")))
    either = lambda side: F.when(F.col("side") == side, F.col("block")).otherwise(F.col("other"))
    blocks = crowded.select("h", either(0).alias("lo"), either(1).alias("hi"), "side", "rid", "comp").join(sets, "rid")
    column = ["h", "lo", "hi"]
    third = written(by_key(blocks, column, ["side", "rid"], lambda g: _block_pairs(g, column, num, den), "x long, y long"), "crowded")
    dropped(product, pairs, sets)

    final = components(near.unionByName(second).unionByName(third), "x", "y")
    dropped(first, within, second, third)
    own = sketched.select("doc_id", "n", "rid").join(final.withColumnRenamed("node", "rid"), "rid", "left")
    own = written(own.select("doc_id", "n", F.coalesce("component", "rid").alias("root")), "components")
    dropped(sketched)
    named = own.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("least"))
    linked = own.where("n > 0").join(named, "root").select("doc_id", F.col("n").alias("n_shingles"), F.col("least").alias("component_id"))
    bare = own.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    null = every.where(F.col("doc_id").isNull())

    def sizes(batches):
        for b in parts(batches):
            yield pa.record_batch([b.column("doc_id"), pa.array([len(shingles(t, k)) for t in texts(b.column("text"))], pa.int64()),
                                   b.column("doc_id")], ["doc_id", "n_shingles", "component_id"])

    return linked.unionByName(bare).unionByName(null.mapInArrow(lean(sizes), linked.schema))
