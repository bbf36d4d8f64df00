"""Near-duplicate embeddings by Euclidean p-stable hashing and exact cosines."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.llm.common import by_key, components, forest, lean, mix, starts_of, written
from tabflow.llm.vptree import _vectors, dots, usable

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MARGIN = 1e-9


def buckets_of(unit: np.ndarray, tables: int, hashes: int, width: float, seed: int) -> np.ndarray:
    """A 32-bit bucket of each table for unit vectors: ``hashes`` projections on normal
    directions, shifted, quantised by ``width`` and hashed together."""
    rng = np.random.default_rng(seed)
    directions = rng.standard_normal((unit.shape[1], tables * hashes))
    shift = rng.uniform(0, width, tables * hashes)
    cell = np.floor((unit @ directions + shift) / width).astype(np.int64).view(np.uint64)
    out = np.zeros((len(unit), tables), np.uint64)
    for j in range(hashes):
        out = mix(out * np.uint64(31) + cell[:, j::hashes])
    return (out & np.uint64(0x7FFFFFFF)).astype(np.int32)


def _linked(a: np.ndarray, b: np.ndarray, an: np.ndarray, bn: np.ndarray, least: float, same: bool):
    """Index pairs with cosine >= ``least``: a matrix product with a margin, then exact."""
    close = (a / an[:, None]) @ (b / bn[:, None]).T >= least - MARGIN
    if same:
        close = np.triu(close, 1)
    i, j = np.nonzero(close)
    keep = np.zeros(len(i), bool)
    for at in range(0, len(i), 1 << 16):
        s = slice(at, at + (1 << 16))
        keep[s] = dots(a[i[s]], b[j[s]]) / (an[i[s]] * bn[j[s]]) >= least
    return i[keep], j[keep]


def compare(groups, least: float):
    """Counts of links and one forest of links for each pair of blocks of a bucket.

    A pair counts in the first table whose bucket it shares, so no pair counts twice.
    A vector's links leave as one number and the smallest partner, never as pairs; the
    smallest partner and, for connectivity, the forest's edges are what goes on."""
    for t in groups:
        cols = {c: t.column(c).to_numpy() for c in ("label", "tab", "bucket", "lo", "hi", "side", "gid", "weight")}
        keys = np.array(t.column("keys").to_pylist(), np.int32)
        column = t.column("v").combine_chunks()
        column = column if isinstance(column, pa.Array) else pa.concat_arrays(column.chunks)
        ends, values = column.offsets.to_numpy() - column.offsets[0].as_py(), column.flatten().to_numpy()
        n = t.num_rows
        links, edges = np.zeros(n, np.int64), []
        cut = starts_of(*[cols[c] for c in ("label", "tab", "bucket", "lo", "hi")])
        for s, e in zip(cut[:-1], cut[1:]):
            if e - s < 2:
                continue
            rows = np.arange(s, e)
            # vectors of one group have one length
            x = values[ends[s]:ends[e]].reshape(e - s, -1)
            norm = np.sqrt(dots(x, x))
            same = cols["lo"][s] == cols["hi"][s]
            left, right = (rows, rows) if same else (rows[cols["side"][s:e] == 0], rows[cols["side"][s:e] == 1])
            if not len(left) or not len(right):
                continue
            i, j = _linked(x[left - s], x[right - s], norm[left - s], norm[right - s], least, same)
            i, j = left[i], right[j]
            tab = cols["tab"][s]
            if tab:
                new = ~(keys[i][:, :tab] == keys[j][:, :tab]).any(axis=1)
                i, j = i[new], j[new]
            if len(i):
                np.add.at(links, i, cols["weight"][j])
                np.add.at(links, j, cols["weight"][i])
                edges.append(forest(i, j))
        hit = np.flatnonzero(links)
        gid = cols["gid"]
        e = np.concatenate(edges) if edges else np.empty((0, 2), np.int64)
        yield pa.record_batch([
            pa.array(np.concatenate([gid[hit], gid[e[:, 0]]])),
            pa.array(np.concatenate([links[hit], np.zeros(len(e), np.int64)])),
            pa.array(np.concatenate([np.full(len(hit), -1), np.ones(len(e))]).astype(np.int32)),
            pa.array(np.concatenate([gid[hit], gid[e[:, 1]]]))], ["gid", "links", "kind", "other"])


def near_duplicates(vectors: DataFrame, least: float = 0.98, tables: int = 16, hashes: int = 10, width: float = 1.5,
                    block: int = 1024, seed: int = 11, id_column: str = "vec_id", vector: str = "embedding",
                    label: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept for each row: links join vectors of equal
    label with cosine >= ``least`` that share a bucket of any table.

    At cosine 0.98 (distance 0.2) one hash agrees with probability 0.89 and one
    of 16 tables of 10 hashes with 0.998. Identical vectors of a label are one row with
    a weight. A bucket of many vectors is cut into blocks of about ``block`` rows and each
    pair of blocks is a group of its own, so a hot bucket spreads over tasks and keeps
    every pair. Vectors travel only for buckets that hold two or more.

    A null label, or a vector that is null, empty, zero or holds null or non-finite
    components, links with nothing; vectors of different length don't link. Rows that repeat
    a vec_id are vectors each, whatever their vector or label (a null vec_id links with nothing
    and has component null). Other columns are ignored; an empty table gives no rows."""
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"),
                          F.col(label).cast("string").alias("label"),
                          F.col(vector).cast("array<double>").alias("v"))
    part = rows.where(usable("v") & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    groups = part.groupBy("label", "v").agg(F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("rid"))

    def hashed(batches):
        for b in batches:
            length = np.diff(b.column("v").offsets.to_numpy())
            out = [None] * b.num_rows
            for d in np.unique(length):
                at = np.flatnonzero(length == d)
                x = _vectors(pa.chunked_array([b.column("v").take(pa.array(at))]))
                unit = x / np.abs(x).max(axis=1)[:, None]
                unit /= np.sqrt(dots(unit, unit))[:, None]
                for i, k in zip(at, buckets_of(unit, tables, hashes, width, seed + int(d))):
                    out[i] = k.tolist()
            yield pa.record_batch([*b.columns, pa.array(out, pa.list_(pa.int32()))], [*b.schema.names, "keys"])

    # a number for each distinct vector of a label, fixed by writing it
    reps = written(groups.mapInArrow(lean(hashed), "label string, v array<double>, weight long, rid long, keys array<int>")
                   .withColumn("gid", F.monotonically_increasing_id()), "vectors")
    whole = reps.select("label", "v", "gid")
    reps = reps.withColumn("label", F.concat_ws(":", F.size("v").cast("string"), "label"))
    keyed_ = reps.select("label", "gid", F.posexplode("keys").alias("tab", "bucket"))
    full = keyed_.groupBy("label", "tab", "bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1") \
        .withColumn("blocks", F.ceil(F.col("n") / F.lit(block)).cast("int"))
    sent = keyed_.join(full, ["label", "tab", "bucket"]) \
        .withColumn("own", F.pmod(F.xxhash64("gid"), F.col("blocks")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select("label", "tab", "bucket", "gid", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
                (F.col("own") > F.col("other")).cast("int").alias("side"))
    sent = sent.join(reps.select("gid", "v", "keys", "weight"), "gid")
    key = ["label", "tab", "bucket", "lo", "hi"]
    found = written(by_key(sent, key, ["gid"], lambda g: compare(g, least),
                           "gid long, links long, kind int, other long"), "links")
    labels = components(found.where("kind = 1").select("gid", "other"), "gid", "other")
    links = found.where("kind = -1").groupBy("gid").agg(F.sum("links").alias("far"))
    per = written(reps.select("gid", "rid", "weight").join(links, "gid", "left").join(labels.withColumnRenamed("node", "gid"), "gid", "left")
                  .select("gid", "rid", (F.coalesce("far", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                          F.coalesce("component", "gid").alias("root")), "linked")
    named = per.groupBy("root").agg(F.min("rid").alias("component_id"))
    member = part.join(whole, ["label", "v"]).select("vec_id", "gid")
    linked = member.join(per.join(named, "root").drop("rid"), "gid").select("vec_id", "n_links", "component_id")
    alone = rows.where(~(usable("v") & F.col("label").isNotNull() & F.col("vec_id").isNotNull())) \
        .select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
