"""Repeated passages across documents, located by sharded Aho-Corasick automata."""

from __future__ import annotations

import sys

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabflow.llm.common import bitmap, bounds, by_key, grams, in_bitmap, lean, mix, parts, starts_of, texts, words, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ANCHOR = 6
SHARD_SEGMENTS = 256
MARK_BITS = 1 << 27
_SPREAD = 0x9E3779B97F4A7C15


class Runs:
    """The words of a few texts and their runs of windows with one anchor, in one go.

    A window's anchor is the smallest hash of its ``k``-word phrases, which depends on
    its words alone: equal windows have equal anchors wherever they stand. ``anchor``,
    ``first``, ``last`` and ``text`` are the runs' anchors, first and end windows (as places
    in all words) and text numbers."""

    def __init__(self, batch: pa.RecordBatch, window: int, k: int):
        data = [t or b"" for t in texts(batch.column("text"))]
        self.window, self.data = window, b"\n".join(data)
        self.begin, self.end, self.h = words(self.data)
        starts = np.cumsum([0] + [len(t) + 1 for t in data[:-1]])
        self.base = np.searchsorted(self.begin, starts)
        number = np.repeat(np.arange(len(data)), np.diff(np.append(self.base, len(self.h))))
        n = len(self.h) - window + 1
        if n <= 0:
            none = np.empty(0, np.int64)
            self.anchor, self.first, self.last, self.text = none.view(np.uint64), none, none, none
            return
        phrases = grams(self.h, k)
        least, at, width = phrases, np.arange(len(phrases)), 1
        while width < window - k + 1:
            step = min(width, window - k + 1 - width)
            lower = least[step:] < least[:-step]
            least = np.where(lower, least[step:], least[:-step])
            at = np.where(lower, at[step:], at[:-step])
            width += step
        # a window over the end of a text belongs to no run
        cut = starts_of(np.where(number[:n] == number[window - 1:], at, -1))
        own = number[cut[:-1]] == number[cut[:-1] + window - 1]
        self.first, self.last = cut[:-1][own], cut[1:][own]
        self.anchor, self.text = phrases[at[self.first]], number[self.first]

    def hashes(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """64-bit hashes of the words under the windows first..last-1."""
        powers = np.full((2, len(self.h) + 1), np.uint64(_SPREAD))
        powers[1] = np.uint64(pow(_SPREAD, -1, 1 << 64))
        powers[:, 0] = 1
        power, inverse = np.cumprod(powers, axis=1, dtype=np.uint64)
        total = np.zeros(len(self.h) + 1, np.uint64)
        np.cumsum(self.h * power[:-1], out=total[1:])
        return mix((total[last + self.window - 1] - total[first]) * inverse[first])

    def said(self, first: np.ndarray, last: np.ndarray) -> list[bytes]:
        """The words under the windows first..last-1, joined by single spaces."""
        stop = last + self.window - 2
        raw = np.frombuffer(self.data, np.uint8)
        wide = np.ones(len(self.h), bool)
        wide[:-1] = (self.begin[1:] - self.end[:-1] != 1) | (raw[self.end[:-1]] != 32)
        wide = np.append(0, np.cumsum(wide))
        plain = wide[stop] == wide[first]
        out = [self.data[s:e] for s, e in zip(self.begin[first].tolist(), self.end[stop].tolist())]
        for i in np.flatnonzero(~plain).tolist():
            out[i] = b" ".join(out[i].split())
        return out


def _anchor_rows(docs: DataFrame, window: int, k: int) -> DataFrame:
    """(h, tk): the anchors of each text, each once."""

    def scan(batches):
        for b in parts(batches):
            runs = Runs(b, window, k)
            order = np.lexsort((runs.anchor, runs.text))
            a, t = runs.anchor[order], runs.text[order]
            head = starts_of(a, t)[:-1]
            yield pa.record_batch([pa.array(a[head].view(np.int64)), b.column("tk").take(pa.array(t[head]))], ["h", "tk"])

    return docs.select("text", "tk").mapInArrow(lean(scan), "h long, tk long")


def _places(docs: DataFrame, window: int, k: int, marks) -> DataFrame:
    """(h, sh, doc_id, tk, start, seg): every run of windows whose anchor may recur, by anchor and
    hash of its words, and where it stands. The words come with one of a few texts' equal runs."""
    held = docs.sparkSession.sparkContext.broadcast(marks)
    names = ["h", "sh", "doc_id", "tk", "start", "seg"]

    def scan(batches):
        bits = held.value
        for b in parts(batches):
            runs = Runs(b, window, k)
            slot = (runs.anchor % np.uint64(len(bits) << 6)).astype(np.int64)
            hit = np.flatnonzero((bits[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1))
            first, last, text = runs.first[hit], runs.last[hit], runs.text[hit]
            sh = runs.hashes(first, last)
            _, once = np.unique(sh, return_index=True)
            seg = np.full(len(hit), None, object)
            seg[once] = runs.said(first[once], last[once])
            yield pa.record_batch([pa.array(runs.anchor[hit].view(np.int64)), pa.array(sh.view(np.int64)),
                                   *[b.column(c).take(pa.array(text)) for c in ("doc_id", "tk")],
                                   pa.array(first - runs.base[text]), pa.array(seg, pa.binary())], names)

    return docs.select("doc_id", "tk", "text").mapInArrow(lean(scan), "h long, sh long, doc_id long, tk long, start long, seg binary")


def locate(segments: list[bytes], lo: np.ndarray, hi: np.ndarray, window: int):
    """Windows of the segments that recur: (segment, window in it, first document).

    Window hashes name the candidates: those with more than one document. Their words,
    from their first document, make an Aho-Corasick automaton over words, and every
    segment is streamed through it, so what is reported is equal word for word."""
    none = np.empty(0, np.int64)
    split = [s.split(b" ") for s in segments]
    size = np.fromiter(map(len, split), np.int64, len(split))
    seg = np.repeat(np.arange(len(segments)), size)
    _, _, h = words(b" ".join(segments))
    w = grams(h, window)
    inside = np.flatnonzero(seg[:len(w)] == seg[window - 1:]) if len(w) else none
    if not len(inside):
        return none, none, none
    order = inside[np.lexsort((lo[seg[inside]], w[inside]))]
    cut = starts_of(w[order])
    head = order[cut[:-1]]
    owner, last = lo[seg[head]], np.maximum.reduceat(hi[seg[order]], cut[:-1])
    again = np.flatnonzero(owner < last)
    if not len(again):
        return none, none, none
    number: dict[bytes, int] = {}
    ids = [number.setdefault(x, len(number) + 1) for p in split for x in p]
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for n, i in enumerate(head[again].tolist()):
        automaton.add_word(tuple(ids[i:i + window]), n)
    automaton.make_automaton()
    found = np.array(list(automaton.iter(tuple(ids))), np.int64).reshape(-1, 2)
    word = found[:, 0] - window + 1
    s = seg[word]
    own = s == seg[found[:, 0]]  # a match may not run from one segment into the next
    s, word, found = s[own], word[own], found[own]
    return s, word - np.searchsorted(seg, s), owner[again[found[:, 1]]]


def _automata(groups, window: int):
    """Per shard of groups: the recurring windows of each distinct segment. A group has
    SHARD_SEGMENTS segments at most, so a shard does too."""
    for t in groups:
        cut = starts_of(t.column("h").to_numpy())
        first = 0
        while first < len(cut) - 1:
            # whole groups, about SHARD_SEGMENTS segments at a time
            last = max(first + 1, int(np.searchsorted(cut, cut[first] + SHARD_SEGMENTS, "right")) - 1)
            part = t.slice(int(cut[first]), int(cut[last] - cut[first]))
            first = last
            lo, hi = part.column("lo").to_numpy(), part.column("hi").to_numpy()
            seg, at, owner = locate(part.column("seg").to_pylist(), lo, hi, window)
            use = owner < hi[seg]
            seg, at, owner = seg[use], at[use], owner[use]
            order = np.lexsort((at, seg))
            seg, at, owner = seg[order], at[order], owner[order]
            c = starts_of(seg)
            yield pa.record_batch([
                *[pa.array(part.column(k).to_numpy()[seg[c[:-1]]]) for k in ("h", "sh")],
                pa.ListArray.from_arrays(pa.array(c, pa.int32()), pa.array(at)),
                pa.ListArray.from_arrays(pa.array(c, pa.int32()), pa.array(owner))], ["h", "sh", "at", "owner"])


def _hot_windows(stretches: DataFrame, window: int) -> DataFrame:
    """(h, sh, at, owner) of the stretches of hot anchors: each of their windows is a key of its
    own, counted before the shuffle, and its smallest document comes back by a join."""

    def cut(batches):
        for b in parts(batches):
            _, _, h = words(b" ".join(b.column("seg").to_pylist()))
            size = np.array([s.count(b" ") + 1 for s in b.column("seg").to_pylist()])
            upto = np.concatenate([[0], np.cumsum(size)])
            w = grams(h, window)
            row = np.repeat(np.arange(b.num_rows), np.maximum(0, size - window + 1))
            n = np.maximum(0, size - window + 1)
            at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            key = w[upto[row] + at] if len(row) else w[:0]
            yield pa.record_batch([*[b.column(c).take(pa.array(row)) for c in ("h", "sh", "lo", "hi")], pa.array(at), pa.array(key.view(np.int64))],
                                  ["h", "sh", "lo", "hi", "at", "w"])

    rows = written(stretches.mapInArrow(lean(cut), "h long, sh long, lo long, hi long, at long, w long"), "hot")
    again = rows.groupBy("h", "w").agg(F.min("lo").alias("owner"), F.max("hi").alias("last")).where("owner < last").drop("last")
    return rows.join(again, ["h", "w"]).where("owner < hi").groupBy("h", "sh") \
        .agg(F.array_sort(F.collect_list(F.struct("at", "owner"))).alias("found")) \
        .select("h", "sh", F.col("found.at").alias("at"), F.col("found.owner").alias("owner"))


def strip_repeats(docs: DataFrame, window: int = 13, anchor: int = ANCHOR, id_column: str = "doc_id",
                  text: str = "text", carry: tuple[str, ...] = (), layout: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words left, joined by one space) and the
    ``carry`` columns per row: a word goes when a window of ``window`` words over it also
    starts in a document with a smaller doc_id. Windows are judged on the input. With
    ``layout``, a text that loses nothing is kept as it is, a null one too.

    1. Each window is named by its anchor, the smallest of its phrase hashes; anchors of
    one text only hold no repeat and go (min and max of the text per anchor, summed
    before the shuffle). 2. The stretches around the other anchors are written once, with
    their places; equal ones are one row by anchor, with the smallest and largest document.
    3. Each shard of anchors confirms the windows that recur, compiles its Aho-Corasick automaton
    over words and streams its stretches through it. Streaming all texts through all shards
    would read the corpus once a shard; an anchor's windows can only stand in that anchor's
    stretches, so each stretch of every document goes to the one automaton that can match it. An
    anchor of more than SHARD_SEGMENTS distinct stretches is hot: its windows are keys of their
    own, so a passage that a third of all documents share is one row for each of its windows,
    whatever stands beside it. 4. Every place of a stretch is joined with its windows, and texts are
    rewritten; only texts that change are shuffled. Exact copies lose all windows to their
    first document directly.

    The bitmap of anchors has 16 bits an anchor and at most MARK_BITS (16 MB); one that is too small
    for the corpus prunes less, up to every stretch (about 3.7 times the text), and the
    result is the same. A long text is hashed in chunks. A null or empty text has no words. A row
    with a null doc_id is neither changed nor changes others. Repeated rows, and rows that repeat
    an id, don't remove each other's words. Other columns are ignored; an empty table gives no rows."""
    clash = {"doc_id", "n_words", "n_removed", "kept"} & set(carry)
    if clash:
        raise ValueError(f"columns of the result can't be carried: {sorted(clash)}")
    more = [f"_c{i}" for i in range(len(carry))]
    every = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
                        *[F.col(c).alias(m) for c, m in zip(carry, more)]) \
        .withColumn("tk", F.xxhash64("text"))
    rows = every.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())

    known = written(_anchor_rows(rows, window, anchor).groupBy("h").agg(F.min("tk").alias("a"), F.max("tk").alias("b"))
                    .where("a <> b").select("h"), "anchors")
    found = written(_places(rows, window, anchor, anchor_bitmap(known)), "places")
    stretches = written(found.groupBy("h", "sh").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.min("seg").alias("seg")), "stretches")
    hot = written(stretches.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > SHARD_SEGMENTS).select("h"), "hot-anchors")
    list_schema = "h long, sh long, at array<long>, owner array<long>"
    windows = by_key(stretches.join(hot, "h", "left_anti"), ["h"], ["sh"], lambda g: _automata(g, window), list_schema)
    windows = written(windows.unionByName(_hot_windows(stretches.join(hot, "h", "left_semi"), window)), "windows")

    def starts(batches):
        for b in batches:
            at, owner = b.column("at"), b.column("owner")
            ends = at.offsets.to_numpy().astype(np.int64)
            n = np.diff(ends)
            keep = owner.flatten().to_numpy() < np.repeat(b.column("doc_id").to_numpy(), n)
            place = (at.flatten().to_numpy() + np.repeat(b.column("start").to_numpy(), n))[keep]
            upto = np.append(0, np.cumsum(keep))[ends - ends[0]]
            some = np.flatnonzero(np.diff(upto))
            raw = place.tobytes()
            yield pa.record_batch([*[b.column(c).take(pa.array(some)) for c in ("doc_id", "tk")],
                                   pa.array([raw[8 * s:8 * e] for s, e in zip(upto[some].tolist(), upto[some + 1].tolist())], pa.binary())],
                                  ["doc_id", "tk", "cut"])

    places = found.drop("seg").join(windows, ["h", "sh"]) \
        .select("doc_id", "tk", "start", "at", "owner").mapInArrow(lean(starts), "doc_id long, tk long, cut binary")
    cuts = _cuts(places)
    firsts = rows.groupBy("tk", F.octet_length("text").alias("size"), F.crc32(F.col("text").cast("binary")).alias("crc")) \
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    same = rows.select("doc_id", "tk", F.octet_length("text").alias("size"), F.crc32(F.col("text").cast("binary")).alias("crc")) \
        .join(firsts, ["tk", "size", "crc"]).where("doc_id > first").select("doc_id", "tk", F.lit(True).alias("copy")).distinct()
    change = written(cuts.join(same, ["doc_id", "tk"], "full"), "cuts")
    touched = bitmap(change, "doc_id")

    def rewrite(batches):
        for part in parts(batches):
            n_words, n_gone, left = [], [], []
            for t, cut, copy in zip(texts(part.column("text")), part.column("cuts").to_pylist(), part.column("copy").to_pylist()):
                n, gone, kept = without(t, cut, copy, window)
                n_words.append(n)
                n_gone.append(gone)
                left.append((t if layout and not gone else kept).decode() if t is not None or not layout else None)
            yield pa.record_batch([part.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_gone, pa.int64()),
                                   pa.array(left, pa.string()), *[part.column(m) for m in more]],
                                  ["doc_id", "n_words", "n_removed", "kept", *more])

    maybe = in_bitmap(rows, "doc_id", touched)
    rest = in_bitmap(rows, "doc_id", ~touched).unionByName(every.where(F.col("doc_id").isNull() | F.col("text").isNull()))
    none = [F.lit(None).cast("array<binary>").alias("cuts"), F.lit(None).cast("boolean").alias("copy")]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType()),
                           *[every.schema[m] for m in more]])
    done = maybe.join(change, ["doc_id", "tk"], "left").select("doc_id", "text", "cuts", "copy", *more).mapInArrow(lean(rewrite), schema) \
        .unionByName(rest.select("doc_id", "text", *none, *more).mapInArrow(lean(rewrite), schema))
    return done.withColumnsRenamed(dict(zip(more, carry)))


def _cuts(places: DataFrame) -> DataFrame:
    """The distinct cuts of each document's text. A set, so that the repetitions of a row
    merge before the shuffle and no buffer holds them."""
    return places.groupBy("doc_id", "tk").agg(F.collect_set("cut").alias("cuts"))


def without(data: bytes | None, cuts: list[bytes] | None, copy: bool | None, window: int) -> tuple[int, int, bytes]:
    """(words, words removed, words left joined by one space) of one text."""
    if not data:
        return 0, 0, b""
    if not cuts and not copy:
        parts = data.split()
        return len(parts), 0, b" ".join(parts)
    begin, end = bounds(data)
    n = len(begin)
    if copy and n >= window:
        return n, n, b""
    depth = np.zeros(n + 1, np.int64)
    if cuts:
        at = np.unique(np.concatenate([np.frombuffer(c, np.int64) for c in cuts]))
        depth[at] += 1
        np.add.at(depth, at + window, -1)
    keep = np.flatnonzero(np.cumsum(depth[:n]) == 0)
    return n, n - len(keep), b" ".join([data[begin[i]:end[i]] for i in keep.tolist()])


def anchor_bitmap(anchors: DataFrame) -> np.ndarray:
    """A bit for the hash class (remainder) of each anchor: 16 bits an anchor, at most MARK_BITS."""
    bits = 1 << 16
    n = anchors.count()
    while bits < min(16 * n, MARK_BITS):
        bits *= 2
    slot = F.expr(f"pmod(h, {bits}L)")
    rows = (anchors.select(F.shiftright(slot, 6).cast("int").alias("i"),
                           F.expr(f"shiftleft(1L, cast(pmod(pmod(h, {bits}L), 64) as int))").alias("b"))
            .groupBy("i").agg(F.expr("bit_or(b)").alias("b"))).toArrow()
    out = np.zeros(bits >> 6, np.uint64)
    out[rows["i"].to_numpy()] = rows["b"].to_numpy().view(np.uint64)
    return out
