"""Vector best-fit packing of tokenised documents into fixed-size sequences."""

from __future__ import annotations

import re
import sys
import zlib

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.llm.common import lean, parts, running, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Letters of Latin-1: lower-casing and composition leave one code point each.
_LETTER = "a-zß-öø-ÿ"
_SAFE = re.compile("[\\t\\n\\r -~À-ÖØ-öø-ÿ]*")
# The tokenizer's own words but those of letters only: 's 't 're 've 'm 'll 'd, one digit, a run of other signs.
_SIGNS = re.compile(f"[^\\s{_LETTER}](?:(?<=')(?:[stmd]|re|ve|ll)|(?<=[0-9])|[^\\s{_LETTER}0-9]*)")
CACHE_WORDS = 300_000


class WordTokenizer:
    """Token ids of whole texts as little-endian 32-bit bytes.

    A text of ASCII and Latin-1 letters is cut into the tokenizer's own words here and
    each word's ids are looked up; unknown words are encoded together, separated by
    spaces, and told apart by the end-of-word mark of their last token. Any other text
    goes to the tokenizer whole, as do texts that may hold its control strings. Both ways give
    the tokenizer's ids. With ``control_as_text`` a control string in a text is encoded as its
    characters, so that a document can't write control ids into a sequence."""

    def __init__(self, path: str, control_as_text: bool = False):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = control_as_text
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.ends = np.zeros(size, bool)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.ends[i] = token.endswith("</w>")
        # the same model for words that are cut and lower-cased already, parted by spaces
        self.words = Tokenizer(self.tokenizer.model)
        self.words.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.known: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(ids, "<u4").tobytes()

    def learn(self, new: list[str]) -> None:
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        for at in range(0, len(new), 2048):
            part = new[at:at + 2048]
            ids = np.array(self.words.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            cut = np.flatnonzero(self.ends[ids]) + 1
            if len(cut) != len(part):
                self.known.update((w, self.whole(w)) for w in part)
                continue
            raw, begin = ids.tobytes(), 0
            for w, end in zip(part, (cut * 4).tolist()):
                self.known[w] = raw[begin:end]
                begin = end

    def batch(self, texts: list[str]) -> list[bytes]:
        parts = [_SIGNS.sub(r" \g<0> ", t.lower()).split() if _SAFE.fullmatch(t) and "<|" not in t else None for t in texts]
        found: set[str] = set()
        for p in parts:
            found.update(p or ())
        new = list(found - self.known.keys())
        if new:
            self.learn(new)
        known = self.known
        if len(new) > CACHE_WORDS:  # one batch over the cache's size
            return [self.whole(t) for t in texts]
        try:
            return [self.whole(t) if p is None else b"".join(map(known.__getitem__, p)) for t, p in zip(texts, parts)]
        except KeyError:  # words cleared with the cache
            self.learn(list(found - known.keys()))
            return [self.whole(t) if p is None else b"".join([known[w] for w in p]) for t, p in zip(texts, parts)]


def pieces(docs: DataFrame, vocabulary: str, capacity: int = 2048, end_id: int = 0,
           id_column: str = "doc_id", text: str = "text", group: int = 256, control_as_text: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and ids (bytes) of every piece: a
    document's ids and ``end_id``, cut every ``capacity`` tokens when longer.
    Texts are taken in groups of ``group``, so memory is that of one group."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def cut(batches):
        tokenizer = WordTokenizer(vocabulary, control_as_text)  # its known words live as long as the task
        tail = np.array([end_id], "<u4").tobytes()
        step = 4 * capacity
        for part in parts(batches, group):
            rows: list[list] = [[] for _ in names]
            ids = tokenizer.batch([t or "" for t in part.column(1).to_pylist()])
            for doc, raw in zip(part.column(0).to_pylist(), ids):
                raw += tail
                for k, begin in enumerate(range(0, len(raw), step)):
                    piece = raw[begin:begin + step]
                    for col, v in zip(rows, (doc, k, begin // 4, len(piece) // 4, zlib.crc32(piece), piece)):
                        col.append(v)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(rows, types)], names)

    return docs.select(F.col(id_column).cast("long").alias("doc_id"),
                       F.col(text).cast("string").alias("text")).mapInArrow(lean(cut), schema)


def best_fit(counts: dict[int, int], capacity: int, max_docs: int, max_attention: float,
             weights: tuple[float, float, float] = (1.0, 1.0, 1.0), rule: str = "norm") -> list[tuple]:
    """Vector best fit over a histogram of piece lengths, longest first.

    A piece of n tokens needs (n tokens, 1 document, n * n attention cost); every bin
    has what is left of each. Bins with the same contents are one class with a count,
    and a whole class is filled at once, so the work depends on the number of
    lengths, not of pieces. Among the classes where all three fit, ``norm`` takes the
    smallest weighted norm of what would be left, ``dot`` the largest weighted
    product of need and rest. Returns (length, first rank, end rank, first bin, offset):
    pieces of that length with these ranks go one each to consecutive bins."""
    if rule not in ("norm", "dot"):
        raise ValueError(f"unknown rule {rule!r}")
    scale = np.array([capacity, max_docs, max_attention], float)
    w = np.array(weights, float)
    rest = np.empty((0, 3))  # of each class, tokens, documents, attention
    spans: list[list[tuple[int, int]]] = []  # bins of each class
    where: dict[tuple, int] = {}
    plan, bins = [], 0

    def put(left: np.ndarray, span: tuple[int, int]) -> None:
        nonlocal rest
        key = tuple(left.tolist())
        if key not in where:
            where[key] = len(spans)
            spans.append([])
            rest = np.vstack([rest, left])
        spans[where[key]].append(span)

    for length in sorted(counts, reverse=True):
        need = np.array([length, 1, float(length) ** 2])
        rank, count = 0, counts[length]
        open_ = np.array([bool(s) for s in spans], bool)
        fits = np.flatnonzero((rest >= need).all(axis=1) & open_) if len(rest) else np.empty(0, int)
        after = (rest[fits] - need) / scale
        if rule == "norm":
            score = (w * after ** 2).sum(axis=1)
        else:
            score = -(w * (need / scale) * (rest[fits] / scale)).sum(axis=1)
        todo = fits[np.argsort(score, kind="stable")].tolist()
        while rank < count:
            if not todo:
                # new bins in bulk, one piece each; their rest takes the next pieces
                left = scale - need
                if (left < 0).any():
                    raise ValueError(f"a piece of {length} tokens fits no bin")
                per = max(1, int(min(scale / np.maximum(need, 1e-9))))
                n = -(-(count - rank) // per)
                put(left, (bins, bins + n))
                plan.append((length, rank, rank + n, bins, 0))
                rank, bins = rank + n, bins + n
                todo = [where[tuple(left.tolist())]] if (left >= need).all() else []
                continue
            c = todo.pop(0)
            used = int(scale[0] - rest[c][0])
            while spans[c] and rank < count:
                a, b = spans[c].pop()
                take = min(b - a, count - rank)
                plan.append((length, rank, rank + take, a, used))
                left = rest[c] - need
                if take < b - a:
                    spans[c].append((a + take, b))
                put(left, (a, a + take))
                rank += take
                if rank < count and (left >= need).all():
                    todo.insert(0, where[tuple(left.tolist())])
    return plan


def pack(docs: DataFrame, vocabulary: str, capacity: int = 2048, max_docs: int = 2048,
         max_attention: float = 2048.0 ** 2, weights: tuple[float, float, float] = (1.0, 1.0, 1.0),
         rule: str = "norm", buckets: int = 256, with_ids: bool = False, **columns) -> DataFrame:
    """Pieces of all documents with the sequence and offset that each goes to.

    Spark tokenises and counts pieces by length; the driver packs that histogram (at
    most ``capacity`` rows); pieces find their place by their rank among those of the
    same length, so one plan holds for any number of documents. Full pieces have a
    sequence of their own and need no rank.

    A null or empty text is one piece of the end id. Repeated rows are packed each. An
    empty table gives no rows; other columns are ignored."""
    found = pieces(docs, vocabulary, capacity, **columns)
    keep = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    ranked = written(running(found.select(*keep), ["length"], ["doc_id", "piece", "ids_crc32"],
                             buckets=buckets, name="pieces"), "ranked")
    counts = {int(r["length"]): int(r["n"]) for r in
              ranked.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    steps = best_fit(counts, capacity, max_docs, max_attention, weights, rule)
    plan = docs.sparkSession.createDataFrame(
        steps, "length long, first long, last long, bin long, offset long")
    at = (F.col("r.length") == F.col("p.length")) & (F.col("r.before") >= F.col("p.first")) & (F.col("r.before") < F.col("p.last"))
    return (ranked.alias("r").join(F.broadcast(plan.alias("p")), at)
            .select(*[F.col(f"r.{c}") for c in keep],
                    (F.col("p.bin") + F.col("r.before") - F.col("p.first")).alias("sequence_id"),
                    F.col("p.offset").alias("offset")))
