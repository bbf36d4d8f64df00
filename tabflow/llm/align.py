"""Alignment of two tokenizers over a corpus whose texts are tokenised once each."""

from __future__ import annotations

import hashlib
import re
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.llm.common import lean, parts, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Both tokenizers end a token before a single space between two other characters.
_CUT = re.compile(r"(?<=[^\s▁]) (?=[^\s▁])")
_INNER = re.compile(r"[^\s▁](?:.*[^\s▁])?", re.DOTALL)
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")
CACHE_WORDS, CACHED_CHARS = 300_000, 64


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level entry stands for: printable bytes stand
    for themselves, the others follow from U+0100 on in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Tokens of both tokenizers and their groups, word by word.

    A text is cut before every single space between two characters that are no white
    space. The byte-level pattern lets no token run over such a place, and no piece of
    the other vocabulary has a space after another character (checked on loading), so the
    tokens of the parts are those of the text, and both tokenizers end a token there. Parts of
    up to CACHED_CHARS characters are aligned once and remembered. A text without such
    places is one part."""

    def __init__(self, a_path: str, b_path: str):
        import os

        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; more threads keep memory each
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letter = byte_alphabet()
        entries = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        said = [entries.get(i, "") for i in range(max(entries) + 1)]
        self.a_bytes = [bytes(letter[c] for c in t) if all(c in letter for c in t) else t.encode() for t in said]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.cuts = not any(re.search("[^▁]▁", p) for p in pieces)
        self.b_bytes = [bytes([int(_BYTE.fullmatch(p)[1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.array([len(t) for t in table], np.int64) for table in (self.a_bytes, self.b_bytes))
        self.a_text, self.b_text = ({end: np.array([f"{i}{end}" for i in range(len(table))], object) for end in ends}
                                    for table, ends in ((self.a_bytes, ",|"), (self.b_bytes, ",;\n")))
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.codes: list[bytes | None] = []
        self.groups: list[str] = []
        self.n_a: list[int] = []
        self.n_b: list[int] = []

    def align(self, words: list[str]) -> tuple[list, list, list, list] | None:
        """(codes of the links, groups, n_a, n_b) of words that stand side by side: encoded as
        one text and cut at the words' ends. None if their bytes don't come back."""
        text = " ".join(words)
        whole = b" " + text.encode()
        x = np.array(self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids, np.int64)
        y = np.array(self.b.encode(text, num_threads=1), np.int64)
        for table, ids in ((self.a_bytes, x), (self.b_bytes, y)):
            if b"".join(map(table.__getitem__, ids.tolist())) != whole:
                return None
        ends_x, ends_y = np.cumsum(self.a_size[x]), np.cumsum(self.b_size[y])
        both = np.intersect1d(ends_x, ends_y, assume_unique=True)
        i, j = np.searchsorted(ends_x, both), np.searchsorted(ends_y, both)  # last tokens of the groups
        last = np.searchsorted(both, np.cumsum([len(w.encode()) + 1 for w in words]))  # last groups of the words
        told = np.empty(len(x) + len(y), object)
        before = np.append(0, j + 1)
        at_x = np.arange(len(x)) + before[np.searchsorted(i, np.arange(len(x)))]
        at_y = np.arange(len(y)) + (i + 1)[np.searchsorted(j, np.arange(len(y)))]
        told[at_x], told[at_y] = self.a_text[","][x], self.b_text[","][y]
        told[at_x[i]], told[at_y[j]] = self.a_text["|"][x[i]], self.b_text[";"][y[j]]
        told[at_y[j[last]]] = self.b_text["\n"][y[j[last]]]
        raw = ((x[i] << 32) | y[j]).astype("<i8").tobytes()
        cut = np.append(0, 8 * (last + 1)).tolist()
        return ([raw[s:e] for s, e in zip(cut, cut[1:])], "".join(told.tolist()).split("\n")[:-1],
                np.diff(i[last], prepend=-1).tolist(), np.diff(j[last], prepend=-1).tolist())

    def learn(self, words: list[str]) -> None:
        """Aligns words, many at once; one whose bytes don't come back gets no codes."""
        done = self.align(words)
        if done is None and len(words) > 1:
            half = len(words) // 2
            self.learn(words[:half])
            self.learn(words[half:])
            return
        for held, new in zip((self.codes, self.groups, self.n_a, self.n_b), done or ([None], [""], [0], [0])):
            held += new
        self.index.update(zip(words, range(len(self.codes) - len(words), len(self.codes))))

    def batch(self, texts: list[str | None]) -> list[tuple]:
        """(n_a, n_b, codes of the links, groups) of each text; all empty without tokens."""
        split = [(_CUT.split(t) if self.cuts else [t]) if t else [] for t in texts]
        if len(self.index) > CACHE_WORDS:
            self.forget()
        known = self.index
        new = set().union(*split) - known.keys()
        # long words, and those at a text's edge with white space of their own, are not kept
        odd = {w for w in new if len(w) > CACHED_CHARS or not _INNER.fullmatch(w)}
        plain = list(new - odd)
        for at in range(0, len(plain), 4096):
            self.learn(plain[at:at + 4096])
        out = []
        for p in split:
            mark, own = len(self.codes), odd.intersection(p)
            for w in own:
                self.learn([w])
            at = list(map(known.__getitem__, p))
            codes = list(map(self.codes.__getitem__, at))
            if not p or None in codes:
                out.append((0, 0, b"", ""))
            else:
                out.append((sum(map(self.n_a.__getitem__, at)), sum(map(self.n_b.__getitem__, at)), b"".join(codes),
                            ";".join(map(self.groups.__getitem__, at))))
            for w in own:
                del known[w]
            del self.codes[mark:], self.groups[mark:], self.n_a[mark:], self.n_b[mark:]
        return out


def aligned_texts(docs: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """(tid, copies, n_a, n_b, n_groups, groups_sha256, links) of each distinct text: texts are
    shuffled whole, equal ones meet and are tokenised and aligned once. ``tid`` is the text's
    SHA-256; ``links`` holds id pairs (a << 32 | b) as little-endian 64-bit numbers. Use
    ``align_groups`` for the groups themselves."""
    once = docs.groupBy(F.col(text).cast("string").alias("text")).agg(F.count(F.lit(1)).alias("copies")) \
        .where("text is not null").select(F.unhex(F.sha2("text", 256)).alias("tid"), "copies", "text")
    names = ["tid", "copies", "n_a", "n_b", "n_groups", "groups_sha256", "links"]
    schema = "tid binary, copies long, n_a long, n_b long, n_groups long, groups_sha256 string, links binary"

    def align(batches):
        aligner = Aligner(a_path, b_path)
        for part in parts(batches, 128):
            done = aligner.batch(part.column("text").to_pylist())
            yield pa.record_batch([
                part.column("tid"), part.column("copies"), pa.array([r[0] for r in done], pa.int64()),
                pa.array([r[1] for r in done], pa.int64()), pa.array([len(r[2]) // 8 for r in done], pa.int64()),
                pa.array([hashlib.sha256(r[3].encode()).hexdigest() if r[0] else "" for r in done], pa.string()),
                pa.array([r[2] for r in done], pa.binary())], names)

    return once.mapInArrow(lean(align), schema)


def align_groups(docs: DataFrame, a_path: str, b_path: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, groups): the groups of each row's tokens, written ``a1,a2|b1;a3|b2,b3``."""

    def align(batches):
        aligner = Aligner(a_path, b_path)
        for part in parts(batches, 128):
            yield pa.record_batch([part.column(0), pa.array([r[3] for r in aligner.batch(part.column(1).to_pylist())], pa.string())],
                                  ["doc_id", "groups"])

    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")) \
        .mapInArrow(lean(align), "doc_id long, groups string")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(code, n, best): how many links of the corpus hold each id pair, copies counted, and
    whether no other pair of the same b has more. Tasks sum their own pairs first."""

    def count(batches):
        for b in parts(batches):
            copies = b.column("copies").to_numpy()
            own, n = [], []
            for m in np.unique(copies):  # most texts come once
                some = b.column("links").filter(pa.array(copies == m)).to_pylist()
                codes, c = np.unique(np.frombuffer(b"".join(some), "<i8"), return_counts=True)
                own.append(codes)
                n.append(c * m)
            yield pa.record_batch([pa.array(np.concatenate(own)), pa.array(np.concatenate(n))], ["code", "n"])

    counted = written(aligned.select("links", "copies").mapInArrow(lean(count), "code long, n long")
                      .groupBy("code").agg(F.sum("n").alias("n")), "pairs")
    b = F.col("code").bitwiseAND(F.lit(0xFFFFFFFF).cast("long")).alias("b")
    most = counted.groupBy(b).agg(F.max("n").alias("most"))
    return written(counted.withColumn("b", b).join(most, "b").select("code", "n", (F.col("n") == F.col("most")).alias("best")), "counts")


def frequent(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes in order and (n, best) of about ``most`` pairs of the largest counts: a
    histogram of the counts by their leading binary digits sets the least one listed."""
    level = F.floor(F.log2("n") * 8).cast("int")
    room, least = most, 1 << 30
    for r in counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("level").desc()).collect():
        if r["n"] > room:
            break
        room, least = room - r["n"], r["level"]
    rows = counts.where(level >= least).toArrow()
    codes = rows["code"].to_numpy()
    order = np.argsort(codes)
    return codes[order], np.column_stack([rows["n"].to_numpy(), rows["best"].to_numpy().astype(np.int64)])[order]


def tokenizer_links(docs: DataFrame, a_path: str, b_path: str, id_column: str = "doc_id", text: str = "text",
                    listed: int = 1 << 18) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row: its
    text's tokens under both tokenizers (byte-level BPE of a space and the text, pieces of the text),
    the groups that common token ends cut them into, and its links (a pair of tokens that end
    together) measured by how often the corpus links the same two ids.

    1. Rows are shuffled by their full text, pre-aggregated, and each distinct text is tokenised
    and aligned once. 2. Its pairs count as often as the text occurs; tasks sum before the
    shuffle. 3. The ``listed`` most frequent pairs (a few MB, whatever the corpus) are looked up
    in the tasks; a text's other pairs are joined with the counts. 4. Measures are joined
    to the ids by the text's SHA-256.

    Null and empty texts, and texts whose tokens' bytes are not the text's (U+2581, which reads as a
    space), have zeros and groups_sha256 ''. Repeated rows and ids stay rows of their
    own. A long text is worked on part by part; only a run without single spaces is encoded
    whole. Other columns are ignored; an empty table gives no rows."""
    aligned = written(aligned_texts(docs, a_path, b_path, text), "aligned")
    counts = pair_counts(aligned)
    held = docs.sparkSession.sparkContext.broadcast(frequent(counts, listed))
    names = ["tid", "n_best", "count_sum", "rest"]

    def measure(batches):
        codes, value = held.value
        for part in parts(batches):
            links = [np.frombuffer(x, "<i8") for x in part.column("links").to_pylist()]
            own, at = np.unique(np.concatenate(links), return_inverse=True)
            place = np.minimum(np.searchsorted(codes, own), max(0, len(codes) - 1))
            hit = codes[place] == own if len(codes) else np.zeros(len(own), bool)
            found = np.zeros((len(own), 2), np.int64)
            found[hit] = value[place[hit]]
            each, known = found[at], hit[at]
            size = np.array([len(x) for x in links])
            upto = np.concatenate([[0], np.cumsum(size)])
            total = np.concatenate([np.zeros((1, 2), np.int64), np.cumsum(each, axis=0)])
            sums = total[upto[1:]] - total[upto[:-1]]
            rest = [x[~known[s:e]].tolist() for x, s, e in zip(links, upto[:-1], upto[1:])]
            yield pa.record_batch([part.column("tid"), pa.array(sums[:, 1]), pa.array(sums[:, 0]), pa.array(rest, pa.list_(pa.int64()))], names)

    near = written(aligned.select("tid", "links").mapInArrow(lean(measure), "tid binary, n_best long, count_sum long, rest array<long>"), "measured")
    rare = near.where(F.size("rest") > 0).select("tid", F.explode("rest").alias("code")) \
        .groupBy("tid", "code").agg(F.count(F.lit(1)).alias("m")).join(counts, "code") \
        .groupBy("tid").agg(F.sum(F.when(F.col("best"), F.col("m")).otherwise(0)).alias("more_best"), F.sum(F.col("n") * F.col("m")).alias("more"))
    per = aligned.drop("links", "copies").join(near.drop("rest"), "tid").join(rare, "tid", "left") \
        .withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0))) \
        .withColumn("count_sum", F.col("count_sum") + F.coalesce("more", F.lit(0)))
    ids = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.unhex(F.sha2(F.col(text).cast("string"), 256)).alias("tid"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return ids.join(per, "tid", "left").select(
        "doc_id", zero("n_a"), zero("n_b"), zero("n_groups"), F.coalesce("n_groups", F.lit(0)).cast("long").alias("n_links"),
        zero("n_best"), zero("count_sum"), F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
