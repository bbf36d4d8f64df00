"""Toxicity of texts whose words may be disguised: a noisy-channel decoder restores
leetspeak, spacing and repetition under a character language model; the restored text
is scored by a logistic model over a learned lexicon."""

from __future__ import annotations

import re
import sys
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabflow.llm.common import lean, parts, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# What each sign may stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "+": "t", "|": "il", "(": "c", "€": "e", "*": ""}  # a star masks any letter
# Channel costs in nats: a sign for a letter, a masked letter, a sign put in, a run kept, cut or doubled, a space.
SIGN, MASKED, INSERTED, KEPT, CUT, DOUBLED, JOINED, SPLIT = 1.0, 2.0, 2.5, 1.0, 0.5, 0.8, 0.1, 4.0

LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
SIZE = len(LETTERS) + 1  # 0 is the edge of a word
_CODE = {c: i + 1 for i, c in enumerate(LETTERS)}
_TABLE = np.zeros(256, np.int32)
for _c, _i in _CODE.items():
    _TABLE[ord(_c)] = _i
_WORD = re.compile(r"[^\W\d_]+")
_SIGNS = re.escape("".join(LEET))
_DISGUISED = re.compile(
    rf"[^\W\d_][{_SIGNS}._\-]+[^\W\d_]|[^\W\d_][{_SIGNS}]|[{_SIGNS}][^\W\d_]|([^\W\d_])\1\1")
# Signs and separators share no character in either form, so each text has one reading.
_SPACED = re.compile(rf"(?<!\S)(?:(?:[\w{_SIGNS}] {{1,2}}){{2,}}[\w{_SIGNS}]"
                     rf"|(?:(?:[^\W_]|(?!\*)[{_SIGNS}])[ .\-_*]{{1,2}}){{2,}}(?:[^\W_]|(?!\*)[{_SIGNS}]))(?!\S)")
_EDGE = ".,;:?!\"'()[]{}<>-_#%&~^`/\\=*"
_PLAIN_EDGE = "".join(c for c in _EDGE if c not in LEET)
KNOWN_TOKENS = 50_000
KNOWN_RESTS = 10_000
SEEN_TOKENS = 100_000
LONGEST_KEPT = 64  # signs of a token that is kept
_TRIPLE = re.compile(r"([^\W\d_])\1\1")
CHUNK = 1 << 20
LONGEST_MASK = 24  # letters; more stars in a row are a line, not a word


def char_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Counts of all letter trigrams of the whole corpus, word edges included: each
    block of texts is counted in its task and sums are merged by Spark; at most
    SIZE ** 3 rows reach the driver."""

    def count(batches):
        for b in batches:
            total = np.zeros(SIZE ** 3, np.int64)
            for some in parts([b], 256):
                part = "\n\n".join(t for t in some.column(0).to_pylist() if t)
                raw = np.frombuffer(("\n\n" + part.lower() + "\n\n").encode("latin-1", "replace"), np.uint8)
                for at in range(0, len(raw) - 2, CHUNK):
                    c = _TABLE[raw[at:at + CHUNK + 2]]
                    total += np.bincount((c[:-2] * SIZE + c[1:-1]) * SIZE + c[2:], minlength=SIZE ** 3)
            hit = np.flatnonzero(total)
            yield pa.record_batch([pa.array(hit), pa.array(total[hit])], ["gram", "n"])

    rows = docs.select(F.col(text).cast("string")).mapInArrow(lean(count), "gram long, n long") \
        .groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(SIZE ** 3, np.int64)
    out[rows["gram"].to_numpy()] = rows["n"].to_numpy()
    return out


def char_costs(counts: np.ndarray) -> np.ndarray:
    """-log P(c | a, b), interpolated from trigram, bigram and single counts."""
    tri = counts.reshape(SIZE, SIZE, SIZE).astype(float)
    bi, one = tri.sum(axis=0), tri.sum(axis=(0, 1)) + 1.0
    p1 = one / one.sum()
    p2 = (bi + 5 * p1) / (bi.sum(axis=1, keepdims=True) + 5)
    p3 = (tri + 5 * p2[None]) / (tri.sum(axis=2, keepdims=True) + 5)
    return -np.log(p3).ravel().astype(np.float32)


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """The letters that each stretch of a disguised token may stand for, with channel
    costs. A letter outside the alphabet stands for itself. A run of three or more equal
    signs is decoration, or one, two or as many letters; each star of a run masks a
    letter of its own ("*" here) or goes."""
    slots, i = [], 0
    while i < len(token):
        c, j = token[i], i + 1
        while j < len(token) and token[j] == c:
            j += 1
        run = j - i
        if c.isalpha():
            if run < 3:
                slots += [[(c, 0.0)]] * run
            else:
                slots.append([(c, CUT), (c + c, DOUBLED), (c * run, KEPT * (run - 2))])
        elif c == " ":
            slots.append([("", JOINED), (" ", SPLIT)])
        elif c == "*":
            if run <= LONGEST_MASK:
                slots += [[("*", MASKED), ("", INSERTED)]] * run
        elif run < 3:
            options = [(x, SIGN) for x in LEET.get(c, "")] + [("", INSERTED if c in LEET else JOINED)]
            slots += [options] * run
        elif c in LEET:
            slots.append([("", 0.0)] + [o for x in LEET[c] for o in (
                (x, SIGN + CUT), (x + x, SIGN + DOUBLED), (x * run, SIGN + KEPT * (run - 2)))])
        i = j
    return slots


def decode(token: str, costs: list[float], cube: np.ndarray | None = None, rests: dict | None = None) -> str:
    """Viterbi path through a token's lattice: least channel plus language model cost.
    ``cube`` is the same costs by (next, last, before last) letter, for masked tokens.
    ``rests`` keeps what follows two letters, as one path up to the first masked letter
    leaves a rest that these two alone decide."""
    slots = [*lattice(token), [(" ", 0.0)]]
    square = SIZE * SIZE
    states = {(0, 0): (0.0, None)}
    for at, options in enumerate(slots):
        if options[0][0] == "*":
            cube = cube_of(costs) if cube is None else cube
            if len(states) > 1:
                return unmask(states, slots[at:], cube).strip()
            (pair, (_, path)), = states.items()
            rests = {} if rests is None else rests
            key = (pair, *map(tuple, slots[at:]))
            rest = rests.get(key)
            if rest is None:
                rest = unmask({pair: (0.0, None)}, slots[at:], cube)
                if len(rests) >= KNOWN_RESTS:
                    rests.clear()
                if len(key) <= LONGEST_KEPT:
                    rests[key] = rest
            return (spelled(path) + rest).strip()
        after: dict = {}
        for (a, b), (cost, path) in states.items():
            for letters, extra in options:
                x, y, k = a, b, cost + extra
                for c in letters:
                    z = _CODE.get(c, 0)
                    k += costs[x * square + y * SIZE + z]
                    x, y = y, z
                old = after.get((x, y))
                if old is None or k < old[0]:
                    after[(x, y)] = (k, (path, letters) if letters else path)
        states = after
    return spelled(min(states.values(), key=lambda s: s[0])[1]).strip()


def spelled(path) -> str:
    out = []
    while path:
        path, letters = path
        out.append(letters)
    return "".join(reversed(out))


def cube_of(costs) -> np.ndarray:
    return np.ascontiguousarray(np.asarray(costs, np.float32).reshape(SIZE, SIZE, SIZE).transpose(2, 1, 0))


def unmask(states: dict, slots: list, cube: np.ndarray) -> str:
    """The rest of ``decode`` from its first masked letter on, with all states (last,
    before last) as one table."""
    state = np.full((SIZE, SIZE), np.inf, np.float32)
    for (a, b), (cost, _) in states.items():
        state[b, a] = cost
    trail = []
    for options in slots:
        best, choice, steps = None, None, []
        for n, (letters, extra) in enumerate(options):
            now, back = state, []
            for c in letters:
                z = slice(1, SIZE) if letters == "*" else slice(_CODE.get(c, 0), _CODE.get(c, 0) + 1)
                total = now + cube[z]
                back.append(total.argmin(axis=2))
                now = np.full((SIZE, SIZE), np.inf, np.float32)
                now[z] = np.take_along_axis(total, back[-1][..., None], 2)[..., 0]
            now = now + np.float32(extra)
            if best is None:
                best = now
            else:
                less = now < best
                choice = np.where(less, n, 0 if choice is None else choice)
                best = np.where(less, now, best)
            steps.append(back)
        trail.append((options, choice, steps))
        state = best
    y, x = divmod(int(state.argmin()), SIZE)
    out = []
    for options, choice, steps in reversed(trail):
        n = 0 if choice is None else int(choice[y, x])
        letters = options[n][0]
        for c, back in zip(reversed(letters), reversed(steps[n])):
            out.append(LETTERS[y - 1] if letters == "*" else c)
            y, x = x, int(back[y - 1 if letters == "*" else 0, x])
    return spelled(states[x, y][1]) + "".join(reversed(out))


class Restorer:
    """Distinct words of a text, disguised ones restored."""

    def __init__(self, costs):
        self.costs = costs.tolist() if isinstance(costs, np.ndarray) else costs
        self.cube = cube_of(costs)
        self.known: dict[str, list[str]] = {}
        self.rests: dict[tuple, str] = {}
        self.seen: dict[str, tuple[str, ...] | None] = {}  # None: one plain word

    def one(self, token: str) -> list[str]:
        got = self.known.get(token)
        if got is None:
            if len(self.known) >= KNOWN_TOKENS:
                self.known.clear()
            plain = token.isalpha() and not _DISGUISED.search(token)  # one path only
            got = self.known[token] = [token] if plain else decode(token, self.costs, self.cube, self.rests).split()
        return got

    def readings(self, token: str) -> set[str]:
        """A token with its outer signs, which may be letters, and without them."""
        token = token.strip(_PLAIN_EDGE)
        bare = token.strip(_EDGE)
        return {token, bare, token.lstrip(_EDGE), token.rstrip(_EDGE), bare.lstrip("".join(LEET))} - {""}

    def token(self, token: str) -> tuple[str, ...]:
        """The words of what stands between spaces, and of its readings if it is disguised."""
        found = set(_WORD.findall(token))
        if _DISGUISED.search(token):
            for reading in self.readings(token):
                found.update(self.one(reading))
        return tuple(found)

    def words(self, text: str | None) -> set[str]:
        if not text:
            return set()
        low = text.lower()
        found, seen = set(), self.seen
        for token in set(low.split()):
            if token in seen:
                got = seen[token]
            else:
                got = None if token.isalpha() and not _TRIPLE.search(token) else self.token(token)
                if len(seen) >= SEEN_TOKENS:
                    seen.clear()
                if len(token) <= LONGEST_KEPT:
                    seen[token] = got
            if got is None:
                found.add(token)
            else:
                found.update(got)
        for m in _SPACED.finditer(low):
            spaced = " ".join(m.group().split())
            found.update(self.one(spaced))
            if "*" in spaced:  # between letters, a star may also part them
                found.update(self.one(" ".join(spaced.replace("*", " ").split())))
        return found


@dataclass
class Model:
    costs: np.ndarray
    weights: dict[str, float] = field(default_factory=dict)
    alone: dict[str, float] = field(default_factory=dict)
    bias: float = -2.0

    def score(self, words: set[str]) -> float:
        """The logistic model's value, or that of the surest single word if higher."""
        z = self.bias + sum(self.weights[w] for w in sorted(words & self.weights.keys()))
        return max(1 / (1 + float(np.exp(-min(max(z, -60.0), 60.0)))),
                   max((self.alone[w] for w in words & self.alone.keys()), default=0.0))


def fold(column: str, folds: int):
    """Remainder of the CRC-32 of a key's text."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 10_000, vocabulary: int = 4096, least: int = 3,
        steps: int = 2000, sure: float = 0.8, id_column: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Language model from all texts; lexicon and weights from a bounded sample of
    labelled rows: ``per_class`` ids of each label by hash order. Words of restored texts
    in at least ``least`` positive rows, ranked by chi-square, are the features; weights
    are not negative, as these words only speak for the label. A word whose shrunk share
    of positive rows is ``sure`` or more also speaks alone."""
    model = Model(char_costs(char_counts(docs, text)))
    marked = labels.where(F.col(label).isin(0, 1) & F.col(id_column).isNotNull()) \
        .groupBy(F.col(id_column).cast("long").alias("doc_id")).agg(F.max(label).cast("int").alias("y"))
    order = Window.partitionBy("y").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = written(marked.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= per_class).select("doc_id", "y"), "sample")
    sample = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")) \
        .join(F.broadcast(ids), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    held = docs.sparkSession.sparkContext.broadcast(model.costs)

    def restored(batches):
        restorer = Restorer(held.value)
        for b in parts(batches):
            found = [sorted(restorer.words(t)) for t in b.column("text").to_pylist()]
            yield pa.record_batch([b.column("doc_id"), b.column("y"), pa.array(found, pa.list_(pa.string()))],
                                  ["doc_id", "y", "words"])

    sample = written(sample.mapInArrow(lean(restored), "doc_id long, y int, words array<string>"), "restored")
    totals = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    pos, neg = totals.get(1, 0), totals.get(0, 0)
    if not pos or not neg:
        model.bias = 2.0 if pos else -4.0
        return model
    by_word = sample.select("y", F.explode("words").alias("w")).groupBy("w") \
        .agg(F.sum("y").alias("a"), F.count(F.lit(1)).alias("n"))
    rate = pos / (pos + neg)
    chosen = by_word.where((F.col("a") >= least) & (F.col("a") > 2 * rate * F.col("n"))) \
        .withColumn("chi", (F.col("a") - rate * F.col("n")) ** 2 / F.col("n")) \
        .orderBy(F.col("chi").desc(), "w").limit(vocabulary).select("w", "a", "n").collect()
    index = {r["w"]: i for i, r in enumerate(chosen)}
    vocab = docs.sparkSession.createDataFrame([(w,) for w in index] or [("",)], "w string")
    rows = sample.select("doc_id", "y", F.explode("words").alias("w")).join(F.broadcast(vocab), "w") \
        .groupBy("doc_id", "y").agg(F.collect_list("w").alias("ws")).select("y", "ws").collect()
    y = np.concatenate([[r["y"] for r in rows], [1, 0]]).astype(float)
    weight = np.ones(len(y))
    weight[-2:] = max(0, pos - y[:-2].sum()), max(0, neg - (1 - y[:-2]).sum())  # rows without any feature
    r = np.repeat(np.arange(len(rows)), [len(x["ws"]) for x in rows])
    c = np.array([index[w] for x in rows for w in x["ws"]], np.int64)
    w, b, gw, gb = np.zeros(len(index)), np.log(rate / (1 - rate)), np.full(len(index), 1e-8), 1e-8
    for _ in range(steps):
        z = b + np.bincount(r, w[c], len(y))
        d = weight * (1 / (1 + np.exp(-z)) - y)
        g, h = np.bincount(c, d[r], len(index)) + 0.002 * w, d.sum()
        gw, gb = gw + g ** 2, gb + h ** 2
        w, b = np.maximum(w - 1.0 * g / np.sqrt(gw), 0), b - 1.0 * h / np.sqrt(gb)
    model.bias = float(b)
    model.weights = {word: float(w[i]) for word, i in index.items()}
    # a word's share of positive rows, shrunk, and more so by every other row
    own = {r["w"]: r["a"] / (3 * r["n"] - 2 * r["a"] + 2) for r in chosen}
    model.alone = {word: p for word, p in own.items() if p >= sure}
    return model


def score(docs: DataFrame, model: Model, threshold: float = 0.7, text: str = "text") -> DataFrame:
    """``docs`` with score (0 to 1) and predicted, from the text alone."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    taken = {"score", "predicted"} & set(names)
    if taken:
        raise ValueError(f"columns already present: {sorted(taken)}")

    def run(batches):
        model = held.value
        restorer = Restorer(model.costs)
        for b in parts(batches):
            value = np.array([model.score(restorer.words(t)) for t in b.column(text).cast(pa.string()).to_pylist()])
            yield pa.record_batch([*b.columns, pa.array(value, pa.float64()), pa.array((value >= threshold).astype(np.int32))],
                                  [*names, "score", "predicted"])

    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return docs.mapInArrow(lean(run), schema)


def toxic_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id_column: str = "doc_id",
                    text: str = "text", **sample) -> DataFrame:
    """doc_id, held_out, score, predicted for every row, learnt from the labelled rows
    whose id's CRC-32 modulo 3 is not 1.

    A null or empty text scores the model's bias. Repeated rows score alike, once each; a
    null id is not held out and teaches nothing. Without rows of both labels every text gets one
    constant score. Other columns are ignored; an empty table gives no rows."""
    model = fit(docs, labels.where(fold(id_column, 3) != 1), id_column=id_column, text=text, **sample)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return score(rows, model, threshold).select(
        "doc_id", F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score", "predicted")
