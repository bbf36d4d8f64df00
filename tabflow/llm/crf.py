"""Language of code-switched text by a linear-chain conditional random field."""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabflow.llm.common import lean, mix, parts, starts_of, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLOTS = 1 << 17
CHAIN = 256
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


@dataclass
class Model:
    """Labels, feature weights (slots x labels), transitions and first-word weights."""

    labels: list[str]
    weights: np.ndarray
    moves: np.ndarray
    first: np.ndarray


def _slot(salt: int, *parts: np.ndarray) -> np.ndarray:
    h = np.full(len(parts[0]), salt, np.uint64)
    for p in parts:
        h = (h ^ p.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (mix(h) & np.uint64(SLOTS - 1)).astype(np.int32)


def features(data: bytes) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
    """Words (runs of letters) of lower-cased UTF-8 bytes: their first bytes, lengths, one
    slot array per word feature (lexicon, prefixes and suffixes of 2 to 4 bytes) and the
    trigram slots of all letter bytes, word edges included, in word order."""
    raw = np.frombuffer(data, np.uint8)
    code = np.zeros(len(raw) + 8, np.uint8)
    code[4:4 + len(raw)] = np.where(_LETTER[raw], raw, 0)
    inside = code > 0
    step = np.diff(inside.astype(np.int8))
    begin, end = np.flatnonzero(step == 1) + 1, np.flatnonzero(step == -1) + 1
    size = end - begin
    at = np.flatnonzero(inside)
    tri = _slot(1, code[at - 1], code[at], code[at + 1])
    word = []
    if len(begin):
        # the word itself: a sum of mixed (byte, place) pairs
        place = np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size)
        spread = mix((place.astype(np.uint64) << np.uint64(8)) | code[at].astype(np.uint64))
        own = np.add.reduceat(spread, np.cumsum(size) - size)
        word.append((mix(own) & np.uint64(SLOTS - 1)).astype(np.int32))
        for n in (2, 3, 4):
            n_ = np.minimum(n, size)
            pre = [np.where(j < n_, code[np.minimum(begin + j, len(code) - 1)], 0) for j in range(n)]
            suf = [np.where(j < n_, code[end - 1 - np.minimum(j, size - 1)], 0) for j in range(n)]
            word += [_slot(10 + n, *pre), _slot(20 + n, *suf)]
    else:
        word = [np.empty(0, np.int32)] * 7
    return begin - 4, size, word, tri


def emissions(weights: np.ndarray, size: np.ndarray, word: list[np.ndarray], tri: np.ndarray) -> np.ndarray:
    """Score of each label for each word: the sum of its features' weights."""
    if not len(size):
        return np.zeros((0, weights.shape[1]), np.float32)
    out = np.add.reduceat(weights[tri], np.cumsum(size) - size, axis=0)
    for slots in word:
        out += weights[slots]
    return out


def forward_backward(score: np.ndarray, chain: np.ndarray, moves: np.ndarray, first: np.ndarray):
    """Marginals of each word's label, and expected transitions, for words in chains.

    ``chain`` numbers the chains of consecutive words. All chains advance together, one
    word a step, longest first, with every step normalised."""
    n, labels = score.shape
    cut = starts_of(chain)
    begin, length = cut[:-1], np.diff(cut)
    order = np.argsort(-length, kind="stable")
    begin, length = begin[order], length[order]
    top = int(length[0]) if len(length) else 0
    live = np.searchsorted(-length, -np.arange(top), side="left")
    e = np.exp(score - score.max(axis=1, keepdims=True)).astype(np.float64)
    m, s = np.exp(moves - moves.max()), np.exp(first - first.max())
    alpha, beta = np.empty((n, labels)), np.ones((n, labels))
    for t in range(top):
        rows = begin[:live[t]] + t
        a = e[rows] * (s if t == 0 else alpha[rows - 1] @ m)
        alpha[rows] = a / a.sum(axis=1, keepdims=True)
    for t in range(top - 2, -1, -1):
        rows = begin[:live[t + 1]] + t
        b = (e[rows + 1] * beta[rows + 1]) @ m.T
        beta[rows] = b / b.sum(axis=1, keepdims=True)
    gamma = alpha * beta
    gamma /= np.maximum(gamma.sum(axis=1, keepdims=True), 1e-300)
    inner = np.flatnonzero(chain[1:] == chain[:-1]) if n else np.empty(0, np.int64)
    return gamma, (alpha, e * beta, m, inner)


def _moves_expected(alpha, right, m, inner) -> np.ndarray:
    pair = alpha[inner][:, :, None] * m[None] * right[inner + 1][:, None, :]
    pair /= pair.sum(axis=(1, 2), keepdims=True)
    return pair.sum(axis=0)


def train(chains: list[tuple[bytes, list[tuple[int, int]]]], labels: list[str], epochs: int = 4, batch: int = 64,
          rate: float = 0.3, decay: float = 1e-4, seed: int = 3) -> Model:
    """Adaptive gradient ascent of the chains' conditional likelihood. A chain is its text
    and its (words, label) stretches in order."""
    model = Model(labels, np.zeros((SLOTS, len(labels)), np.float32), np.zeros((len(labels),) * 2), np.zeros(len(labels)))
    grads = [np.full(a.shape, 1e-6) for a in (model.weights, model.moves, model.first)]
    ready = []
    for text, stretches in chains:
        _, size, word, tri = features(text)
        y = np.concatenate([np.full(n, k) for n, k in stretches])[:len(size)]
        if len(y) == len(size) and len(y):
            ready.append((size, word, tri, y))
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(len(ready)), max(1, len(ready) // batch)):
            if not len(part):
                continue
            group = [ready[i] for i in part]
            size, tri, y = (np.concatenate([g[k] for g in group]) for k in (0, 2, 3))
            word = [np.concatenate(w) for w in zip(*[g[1] for g in group])]
            chain = np.repeat(np.arange(len(group)), [len(g[3]) for g in group])
            gamma, rest = forward_backward(emissions(model.weights, size, word, tri), chain, model.moves, model.first)
            err = -gamma
            err[np.arange(len(y)), y] += 1
            # features of the batch, each slot once
            slots = np.concatenate([tri, *word])
            owner = np.concatenate([np.repeat(np.arange(len(size)), size), *[np.arange(len(size))] * len(word)])
            used, back = np.unique(slots, return_inverse=True)
            g = np.stack([np.bincount(back, err[owner, k], len(used)) for k in range(len(labels))], axis=1)
            g -= decay * model.weights[used]
            grads[0][used] += g ** 2
            model.weights[used] += (rate * g / np.sqrt(grads[0][used])).astype(np.float32)
            seen = np.zeros_like(model.moves)
            inner = rest[3]
            np.add.at(seen, (y[inner], y[inner + 1]), 1)
            g = seen - _moves_expected(*rest) - decay * model.moves
            grads[1] += g ** 2
            model.moves += 0.1 * g / np.sqrt(grads[1])
            heads = np.flatnonzero(np.append(True, chain[1:] != chain[:-1]))
            g = err[heads].sum(axis=0) - decay * model.first
            grads[2] += g ** 2
            model.first += 0.1 * g / np.sqrt(grads[2])
    return model


def fit(docs: DataFrame, per_label: int = 250, stretches: int = 6, stretch: int = 48, switched: float = 0.3,
        id_column: str = "doc_id", text: str = "text", label: str = "lang", seed: int = 7, **how) -> Model | None:
    """A model from a bounded sample: ``per_label`` ids of each label by hash order, from
    each up to ``stretches`` evenly spaced runs of ``stretch`` words. Words take their document's
    label; a share of the chains joins runs of two labels, so transitions between
    languages are learnt too. None without labelled text."""
    rows = docs.where(F.col(label).isNotNull() & F.col(id_column).isNotNull() & F.col(text).isNotNull())
    ids = rows.select(F.col(id_column).cast("long").alias("doc_id"), F.col(label).cast("string").alias("y")) \
        .groupBy("doc_id").agg(F.min("y").alias("y"))
    order = Window.partitionBy("y").orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id")
    ids = written(ids.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= per_label).select("doc_id", "y"), "sample")
    names = sorted(r["y"] for r in ids.select("y").distinct().collect())
    if not names:
        return None
    texts = rows.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def cut(batches):
        for b in batches:
            doc, y, part, runs, words_ = [], [], [], [], []
            for d, k, t in zip(*[b.column(c).to_pylist() for c in ("doc_id", "y", "text")]):
                data = t.lower().encode()
                begin, size, _, _ = features(data)
                n = max(1, min(stretches, len(begin) // stretch))
                for i in range(n):
                    a = i * len(begin) // n
                    z = min(len(begin), a + stretch)
                    if a < z:
                        for col, v in zip((doc, y, part, runs, words_), (d, k, i, data[begin[a]:begin[z - 1] + size[z - 1]], z - a)):
                            col.append(v)
            yield pa.record_batch([pa.array(doc, pa.int64()), pa.array(y, pa.string()), pa.array(part, pa.int32()),
                                   pa.array(runs, pa.binary()), pa.array(words_, pa.int32())], ["doc_id", "y", "part", "run", "n"])

    sample = texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text")) \
        .mapInArrow(lean(cut), "doc_id long, y string, part int, run binary, n int")
    runs = sorted((r["doc_id"], r["part"], bytes(r["run"]), r["n"], names.index(r["y"])) for r in sample.collect())
    rng = np.random.default_rng(seed)
    chains = []
    for _, _, run, n, k in runs:
        other = runs[int(rng.integers(len(runs)))]
        if rng.random() < switched and other[4] != k:
            chains.append((run + b" " + other[2], [(n, k), (other[3], other[4])]))
        else:
            chains.append((run, [(n, k)]))
    return train(chains, names, **how)


def label_words(model: Model, data: bytes, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text of each word, label marginals) for texts joined in ``data`` at byte ``limits``.
    A chain is one text, cut every CHAIN words."""
    begin, size, word, tri = features(data)
    score = emissions(model.weights, size, word, tri)
    owner = np.searchsorted(limits, begin, side="right") - 1
    place = np.arange(len(begin)) - np.searchsorted(owner, owner)
    chain = owner.astype(np.int64) * (1 << 32) + place // CHAIN
    return owner, forward_backward(score, chain, model.moves, model.first)[0]


def languages(docs: DataFrame, learn: DataFrame, id_column: str = "doc_id", text: str = "text", group: int = 256,
              **how) -> DataFrame:
    """doc_id, lang_pred and score for every row of ``docs``, learnt from ``learn``: the label
    with the largest mean marginal over all words of the whole text.

    A text that is null or has no letter is ``und`` with score 0, and so is every text
    where nothing could be learnt. Repeated rows are labelled alike, once each. Other columns
    are ignored; an empty table gives no rows."""
    model = fit(learn, id_column=id_column, text=text, **how)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def label(batches):
        model = held.value
        for part in parts(batches, group):
            if part.num_rows:
                low = pc.utf8_lower(pc.fill_null(part.column("text"), "")).to_pylist()
                raw = [t.encode() for t in low]
                limits = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])])
                best, value = ["und"] * len(raw), np.zeros(len(raw))
                if model is not None:
                    owner, gamma = label_words(model, b"\n".join(raw), limits)
                    total = np.stack([np.bincount(owner, gamma[:, k], len(raw)) for k in range(gamma.shape[1])], axis=1)
                    words = np.bincount(owner, minlength=len(raw))
                    for i, t in enumerate(low):
                        if words[i] and any(c.isalpha() for c in t):
                            k = int(total[i].argmax())
                            best[i], value[i] = model.labels[k], min(1.0, total[i, k] / words[i])
                yield pa.record_batch([part.column("doc_id"), pa.array(best), pa.array(value)], ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(lean(label), "doc_id long, lang_pred string, score double")
