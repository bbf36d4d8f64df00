"""Vector operators and the pipeline against plain Python versions."""

import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from tabflow.llm import embeddup, mixing, vptree
from tabflow.llm.queries import QUERIES, SQL

VECTORS = "vec_id long, embedding array<float>, label int, rid long, score double, v string"


def table_of(spark, data):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], k, 7, 0.5, "v")
                                  for i, v, k in data], VECTORS)


def awkward(n=300, dim=12, seed=3):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dim)).astype(np.float32)
    data = [(i, base[i], i % 3) for i in range(n)]
    data += [(1000 + i, base[5] + 0.001 * rng.normal(size=dim).astype(np.float32), 2) for i in range(40)]
    data += [(2000 + i, base[7], 1) for i in range(30)] + [(7, base[7], 1), (7, base[7], 1)]
    data += [(3000, None, 1), (3001, [], 1), (3020, [0.0] * dim, 1), (3040, [1.0] + [None] * (dim - 1), 1), (3060, [float("nan")] * dim, 1),
             (3080, [float("inf")] + [1.0] * (dim - 1), 1), (3100, base[9], None), (3120, [1.0, 2.0], 1), (3140, [2.0, 4.0], 1), (None, base[7], 1)]
    return data


def good(v):
    return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)


def dot(a, b):
    s = 0.0
    for x, y in zip(a, b):
        s += float(x) * float(y)
    return s


def test_exact_search_against_brute_force(spark):
    data = awkward()
    use = [(i, v) for i, v, _ in data if i is not None and good(v)]
    got = defaultdict(list)
    for r in vptree.nearest(table_of(spark, data), every=20, k=20, shard_rows=64, leaf=8).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    want = {}
    for q, x in use:
        if q % 20 == 0:
            best = sorted(((-dot(x, v), i) for i, v in use if i != q and len(v) == len(x)))[:20]
            if best:
                want[q] = [(n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert {q: sorted(v) for q, v in got.items()} == want
    assert vptree.nearest(table_of(spark, [])).count() == 0


def brute(use, every, k):
    return {q: [(n + 1, i, -s) for n, (s, i) in enumerate(sorted((-dot(x, v), i) for i, v in use if i != q and len(v) == len(x))[:k])]
            for q, x in use if q % every == 0}


def found(df):
    got = defaultdict(list)
    for r in df.collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    return {q: sorted(v) for q, v in got.items()}


def test_ties_of_many_distinct_vectors_go_to_the_smaller_ids(spark):
    rng = np.random.default_rng(2)
    use = [(i, v) for i, v in zip(rng.permutation(500).tolist(), rng.integers(0, 2, (500, 24)) * (rng.random((500, 24)) < 0.2) * 1.0) if v.any()]
    got = found(vptree.nearest(table_of(spark, [(i, v, 1) for i, v in use]), every=20, k=20, shard_rows=256, leaf=8))
    assert got == brute(use, 20, 20)


def test_one_large_vector_blurs_no_other(spark):
    rng = np.random.default_rng(7)
    use = [(i, v) for i, v in enumerate(rng.normal(size=(300, 6)).astype(np.float32))] + [(301, np.float32([1e8] + [0] * 5))]
    got = found(vptree.nearest(table_of(spark, [(i, v, 1) for i, v in use]), every=20, k=20, shard_rows=1000, leaf=8))
    assert got == brute(use, 20, 20)


def test_relaxed_pruning_keeps_recall():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 8))
    tree = vptree.VantageTree(x, leaf=32)
    q = rng.normal(size=(50, 8))
    far = np.linalg.norm(q[:, None] - x[None], axis=2)
    exact = [set(r) for r in tree.search(q, 10, 1.0)[0]]
    assert exact == [set(r) for r in np.argsort(far, axis=1)[:, :10]]
    near = [set(r) for r in tree.search(q, 10, 0.8)[0]]
    assert np.mean([len(a & b) for a, b in zip(exact, near)]) >= 9


@pytest.mark.parametrize("block", [1024, 8])
def test_embedding_links_against_brute_force(spark, block):
    data = awkward()
    ok = [i is not None and k is not None and bool(good(v)) for i, v, k in data]
    links, root = [0] * len(data), list(range(len(data)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(data)):
        for b in range(a):
            if ok[a] and ok[b] and data[a][2] == data[b][2] and len(data[a][1]) == len(data[b][1]):
                x, y = data[a][1], data[b][1]
                if dot(x, y) / (dot(x, x) ** 0.5 * dot(y, y) ** 0.5) >= 0.98:
                    links[a] += 1
                    links[b] += 1
                    root[find(a)] = find(b)
    least = {}
    for i in range(len(data)):
        if ok[i]:
            least[find(i)] = min(least.get(find(i), 1 << 60), data[i][0])
    want = sorted((str(i), links[n], str(least[find(n)] if ok[n] else i)) for n, (i, _, _) in enumerate(data))
    got = embeddup.near_duplicates(table_of(spark, data), block=block).collect()
    assert sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"])) for r in got) == want
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)
    assert embeddup.near_duplicates(table_of(spark, [])).count() == 0


def test_rows_that_repeat_an_id_stay_vectors_of_their_own(spark):
    data = [(1, [1.0, 0.0], 7), (1, [0.0, 1.0], 7), (2, [1.0, 0.001], 7), (3, [0.0, 1.0], 8), (4, [0.5, 0.5], 7),
            (9, [0.0, 2.0], 7), (8, [0.0, 1.0], 7)]
    got = sorted(tuple(r) for r in embeddup.near_duplicates(table_of(spark, data)).collect())
    assert got == [(1, 1, 1, True), (1, 2, 1, True), (2, 1, 1, False), (3, 0, 3, True), (4, 0, 4, True), (8, 2, 1, False), (9, 2, 1, False)]


def test_queries_are_registered_once_each():
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES) == list(range(1, 14))
    assert set(SQL) <= set(QUERIES)


# --- the pipeline, stage by stage, on a small corpus ------------------------------

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, _d0 int, copies string"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = np.random.default_rng(6)
    vocab = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(400)]
    texts = [" ".join(rng.choice(vocab, 60)) for _ in range(150)]
    passage = " ".join(rng.choice(vocab, 55))
    for i in range(0, 150, 5):
        texts[i] += " verminous"
    texts[11] = texts[12].replace(" ", "  ", 3)
    texts[21] = texts[22] + " extra"
    texts[31] += "\n" + passage
    texts[33] = passage + "\n " + texts[33]
    data = [(i, t, "en", None if i % 10 == 3 else f"s{i % 2}", len(t), "x", 1, "y") for i, t in enumerate(texts)]
    data += [(200, None, None, "s0", 0, "x", 1, "y"), (201, "", "en", "s1", 0, "x", 1, "y"), (None, texts[41], "en", "s1", 9, "x", 1, "y"),
             (34, texts[34], "en", "s0", len(texts[34]), "x", 1, "y")]
    folder = tmp_path_factory.mktemp("sf")
    spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(150)], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(data, DOCS).write.parquet(f"{folder}/documents.parquet")
    return str(folder), data, passage


def test_every_stage_on_its_predecessors_rows(spark, corpus):
    folder, data, passage = corpus
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["toxicity", "near_duplicates", "repeated_passages", "mixing", "packing"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns

    docs = spark.createDataFrame(stage["toxicity"](spark, docs, folder).collect(), docs.schema)
    left = {r["doc_id"] for r in docs.collect()}
    assert docs.columns == columns
    assert left == {d[0] for d in data if d[0] is None or d[0] >= 150 or d[0] % 5}

    docs = spark.createDataFrame(stage["near_duplicates"](spark, docs, folder).collect(), docs.schema)
    kept = sorted(str(r["doc_id"]) for r in docs.collect())
    assert docs.columns == columns and kept == sorted({str(i) for i in left} - {"12", "22"})

    done = {r["doc_id"]: r for r in stage["repeated_passages"](spark, docs, folder).collect()}
    before = {r["doc_id"]: r for r in docs.collect()}
    assert passage in done[31]["text"] and passage not in done[33]["text"]
    assert done[33]["n_chars"] == len(done[33]["text"]) and done[200]["text"] is None
    assert all(done[i] == before[i] for i in done if i != 33)
    docs = spark.createDataFrame(list(done.values()), docs.schema)

    mixed = stage["mixing"](spark, docs, folder)
    assert mixed.columns == columns
    rows = mixed.collect()
    own, taken = defaultdict(int), defaultdict(int)
    count = lambda t: len((t or "").split())
    for r in docs.collect():
        own[r["source"]] += count(r["text"])
    for r in rows:
        taken[r["source"]] += count(r["text"])
    names = sorted(own, key=lambda s: (s is None, s or ""))
    goal = mixing.targets([own[s] for s in names], [(3, 1, 2)[i % 3] for i in range(len(names))], 1.5 * sum(own.values()))
    for s, g in zip(names, goal):
        assert abs(taken[s] - g) <= 130
    docs = spark.createDataFrame(rows, docs.schema)

    packed = stage["packing"](spark, docs, folder).collect()
    whole = defaultdict(int)
    for r in packed:
        whole[r["doc_id"]] += r["length"]
    assert set(whole) == {r["doc_id"] for r in rows}
    assert sum(1 for r in packed if r["piece"] == 0) == len(rows)
    assert zlib.crc32(b"\0\0\0\0") in {r["ids_crc32"] for r in packed} or None not in {r["text"] for r in rows}


def test_stages_accept_an_empty_table(spark, corpus):
    folder, _, _ = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        assert out.count() == 0, name


def test_run_returns_pieces(spark, corpus):
    folder, _, _ = corpus
    assert corpus_pipeline.run(spark, folder).count() > 100
