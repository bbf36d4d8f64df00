"""Corpus operators on text against plain Python versions, on small awkward tables."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabflow.llm import chat, crf, jaccard, mixing, packing, sharding, substring, toxicity
from tabflow.llm.queries import vocabulary

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, h long, tk string, size string, n_words int, score string"
BASE = " ".join(f"w{i}" for i in range(120))
ROWS = [
    (5, BASE), (7, BASE), (7, BASE), (9, BASE.replace("w60 ", "zz ")), (12, "x " * 40 + BASE + " tail"),
    (3, "Alpha beta gamma"), (4, "alpha  BETA\tgamma"), (20, None), (21, ""), (22, " \n\t "), (None, BASE), (None, None),
    (30, "é " + " ".join(f"v{i}" for i in range(20)) + " end"), (31, "ü " + " ".join(f"v{i}" for i in range(20)) + " fin"),
    (40, "a " * 30), (41, "a " * 25), (50, "long " + " ".join(f"u{i % 977}" for i in range(30000))),
    (51, "long\u00a0" + " ".join(f"u{i % 977}" for i in range(29990))), (60, "one two"), (61, "ONE two"),
]


def rows(pairs):
    return [(d, t, "en", None if i % 5 == 0 else f"s{i % 3}", len(t or ""), 1, "t", "big", 2, "s") for i, (d, t) in enumerate(pairs)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(ROWS), DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def lower(t):
    return t.translate({c: c + 32 for c in range(65, 91)})


def test_sharding_is_stable_gapless_and_grows_into_the_new_shard(spark, docs, empty):
    got = sharding.shard_documents(docs, 5).collect()
    assert len(got) == len(ROWS)
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 5) and 0 <= r["shard"] < 5
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    want = sorted((d if d is not None else -1, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in ROWS)
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["size"], r["text_crc32"]) for r in got) == want
    assert sharding.shard_documents(empty, 5).count() == 0
    again = sharding.shard_documents(docs.repartition(3, "text"), 5).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_jump_hash_follows_the_published_loop():
    def one(key, n):
        b, j = -1, 0
        while j < n:
            b = j
            key = (key * 2862933555777941757 + 1) % (1 << 64)
            j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
        return b

    keys = np.random.default_rng(1).integers(0, 1 << 63, 500).astype(np.uint64)
    for n in (1, 2, 24, 25, 1000):
        assert sharding.jump(keys, n).tolist() == [one(int(k), n) for k in keys]


def test_substring_dedup_against_brute_force(spark, docs, empty):
    k = 13
    first = {}
    for d, t in ROWS:
        w = WORD.findall(t or "")
        for i in range(len(w) - k + 1):
            g = tuple(w[i:i + k])
            if d is not None:
                first[g] = min(first.get(g, d), d)
    want = []
    for d, t in ROWS:
        w = WORD.findall(t or "")
        gone = set()
        for i in range(len(w) - k + 1):
            if d is not None and first[tuple(w[i:i + k])] < d:
                gone.update(range(i, i + k))
        want.append((str(d), len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    done = substring.strip_repeats(docs, k, carry=("source", "h"))
    got = [(str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept"]) for r in done.collect()]
    assert sorted(got) == sorted(want)
    assert done.columns == ["doc_id", "n_words", "n_removed", "kept", "source", "h"]
    assert substring.strip_repeats(empty, k).count() == 0


def test_substring_groups_stay_small_when_one_passage_or_phrase_is_everywhere(spark, monkeypatch):
    passage, phrase = " ".join(f"p{i}" for i in range(20)), " ".join(f"q{i}" for i in range(6))
    pairs = [(d, " ".join([f"a{d}_{i}" for i in range(8)] + [passage] + [f"b{d}_{i}" for i in range(8)]
                          + [phrase] + [f"c{d // 2}_{i}" for i in range(8)])) for d in range(700)]
    sizes, real = [], substring.by_key

    def by_key(df, keys, *rest):
        sizes.append(df.groupBy(*keys).count().agg(F.max("count")).first()[0])
        return real(df, keys, *rest)

    monkeypatch.setattr(substring, "by_key", by_key)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"])
           for r in substring.strip_repeats(spark.createDataFrame(rows(pairs), DOCS), 13).collect()}
    assert max(sizes) <= substring.SHARD_SEGMENTS
    for d, t in pairs:
        w = t.split()
        # the passage goes from all but the first; the phrase and what follows from the second of two
        left = w[:8] + w[28:36] + ([] if d % 2 else w[36:])
        assert got[d] == ((50, 0, t) if not d else (50, 50 - len(left), " ".join(left))), d


def test_cuts_of_a_repeated_row_merge_before_the_shuffle(spark):
    places = spark.range(100_000).select(F.lit(1).alias("doc_id"), F.lit(2).alias("tk"), F.encode((F.col("id") % 3).cast("string"), "utf-8").alias("cut"))
    cuts = substring._cuts(places)
    assert [sorted(map(bytes, r["cuts"])) for r in cuts.collect()] == [[b"0", b"1", b"2"]]
    plan = cuts._jdf.queryExecution().toString()
    assert "collect_list" not in plan and "partial_collect_set" in plan


def test_locate_reports_only_equal_words():
    a = b" ".join(b"w%d" % i for i in range(16))
    seg, at, owner = substring.locate([a, a.replace(b"w15", b"w16"), b"q " + a], np.array([4, 2, 9]), np.array([4, 2, 9]), 13)
    found = sorted(zip(seg.tolist(), at.tolist(), owner.tolist()))
    assert (1, 0, 2) in found and (0, 0, 2) in found and (2, 1, 2) in found and (0, 3, 4) in found and (2, 4, 4) in found
    assert (2, 0, 9) not in found


def groups(pairs, k, num, den):
    sets = []
    for _, t in pairs:
        w = WORD.findall(lower(t or ""))
        n = min(k, len(w))
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set())
    root = list(range(len(pairs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(pairs)):
        for j in range(i):
            if sets[i] and sets[j] and pairs[i][0] is not None and pairs[j][0] is not None:
                same = len(sets[i] & sets[j])
                if den * same >= num * (len(sets[i]) + len(sets[j]) - same):
                    root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(pairs):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted((str(d), len(s), str(None if d is None else least[find(i)])) for i, ((d, _), s) in enumerate(zip(pairs, sets)))


@pytest.mark.parametrize("k,num", [(4, 85), (5, 80)])
def test_jaccard_against_brute_force(spark, docs, k, num):
    got = jaccard.near_duplicates(docs, k, num, 100).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == groups(ROWS, k, num, 100)


def test_jaccard_on_chains_of_near_copies(spark, empty):
    rng = np.random.default_rng(4)
    pairs, text = [], [f"c{i}" for i in range(90)]
    for d in range(60):
        text = list(text)
        text[int(rng.integers(90))] = f"n{d}"
        pairs.append((100 - d, " ".join(text) + (" all rights reserved by nobody at all in this place" if d % 2 else "")))
    got = jaccard.near_duplicates(spark.createDataFrame(rows(pairs), DOCS), 4, 85, 100).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == groups(pairs, 4, 85, 100)
    assert jaccard.near_duplicates(empty).count() == 0


def variants(seed, count, changed):
    """Texts of one base with ``changed`` words replaced at random: alike, but few of them linked."""
    rng = np.random.default_rng(seed)
    out = []
    for d in range(count):
        text = [f"b{i}" for i in range(120 + 40 * (d % 4 == 0))]
        for at in rng.choice(120, changed + d % 3, replace=False):
            text[at] = f"n{rng.integers(12)}"
        out.append((count - d, " ".join(text)))
    return out


def test_jaccard_rows_of_a_crowded_column_grow_with_its_entries():
    import pyarrow as pa

    def made(m):
        size = np.sort(100 + np.arange(m) % 10)
        column = {"h": np.zeros(m, np.int64), "rid": np.arange(m), "n": size, "comp": np.arange(m)}
        entries = pa.table(column | {f"k{j}": np.zeros(m, np.int32) for j in range(jaccard.SKETCHES)})
        return sum(b.num_rows for b in jaccard._product([entries], 80, 100))

    assert made(2000) <= 2 * 2000 and made(4000) <= 2 * 4000
    assert made(20) == 190


#: Hardly any two nodes agree in such a sketch: their links come from columns.
WIDE = {"SKETCHES": 1, "SKETCH_SIZE": 40, "_SEEDS": jaccard.mix(np.arange(1, 41, dtype=np.uint64))}


@pytest.mark.parametrize("limits", [{}, {"COLUMN_PAIRS": 3, "BLOCK": 16, "BLOCK_ELEMENTS": 900}, {"COLUMN_PAIRS": 3, **WIDE}])
def test_jaccard_on_a_group_of_texts_not_quite_alike(spark, monkeypatch, limits):
    pairs = variants(8, 150, 4) + [(1000 + d, t) for d, t in variants(9, 20, 2)]
    for name, value in limits.items():
        monkeypatch.setattr(jaccard, name, value)
    docs = spark.createDataFrame(rows(pairs), DOCS)
    got = jaccard.near_duplicates(docs, 5, 80, 100, frequent=0).collect()
    want = groups(pairs, 5, 80, 100)
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == want
    assert 20 < len({c for _, _, c in want}) < len(pairs)


def test_jaccard_leaves_no_shuffle_files_and_one_result_behind(spark, docs):
    import os
    import time
    from urllib.parse import urlparse

    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    local = [d.toString() for d in manager.localDirs()]
    shuffles = lambda: {f for top in local for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_")}
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    folder = os.path.join(urlparse(spark.sparkContext.getCheckpointDir()).path, "tabflow")
    tables = lambda: set(os.listdir(folder)) if os.path.isdir(folder) else set()
    before, held, setting = tables(), shuffles(), spark.conf.get(key, None)
    got = jaccard.near_duplicates(docs, 4, 85, 100)
    assert {t.rsplit("-", 1)[0] for t in tables() - before} <= {"links", "components"}
    until = time.time() + 20  # files go a little after their query
    while shuffles() - held and time.time() < until:
        time.sleep(0.2)
    assert not shuffles() - held
    assert spark.conf.get(key, None) == setting
    assert got.count() == got.count() == len(ROWS)


def test_jaccard_blocks_hold_each_pair_that_is_not_compared_yet(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    # sketch: its nodes, the typical one first, by component
    groups_of = {1: {1: 1, 2: 2}, 2: {10: 10, 11: 10, 12: 12}, 3: {20: 20, 21: 21, 22: 22}, 4: {30: 30, 31: 31, 32: 31},
                 5: {100 + i: 100 if i % 3 == 0 else 101 if i % 3 == 1 else 100 + i for i in range(40)}}
    nodes = [(0, s, len(of), r, 9) for s, of in groups_of.items() for r in of]
    member = spark.createDataFrame(nodes, "tab int, sketch int, m long, rid long, n long")
    center = spark.createDataFrame([(0, s, (min(of), 9)) for s, of in groups_of.items()], "tab int, sketch int, c struct<rid: long, n: long>")
    label = spark.createDataFrame([(r, c) for of in groups_of.values() for r, c in of.items()], "rid long, component long")
    blocks = defaultdict(list)
    for r in jaccard._group_blocks(member, center, label).collect():
        assert r["rid"] in groups_of[r["sketch"]] and r["comp"] == groups_of[r["sketch"]][r["rid"]]
        blocks[r["sketch"], r["lo"], r["hi"]].append((r["rid"], r["side"]))
    met = defaultdict(set)
    for (s, _, _), found in blocks.items():
        assert len({r for r, _ in found}) == len(found)
        met[s] |= {(min(x, y), max(x, y)) for x, a in found if a != 1 for y, b in found if b != 0 and x != y}
    # two nodes, or others of one component, need no comparison; three need one of two rows
    assert set(met) == {2, 3, 5}
    assert met[2] == {(11, 12)} and sorted(blocks[3, 0, 0]) == [(21, 2), (22, 2)]
    for s in (2, 3, 5):
        of = groups_of[s]
        assert met[s] >= {(x, y) for x in of for y in of if min(of) < x < y and of[x] != of[y]}


def test_packing_keeps_ids_and_fills_sequences(spark, docs, empty):
    from tokenizers import Tokenizer

    pairs = ROWS + [(70, "Straße l’été 12 don't 'S <|endoftext|> … ŞİΣ ﬁ"), (71, "naïve\u0301 x")]
    t = Tokenizer.from_file(vocabulary())
    assert packing.WordTokenizer(vocabulary(), control_as_text=True).batch(["a <|endoftext|>"]) != packing.WordTokenizer(vocabulary()).batch(["a <|endoftext|>"])
    want = []
    for d, text in pairs:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        want += [(str(d), i // 512, i, len(p), zlib.crc32(np.array(p, "<u4").tobytes()))
                 for i in range(0, len(ids), 512) for p in [ids[i:i + 512]]]
    got = packing.pack(spark.createDataFrame(rows(pairs), DOCS), vocabulary(), capacity=512, max_docs=3, max_attention=300.0 ** 2 + 512 ** 2).collect()
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(want)
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        b.sort()
        assert [o for o, _ in b] == [sum(n for _, n in b[:i]) for i in range(len(b))]
        assert sum(n for _, n in b) <= 512 and len(b) <= 3
    assert packing.pack(empty, vocabulary()).count() == 0


def test_word_tokenizer_sends_cut_words_to_the_model_alone(monkeypatch):
    """Words of Latin-1 texts need neither the normalizer nor the split of the whole tokenizer."""
    rng = np.random.default_rng(9)
    signs = list("  ab'st'reveml'd012,.\n\té\"'ÿ×÷ßÉA<|")
    made = ["".join(rng.choice(signs, n)) for n in rng.integers(0, 60, 3000)]
    made = [t for t in made if packing._SAFE.fullmatch(t) and "<|" not in t]
    t = packing.WordTokenizer(vocabulary())
    want = [t.whole(x) for x in made]
    monkeypatch.setattr(t, "whole", lambda text: pytest.fail("a whole text"))
    assert t.words.normalizer is None and len(made) > 500
    assert t.batch(made) == want and t.batch(made) == want


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_holds_every_constraint(rule):
    rng = np.random.default_rng(2)
    counts = {int(n): int(c) for n, c in zip(rng.permutation(100)[:60] + 1, rng.integers(1, 50, 60))}
    bins = defaultdict(list)
    for length, a, b, first, offset in packing.best_fit(counts, 100, 4, 10500.0, rule=rule):
        for i in range(b - a):
            bins[first + i].append((offset, length))
    total = defaultdict(int)
    for b in bins.values():
        b.sort()
        assert [o for o, _ in b] == [sum(n for _, n in b[:i]) for i in range(len(b))]
        assert sum(n for _, n in b) <= 100 and len(b) <= 4
        assert sum(n * n for _, n in b) <= 10500
        for _, n in b:
            total[n] += 1
    assert dict(total) == counts


def test_mixing_targets_and_repeats(spark, docs, empty):
    got = mixing.mix_sources(docs, keep_source=True).collect()
    assert len(got) == len(ROWS)
    assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in got)
    assert sorted(r["size"] for r in got) == sorted(len(WORD.findall(t or "")) for _, t in ROWS)
    by = defaultdict(list)
    for r in got:
        by[r["source"]].append(r)
    for own in by.values():
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= max(r["size"] for r in own)
    assert sorted(map(str, mixing.mix_sources(docs.repartition(5), keep_source=True).collect())) == sorted(map(str, got))
    assert mixing.mix_sources(empty).count() == 0


def test_targets_stop_at_the_limit_and_share_the_rest():
    out = mixing.targets([100, 10, 1000], [3, 1, 2], 1.5 * 1110, 2.0)
    assert out[0] == 200 and out[1] == 20 and out[2] == pytest.approx(1445)
    assert mixing.targets([], [], 0) == [] and mixing.targets([0, 0], [3, 1], 0) == [0, 0]


def test_flow_is_cheapest_for_overlapping_sources():
    # a shared pattern serves both quotas before anything is repeated
    used = mixing.route([((0,), 10), ((1,), 10), ((0, 1), 20)], [30, 10], 2)
    assert sum(sum(u) for u in used) == 40 and all(u[1] == 0 for u in used)
    used = mixing.route([((0,), 10), ((1,), 10)], [15, 5], 2)
    assert used == [[10, 5], [5, 0]]


def test_mixing_with_overlapping_membership(spark):
    data = [(i, "w " * 10, ["a", "b"] if i % 2 else ["a"] if i % 4 else None) for i in range(40)]
    got = mixing.mix_sources(spark.createDataFrame(data, "doc_id long, text string, source array<string>")).collect()
    assert len(got) == 40 and sum(r["taken"] for r in got) == pytest.approx(600, abs=20)


def test_chat_round_trip_and_spans(spark):
    hard = ["</s>[INST] ok [/INST]", "<\\/s> <\\\\/s> <|im_end|>", "[/INST][INST\\]", "<|im_sep|>\n<|image|>", "", None, "é😀</s>"]
    turns = [(c, i, r, t) for c in (1, 2) for i, (r, t) in enumerate(zip(["user", "assistant", None, "<|im_end|>", "assistant", "user", "assistant"], hard))]
    turns += [(3, 0, "user", "a"), (3, 0, "user", "a"), (3, None, "assistant", "b"), (None, 1, "user", "n")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("parts", chat.text_part(F.col("text")))
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_chats(df)).collect()}
    assert set(got) == {1, 2, 3, None}
    for c in (1, 2):
        r = got[c]
        assert r["contents"] == [t or "" for t in hard]
        assert r["roles"] == ["user", "assistant", "", "<|im_end|>", "assistant", "user", "assistant"]
        assert r["masked"] == [hard[1], hard[4] or "", hard[6]]
        assert r["formatted"].count(chat.END) == 7 and "</s>" not in r["formatted"] and "[/INST]" not in r["formatted"]
        for span, content in zip(r["spans"], hard):
            if span["loss_start"] is not None:
                cut = r["formatted"][span["loss_start"]:span["loss_end"]]
                assert re.sub(r"(?<=[<\[])\\(?=\\*(/s>|\|im_end))", "", cut) == content
    assert got[3]["contents"] == ["b", "a", "a"] and got[3]["n_turns"] == 3
    assert chat.format_chats(df.limit(0)).count() == 0


def test_chat_parts_become_ordered_placeholders(spark):
    part = "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
    data = [(1, 0, "user", [("text", "see <|image|>", None, None, None, None, None), ("image", None, "a.png", 28, 15, None, None),
                            None, ("audio", None, "b.wav", None, None, 2.0, None), ("document", None, "c.pdf", None, None, None, 3),
                            ("video", None, "d", None, None, None, None)]), (1, 1, "assistant", None)]
    r = chat.format_chats(spark.createDataFrame(data, f"conv_id long, turn long, role string, parts {part}")).first()
    assert r["formatted"] == ("<|im_start|>user<|im_sep|>see <\\|image|><|image|><|audio|><|document|><|attachment|><|im_end|>"
                              "<|im_start|>assistant<|im_sep|><|im_end|>")
    assert [(a["type"], a["ref"], a["tokens"]) for a in r["attachments"]] == [
        ("image", "a.png", 4), ("audio", "b.wav", 50), ("document", "c.pdf", 1536), ("video", "d", 1)]
    for a in r["attachments"]:
        assert r["formatted"][a["position"]:].startswith(chat.PLACEHOLDERS.get(a["type"], chat.OTHER))
    assert r["attachment_tokens"] == 4 + 50 + 1536 + 1


def test_decoder_restores_disguised_words():
    words = "the idiot stupid loser moron said worthless things about a stupid clown and the idiot went home book".split()
    raw = np.frombuffer(("\n\n" + " ".join(words * 50) + "\n\n").encode("latin-1"), np.uint8)
    c = toxicity._TABLE[raw]
    counts = np.bincount((c[:-2] * toxicity.SIZE + c[1:-1]) * toxicity.SIZE + c[2:], minlength=toxicity.SIZE ** 3)
    r = toxicity.Restorer(toxicity.char_costs(counts))
    for text, word in (("1d10t", "idiot"), ("$tup1d!", "stupid"), ("l0s3r,", "loser"), ("stuuuuupid", "stupid"),
                       ("i d i o t", "idiot"), ("m-o-r-o-n", "moron"), ("st*pid", "stupid"), ("w.o.r.t.h.l.e.s.s", "worthless")):
        assert word in r.words(f"you are {text} really"), text
    assert {"book", "the"} <= r.words("the book") and r.words(None) == set() and r.words("") == set()
    assert r.words("antre$$$ ok") >= {"antre", "ok"}
    assert len(r.words("q7" * 20000)) >= 1


def test_decoder_restores_sign_runs_masks_outer_signs_and_spaced_signs():
    words = "the idiot stupid loser asshole bitch shit fuck cunt said worthless things about a stupid clown and the idiot went home book".split()
    raw = np.frombuffer(("\n\n" + " ".join(words * 50) + "\n\n").encode("latin-1"), np.uint8)
    c = toxicity._TABLE[raw]
    counts = np.bincount((c[:-2] * toxicity.SIZE + c[1:-1]) * toxicity.SIZE + c[2:], minlength=toxicity.SIZE ** 3)
    r = toxicity.Restorer(toxicity.char_costs(counts))
    for text, word in (("id111ot", "idiot"), ("sh!!!t", "shit"), ("b***h", "bitch"), ("f**k", "fuck"), ("f*ck", "fuck"),
                       ("!diot", "idiot"), ("(unt", "cunt"), ("shi*", "shit"), ("*sshole", "asshole"),
                       ("\"*sshole\",", "asshole"), ("stup!d!!!", "stupid"), ("i d ! o t", "idiot"), ("$ h i t", "shit"),
                       ("s h * t", "shit"), ("f.u.c.k", "fuck"), ("i*d*i*o*t", "idiot"), ("жжж1d10t", "idiot")):
        got = r.words(f"you are {text} really")
        assert word in got or any(word in g for g in got if "ж" in text), (text, got)
    assert any(w.startswith("s") and len(w) == 4 for w in r.words("s***"))
    for text in ("_" * 400 + "a b", "a" + "*" * 5000 + "b", "* " * 400 + "ab", "a" + "_*" * 400 + "!?"):
        assert r.words(text) is not None


def test_masked_rests_and_seen_tokens_are_worked_out_once(monkeypatch):
    words = "the idiot stupid loser said worthless things about a stupid clown and went home with a book".split()
    raw = np.frombuffer(("\n\n" + " ".join(words * 50) + "\n\n").encode("latin-1"), np.uint8)
    c = toxicity._TABLE[raw]
    counts = np.bincount((c[:-2] * toxicity.SIZE + c[1:-1]) * toxicity.SIZE + c[2:], minlength=toxicity.SIZE ** 3)
    costs = toxicity.char_costs(counts)
    texts = ["clown*** the", "crown*** the", "the frown***", "stu*id id1ot", "4_ ___ l0*er", "x" * 70 + "*", "the loooser"]
    alone = [toxicity.Restorer(costs).words(t) for t in texts]
    calls = []
    real = toxicity.unmask
    monkeypatch.setattr(toxicity, "unmask", lambda *a: calls.append(a) or real(*a))
    r = toxicity.Restorer(costs)
    assert [r.words(t) for t in texts[:3]] == alone[:3]
    assert len(calls) == 1  # one rest after the letters wn
    assert [r.words(t) for t in texts] == alone and [r.words(t) for t in texts] == alone
    assert "stupid" in alone[3] and "the" in alone[0] and alone[4] and max(map(len, r.seen)) <= toxicity.LONGEST_KEPT
    many = " ".join(f"q{i}" for i in range(300))
    monkeypatch.setattr(toxicity, "SEEN_TOKENS", 100)
    assert r.words(many) == toxicity.Restorer(costs).words(many) and len(r.seen) <= 100


def test_toxicity_learns_and_handles_odd_rows(spark, empty):
    rng = np.random.default_rng(8)
    vocab = [f"{a}{b}" for a in "bcdfg" for b in ("ar", "el", "on", "un")]
    vocab = ["w" + v.replace("1", "") for v in vocab]
    data, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        w = list(rng.choice(vocab, 30))
        if bad:
            w[3] = ["scumbag", "scumb4g", "dumbass", "$cumbag"][i // 4 % 4] if i > 100 else ["scumbag", "dumbass"][i // 4 % 2]
        data.append((i, " ".join(w)))
        labels.append((i, int(bad), i % 7))
    data += [(1000, None), (1001, ""), (None, "scumbag"), (1002, "x " * 50000), (5, data[5][1])]
    lab = spark.createDataFrame(labels + [(None, 1, 0), (2000, None, 0)], "doc_id long, toxic int, extra int")
    got = toxicity.toxic_documents(spark.createDataFrame(rows(data), DOCS), lab).collect()
    assert len(got) == len(data) and all(0 <= r["score"] <= 1 for r in got)
    held = [(r["predicted"], r["doc_id"] % 4 == 0) for r in got if r["held_out"] and r["doc_id"] < 400]
    assert sum(p == int(y) for p, y in held) >= 0.97 * len(held)
    assert {r["held_out"] for r in got if r["doc_id"] is None} == {False}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got if r["doc_id"] is not None)
    assert toxicity.toxic_documents(empty, lab).count() == 0
    plain = toxicity.toxic_documents(spark.createDataFrame(rows(data), DOCS), lab.limit(0)).collect()
    assert len(plain) == len(data) and len({r["score"] for r in plain}) == 1


def test_crf_marginals_against_enumeration():
    rng = np.random.default_rng(0)
    score, moves, first = rng.normal(size=(7, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    chain = np.array([0, 0, 0, 0, 1, 1, 2])
    gamma, rest = crf.forward_backward(score, chain, moves, first)
    expected = crf._moves_expected(*rest)
    import itertools

    want, pairs = np.zeros((7, 3)), np.zeros((3, 3))
    for c in range(3):
        at = np.flatnonzero(chain == c)
        paths = list(itertools.product(range(3), repeat=len(at)))
        p = np.array([np.exp(first[y[0]] + sum(score[i, k] for i, k in zip(at, y)) + sum(moves[a, b] for a, b in zip(y, y[1:]))) for y in paths])
        p /= p.sum()
        for y, q in zip(paths, p):
            for i, k in zip(at, y):
                want[i, k] += q
            for a, b in zip(y, y[1:]):
                pairs[a, b] += q
    assert np.allclose(gamma, want) and np.allclose(expected, pairs)


def test_crf_labels_code_switched_words_and_odd_rows(spark, empty):
    rng = np.random.default_rng(5)
    kinds = {"en": ["the", "thing", "house", "walking", "with"], "de": ["schön", "straße", "gehen", "und", "haus"]}
    data = [(i, " ".join(rng.choice(kinds[k], 60)), k, "s", 1) for i, k in enumerate(["en", "de"] * 60)]
    odd = [(500, None), (501, ""), (502, "123 … ’"), (503, "THE HOUSE"), (None, "und haus"), (504, "gehen " * 40000)]
    df = spark.createDataFrame(data + [(d, t, None, None, None) for d, t in odd], "doc_id long, text string, lang string, source string, n_chars long")
    learn = df.where(toxicity.fold("doc_id", 4) != 2)
    got = {r["doc_id"]: r for r in crf.languages(df, learn).collect()}
    assert all(got[i]["lang_pred"] == k for i, _, k, _, _ in data)
    assert [got[i]["lang_pred"] for i in (500, 501, 502, 503, None, 504)] == ["und", "und", "und", "en", "de", "de"]
    model = crf.fit(learn)
    text = "the thing walking schön straße gehen".encode()
    owner, gamma = crf.label_words(model, text, np.array([0, len(text) + 1]))
    assert [model.labels[k] for k in gamma.argmax(axis=1)] == ["en"] * 3 + ["de"] * 3
    none = crf.languages(df, df.where("lang = 'xx'")).collect()
    assert {r["lang_pred"] for r in none} == {"und"}
    assert crf.languages(empty, learn.select("doc_id", "text", "lang")).count() == 0


def test_hashes_hold_across_texts():
    from tabflow.llm.common import grams, words

    a, b = "xx the cat sat".encode(), "the   cat\tsat é".encode()
    assert (grams(words(a)[2], 3)[1:] == grams(words(b)[2], 3)[:1]).all()
    assert hashlib.sha256(b" ".join(b.split())).hexdigest() and len(words(b)[0]) == 4
