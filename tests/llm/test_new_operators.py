"""Exact dedup, tokenizer alignment and conversation repair against plain Python versions."""

import hashlib
import itertools
import json
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tabflow.llm import align, exactdup, repair
from tabflow.llm.queries import QUERIES, vocabulary

DOCS = "doc_id long, text string, d string, n long, row int, tid string, copies long, kept string"
A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"


def lower(t):
    return t.translate({c: c + 32 for c in range(65, 91)})


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


TEXTS = [(1, "Alpha Beta"), (4, "alpha beta"), (4, "ALPHA beta"), (2, "Ärger"), (3, "ärger"), (5, None), (9, ""), (None, "x"), (None, "x"),
         (7, "long " * 60000), (8, "LONG " * 60000), (None, None), (11, "alone"), (6, "hot"), (6, "hot")] + [(100 + i, "HOT"[: 2 + i % 2]) for i in range(60)]


def documents(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1, 2, "t", 3, "k") for d, t in rows], DOCS)


@pytest.mark.parametrize("counters", [1, 2, 4096])
def test_exact_duplicates_against_groups(spark, counters):
    got = exactdup.exact_duplicates(documents(spark, TEXTS).repartition(5), counters=counters, carry=("tid",)).collect()
    groups = defaultdict(list)
    for d, t in TEXTS:
        groups[lower(t or "")].append(d)
    want = []
    for t, ids in groups.items():
        keep = max((d for d in ids if d is not None), default=None)
        want += [(d, keep, len(ids), sha(t)) for d in ids]
    assert sorted(map(str, want)) == sorted(str((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"])) for r in got)
    kept = [r for r in got if r["kept"]]
    assert Counter(r["text_sha256"] for r in kept) == Counter(sha(t) for t in groups)
    assert all(r["doc_id"] == r["keep_id"] for r in kept) and all(r["tid"] == "t" for r in got)
    assert exactdup.exact_duplicates(documents(spark, [])).count() == 0


def test_misra_gries_keeps_every_heavy_key_and_its_error_bound():
    rng = random.Random(1)
    rows = [rng.choice("aaaaabbbcd" + "efghijklmnop") for _ in range(3000)]
    true, held, k = Counter(rows), Counter(), 4
    for at in range(0, len(rows), 97):
        held = exactdup.misra_gries(held, rows[at:at + 97], k)
    assert len(held) <= k
    assert all(true[x] - len(rows) / (k + 1) <= held[x] <= true[x] for x in true)


def test_heavy_digests_are_all_found_over_many_tasks(spark):
    rows = [(bytes([i % 7 if i % 3 else 99, i % 50 if i % 3 else 0]),) for i in range(6000)]
    got = {bytes(r["d"]): r["n"] for r in exactdup.heavy(spark.createDataFrame(rows, "d binary").repartition(13), "d", 8).collect()}
    true = Counter(r[0] for r in rows)
    assert all(true[k] == n for k, n in got.items()) and len(got) <= 9
    assert {k for k, n in true.items() if n > 2 * 6000 / 9} <= set(got)


# --- alignment ----------------------------------------------------------------

ALIGN = [(1, "Hello world, it's  an <|endoftext|> test.\nNext\tline ünïcödé 日本語 </s> <s> <0x41>"), (2, None), (3, ""), (4, " "), (5, "a▁b c"),
         (6, "Hello world"), (7, "Hello world"), (7, "Hello world"), (None, "Hello there world"), (8, "x y z \x1c w   q"),
         (9, " leading and trailing "), (10, "pneumonoultramicroscopic" * 8 + " " + "word " * 3000), (11, "\u0000 nul ﻿"), (12, "'s 't it 's"),
         (13, "The theory; therefore the them"), (14, "é \U0001f600 family")]


def plain_alignment(rows):
    """Whole texts, no parts and no cache, byte offset by byte offset."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(vocabulary(A)), sentencepiece.SentencePieceProcessor(model_file=vocabulary(B))
    a.encode_special_tokens = True
    letters = [*range(33, 127), *range(161, 173), *range(174, 256)]
    back = {chr(c): c for c in letters}
    for c in range(256):
        if c not in letters:
            back[chr(256 + len(back) - len(letters))] = c
    entries = {i: t for t, i in json.load(open(vocabulary(A)))["model"]["vocab"].items()}
    out, links = [], []
    for d, t in rows:
        x, y, groups, own = [], [], [], []
        if t:
            ia, ib = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)
            ba = [bytes(back[c] for c in entries[i]) for i in ia]
            bb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
            if b"".join(ba) == b"".join(bb) == (" " + t).encode():
                x, y = ia, ib
                ea, eb = list(itertools.accumulate(map(len, ba))), list(itertools.accumulate(map(len, bb)))
                i = j = 0
                for p, q in [(ea.index(e) + 1, eb.index(e) + 1) for e in sorted(set(ea) & set(eb))]:
                    groups.append(",".join(map(str, x[i:p])) + "|" + ",".join(map(str, y[j:q])))
                    own.append((x[p - 1], y[q - 1]))
                    i, j = p, q
        out.append((d, len(x), len(y), len(groups), ";".join(groups)))
        links.append(own)
    count = Counter(p for own in links for p in own)
    most = defaultdict(int)
    for (_, b_), n in count.items():
        most[b_] = max(most[b_], n)
    return [(d, na, nb, ng, ng, sum(count[p] == most[p[1]] for p in own), sum(count[p] for p in own), sha(g) if na else "")
            for (d, na, nb, ng, g), own in zip(out, links)], [g for *_, g in out]


@pytest.mark.parametrize("listed", [0, 20, 1 << 18])
def test_alignment_against_whole_texts(spark, listed):
    docs = documents(spark, ALIGN)
    got = align.tokenizer_links(docs, vocabulary(A), vocabulary(B), listed=listed).collect()
    want, groups = plain_alignment(ALIGN)
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))
    assert {r["groups"] for r in align.align_groups(docs, vocabulary(A), vocabulary(B)).collect()} == set(groups)
    assert [r for r in want if r[0] == 5][0][1:] == (0, 0, 0, 0, 0, 0, "")
    assert align.tokenizer_links(documents(spark, []), vocabulary(A), vocabulary(B)).count() == 0


def test_alignment_of_the_test_documents(spark, sf):
    got = sorted(map(tuple, QUERIES["op12_tokenizer_alignment"](spark, sf).collect()))
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert got == sorted(plain_alignment(rows)[0])


# --- repair -------------------------------------------------------------------


def plain_repair(rows):
    """rows in order [(role, text)]; every target up to a length, all alignments by DP."""
    faults, seen = [], set()
    for role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "" if solid[-1] in ".!?" else "truncated")
        seen.add((role, text))
    best = None
    for n in range(len(rows) + 3):
        for target in {"", *(["ua" * n, "s" + "ua" * n] if n else [])}:
            cells = {(len(rows), len(target)): (0, "", ())}
            for i in range(len(rows), -1, -1):
                for j in range(len(target), -1, -1):
                    if (i, j) in cells:
                        continue
                    options = []
                    if i < len(rows) and (i + 1, j) in cells:
                        c, a, out = cells[i + 1, j]
                        options.append((c + 3, "D" + a, out))
                    if j < len(target) and target[j] != "s" and (i, j + 1) in cells:
                        c, a, out = cells[i, j + 1]
                        options.append((c + 2, "I" + a, ({"u": "user:", "a": "assistant:"}[target[j]], *out)))
                    if i < len(rows) and j < len(target) and faults[i] in ("", "truncated") and (i + 1, j + 1) in cells:
                        c, a, out = cells[i + 1, j + 1]
                        c += faults[i] == "truncated"
                        role, text = rows[i]
                        if role[:1] == target[j]:
                            options.append((c, "K" + a, (f"{role}:{text}", *out)))
                        if target[j] != "s":
                            options.append((c + 2, "R" + a, ({"u": "user", "a": "assistant"}[target[j]] + ":" + text, *out)))
                    if options:
                        cells[i, j] = min(options)
            if (0, 0) in cells:
                best = min(best, cells[0, 0]) if best else cells[0, 0]
    pairs = [x[0][:1] + y[0][:1] for x, y in zip(rows, rows[1:])]
    return (*[faults.count(f) for f in ("blank", "duplicate", "truncated")], sum(p not in ("su", "ua", "au") for p in pairs),
            best[0], best[1], sha("\n".join(best[2])))


def gaps(turns):
    known = [t for t in turns if t is not None]
    return max(known) - min(known) + 1 - len(set(known)) if known else 0


def random_turns(rng, n):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    out = []
    for t in range(n):
        role = rng.choice(roles) if rng.random() < 0.5 else ("user", "assistant")[t % 2]
        text = rng.choice([f"Said {rng.randrange(4)}.", "cut off", "", " \n", "ok!", None, "same?"])
        out.append((rng.choice([t, t, t, 2 * t, None, 0]), role, text))
    return out


def order(rows):
    return sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows),
                  key=lambda v: (v[0] is not None, v[0] or 0, v[1], v[2]))


@pytest.mark.parametrize("block", [3, 64])
def test_repair_against_all_alignments(spark, block):
    rng = random.Random(7)
    convs = {c: random_turns(rng, rng.randrange(1, 12)) for c in range(120)}
    convs[None] = random_turns(rng, 6)
    convs[500] = [(i, ("user", "assistant")[i % 2], "same.") for i in range(20)]
    convs[501] = [(0, "user", "again.")] * 30 + [(1, "assistant", "cut")] * 3 + [(None, "system", "Rules.")]
    convs[502] = [(i, ("user", "assistant")[(i // 3) % 2], f"turn {i}" + "." * (i % 2)) for i in range(40)]
    schema = "conv_id long, turn long, role string, text string, ck string, block long, fault string"
    rows = [(c, *t, "ck", 1, "f") for c, ts in convs.items() for t in ts]
    rng.shuffle(rows)
    report, repaired = repair.repair(spark.createDataFrame(rows, schema).repartition(4), block)
    digest = {r["ck"]: r["repaired_sha256"] for r in repair.digests(repaired).collect()}
    got = {r["ck"]: r for r in report.collect()}
    assert len(got) == len(convs)
    for c, ts in convs.items():
        r = got["" if c is None else str(c)]
        said = order(ts)
        want = plain_repair([x[1:] for x in said])
        have = tuple(r[x] for x in ("blank", "duplicate", "truncated", "illegal", "cost", "audit")) + (digest.get(r["ck"], sha("")),)
        assert have == want and r["gaps"] == gaps([t for t, *_ in ts]), (c, said)
    none, _ = repair.repair(spark.createDataFrame([], schema))
    assert none.count() == 0


def test_query_damages_and_repairs_every_conversation(spark, sf):
    got = {r["conv_id"]: r for r in QUERIES["op13_conversation_repair"](spark, sf).collect()}
    convs = defaultdict(list)
    for r in spark.read.parquet(f"{sf}/conversations.parquet").collect():
        fate = zlib.crc32(f"{r['conv_id']}:{r['turn']}".encode()) % 20
        convs[r["conv_id"]] += {0: [], 1: [(r["turn"], r["role"], "")], 2: [(r["turn"], r["role"], re.sub("[.!?]", "", r["text"]))],
                                3: [(r["turn"], r["role"], r["text"])] * 2, 4: [(r["turn"], "user", r["text"])]}.get(fate, [(r["turn"], r["role"], r["text"])])
    assert set(got) == set(convs)
    for c, ts in convs.items():
        r = got[c]
        want = (gaps([t for t, *_ in ts]), *plain_repair([x[1:] for x in order(ts)])) if ts else (0, 0, 0, 0, 0, 0, "", sha(""))
        assert tuple(r[x] for x in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) == want


def test_exact_dedup_query_equals_its_sql(spark, sf):
    import duckdb

    from tabflow.llm.queries import SQL

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = con.sql(SQL["op11_exact_dedup"]).fetchall()
    assert sorted(map(tuple, QUERIES["op11_exact_dedup"](spark, sf).collect())) == sorted(want)



# --- shared helpers -----------------------------------------------------------


def test_words_of_a_long_text_need_little_more_than_the_words():
    import tracemalloc

    from tabflow.llm import common

    text = b"some words, \t again\n" * 1_000_000
    tracemalloc.start()
    begin, end, h = common.words(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(begin) == 3_000_000 and peak < 12 * len(text)
    assert len(set(h[:30].tolist())) == 3 and (h[:3] == h[-3:]).all() and text[begin[-1]:end[-1]] == b"again"


@pytest.mark.parametrize("chunk", [2, 3, 7, 64])
def test_words_do_not_depend_on_the_chunk(monkeypatch, chunk):
    from tabflow.llm import common

    rng = random.Random(chunk)
    data = [bytes(rng.choice(b"ab \n") for _ in range(n)) for n in (0, 1, 2, 5, 60, 200)] + [b"x" * 300, b" " * 50]
    want = [common.words(d) for d in data]
    monkeypatch.setattr(common, "CHUNK", chunk)
    for name in ("_POWERS", "_INVERSES"):
        monkeypatch.setattr(common, name, np.ones(1, np.uint64))
    for d, w in zip(data, want):
        assert all((x == y).all() and len(x) == len(y) for x, y in zip(common.words(d), w))
        assert [d[s:e] for s, e in zip(*common.bounds(d))] == d.split() if d else True


def test_parts_are_cut_by_rows_and_bytes():
    import pyarrow as pa

    from tabflow.llm import common

    batch = pa.record_batch([pa.array(["a" * n for n in (5, 900, 2000, 1, 1, 1, 400, 700)]), pa.array(range(8))], ["t", "i"])
    got = [p.column("i").to_pylist() for p in common.parts([batch], rows=3, size=1000)]
    assert got == [[0, 1], [2], [3, 4, 5], [6], [7]]
