"""Queries of the corpus operators, one per operator, and their DuckDB twins."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.llm import align, chat, crf, embeddup, exactdup, jaccard, mixing, packing, repair, sharding, substring, toxicity, vptree
from tabflow.sources.tables import table

QueryFn = Callable[[SparkSession, str], DataFrame]
VOCABULARY = "word_bpe_49k.json"
QUERIES: dict[str, QueryFn] = {}
SQL: dict[str, str] = {}


def vocabulary(name: str = VOCABULARY) -> str:
    """Path of a public tokenizer file, which every executor has installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(fn: QueryFn) -> QueryFn:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts are control strings, read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"))
    turns = turns.unionByName(probe).withColumn("parts", chat.text_part(F.col("text")))
    read = chat.read_back(chat.format_chats(turns))
    said = F.zip_with("roles", "contents", lambda r, t: F.concat(r, F.lit("\n"), t, F.lit("\n")))
    loss = F.array_join("masked", "")
    return read.select(
        "conv_id", F.size("contents").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "attachment_tokens")


def _stuffed(column: str) -> str:
    """DuckDB: ``column`` with a backslash stuffed into every control string."""
    for first in "<[":
        body = "|".join(re.escape(c[1:]).replace("'", "''") for c in sorted(chat.CONTROLS, key=len, reverse=True) if c[0] == first)
        column = rf"regexp_replace({column}, '(\{first})(\\*(?:{body}))', '\1\\\2', 'g')"
    return column


SQL["op1_chat_format"] = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), shown AS (SELECT *, {_stuffed('text')} AS body, {_stuffed('role')} AS head FROM rows)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, body)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, body)) AS loss_sha256,
  CAST(sum(length(head) + length(body) + {len(chat.START + chat.SEP + chat.END)}) AS BIGINT) AS formatted_chars,
  CAST(0 AS BIGINT) AS attachment_tokens
FROM shown GROUP BY conv_id"""


@query
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), shards=24)


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxic_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.7)


@query
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring.strip_repeats(table(spark, sf_dir, "documents"), window=13)
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL["op4_substring_dedup"] = r"""
WITH t AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), p AS MATERIALIZED (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM t)
), f AS (SELECT g, min(doc_id) AS first FROM p GROUP BY g HAVING min(doc_id) < max(doc_id)),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM p JOIN f USING (g) WHERE doc_id > first
), g AS (SELECT doc_id, list(i) AS cut FROM gone GROUP BY doc_id)
SELECT t.doc_id, len(w) AS n_words, coalesce(len(cut), 0) AS n_removed,
  sha256(array_to_string(CASE WHEN cut IS NULL THEN w ELSE list_transform(
    list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(cut, i)), lambda i: w[i]) END, ' ')) AS kept_sha256
FROM t LEFT JOIN g ON g.doc_id = t.doc_id"""


@query
def op5_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    done = crf.languages(docs, docs.where(toxicity.fold("doc_id", 4) != 2))
    held = F.coalesce(toxicity.fold("doc_id", 4) == 2, F.lit(False))
    return done.select("doc_id", held.alias("held_out"), "lang_pred", "score")


@query
def op6_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.nearest(table(spark, sf_dir, "embeddings"), every=20, k=20)


SQL["op6_vptree"] = """
WITH u AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_reduce(list_prepend(CAST(0 AS DOUBLE),
      list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), lambda a, x: a + x) AS score
  FROM u q JOIN u c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20"""


@query
def op7_embedding_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddup.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.98)


SQL["op7_embedding_dups"] = """
WITH RECURSIVE u AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), n AS (
  SELECT *, sqrt(list_reduce(list_prepend(CAST(0 AS DOUBLE), list_transform(v, lambda x: x * x)), lambda a, x: a + x)) AS size FROM u
), e AS MATERIALIZED (
  SELECT a.vec_id AS x, b.vec_id AS y FROM n a JOIN n b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_reduce(list_prepend(CAST(0 AS DOUBLE), list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])),
                    lambda s, x: s + x) / (a.size * b.size) >= 0.98
), r(node, c) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT e.y, r.c FROM r JOIN e ON r.node = e.x
), c AS (SELECT node, min(c) AS component_id FROM r GROUP BY node),
k AS (SELECT x, count(*) AS n_links FROM e GROUP BY x)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings LEFT JOIN c ON c.node = vec_id LEFT JOIN k ON k.x = vec_id"""


@query
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"), k=4, num=85, den=100)


SQL["op8_jaccard_join"] = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS g
  FROM t
), n AS MATERIALIZED (SELECT doc_id, len(g) AS n FROM s),
x AS MATERIALIZED (SELECT doc_id, unnest(g) AS h FROM s),
e AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.h = b.h AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  WHERE na.n * 100 >= nb.n * 85 AND nb.n * 100 >= na.n * 85
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 85 * (na.n + nb.n - count(*))
), r(node, c) AS (SELECT doc_id, doc_id FROM n UNION SELECT e.b, r.c FROM r JOIN e ON r.node = e.a),
c AS (SELECT node, min(c) AS component_id FROM r GROUP BY node)
SELECT n.doc_id, n.n AS n_shingles, component_id FROM n JOIN c ON c.node = n.doc_id"""


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary(), capacity=2048)


@query
def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdup.exact_duplicates(table(spark, sf_dir, "documents"))


SQL["op11_exact_dedup"] = """
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
), g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)"""


@query
def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.tokenizer_links(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every original conversation, with faults planted in its turns, and its repair."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    report, repaired = repair.repair(repair.damaged(turns))
    ids = turns.select("conv_id").distinct().withColumn("ck", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    done = ids.join(report, "ck", "left").join(repair.digests(repaired), "ck", "left")
    return done.select("conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c)
                                    for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                       F.coalesce("audit", F.lit("")).alias("audit"),
                       F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
