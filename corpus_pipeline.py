"""The corpus pipeline: documents through five of the corpus operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. ``run`` writes every
stage's result to the cluster's shared folder as Parquet and reads it again as the next
one's documents, so a lost executor repeats tasks of one stage only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabflow.llm import jaccard, mixing, packing, substring, toxicity
from tabflow.llm.common import written
from tabflow.llm.queries import vocabulary
from tabflow.sources.tables import table


def hidden(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` under names that no operator uses, and each column's new name."""
    names = {c: f"_d{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.7; the model learns as in op3."""
    learn = table(spark, sf_dir, "labels").where(toxicity.fold("doc_id", 3) != 1)
    rows, name = hidden(docs)
    scored = toxicity.score(rows, toxicity.fit(docs, learn), threshold=0.7, text=name["text"])
    return scored.where(F.col("predicted") == 0).select(rows.columns).toDF(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of near duplicates (five-word shingles, 0.8).
    Rows that repeat both its id and text are one; rows without an id stay."""
    groups = jaccard.near_duplicates(docs, k=5, num=80, den=100)
    first = groups.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    kept = docs.join(first, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.unionByName(docs.where(F.col("doc_id").isNull())).select(docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 13 words or more that an earlier document has; a text
    that loses nothing stays as it is."""
    rows, name = hidden(docs)
    done = substring.strip_repeats(rows, window=13, id_column=name["doc_id"], text=name["text"], layout=True,
                                   carry=tuple(n for c, n in name.items() if c not in ("doc_id", "text")))
    done = done.withColumnsRenamed({"doc_id": name["doc_id"], "kept": name["text"]})
    count = F.when(F.col("n_removed") > 0, F.length(name["text"]).cast("long")).otherwise(F.col(name["n_chars"]))
    return done.withColumn(name["n_chars"], count).select(rows.columns).toDF(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice. Rows equal
    in id, size and source are told apart by number, so each gets its own count."""
    keys = ["_id", "_size", "_source"]
    rows, name = hidden(docs.withColumn("text", F.col("text").cast("string")))
    rows = rows.select("*", F.col(name["doc_id"]).alias("_id"), mixing.word_count(name["text"]).alias("_size"),
                       F.coalesce(F.concat(F.lit("s"), name["source"]), F.lit("n")).alias("_source"))
    rows = rows.withColumn("_no", F.row_number().over(Window.partitionBy(*keys).orderBy(F.xxhash64(name["text"]))))
    taken = mixing.mix_sources(docs.select("doc_id", "text", "source"), keep_source=True) \
        .select(F.col("doc_id").alias("_id"), F.col("size").alias("_size"), F.col("source").alias("_source"), "copies")
    taken = taken.where("copies > 0") \
        .withColumn("_no", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("copies").desc())))
    same = [rows[c].eqNullSafe(taken[c]) for c in [*keys, "_no"]]
    return rows.join(taken, same).withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("copies")))) \
        .select(list(name.values())).toDF(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and the sequence each goes to, as in op9."""
    return packing.pack(docs, vocabulary(), capacity=2048)


STAGES = [("toxicity", drop_toxic), ("near_duplicates", one_of_each_group), ("repeated_passages", cut_repeats),
          ("mixing", mix), ("packing", pack)]

#: No SQL: a learnt model, a seeded choice and a tokenizer. tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


def pipeline_queries() -> dict:
    return {"pipeline": run}


def pipeline_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
