"""Word tokenisation and counts on whole texts (no prefixes, no caps)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WHITESPACE = r"\s+"


def words(df: DataFrame, text_col: str, pattern: str = WHITESPACE, lower: bool = True,
          out: str = "word") -> DataFrame:
    """One row per token of ``text_col`` (empty tokens dropped). Tokenising is
    the costly step, so a text column that arrives in fewer splits than task
    slots is spread first (``spread``)."""
    from tabflow.sources.tables import spread

    text = F.lower(F.col(text_col)) if lower else F.col(text_col)
    return (spread(df.select(text_col)).select(F.explode(F.split(text, pattern)).alias(out))
            .filter(F.col(out) != ""))


def word_counts(df: DataFrame, text_col: str, pattern: str = WHITESPACE,
                lower: bool = True) -> DataFrame:
    """``(word, n)`` over every text; partial aggregation per map task."""
    return (words(df, text_col, pattern, lower)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def distinct_words(df: DataFrame, text_col: str, pattern: str = WHITESPACE,
                   lower: bool = True) -> DataFrame:
    return words(df, text_col, pattern, lower).agg(F.countDistinct("word").alias("n_distinct"))
