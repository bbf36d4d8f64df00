"""Collaborative filtering with ALS (alternating least squares).

Fitting is block-wise and shuffles user/item factor blocks; scoring uses
``ALSModel.transform``, which joins given (user, item) pairs with the factor
tables. Recommending from *all* items (``recommendForAllUsers``) scores every
user x item pair through a cross join, so it is not used: candidates are
always given pairs, ranked per user with a partial top-N.
"""

from __future__ import annotations

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabflow.operators.windows import top_n_per_group


def _ids(df: DataFrame, user: str, item: str) -> DataFrame:
    """MLlib wants 32-bit ids; one beyond that or a null one is an error, never left out."""
    for c in (user, item):
        fits = F.col(c).between(-(1 << 31), (1 << 31) - 1)
        df = df.withColumn("__u" if c == user else "__i", F.when(fits, F.col(c).cast("int"))
                           .otherwise(F.raise_error(F.lit(f"{c}: null or beyond 32 bits"))))
    return df


def als_fit(ratings: DataFrame, user: str, item: str, rating: str, rank: int = 8, max_iter: int = 5,
            reg: float = 0.1, seed: int = 42, implicit: bool = False) -> ALSModel:
    """Fit ALS on all rows; a null id, rating or an id beyond 32 bits is an error."""
    value = F.coalesce(F.col(rating).cast("float"), F.raise_error(F.lit(f"{rating}: null")).cast("float"))
    data = _ids(ratings, user, item).select("__u", "__i", value.alias("__r"))
    als = ALS(userCol="__u", itemCol="__i", ratingCol="__r", rank=rank, maxIter=max_iter, regParam=reg,
              seed=seed, implicitPrefs=implicit, coldStartStrategy="nan", nonnegative=True)
    return als.fit(data)


def score_pairs(model: ALSModel, pairs: DataFrame, user: str, item: str) -> DataFrame:
    """Predicted score of each given (user, item) pair; null where the model does not
    know the user or the item, so that every pair comes back."""
    scored = model.transform(_ids(pairs, user, item))
    return scored.withColumn("score", F.when(~F.isnan("prediction"), F.col("prediction"))).drop("__u", "__i", "prediction")


def top_n_scored(model: ALSModel, candidates: DataFrame, user: str, item: str, n: int = 5) -> DataFrame:
    """Best ``n`` candidate items per user by predicted score:
    ``(user, item, score, rank)``; ties broken by item id."""
    scored = score_pairs(model, candidates.select(user, item), user, item)
    top = top_n_per_group(scored.withColumn("score", F.col("score").cast("double")), [user],
                          [F.desc_nulls_last("score"), F.asc(item)], n)
    return top.select(user, F.col(item).cast("bigint").alias(item), "score", "rank")
