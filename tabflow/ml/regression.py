"""Linear regression in a Pipeline (VectorAssembler -> LinearRegression)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_linear(df: DataFrame, features: Sequence[str], label: str,
               solver: str = "normal") -> PipelineModel:
    """Ordinary least squares. ``normal`` solves the normal equations from one
    distributed pass of sufficient statistics (feature count is small). A null
    feature or label is an error: drop or fill such rows first, where it shows."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")
    lr = LinearRegression(featuresCol="features", labelCol=label, predictionCol="prediction",
                          solver=solver, regParam=0.0, elasticNetParam=0.0)
    return Pipeline(stages=[assembler, lr]).fit(df.select(*features, label))


def coefficients(model: PipelineModel, features: Sequence[str]) -> list[tuple[str, float]]:
    lr = model.stages[-1]
    return [("intercept", float(lr.intercept))] + [
        (f, float(c)) for f, c in zip(features, lr.coefficients.toArray())]


def regression_metrics(pred: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """RMSE, MAE and R² of a prediction table in one aggregate pass."""
    err = F.col(label) - F.col(prediction)
    stats = pred.agg(F.count(F.lit(1)).alias("n"), F.avg(err * err).alias("mse"),
                     F.avg(F.abs(err)).alias("mae"), F.var_pop(label).alias("var_y"))
    return stats.select(F.col("n").cast("bigint").alias("n"), F.sqrt("mse").alias("rmse"),
                        F.col("mae"),
                        F.when(F.col("var_y") > 0, 1 - F.col("mse") / F.col("var_y")).alias("r2"))
