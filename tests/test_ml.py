import pytest
from pyspark.sql import functions as F

from tabflow.ml.recommend import als_fit, top_n_scored
from tabflow.ml.regression import coefficients, fit_linear, regression_metrics


def test_linear_regression_recovers_exact_coefficients(spark):
    df = spark.range(200).select((F.col("id") * 1.0).alias("a"), (F.col("id") % 7 * 1.0).alias("b"))
    df = df.withColumn("y", 3.0 + 2.0 * F.col("a") - 0.5 * F.col("b"))
    model = fit_linear(df, ["a", "b"], "y")
    coef = dict(coefficients(model, ["a", "b"]))
    assert coef["intercept"] == pytest.approx(3.0, abs=1e-6)
    assert coef["a"] == pytest.approx(2.0, abs=1e-8) and coef["b"] == pytest.approx(-0.5, abs=1e-6)
    m = regression_metrics(model.transform(df), "y").first()
    assert m.rmse == pytest.approx(0.0, abs=1e-6) and m.r2 == pytest.approx(1.0, abs=1e-9)


def test_als_top_n_over_candidates_without_cross_join(spark):
    from tabflow.plans.explain import explain_text
    rows = [(u, i, float((u * i) % 5 + 1)) for u in range(20) for i in range(15) if (u + i) % 3]
    df = spark.createDataFrame(rows, "u long, i long, r double")
    model = als_fit(df, "u", "i", "r", max_iter=3)
    candidates = spark.createDataFrame([(u, i) for u in range(20) for i in range(15) if (u + i) % 3 == 1],
                                       "u long, i long")
    out = top_n_scored(model, candidates, "u", "i", n=3)
    per_user = {r.u: r["count"] for r in out.groupBy("u").count().collect()}
    assert len(per_user) == 20 and set(per_user.values()) == {3}
    assert "CartesianProduct" not in explain_text(out)
    ranks = [r["rank"] for r in out.filter("u = 4").orderBy("rank").collect()]
    assert ranks == [1, 2, 3]
