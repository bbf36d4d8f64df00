"""UDF and ML queries (survey 2.10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabflow.functions.udfs import upper_pandas, upper_udf
from tabflow.ml.recommend import als_fit, top_n_scored
from tabflow.ml.regression import coefficients, fit_linear, regression_metrics
from tabflow.operators.sampling import hash_split
from tabflow.queries.registry import query, tbl


@query("udf_upper", "U1", sql="SELECT c_custkey, upper(c_name) AS name_upper FROM customer")
def udf_upper(spark, sf):
    return tbl(spark, sf, "customer").select("c_custkey", upper_udf("c_name").alias("name_upper"))


@query("udf_three_ways", "U2", sql="""
SELECT c_custkey, upper(c_mktsegment) AS native, upper(c_mktsegment) AS row_udf,
       upper(c_mktsegment) AS pandas_udf
FROM customer
""")
def udf_three_ways(spark, sf):
    cu = tbl(spark, sf, "customer").select("c_custkey", F.lower("c_mktsegment").alias("seg"))
    return cu.select("c_custkey", F.upper("seg").alias("native"), upper_udf("seg").alias("row_udf"),
                     upper_pandas("seg").alias("pandas_udf"))


@query("ml_linreg_coeffs", "M1 M2", sql="""
SELECT 'intercept' AS term, round(regr_intercept(l_extendedprice, l_quantity), 6) AS value FROM lineitem
UNION ALL
SELECT 'l_quantity', round(regr_slope(l_extendedprice, l_quantity), 6) FROM lineitem
""")
def ml_linreg_coeffs(spark, sf):
    """OLS fit by the ML Pipeline; the coefficients (shown to 6 decimals)
    become a 2-row table."""
    li = tbl(spark, sf, "lineitem")
    model = fit_linear(li, ["l_quantity"], "l_extendedprice")
    coef = spark.createDataFrame(coefficients(model, ["l_quantity"]), "term string, value double")
    return coef.withColumn("value", F.round("value", 6))


@query("ml_linreg_metrics", "M3 S6")
def ml_linreg_metrics(spark, sf):
    """Fit on the 80 % hash split, RMSE / MAE / R² on the held-out 20 %."""
    li = tbl(spark, sf, "lineitem")
    feats = ["l_quantity", "l_discount", "l_tax"]
    train, test = hash_split(li, ["l_orderkey", "l_linenumber", "l_partkey"], 80)
    model = fit_linear(train, feats, "l_extendedprice")
    return regression_metrics(model.transform(test), "l_extendedprice")


@query("ml_als_topn", "M4")
def ml_als_topn(spark, sf):
    """ALS on quantities bought per (customer, part): fit on a hash 80 % of
    the pairs, score the held-out 20 %, keep the best 5 held-out parts per
    customer. (Ranking all parts for every customer would need every
    customer x part pair, a cross join; candidates are the given pairs.)"""
    li = tbl(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = tbl(spark, sf, "orders").select("o_orderkey", "o_custkey")
    ratings = (li.join(od, li.l_orderkey == od.o_orderkey, "inner")
               .groupBy("o_custkey", "l_partkey").agg(F.sum("l_quantity").alias("qty")))
    train, held_out = hash_split(ratings, ["o_custkey", "l_partkey"], 80)
    model = als_fit(train, "o_custkey", "l_partkey", "qty", implicit=True)
    return top_n_scored(model, held_out, "o_custkey", "l_partkey", n=5)
