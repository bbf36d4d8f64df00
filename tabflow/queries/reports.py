"""Queries of survey rows that need more than one operator or a file in between:
format reads, several files as one table, nested feeds, salted joins, genre analyses,
splits and their metrics."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabflow.ml.regression import fit_linear, regression_metrics
from tabflow.operators.aggregates import decimal_sum
from tabflow.operators.quality import step_counts
from tabflow.operators.sampling import hash_split
from tabflow.operators.skew import hot_keys, largest_share, salted_join
from tabflow.operators.windows import top_n_per_group
from tabflow.queries.registry import query, tbl
from tabflow.schemas import DRIVER
from tabflow.session import shared_path
from tabflow.sources.files import read_csv_inferred, read_layer, write_layer, write_report, write_text

FORMATS = (("csv", "gzip"), ("json", "gzip"), ("parquet", "snappy"), ("parquet", "zstd"), ("orc", "zstd"))


@query("format_one_column", "L4 A18", sql="\nUNION ALL\n".join(
    f"SELECT '{f}' AS format, '{c}' AS codec, count(*) AS n_rows, round(sum(o_totalprice), 2) AS total_price FROM orders"
    for f, c in FORMATS))
def format_one_column(spark, sf):
    """Each format written once and one column of it read back: the columnar formats
    read that column only (ReadSchema), the text formats every byte."""
    root, out = shared_path(spark, "one-column"), None
    for fmt, codec in FORMATS:
        write_layer(tbl(spark, sf, "orders"), f"{root}/{fmt}_{codec}", fmt=fmt, compression=codec)
        # a CSV is positional, so its whole schema is declared; the scan prunes the rest
        back = spark.read.format(fmt).schema(DRIVER["orders"]).option("header", True).load(f"{root}/{fmt}_{codec}")
        part = back.select("o_totalprice").agg(F.count(F.lit(1)).alias("n_rows"), decimal_sum("o_totalprice").alias("total_price")) \
            .select(F.lit(fmt).alias("format"), F.lit(codec).alias("codec"), "n_rows", "total_price")
        out = part if out is None else out.unionByName(part)
    return out


@query("aggregate_by_format", "L4", sql="\nUNION ALL\n".join(
    f"SELECT '{f}' AS format, o_orderpriority, count(*) AS n_orders FROM orders GROUP BY o_orderpriority"
    for f in ("csv", "json", "parquet", "orc")))
def aggregate_by_format(spark, sf):
    """One aggregate written in each format and read back equal."""
    root, out = shared_path(spark, "aggregate"), None
    agg = tbl(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_orders"))
    for fmt in ("csv", "json", "parquet", "orc"):
        write_layer(agg, f"{root}/{fmt}", fmt=fmt)
        back = spark.read.format(fmt).schema(agg.schema).option("header", True).load(f"{root}/{fmt}")
        part = back.select(F.lit(fmt).alias("format"), "o_orderpriority", "n_orders")
        out = part if out is None else out.unionByName(part)
    return out


@query("monthly_files", "A7", sql="""
SELECT o_orderkey, o_totalprice, CASE WHEN year(o_orderdate) >= 1999 THEN o_orderpriority END AS o_orderpriority FROM orders
""")
def monthly_files(spark, sf):
    """Folders by year as one table, where a column appears in 1999: merged schema, null before."""
    root = shared_path(spark, "years")
    od = tbl(spark, sf, "orders")
    early = F.year("o_orderdate") < 1999
    write_layer(od.where(early).select("o_orderkey", "o_totalprice"), f"{root}/early")
    write_layer(od.where(~early).select("o_orderkey", "o_totalprice", "o_orderpriority"), f"{root}/late")
    return read_layer(spark, [f"{root}/early", f"{root}/late"], merge_schema=True).select("o_orderkey", "o_totalprice", "o_orderpriority")


@query("append_layer", "A10", sql="SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def append_layer(spark, sf):
    """Two appends to one layer: every row of both, once."""
    path = shared_path(spark, "append")
    od = tbl(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    write_layer(od.where("o_orderkey % 2 = 0"), path, mode="append")
    write_layer(od.where("o_orderkey % 2 = 1"), path, mode="append")
    write_layer(od, path, mode="ignore")
    return read_layer(spark, path, od.schema)


@query("report_file", "A11 P1", sql="""
SELECT n_name, count(*) AS n_customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name
""")
def report_file(spark, sf):
    """An ordered report in one CSV file, read back."""
    path = shared_path(spark, "report")
    rows = tbl(spark, sf, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n_customers"))
    named = rows.join(tbl(spark, sf, "nation").select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
    report = named.select("n_name", "n_customers")
    write_report(report, path, order_by=[F.desc("n_customers"), F.asc("n_name")])
    return spark.read.schema(report.schema).option("header", True).csv(path)


@query("text_sink", "A15", sql="SELECT CAST(c_custkey AS VARCHAR) || ':' || c_mktsegment AS value FROM customer")
def text_sink(spark, sf):
    path = shared_path(spark, "text")
    write_text(tbl(spark, sf, "customer").select(F.concat_ws(":", F.col("c_custkey").cast("string"), "c_mktsegment").alias("line")), path, "line")
    return spark.read.text(path)


@query("csv_inferred", "A3", sql="SELECT n_nationkey, n_name FROM nation")
def csv_inferred(spark, sf):
    """A small lookup file read with inferred types."""
    path = shared_path(spark, "inferred")
    tbl(spark, sf, "nation").select("n_nationkey", "n_name").write.option("header", True).csv(path)
    return read_csv_inferred(spark, path).select(F.col("n_nationkey").cast(DRIVER["nation"]["n_nationkey"].dataType), "n_name")


STATUS_FEED = T.StructType([
    T.StructField("last_updated", T.LongType()),
    T.StructField("data", T.StructType([T.StructField("stations", T.ArrayType(T.StructType([
        T.StructField("station_id", T.LongType()), T.StructField("counts", T.MapType(T.StringType(), T.LongType()))])))]))])


def feed_records(stations, size=1000):
    """Records of at most ``size`` stations each, so their number grows with the table."""
    return stations.groupBy(F.floor(F.col("l_suppkey") / size).alias("last_updated")).agg(
        F.collect_list(F.struct(F.col("l_suppkey").alias("station_id"), "counts")).alias("stations"))


@query("json_nested_join", "A8", sql="""
SELECT s.s_suppkey, s.s_name, l.l_returnflag AS kind, count(*) AS n_lines
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey GROUP BY ALL
""")
def json_nested_join(spark, sf):
    """A nested status feed (an array of stations, each with a map of counts), written as
    JSON, exploded and joined to the station information."""
    path = shared_path(spark, "feed")
    per = tbl(spark, sf, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    stations = per.groupBy("l_suppkey").agg(F.map_from_entries(F.collect_list(F.struct("l_returnflag", "n"))).alias("counts"))
    feed = feed_records(stations)
    feed.select("last_updated", F.struct("stations").alias("data")).write.json(path)
    status = spark.read.schema(STATUS_FEED).json(path).select(F.explode("data.stations").alias("s")) \
        .select("s.station_id", F.explode("s.counts").alias("kind", "n_lines"))
    info = tbl(spark, sf, "supplier").select("s_suppkey", "s_name")
    return status.join(info, F.col("station_id") == F.col("s_suppkey")).select("s_suppkey", "s_name", "kind", "n_lines")


@query("dq_rejected_share", "Q6", sql="""
WITH c AS (SELECT count(*) AS n0, count_if(l_quantity > 10) AS n1, count_if(l_quantity > 10 AND l_discount <= 0.06) AS n2 FROM lineitem)
SELECT 0 AS step_no, 'raw' AS step, n0 AS n_rows, CAST(0 AS DOUBLE) AS rejected_pct FROM c UNION ALL
SELECT 1, 'quantity', n1, 100.0 * (n0 - n1) / n0 FROM c UNION ALL SELECT 2, 'discount', n2, 100.0 * (n0 - n2) / n0 FROM c
""")
def dq_rejected_share(spark, sf):
    """Rows after each cleaning step and the share of the raw rows rejected so far, in one scan."""
    steps = step_counts(tbl(spark, sf, "lineitem"), [("quantity", F.col("l_quantity") > 10), ("discount", F.col("l_discount") <= 0.06)])
    raw = steps.where("step_no = 0").select("n_rows").scalar()
    return steps.withColumn("rejected_pct", F.lit(100.0) * (raw - F.col("n_rows")) / raw)


# --- skew: measure, salt, measure again ------------------------------------------

SALTS = 16


@query("skew_salted_join", "D13", sql="""
WITH p AS (SELECT l_returnflag AS flag, round(sum(l_extendedprice), 2) / count(*) AS mean_price FROM lineitem GROUP BY 1)
SELECT l_returnflag, l_linestatus, count(*) AS n_lines, count_if(l_extendedprice > mean_price) AS n_above
FROM lineitem JOIN p ON l_returnflag = flag GROUP BY 1, 2
""")
def skew_salted_join(spark, sf):
    """Lines joined to the mean price of their return flag, a key where each value is hot."""
    li = tbl(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_linestatus", "l_extendedprice")
    mean = li.groupBy(F.col("l_returnflag").alias("flag")).agg((decimal_sum("l_extendedprice") / F.count(F.lit(1))).alias("mean_price"))
    joined = salted_join(li, mean, "l_returnflag", "flag", F.col("l_orderkey"), salts=SALTS, least_share=0.1)
    return joined.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_if(F.col("l_extendedprice") > F.col("mean_price")).alias("n_above"))


@query("skew_before_after", "D13", sql=f"""
WITH n AS (SELECT count(*) AS n FROM lineitem)
SELECT 'before' AS stage, max(c) / max(n) AS largest_share FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_returnflag), n
UNION ALL SELECT 'after', max(c) / max(n) FROM (
  SELECT count(*) AS c FROM lineitem GROUP BY l_returnflag, l_orderkey % {SALTS}), n
""")
def skew_before_after(spark, sf):
    """The largest share of rows that one join key holds, before and after salting its hot keys."""
    li = tbl(spark, sf, "lineitem").select("l_orderkey", "l_returnflag")
    hot = hot_keys(li, "l_returnflag", 0.1)
    salt = F.when(F.col("l_returnflag").isin(hot), F.pmod(F.col("l_orderkey"), F.lit(SALTS)).cast("int")).otherwise(0)
    return largest_share(li, ["l_returnflag"], "before").unionByName(
        largest_share(li.withColumn("salt", salt), ["l_returnflag", "salt"], "after"))


# --- genres: a part's name is its list of genres, a line a rating -----------------

def _rated(spark, sf):
    li = tbl(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    genres = tbl(spark, sf, "part").select("p_partkey", F.explode(F.split("p_name", " ")).alias("genre"))
    return li.join(genres, F.col("l_partkey") == F.col("p_partkey"))


_GENRES = """WITH g AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS genre FROM part),
r AS (SELECT l.*, genre FROM lineitem l JOIN g ON l_partkey = p_partkey)
"""


@query("genre_popularity", "G14", sql=_GENRES + """
SELECT genre, count(*) AS n_ratings, count(DISTINCT l_partkey) AS n_items, sum(l_quantity) / count(*) AS mean_rating FROM r GROUP BY genre""")
def genre_popularity(spark, sf):
    return _rated(spark, sf).groupBy("genre").agg(
        F.count(F.lit(1)).alias("n_ratings"), F.countDistinct("l_partkey").alias("n_items"),
        (F.sum("l_quantity") / F.count(F.lit(1))).alias("mean_rating"))


@query("genre_rank", "G14 W1", sql=_GENRES + """
, c AS (SELECT genre, l_partkey, count(*) AS n_ratings FROM r GROUP BY 1, 2)
SELECT genre, l_partkey, n_ratings, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY genre ORDER BY n_ratings DESC, l_partkey) AS rank FROM c) WHERE rank <= 3""")
def genre_rank(spark, sf):
    """The three most rated items of each genre."""
    per = _rated(spark, sf).groupBy("genre", "l_partkey").agg(F.count(F.lit(1)).alias("n_ratings"))
    return top_n_per_group(per, ["genre"], [F.desc("n_ratings"), F.asc("l_partkey")], 3)


@query("ratings_per_user", "G14", sql="""
SELECT o_custkey, count(*) AS n_ratings, min(l_quantity) AS lowest, max(l_quantity) AS highest, sum(l_quantity) / count(*) AS mean_rating
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey""")
def ratings_per_user(spark, sf):
    li = tbl(spark, sf, "lineitem").select("l_orderkey", "l_quantity")
    od = tbl(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return li.join(od, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_ratings"), F.min("l_quantity").alias("lowest"), F.max("l_quantity").alias("highest"),
        (F.sum("l_quantity") / F.count(F.lit(1))).alias("mean_rating"))


@query("genre_trend", "G14", sql=_GENRES + """
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, genre, count(*) AS n_ratings FROM r GROUP BY 1, 2""")
def genre_trend(spark, sf):
    """Ratings by year and genre."""
    li = tbl(spark, sf, "lineitem").select("l_partkey", F.year("l_shipdate").alias("year"))
    per = li.groupBy("year", "l_partkey").agg(F.count(F.lit(1)).alias("n"))
    genres = tbl(spark, sf, "part").select("p_partkey", F.explode(F.split("p_name", " ")).alias("genre"))
    return per.join(genres, F.col("l_partkey") == F.col("p_partkey")).groupBy("year", "genre").agg(F.sum("n").alias("n_ratings"))


@query("user_profiles", "G14", sql="""
SELECT c_mktsegment, c_nationkey, count(DISTINCT c_custkey) AS n_users, count(o_orderkey) AS n_orders
FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2""")
def user_profiles(spark, sf):
    """Users and their orders by profile; orders are counted per user before the join."""
    per = tbl(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    cu = tbl(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    return cu.join(per, F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("c_mktsegment", "c_nationkey").agg(
        F.countDistinct("c_custkey").alias("n_users"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_orders"))


@query("events_by_day_hour", "G14 G6", sql="""
SELECT CAST(dayofweek(ts) + 1 AS INTEGER) AS weekday, CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n_events FROM events GROUP BY 1, 2""")
def events_by_day_hour(spark, sf):
    return tbl(spark, sf, "events").groupBy(F.dayofweek("ts").alias("weekday"), F.hour("ts").alias("hour")) \
        .agg(F.count(F.lit(1)).alias("n_events"))


# --- splits, fits and quartiles ---------------------------------------------------

_BUCKET = "CAST('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey)), 1, 8) AS BIGINT) % 100"


@query("split_sizes", "S6", sql=f"""
SELECT CASE WHEN {_BUCKET} < 80 THEN 'train' ELSE 'test' END AS side, count(*) AS n_rows, sum(l_quantity) AS sum_qty
FROM lineitem GROUP BY 1""")
def split_sizes(spark, sf):
    """Both sides of the hash split: every row on one of them."""
    train, test = hash_split(tbl(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey"], 80)
    both = train.select(F.lit("train").alias("side"), "l_quantity").unionByName(test.select(F.lit("test").alias("side"), "l_quantity"))
    return both.groupBy("side").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("l_quantity").alias("sum_qty"))


@query("ml_split_metrics", "M3 S6", sql=f"""
WITH s AS (SELECT *, {_BUCKET} < 80 AS train FROM lineitem),
f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS a, regr_intercept(l_extendedprice, l_quantity) AS b FROM s WHERE train),
e AS (SELECT l_extendedprice AS y, l_extendedprice - (a * l_quantity + b) AS e FROM s, f WHERE NOT train)
SELECT count(*) AS n, round(sqrt(avg(e * e)), 4) AS rmse, round(avg(abs(e)), 4) AS mae,
       round(1 - avg(e * e) / var_pop(y), 6) AS r2 FROM e""")
def ml_split_metrics(spark, sf):
    """Fit on the train side, error on the held-out side."""
    train, test = hash_split(tbl(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey"], 80)
    out = regression_metrics(fit_linear(train, ["l_quantity"], "l_extendedprice").transform(test), "l_extendedprice")
    return out.select("n", F.round("rmse", 4).alias("rmse"), F.round("mae", 4).alias("mae"), F.round("r2", 6).alias("r2"))


@query("profile_quartiles", "Q7", sql="\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, " + ", ".join(f"round(quantile_cont({c}, {q}), 9) AS q{int(q * 100)}" for q in (0.25, 0.5, 0.75))
    + " FROM lineitem" for c in ("l_quantity", "l_discount", "l_tax")))
def profile_quartiles(spark, sf):
    """Typed exact quartiles. ``percentile`` keeps one count per distinct value and these
    columns have few; a column of many values takes ``percentile_approx``."""
    li, out = tbl(spark, sf, "lineitem"), None
    for c in ("l_quantity", "l_discount", "l_tax"):
        q = F.percentile(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
        part = li.agg(q.alias("q")).select(F.lit(c).alias("column_name"), *[F.round(F.col("q")[i], 9).alias(n) for i, n in enumerate(("q25", "q50", "q75"))])
        out = part if out is None else out.unionByName(part)
    return out


_DIRTY = """WITH o AS (SELECT o_orderkey, o_custkey, o_orderdate FROM orders),
bad AS (SELECT * FROM o UNION ALL SELECT * FROM o WHERE o_orderkey % 3 = 0
        UNION ALL SELECT NULL, o_custkey, o_orderdate FROM o WHERE o_orderkey % 5 = 0
        UNION ALL SELECT o_orderkey, NULL, o_orderdate FROM o WHERE o_orderkey % 7 = 0)
"""


@query("silver_cleaning", "P1 Q1 Q3", sql=_DIRTY + """
SELECT 'raw' AS stage, count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_keys FROM bad UNION ALL
SELECT 'clean', count(*), count(DISTINCT o_orderkey) FROM (
  SELECT DISTINCT o_orderkey FROM bad WHERE o_orderkey IS NOT NULL AND o_custkey IS NOT NULL)""")
def silver_cleaning(spark, sf):
    """The silver cleaning of orders on repeated and incomplete rows made from the table."""
    from tabflow.jobs.star import clean_orders

    od = tbl(spark, sf, "orders")
    raw = od.unionByName(od.where("o_orderkey % 3 = 0")) \
        .unionByName(od.where("o_orderkey % 5 = 0").withColumn("o_orderkey", F.lit(None).cast(od.schema["o_orderkey"].dataType))) \
        .unionByName(od.where("o_orderkey % 7 = 0").withColumn("o_custkey", F.lit(None).cast(od.schema["o_custkey"].dataType)))
    count = lambda df, stage: df.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("o_orderkey").alias("n_keys")) \
        .select(F.lit(stage).alias("stage"), "n_rows", "n_keys")
    return count(raw, "raw").unionByName(count(clean_orders(raw), "clean"))
