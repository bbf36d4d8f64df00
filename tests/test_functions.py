from pyspark.sql import functions as F

from tabflow.functions import codes
from tabflow.functions.columns import band, days_between, in_range, minutes_between, safe_ratio


def test_band_first_match_and_null(spark):
    df = spark.createDataFrame([(None,), (1.9,), (2.0,), (7.99,), (8.0,), (100.0,)], "x double")
    out = df.select(band("x", [2, 8], ["short", "medium", "long"]).alias("b")).collect()
    assert [r.b for r in out] == [None, "short", "medium", "medium", "long", "long"]
    out = df.select(band("x", [2, 8], ["s", "m", "l"], null_label="unknown").alias("b")).collect()
    assert out[0].b == "unknown"


def test_safe_ratio_zero_and_negative(spark):
    df = spark.createDataFrame([(10.0, 2.0), (10.0, 0.0), (10.0, -1.0), (10.0, None)], "n double, d double")
    assert [r.r for r in df.select(safe_ratio("n", "d").alias("r")).collect()] == [5.0, None, None, None]


def test_minutes_between_ntz_and_tz(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 10:00:00' a, TIMESTAMP_NTZ '2024-01-01 11:30:00' b")
    r = df.select(minutes_between("a", "b").alias("m"), days_between("a", "b").alias("d")).first()
    assert r.m == 90.0 and abs(r.d - 90 / 1440) < 1e-12
    df2 = df.select(F.col("a").cast("timestamp").alias("a"), F.col("b").cast("timestamp").alias("b"))
    assert df2.select(minutes_between("a", "b")).first()[0] == 90.0


def test_in_range_ends(spark):
    df = spark.createDataFrame([(1000.0,), (50000.0,), (500.0,), (700.0,)], "p double")
    both = df.filter(in_range("p", 1000, 50000, "both")).count()
    neither = df.filter(in_range("p", 500, 50000, "neither")).count()
    assert both == 2 and neither == 2


def test_decode_default_and_unknown_codes(spark):
    df = spark.createDataFrame([(1,), (9,), (-1,), (None,), (42,)], "atm int")
    out = [r.l for r in df.select(codes.decode("atm", codes.WEATHER, codes.WEATHER_DEFAULT).alias("l")).collect()]
    assert out == ["Normale", "Autre", "Non renseigné", "Non renseigné", "Non renseigné"]


def test_decode_many_to_one(spark):
    df = spark.createDataFrame([(1,), (7,), (14,), (38,), (99,)], "catv int")
    out = [r.g for r in df.select(codes.decode_many("catv", codes.VEHICLE_GROUPS, codes.VEHICLE_DEFAULT)
                                  .alias("g")).collect()]
    assert out == ["Deux-roues", "Voiture", "Poids lourd / transport", "Transport en commun", "Autre"]


def test_decode_with_table_keeps_row_count(spark):
    facts = spark.createDataFrame([(1,), (2,), (3,), (3,)], "code int")
    table = spark.createDataFrame([(1, "one"), (3, "three")], "c int, label string")
    out = codes.decode_with_table(facts, "code", table, "c", "label", "lbl", "n/a")
    assert sorted(r.lbl for r in out.collect()) == ["n/a", "one", "three", "three"]


def test_decode_with_a_repeated_code_keeps_the_rows(spark):
    facts = spark.createDataFrame([(1,), (2,), (None,)], "code int")
    table = spark.createDataFrame([(1, "b"), (1, "a"), (3, "c")], "c int, label string")
    out = codes.decode_with_table(facts, "code", table, "c", "label", "lbl", "n/a")
    assert sorted((r.code or 0, r.lbl) for r in out.collect()) == [(0, "n/a"), (1, "a"), (2, "n/a")]
