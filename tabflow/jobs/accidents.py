"""Bronze -> silver -> gold job for the four-table road-accident data set
(semicolon CSV files joined on ``Num_Acc``).

Cleaning filters *before* de-duplicating and de-duplicates with a total
order, so the surviving row never depends on task order. Silver is written
once (lineage cut) and gold reads it back with declared schemas.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabflow.functions import codes
from tabflow.functions.columns import band
from tabflow.operators.quality import dedupe_by_key, observe_counts
from tabflow.operators.windows import top_n_per_group
from tabflow.schemas import ACCIDENT_TABLES
from tabflow.sources.files import CORRUPT_COL, read_delimited, read_layer, write_layer, write_report


def read_bronze(spark: SparkSession, paths: dict[str, str], encoding: str = "UTF-8") -> dict[str, DataFrame]:
    """The four CSV tables, each with the raw line of rows that did not parse."""
    return {name: read_delimited(spark, paths[name], schema, sep=";", encoding=encoding, keep_corrupt=True)
            for name, schema in ACCIDENT_TABLES.items()}



def gold_order(name: str) -> list:
    """The order in which each gold report is written."""
    return {"accidents_par_departement": [F.desc("nombre_accidents"), F.asc("dep")],
            "gravite_par_meteo": [F.asc("condition_meteo"), F.desc("nombre_usagers"), F.asc("gravite")],
            "top_departements_par_mois": [F.asc("mois"), F.asc("rang")],
            "gravite_par_type_route": [F.asc("type_route"), F.desc("nombre_usagers"), F.asc("gravite")]}[name]


def clean_accidents(df: DataFrame, year: int) -> DataFrame:
    c = F.col
    dep = F.trim(c("dep"))
    return dedupe_by_key(
        df.filter(c("Num_Acc").isNotNull() & c("mois").between(1, 12) & c("jour").between(1, 31)
                  & c("dep").isNotNull() & (dep != ""))
          .withColumns({"dep": dep, "annee": F.lit(year),
                        "condition_meteo": codes.decode("atm", codes.WEATHER, codes.WEATHER_DEFAULT),
                        "luminosite": codes.decode("lum", codes.LIGHT, codes.LIGHT_DEFAULT)}),
        ["Num_Acc"], [F.asc("jour"), F.asc("hrmn")])


def clean_places(df: DataFrame) -> DataFrame:
    return dedupe_by_key(
        df.filter(F.col("Num_Acc").isNotNull())
          .withColumns({"type_route": codes.decode("catr", codes.ROAD, codes.ROAD_DEFAULT),
                        "surface_route": codes.decode("surf", codes.SURFACE, codes.SURFACE_DEFAULT)}),
        ["Num_Acc"], [F.asc_nulls_last("catr")])


def clean_users(df: DataFrame, year: int) -> DataFrame:
    c = F.col
    age = F.when(c("an_nais").isNotNull() & (c("an_nais") > 1900) & (c("an_nais") <= year),
                 F.lit(year) - c("an_nais"))
    return dedupe_by_key(
        df.filter(c("Num_Acc").isNotNull() & c("grav").isin(1, 2, 3, 4))
          .withColumns({"gravite": codes.decode("grav", codes.SEVERITY, codes.SEVERITY_DEFAULT),
                        "categorie_usager": codes.decode("catu", codes.USER_KIND, codes.USER_KIND_DEFAULT),
                        "sexe_libelle": codes.decode("sexe", codes.SEX, codes.SEX_DEFAULT),
                        "age": age})
          .withColumn("classe_age", band("age", codes.AGE_EDGES, codes.AGE_LABELS,
                                         null_label=codes.AGE_UNKNOWN)),
        ["Num_Acc", "id_usager"], [F.asc_nulls_last("grav")])


def clean_vehicles(df: DataFrame) -> DataFrame:
    return dedupe_by_key(
        df.filter(F.col("Num_Acc").isNotNull())
          .withColumn("type_vehicule_simplifie",
                      codes.decode_many("catv", codes.VEHICLE_GROUPS, codes.VEHICLE_DEFAULT)),
        ["Num_Acc", "id_vehicule", "num_veh"], [F.asc_nulls_last("catv")])


def write_silver(tables: dict[str, DataFrame], root: str) -> dict[str, str]:
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{root.rstrip('/')}/{name}"
        write_layer(df, paths[name], partition_by=["dep"] if name == "caracteristiques" else ())
    return paths


def clean_all(raw: dict[str, DataFrame], year: int) -> tuple[dict[str, DataFrame], dict[str, Observation]]:
    """Clean the four tables with row counters on the raw input and on the
    cleaned output; the counters fill during the silver write (one pass)."""
    cleaners = {"caracteristiques": lambda d: clean_accidents(d, year), "lieux": clean_places,
                "usagers": lambda d: clean_users(d, year), "vehicules": clean_vehicles}
    clean, obs = {}, {}
    for name, fn in cleaners.items():
        table = raw[name]
        if CORRUPT_COL in table.columns:
            seen = Observation(f"{name}_corrupt")
            table = table.observe(seen, F.count(F.col(CORRUPT_COL)).alias("rows")).drop(CORRUPT_COL)
            obs[f"{name}_corrupt"] = seen
        raw_df, obs[f"{name}_raw"] = observe_counts(table, f"{name}_raw")
        clean[name], obs[f"{name}_clean"] = observe_counts(fn(raw_df), f"{name}_clean")
    return clean, obs


def read_silver(spark: SparkSession, paths: dict[str, str], schemas: dict[str, T.StructType]) -> dict[str, DataFrame]:
    return {n: read_layer(spark, p, schemas[n]) for n, p in paths.items()}


def gold_tables(silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
    acc, places, users = silver["caracteristiques"], silver["lieux"], silver["usagers"]
    by_dep = acc.groupBy("dep").agg(F.countDistinct("Num_Acc").alias("nombre_accidents"))
    acc_users = acc.join(users, on="Num_Acc", how="inner")
    weather = (acc_users.groupBy("condition_meteo", "gravite")
               .agg(F.count(F.lit(1)).alias("nombre_usagers")))
    month_dep = acc.groupBy("mois", "dep").agg(F.countDistinct("Num_Acc").alias("nombre_accidents"))
    top5 = top_n_per_group(month_dep, ["mois"], [F.desc("nombre_accidents"), F.asc("dep")], 5, "rang")
    road = (acc.join(places, on="Num_Acc", how="inner").join(users, on="Num_Acc", how="inner")
            .groupBy("type_route", "gravite").agg(F.count(F.lit(1)).alias("nombre_usagers")))
    return {"accidents_par_departement": by_dep, "gravite_par_meteo": weather,
            "top_departements_par_mois": top5, "gravite_par_type_route": road}


def run(spark: SparkSession, bronze_paths: dict[str, str], silver_root: str, gold_root: str,
        year: int) -> tuple[dict[str, str], dict[str, int]]:
    """Whole job; returns the gold report paths (one CSV file each) and the
    row counts per table: raw lines, those with a field that did not parse, and
    rows after cleaning (gathered by the silver write itself, no re-scan)."""
    raw = read_bronze(spark, bronze_paths)
    clean, obs = clean_all(raw, year)
    schemas = {n: df.schema for n, df in clean.items()}
    silver = read_silver(spark, write_silver(clean, silver_root), schemas)
    counts = {name: int(o.get["rows"]) for name, o in obs.items()}
    out = {}
    for name, df in gold_tables(silver).items():
        out[name] = f"{gold_root.rstrip('/')}/{name}"
        write_report(df, out[name], order_by=gold_order(name))
    return out, counts
