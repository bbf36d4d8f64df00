from pyspark.sql import functions as F

from tabflow.jobs import accidents
from tabflow.operators.upsert import upsert_layer
from tabflow.sources.files import read_layer, write_layer

HEAD = {
    "caracteristiques": "Num_Acc;jour;mois;an;hrmn;lum;dep;com;agg;int;atm;col;adr;lat;long",
    "lieux": "Num_Acc;catr;voie;v1;v2;circ;nbv;vosp;prof;pr;pr1;plan;lartpc;larrout;surf;infra;situ;vma",
    "usagers": "Num_Acc;id_usager;id_vehicule;num_veh;place;catu;grav;sexe;an_nais;trajet;secu1;secu2;secu3;"
               "locp;actp;etatp",
    "vehicules": "Num_Acc;id_vehicule;num_veh;senc;catv;obs;obsm;choc;manv;motor;occutc",
}
ROWS = {
    "caracteristiques": [
        "A1;1;1;2023;08:00;1;01;001;1;1;1;1;x;0;0",
        "A1;1;13;2023;08:00;1;01;001;1;1;1;1;x;0;0",     # duplicate with bad month -> filtered first
        "A2;2;1;2023;09:00;5;2A;002;1;1;2;1;x;0;0",
        "A3;3;2;2023;10:00;2; 75 ;003;1;1;-1;1;x;0;0",   # blanks trimmed, unknown weather code
        ";3;2;2023;10:00;2;75;003;1;1;1;1;x;0;0",        # null key
        "A4;3;2;2023;10:00;2;  ;003;1;1;1;1;x;0;0",      # blank department
    ],
    "lieux": ["A1;1;;;;;;;;;;;;;1;;;", "A1;3;;;;;;;;;;;;;2;;;", "A2;4;;;;;;;;;;;;;9;;;", "A3;9;;;;;;;;;;;;;1;;;"],
    "usagers": [
        "A1;u1;v1;A01;1;1;1;1;1990;;;;;;;", "A1;u1;v1;A01;1;1;1;1;1990;;;;;;;",
        "A1;u2;v1;A01;1;2;2;2;2024;;;;;;;", "A2;u3;v2;B01;1;3;3;1;1900;;;;;;;",
        "A3;u4;v3;C01;1;1;4;2;2005;;;;;;;", "A3;u5;v3;C01;1;1;0;2;2005;;;;;;;",
    ],
    "vehicules": ["A1;v1;A01;1;7;;;;;;", "A2;v2;B01;1;33;;;;;;", "A3;v3;C01;1;99;;;;;;"],
}


def test_accident_medallion_job(spark, tmp_path):
    paths = {}
    for name, head in HEAD.items():
        p = tmp_path / f"{name}.csv"
        p.write_text(head + "\n" + "\n".join(ROWS[name]) + "\n", encoding="utf-8")
        paths[name] = str(p)
    out, counts = accidents.run(spark, paths, str(tmp_path / "silver"), str(tmp_path / "gold"), 2023)
    assert counts["caracteristiques_raw"] == 6 and counts["caracteristiques_clean"] == 3
    assert counts["usagers_raw"] == 6 and counts["usagers_clean"] == 4
    assert counts["lieux_raw"] == 4 and counts["lieux_clean"] == 3
    gold = {n: spark.read.option("header", True).csv(p) for n, p in out.items()}
    by_dep = {r.dep: int(r.nombre_accidents) for r in gold["accidents_par_departement"].collect()}
    assert by_dep == {"01": 1, "2A": 1, "75": 1}
    weather = {(r.condition_meteo, r.gravite): int(r.nombre_usagers) for r in gold["gravite_par_meteo"].collect()}
    assert sum(weather.values()) == 4  # u1 deduped, u5 (grav 0) dropped
    assert weather[("Non renseigné", "Blessé léger")] == 1
    silver_users = spark.read.parquet(str(tmp_path / "silver" / "usagers"))
    ages = {r.id_usager: (r.age, r.classe_age) for r in silver_users.collect()}
    assert ages["u2"] == (None, "Non renseigné") and ages["u3"] == (None, "Non renseigné")
    assert ages["u4"] == (18, "18-29 ans")
    places = {r.Num_Acc: r.type_route for r in spark.read.parquet(str(tmp_path / "silver" / "lieux")).collect()}
    assert places["A1"] == "Autoroute"  # deterministic survivor (lowest catr)
    road = gold["gravite_par_type_route"]
    assert sum(int(r.nombre_usagers) for r in road.collect()) == 4


def test_upsert_rewrites_only_touched_partitions(spark, tmp_path):
    base = spark.createDataFrame([(1, "a", 10.0), (2, "a", 20.0), (3, "b", 30.0), (4, "c", 40.0)],
                                 "k int, part string, v double")
    path = str(tmp_path / "layer")
    write_layer(base, path, partition_by=["part"])
    c_files = sorted(p.name for p in (tmp_path / "layer" / "part=c").iterdir())
    changes = spark.createDataFrame([(2, "b", 21.0, 1), (2, "b", 22.0, 2), (5, "a", 50.0, 1)],
                                    "k int, part string, v double, seq int")
    upsert_layer(spark, path, changes, ["k"], [F.desc("seq")], ["part"], schema=base.schema)
    out = sorted(tuple(r) for r in read_layer(spark, path, base.schema).select("k", "part", "v").collect())
    assert out == [(1, "a", 10.0), (2, "b", 22.0), (3, "b", 30.0), (4, "c", 40.0), (5, "a", 50.0)]
    assert sorted(p.name for p in (tmp_path / "layer" / "part=c").iterdir()) == c_files


def test_upsert_removes_partition_left_empty(spark, tmp_path):
    base = spark.createDataFrame([(1, "a", 1.0), (2, "b/x", 2.0)], "k int, part string, v double")
    path = str(tmp_path / "layer2")
    write_layer(base, path, partition_by=["part"])
    changes = spark.createDataFrame([(2, "a", 3.0, 1)], "k int, part string, v double, seq int")
    upsert_layer(spark, path, changes, ["k"], [F.desc("seq")], ["part"], schema=base.schema)
    out = sorted(tuple(r) for r in read_layer(spark, path, base.schema).select("k", "part", "v").collect())
    assert out == [(1, "a", 1.0), (2, "a", 3.0)]


def test_upsert_with_null_partitions_loses_no_row(spark, tmp_path):
    base = spark.createDataFrame([(1, "a", 1.0), (2, None, 2.0), (3, None, 3.0), (4, "b", 4.0)],
                                 "k int, part string, v double")
    path = str(tmp_path / "layer3")
    write_layer(base, path, partition_by=["part"])
    changes = spark.createDataFrame([(2, None, 20.0, 1), (5, None, 50.0, 1), (4, None, 40.0, 1), (1, "b", 10.0, 1)],
                                    "k int, part string, v double, seq int")
    upsert_layer(spark, path, changes, ["k"], [F.desc("seq")], ["part"], schema=base.schema)
    out = sorted(tuple(r) for r in read_layer(spark, path, base.schema).select("k", "part", "v").collect())
    assert out == [(1, "b", 10.0), (2, None, 20.0), (3, None, 3.0), (4, None, 40.0), (5, None, 50.0)]


def test_silver_buckets_are_one_file_for_each_partition_value(spark, sf, tmp_path):
    from tabflow.jobs import star

    silver = star.build_silver(spark, sf, root=str(tmp_path / "silver"), buckets=4)
    years = silver["orders"].select("order_year").distinct().count()
    assert len(list((tmp_path / "silver" / "lineitem").rglob("part-*.parquet"))) <= 4
    assert len(list((tmp_path / "silver" / "orders").rglob("part-*.parquet"))) <= 4 * years


def test_silver_buckets_grow_with_the_input(spark, sf, tmp_path, monkeypatch):
    from tabflow.jobs import star

    assert [star.buckets_for(n) for n in (0, 1 << 30, 8 << 30, (8 << 30) + 1, 100 << 40)] == [32, 32, 32, 64, 1 << 19]
    monkeypatch.setattr(star, "input_bytes", lambda *a: 9 << 30)
    silver = star.build_silver(spark, sf, root=str(tmp_path / "silver"))
    assert 32 < len(list((tmp_path / "silver" / "lineitem").rglob("part-*.parquet"))) <= 64
    assert silver["lineitem"].count() == spark.read.parquet(f"{sf}/lineitem.parquet").distinct().count()
