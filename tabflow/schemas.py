"""Declared schemas. Layers are always read back with one of these, so
partition columns keep their declared type (no leading-zero loss) and a file
with a moved column fails loudly instead of shifting values."""

from __future__ import annotations

from pyspark.sql import types as T


def _s(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


S, I, L, D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
NTZ = T.TimestampNTZType()

# Star-schema tables used by the registered queries.
DRIVER = {
    "region": _s(("r_regionkey", I), ("r_name", S)),
    "nation": _s(("n_nationkey", I), ("n_name", S), ("n_regionkey", I)),
    "customer": _s(("c_custkey", L), ("c_name", S), ("c_nationkey", I), ("c_acctbal", D),
                   ("c_mktsegment", S)),
    "supplier": _s(("s_suppkey", L), ("s_name", S), ("s_nationkey", I), ("s_acctbal", D)),
    "part": _s(("p_partkey", L), ("p_name", S), ("p_brand", S), ("p_type", S), ("p_size", I),
               ("p_retailprice", D)),
    "orders": _s(("o_orderkey", L), ("o_custkey", L), ("o_orderstatus", S), ("o_totalprice", D),
                 ("o_orderdate", NTZ), ("o_orderpriority", S)),
    "lineitem": _s(("l_orderkey", L), ("l_partkey", L), ("l_suppkey", L), ("l_linenumber", I),
                   ("l_quantity", D), ("l_extendedprice", D), ("l_discount", D), ("l_tax", D),
                   ("l_returnflag", S), ("l_linestatus", S), ("l_shipdate", NTZ)),
    "events": _s(("event_id", L), ("ts", NTZ), ("user_id", L), ("event_type", S), ("value", D),
                 ("props", S)),
}

# Four related tables of the road-accident open data (semicolon CSV, header).
# Field order matters: CSV schemas are positional.
ACCIDENTS = _s(("Num_Acc", S), ("jour", I), ("mois", I), ("an", I), ("hrmn", S), ("lum", I),
               ("dep", S), ("com", S), ("agg", I), ("int", I), ("atm", I), ("col", I),
               ("adr", S), ("lat", S), ("long", S))
PLACES = _s(("Num_Acc", S), ("catr", I), ("voie", S), ("v1", S), ("v2", S), ("circ", I),
            ("nbv", S), ("vosp", I), ("prof", I), ("pr", S), ("pr1", S), ("plan", I),
            ("lartpc", S), ("larrout", S), ("surf", I), ("infra", I), ("situ", I), ("vma", I))
USERS = _s(("Num_Acc", S), ("id_usager", S), ("id_vehicule", S), ("num_veh", S), ("place", I),
           ("catu", I), ("grav", I), ("sexe", I), ("an_nais", I), ("trajet", I), ("secu1", I),
           ("secu2", I), ("secu3", I), ("locp", I), ("actp", S), ("etatp", I))
VEHICLES = _s(("Num_Acc", S), ("id_vehicule", S), ("num_veh", S), ("senc", I), ("catv", I),
              ("obs", I), ("obsm", I), ("choc", I), ("manv", I), ("motor", I), ("occutc", I))
ACCIDENT_TABLES = {"caracteristiques": ACCIDENTS, "lieux": PLACES, "usagers": USERS,
                   "vehicules": VEHICLES}
