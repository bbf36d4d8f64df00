"""Code -> label decoding.

Small, fixed code tables are applied as a literal map expression (no join, no
shuffle, stays in codegen). Code tables that arrive as DataFrames go through
``tabflow.operators.relational.lookup_join`` so their size is checked before
any broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Code tables of the road-accident open data (2023 files).
# These labels are output values and must stay exactly as published.
# ---------------------------------------------------------------------------
WEATHER = {
    1: "Normale", 2: "Pluie légère", 3: "Pluie forte", 4: "Neige / grêle",
    5: "Brouillard / fumée", 6: "Vent fort / tempête", 7: "Temps éblouissant",
    8: "Temps couvert", 9: "Autre",
}
WEATHER_DEFAULT = "Non renseigné"
LIGHT = {
    1: "Plein jour", 2: "Crépuscule ou aube", 3: "Nuit sans éclairage public",
    4: "Nuit avec éclairage public non allumé", 5: "Nuit avec éclairage public allumé",
}
LIGHT_DEFAULT = "Non renseigné"
ROAD = {
    1: "Autoroute", 2: "Route nationale", 3: "Route départementale",
    4: "Voie communale", 5: "Hors réseau public", 6: "Parc de stationnement",
    7: "Route de métropole urbaine",
}
ROAD_DEFAULT = "Autre / non renseigné"
SURFACE = {
    1: "Normale", 2: "Mouillée", 3: "Flaques", 4: "Inondée", 5: "Enneigée",
    6: "Boue", 7: "Verglacée", 8: "Corps gras / huile", 9: "Autre",
}
SURFACE_DEFAULT = "Non renseigné"
SEVERITY = {1: "Indemne", 2: "Tué", 3: "Blessé hospitalisé", 4: "Blessé léger"}
SEVERITY_DEFAULT = "Non renseigné"
USER_KIND = {1: "Conducteur", 2: "Passager", 3: "Piéton"}
USER_KIND_DEFAULT = "Autre / non renseigné"
SEX = {1: "Masculin", 2: "Féminin"}
SEX_DEFAULT = "Non renseigné"
VEHICLE_GROUPS = {
    "Deux-roues": [1, 2, 30, 31, 32, 33, 34],
    "Voiture": [7, 10],
    "Poids lourd / transport": [13, 14, 15],
    "Transport en commun": [37, 38, 39, 40],
}
VEHICLE_DEFAULT = "Autre"
AGE_EDGES = [18, 30, 45, 60]
AGE_LABELS = ["Moins de 18 ans", "18-29 ans", "30-44 ans", "45-59 ans", "60 ans et plus"]
AGE_UNKNOWN = "Non renseigné"
# ---------------------------------------------------------------------------


def code_map(table: Mapping) -> Column:
    """Literal map column built from a small, fixed code table."""
    pairs = []
    for code, label in table.items():
        pairs.extend([F.lit(code), F.lit(label)])
    return F.create_map(*pairs)


def decode(col, table: Mapping, default: str | None = None) -> Column:
    """Label for ``col`` from a fixed code table, ``default`` when unmatched.

    Uses ``try_element_at`` so an unknown code never raises under ANSI mode.
    """
    c = F.col(col) if isinstance(col, str) else col
    label = F.try_element_at(code_map(table), c)
    return label if default is None else F.coalesce(label, F.lit(default))


def group_codes(groups: Mapping[str, Sequence]) -> dict:
    """Invert ``{category: [codes]}`` into a code -> category table."""
    out = {}
    for category, codes in groups.items():
        for code in codes:
            if code in out:
                raise ValueError(f"code {code!r} in two groups")
            out[code] = category
    return out


def decode_many(col, groups: Mapping[str, Sequence], default: str) -> Column:
    """Many codes -> one category (n:1 code table), ``default`` otherwise."""
    return decode(col, group_codes(groups), default)


def decode_with_table(df: DataFrame, col: str, codes: DataFrame, code_col: str,
                      label_col: str, out: str, default: str,
                      max_broadcast_rows: int = 1_000_000) -> DataFrame:
    """Decode through a code-table DataFrame. A code that the table repeats takes its
    smallest label, so the left join keeps the row count; the table is broadcast
    only when it has at most ``max_broadcast_rows`` rows."""
    from tabflow.operators.relational import lookup_join

    table = codes.groupBy(F.col(code_col).alias("__code")).agg(F.min(label_col).alias("__label"))
    joined = lookup_join(df, table, left_on=col, right_on="__code", how="left", strategy="broadcast",
                         max_broadcast_rows=max_broadcast_rows)
    return (joined.withColumn(out, F.coalesce(F.col("__label"), F.lit(default)))
            .drop("__code", "__label"))
