"""Enriched (intermediate) models: calendar dimensions, flags and KPIs.

Narrow transformations only — no shuffle; they fuse with the staging scan
into one code-generated stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from gridmix.functions import kpis
from gridmix.functions.timedims import national_time_columns, regional_time_columns

INT_NATIONAL_BASE = [
    "date_heure", "consommation_mw", "prevision_j1_mw", "prevision_j_mw", "nucleaire_mw",
    "hydraulique_mw", "eolien_mw", "solaire_mw", "gaz_mw", "fioul_mw", "charbon_mw",
    "bioenergies_mw", "pompage_mw", "ech_physiques_mw", "taux_co2", "_loaded_at",
]
INT_REGIONAL_BASE = [
    "date_heure", "code_insee_region", "libelle_region", "consommation_mw", "thermique_mw",
    "nucleaire_mw", "eolien_mw", "solaire_mw", "hydraulique_mw", "pompage_mw",
    "bioenergies_mw", "ech_physiques_mw", "eolien_terrestre_mw", "eolien_offshore_mw",
    "tco_thermique", "tco_nucleaire", "tco_eolien", "tco_solaire", "tco_hydraulique",
    "tco_bioenergies", "_loaded_at",
]


def int_national(stg: DataFrame) -> DataFrame:
    """Enriched national readings (the five exchange columns are pruned)."""
    derived = {
        **national_time_columns("date_heure"),
        "indice_vert": kpis.green_index("taux_co2"),
        "part_bas_carbone": kpis.share_low_carbon(),
        "part_renouvelables": kpis.share_renewable(),
        "part_fossiles": kpis.share_fossil(),
    }
    return stg.select(*INT_NATIONAL_BASE, *[v.alias(k) for k, v in derived.items()])


def int_regional(stg: DataFrame) -> DataFrame:
    """Enriched regional readings. Production total is computed once and
    reused by the self-sufficiency ratio."""
    base = stg.select(*INT_REGIONAL_BASE,
                      *[v.alias(k) for k, v in regional_time_columns("date_heure").items()],
                      kpis.production_total().alias("production_totale_mw"))
    return base.select(
        *base.columns,
        kpis.self_sufficiency("production_totale_mw").alias("autosuffisance"),
        kpis.flag_importer().alias("flag_importatrice"),
        kpis.share_renewable().alias("part_renouvelables"),
        kpis.share_low_carbon().alias("part_bas_carbone"),
        kpis.tco_renewable().alias("tco_renouvelables"))
