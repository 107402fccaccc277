"""Mart (gold) models."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmix.functions import kpis
from gridmix.functions.cleaning import rnd

MART_NATIONAL_COLUMNS = [
    "date_heure", "heure", "saison", "jour_semaine", "mois", "annee", "flag_weekend",
    "flag_covid", "flag_crise_nuc_2022", "consommation_mw", "prevision_j1_mw",
    "prevision_j_mw", "ecart_prevision_mw", "nucleaire_mw", "hydraulique_mw", "eolien_mw",
    "solaire_mw", "gaz_mw", "fioul_mw", "charbon_mw", "bioenergies_mw", "pompage_mw",
    "ech_physiques_mw", "taux_co2", "indice_vert", "part_bas_carbone", "part_renouvelables",
    "part_fossiles", "_loaded_at",
]
PATTERN_KEYS = ["heure", "saison", "jour_semaine", "flag_weekend"]
REGIONAL_MONTH_KEYS = ["annee", "mois", "libelle_region", "code_insee_region"]
GREEN_HOURS_COLUMNS = [
    "saison", "rang", "heure_optimale", "co2_moyen", "co2_heure_pointe",
    "gain_vs_pointe_gco2", "gain_vs_pointe_pct", "emission_zoe_kg_co2",
    "emission_zoe_pointe_kg_co2", "nb_observations",
]
TOP_N = 3


def mart_national(enriched: DataFrame) -> DataFrame:
    """One row per half-hour reading with the forecast gap (29 columns)."""
    return enriched.withColumn("ecart_prevision_mw", kpis.forecast_gap()).select(
        *MART_NATIONAL_COLUMNS)


def pattern_aggregates(enriched: DataFrame) -> DataFrame:
    """Hour × season × weekday cells outside the flagged periods.

    Hash aggregation with a partial (map-side) step: at most 672 groups, so
    the shuffle after the partial step carries a few hundred rows per task
    whatever the input size or key skew.
    """
    src = enriched.filter((F.col("flag_crise_nuc_2022") == 0) & (F.col("flag_covid") == 0))
    return src.groupBy(*PATTERN_KEYS).agg(
        rnd(F.avg("taux_co2"), 2).alias("avg_taux_co2"),
        rnd(F.min("taux_co2"), 2).alias("min_taux_co2"),
        rnd(F.max("taux_co2"), 2).alias("max_taux_co2"),
        rnd(F.stddev_samp("taux_co2"), 2).alias("stddev_taux_co2"),
        F.count(F.lit(1)).alias("nb_observations"),
        rnd(F.avg("part_bas_carbone"), 4).alias("avg_part_bas_carbone"),
        rnd(F.avg("part_renouvelables"), 4).alias("avg_part_renouvelables"),
        rnd(F.avg("part_fossiles"), 4).alias("avg_part_fossiles"),
        rnd(F.avg("consommation_mw"), 2).alias("avg_consommation_mw"),
        rnd(F.avg("nucleaire_mw"), 2).alias("avg_nucleaire_mw"),
        rnd(F.avg("eolien_mw"), 2).alias("avg_eolien_mw"),
        rnd(F.avg("solaire_mw"), 2).alias("avg_solaire_mw"),
        rnd(F.avg("gaz_mw"), 2).alias("avg_gaz_mw"))


def rank_by_season(cells: DataFrame) -> DataFrame:
    w = Window.partitionBy("saison").orderBy(F.col("avg_taux_co2").asc_nulls_last())
    return cells.withColumn("rang_heure_par_saison", F.rank().over(w))


def rank_global(cells: DataFrame) -> DataFrame:
    """Rank over all cells. A window without partition runs in one task; the
    input is the aggregated cell table (≤ 24 × 4 × 7 = 672 rows), so the
    single partition is bounded by construction."""
    w = Window.orderBy(F.col("avg_taux_co2").asc_nulls_last())
    return cells.withColumn("rang_global", F.rank().over(w))


def mart_patterns(enriched: DataFrame) -> DataFrame:
    """Cells with their rank in the season and over all cells.

    The global rank runs first: its single partition (≤ 672 cells) also
    satisfies the per-season window, so no further exchange is planned.
    """
    return ranked_patterns(pattern_aggregates(enriched))


def ranked_patterns(cells: DataFrame) -> DataFrame:
    ranked = rank_by_season(rank_global(cells))
    return ranked.select(*cells.columns, "rang_heure_par_saison", "rang_global")


def season_peak(patterns: DataFrame) -> DataFrame:
    """Per season the highest and lowest (already rounded) cell mean."""
    return patterns.groupBy("saison").agg(
        F.max("avg_taux_co2").alias("co2_heure_pointe"),
        F.min("avg_taux_co2").alias("co2_heure_min"))


def green_hours(patterns: DataFrame, battery_kwh: float = kpis.EV_BATTERY_KWH,
                top_n: int = TOP_N, ordered: bool = True) -> DataFrame:
    """Top cells per season with the saving against the season's peak.

    The per-season peak (the cells' highest rounded mean) is attached with
    a window over the season instead of a second aggregation joined back:
    the same rows as the equi-join on ``saison``, computed in the same pass
    over the cells. At most 672 cells, so the final sort runs in one
    partition.
    """
    season = Window.partitionBy("saison")
    p = (patterns.withColumn("co2_heure_pointe", F.max("avg_taux_co2").over(season))
         .filter(F.col("rang_heure_par_saison") <= top_n))
    gain = F.col("co2_heure_pointe") - F.col("avg_taux_co2")
    out = p.select(
        "saison",
        F.col("rang_heure_par_saison").alias("rang"),
        F.col("heure").alias("heure_optimale"),
        F.col("avg_taux_co2").alias("co2_moyen"),
        "co2_heure_pointe",
        rnd(gain, 2).alias("gain_vs_pointe_gco2"),
        rnd(gain / F.nullif(F.col("co2_heure_pointe"), F.lit(0)) * 100, 1).alias("gain_vs_pointe_pct"),
        kpis.ev_charge_kg("avg_taux_co2", battery_kwh).alias("emission_zoe_kg_co2"),
        kpis.ev_charge_kg("co2_heure_pointe", battery_kwh).alias("emission_zoe_pointe_kg_co2"),
        "nb_observations")
    return out.repartition(1).sortWithinPartitions("saison", "rang") if ordered else out


def mart_regional_monthly(enriched: DataFrame, ordered: bool = True) -> DataFrame:
    """Monthly regional aggregates (partial aggregation before the shuffle)."""
    out = enriched.groupBy(*REGIONAL_MONTH_KEYS).agg(
        rnd(F.avg("consommation_mw"), 2).alias("avg_consommation_mw"),
        rnd(F.avg("production_totale_mw"), 2).alias("avg_production_mw"),
        rnd(F.avg("nucleaire_mw"), 2).alias("avg_nucleaire_mw"),
        rnd(F.avg("eolien_mw"), 2).alias("avg_eolien_mw"),
        rnd(F.avg("solaire_mw"), 2).alias("avg_solaire_mw"),
        rnd(F.avg("hydraulique_mw"), 2).alias("avg_hydraulique_mw"),
        rnd(F.avg("thermique_mw"), 2).alias("avg_thermique_mw"),
        rnd(F.avg("bioenergies_mw"), 2).alias("avg_bioenergies_mw"),
        rnd(F.avg("autosuffisance"), 4).alias("autosuffisance_moyenne"),
        rnd(F.avg("part_renouvelables"), 4).alias("part_renouvelables_moyenne"),
        rnd(F.avg("part_bas_carbone"), 4).alias("part_bas_carbone_moyenne"),
        rnd(F.avg("tco_renouvelables"), 2).alias("tco_renouvelables_moyen"),
        F.max("flag_covid").alias("flag_covid"),
        F.max("flag_crise_nuc_2022").alias("flag_crise_nuc_2022"),
        F.count(F.lit(1)).alias("nb_observations"))
    # one row per (year, month, region): bounded by dimensions, not by
    # readings, so the ordered output is produced in one partition
    return (out.repartition(1).sortWithinPartitions("annee", "mois", "libelle_region")
            if ordered else out)
