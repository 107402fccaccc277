"""Dashboard questions over the marts (definitions are ours; the dashboards'
own queries are not part of the source material).

Windows without a partition run in one task; each is applied to an
aggregated table whose size is bounded by a dimension (years, regions),
never by the number of readings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmix.functions.cleaning import rnd
from gridmix.functions.timedims import SEASON_NAMES

# Hours compared by the "charge at noon, not in the evening" card.
NOON_HOUR = 12
EVENING_HOURS = (18, 21)


def _typical(enriched: DataFrame) -> DataFrame:
    """Readings outside the flagged periods (same rule as the patterns mart)."""
    return enriched.filter((F.col("flag_crise_nuc_2022") == 0) & (F.col("flag_covid") == 0))


def latest_index(mart: DataFrame) -> DataFrame:
    """Is it green now? The latest reading and its index (top-1, no sort)."""
    return mart.orderBy(F.col("date_heure").desc_nulls_last()).limit(1).select(
        "date_heure", "taux_co2", "indice_vert", "part_bas_carbone", "part_renouvelables")


def yearly_co2(mart: DataFrame) -> DataFrame:
    """Mean CO2 per year and how many times lower it is than the first year."""
    yearly = mart.groupBy("annee").agg(rnd(F.avg("taux_co2"), 2).alias("avg_taux_co2"),
                                       F.count(F.lit(1)).alias("nb_observations"))
    first = F.first("avg_taux_co2").over(Window.orderBy("annee").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing))
    return yearly.withColumn(
        "ratio_vs_first_year", rnd(first / F.nullif(F.col("avg_taux_co2"), F.lit(0)), 2))


def season_hour(enriched: DataFrame) -> DataFrame:
    """Heat map: one row per hour, one column per season (mean CO2)."""
    return (_typical(enriched).groupBy("heure").pivot("saison", SEASON_NAMES)
            .agg(rnd(F.avg("taux_co2"), 2)))


def region_rank(enriched_regional: DataFrame) -> DataFrame:
    """Regions ranked by mean low-carbon share (1 = greenest)."""
    per = enriched_regional.groupBy("libelle_region", "code_insee_region").agg(
        rnd(F.avg("part_bas_carbone"), 4).alias("part_bas_carbone_moyenne"),
        rnd(F.avg("autosuffisance"), 4).alias("autosuffisance_moyenne"),
        F.count(F.lit(1)).alias("nb_observations"))
    w = Window.orderBy(F.col("part_bas_carbone_moyenne").desc_nulls_last())
    return per.withColumn("rang", F.rank().over(w))


def region_trend(enriched_regional: DataFrame) -> DataFrame:
    """Slope per year of each region's mean renewable share."""
    yearly = enriched_regional.groupBy("libelle_region", "code_insee_region", "annee").agg(
        rnd(F.avg("part_renouvelables"), 4).alias("part_renouvelables"))
    return yearly.groupBy("libelle_region", "code_insee_region").agg(
        F.count(F.lit(1)).alias("nb_annees"),
        rnd(F.regr_slope("part_renouvelables", F.col("annee").cast("double")), 5)
        .alias("pente_renouvelables"))


def best_hour(enriched: DataFrame) -> DataFrame:
    """Best charging hour per season, all weekdays together (rank 1, ties kept)."""
    by_hour = _typical(enriched).groupBy("saison", "heure").agg(
        rnd(F.avg("taux_co2"), 2).alias("avg_taux_co2"),
        F.count(F.lit(1)).alias("nb_observations"))
    w = Window.partitionBy("saison").orderBy(F.col("avg_taux_co2").asc_nulls_last())
    return by_hour.withColumn("rang", F.rank().over(w)).filter(F.col("rang") == 1)


def hour_saving(enriched: DataFrame) -> DataFrame:
    """CO2 at noon vs the evening per season, and the saving in %."""
    lo, hi = EVENING_HOURS
    h = F.col("heure")
    per = _typical(enriched).groupBy("saison").agg(
        rnd(F.avg(F.when(h == NOON_HOUR, F.col("taux_co2"))), 2).alias("co2_midi"),
        rnd(F.avg(F.when(h.between(lo, hi), F.col("taux_co2"))), 2).alias("co2_soir"))
    saving = (F.col("co2_soir") - F.col("co2_midi")) / F.nullif(F.col("co2_soir"), F.lit(0)) * 100
    return per.withColumn("baisse_pct", rnd(saving, 1))
