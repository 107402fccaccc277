"""Registered queries: dashboard questions B1-B7."""

from __future__ import annotations

from gridmix.plans import bi, models
from gridmix.plans import oracle as O
from gridmix.plans.catalog import register

_TYPICAL = "FROM int_national WHERE flag_crise_nuc_2022 = 0 AND flag_covid = 0"


@register("bi_latest_index", O.query(
    "SELECT date_heure, taux_co2, indice_vert, part_bas_carbone, part_renouvelables "
    "FROM mart_national ORDER BY date_heure DESC NULLS LAST LIMIT 1"))
def bi_latest_index(spark, src):
    return bi.latest_index(models.mart_national(spark, src))


@register("bi_yearly_co2", O.query(
    f"SELECT *, {O.rnd('first_value(avg_taux_co2) OVER (ORDER BY annee ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) / nullif(avg_taux_co2, 0)', 2)} AS ratio_vs_first_year "
    f"FROM (SELECT annee, {O.rnd('avg(taux_co2)', 2)} AS avg_taux_co2, count(*) AS nb_observations "
    f"FROM mart_national GROUP BY annee)"))
def bi_yearly_co2(spark, src):
    return bi.yearly_co2(models.mart_national(spark, src))


@register("bi_season_hour", O.query(
    "SELECT heure, " + ", ".join(
        f"{O.rnd(f'avg(CASE WHEN saison = {chr(39)}{s}{chr(39)} THEN taux_co2 END)', 2)} AS \"{s}\""
        for s in ["Hiver", "Printemps", "Été", "Automne"]) + f" {_TYPICAL} GROUP BY heure"))
def bi_season_hour(spark, src):
    return bi.season_hour(models.int_national(spark, src))


@register("bi_region_rank", O.query(
    f"SELECT *, CAST(rank() OVER (ORDER BY part_bas_carbone_moyenne DESC NULLS LAST) AS INTEGER) "
    f"AS rang FROM (SELECT libelle_region, code_insee_region, "
    f"{O.rnd('avg(part_bas_carbone)', 4)} AS part_bas_carbone_moyenne, "
    f"{O.rnd('avg(autosuffisance)', 4)} AS autosuffisance_moyenne, count(*) AS nb_observations "
    f"FROM int_regional GROUP BY libelle_region, code_insee_region)"))
def bi_region_rank(spark, src):
    return bi.region_rank(models.int_regional(spark, src))


@register("bi_region_trend", O.query(
    f"SELECT libelle_region, code_insee_region, count(*) AS nb_annees, "
    f"{O.rnd('regr_slope(part_renouvelables, CAST(annee AS DOUBLE))', 5)} AS pente_renouvelables "
    f"FROM (SELECT libelle_region, code_insee_region, annee, "
    f"{O.rnd('avg(part_renouvelables)', 4)} AS part_renouvelables FROM int_regional "
    f"GROUP BY libelle_region, code_insee_region, annee) GROUP BY libelle_region, code_insee_region"))
def bi_region_trend(spark, src):
    return bi.region_trend(models.int_regional(spark, src))


@register("bi_best_hour", O.query(
    f"SELECT * FROM (SELECT *, CAST(rank() OVER (PARTITION BY saison ORDER BY avg_taux_co2 ASC "
    f"NULLS LAST) AS INTEGER) AS rang FROM (SELECT saison, heure, "
    f"{O.rnd('avg(taux_co2)', 2)} AS avg_taux_co2, count(*) AS nb_observations {_TYPICAL} "
    f"GROUP BY saison, heure)) WHERE rang = 1"))
def bi_best_hour(spark, src):
    return bi.best_hour(models.int_national(spark, src))


@register("bi_hour_saving", O.query(
    f"SELECT *, {O.rnd('(co2_soir - co2_midi) / nullif(co2_soir, 0) * 100', 1)} AS baisse_pct "
    f"FROM (SELECT saison, {O.rnd('avg(CASE WHEN heure = 12 THEN taux_co2 END)', 2)} AS co2_midi, "
    f"{O.rnd('avg(CASE WHEN heure BETWEEN 18 AND 21 THEN taux_co2 END)', 2)} AS co2_soir "
    f"{_TYPICAL} GROUP BY saison)"))
def bi_hour_saving(spark, src):
    return bi.hour_saving(models.int_national(spark, src))
