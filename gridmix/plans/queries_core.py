"""Registered queries: whole models and their building blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridmix.plans import marts, models, staging
from gridmix.plans import oracle as O
from gridmix.plans.catalog import register

# ---- whole models (M1-M8) -------------------------------------------------

register("stg_national", O.query("SELECT * FROM stg_national"))(models.stg_national)
register("stg_regional", O.query("SELECT * FROM stg_regional"))(models.stg_regional)
register("int_national", O.query("SELECT * FROM int_national"))(models.int_national)
register("int_regional", O.query("SELECT * FROM int_regional"))(models.int_regional)
register("mart_national", O.query("SELECT * FROM mart_national"))(models.mart_national)
register("mart_patterns", O.query("SELECT * FROM mart_patterns"))(models.mart_patterns)
register("green_hours", O.query("SELECT * FROM green_hours ORDER BY saison, rang"))(
    models.green_hours)
register("mart_regional_monthly",
         O.query("SELECT * FROM mart_regional_monthly ORDER BY annee, mois, libelle_region"))(
    models.mart_regional_monthly)

# ---- sources (S5, S6) -----------------------------------------------------
from gridmix.functions import kpis  # noqa: E402
from gridmix.functions.cleaning import (instant, lenient_double, lenient_timestamp,  # noqa: E402
                                        nan_to_null, normalize_text, strict_double, wall_clock)
from gridmix.operators.dedup import keep_latest  # noqa: E402
from gridmix.sources import adapter, readers  # noqa: E402

FEED_LIMIT = 100
SLICE_YEAR = 2019


@register("latest_100", O.query(
    "SELECT * FROM nat_rt_raw ORDER BY date_heure DESC NULLS LAST, _row_key DESC LIMIT 100"))
def latest_100(spark, src):
    """The feed request: the 100 most recent national readings (top-k plan)."""
    return readers.latest_n(models.raw_national_realtime(spark, src), FEED_LIMIT)


@register("latest_100_regional", O.query(
    "SELECT * FROM reg_rt_raw ORDER BY date_heure DESC NULLS LAST, _row_key DESC LIMIT 100"))
def latest_100_regional(spark, src):
    return readers.latest_n(models.raw_regional_realtime(spark, src), FEED_LIMIT)


@register("year_slice", O.query(
    f"SELECT * FROM nat_hist_landed "
    f"WHERE try_cast(date_heure AS TIMESTAMPTZ) >= TIMESTAMPTZ '{SLICE_YEAR}-01-01 00:00:00+01:00' "
    f"AND try_cast(date_heure AS TIMESTAMPTZ) < TIMESTAMPTZ '{SLICE_YEAR + 1}-01-01 00:00:00+01:00'"))
def year_slice(spark, src):
    """One yearly export slice, half-open on the instant. Wall-clock years beside
    it can hold instants of the year, others are not read."""
    near = adapter.national_history_landed(spark, src, years=(SLICE_YEAR - 1, SLICE_YEAR + 1))
    return readers.year_slice(near, SLICE_YEAR)


# ---- projections and casts (P1-P12) ---------------------------------------

@register("normalize_names", O.query(
    "SELECT DISTINCT code_insee_region, libelle_region, "
    "translate(lower(libelle_region), ' -éèêàô()', '__eeeao') AS region_slug FROM reg_base"))
def normalize_names(spark, src):
    r = adapter.regional_base(spark, src)
    return r.select("code_insee_region", "libelle_region",
                    normalize_text("libelle_region").alias("region_slug")).distinct()


@register("nan_to_null", O.query(
    "SELECT _row_key, l.consommation AS consommation_raw, r.consommation "
    "FROM nat_hist_landed l JOIN nat_hist_raw r USING (_row_key)"))
def nan_to_null_q(spark, src):
    landed = adapter.national_history_landed(spark, src)
    both = landed.select("_row_key", F.col("consommation").alias("consommation_raw"), "consommation")
    return nan_to_null(both, ["consommation"])


@register("strict_cast", O.query(
    "SELECT _row_key, CAST(consommation AS DOUBLE) AS consommation_mw, "
    "CAST(taux_co2 AS DOUBLE) AS taux_co2 FROM nat_hist_raw"))
def strict_cast(spark, src):
    raw = models.raw_national_history(spark, src)
    return raw.select("_row_key", strict_double("consommation").alias("consommation_mw"),
                      strict_double("taux_co2").alias("taux_co2"))


@register("try_cast_double", O.query(
    "SELECT _row_key, consommation, try_cast(consommation AS DOUBLE) AS consommation_mw "
    "FROM reg_hist_raw"))
def try_cast_double(spark, src):
    raw = models.raw_regional_history(spark, src)
    return raw.select("_row_key", "consommation",
                      lenient_double("consommation").alias("consommation_mw"))


@register("try_cast_timestamp", O.query(
    "SELECT _row_key, date_heure, try_cast(date_heure AS TIMESTAMP) AS date_heure_ts "
    "FROM nat_hist_raw"))
def try_cast_timestamp(spark, src):
    raw = models.raw_national_history(spark, src)
    return raw.select("_row_key", "date_heure",
                      lenient_timestamp("date_heure").alias("date_heure_ts"))


@register("paris_wall_clock", O.query(
    "SELECT _row_key, date_heure, "
    "timezone('Europe/Paris', try_cast(date_heure AS TIMESTAMPTZ)) AS wall_clock "
    "FROM nat_hist_raw"))
def paris_wall_clock(spark, src):
    """ISO text with offset -> instant -> Paris wall clock (DST-aware)."""
    raw = models.raw_national_history(spark, src)
    return raw.select("_row_key", "date_heure",
                      wall_clock(instant("date_heure")).alias("wall_clock"))


@register("null_padding", O.query("SELECT * FROM nat_rt_clean"))
def null_padding(spark, src):
    return staging.clean_national_realtime(models.raw_national_realtime(spark, src))


# ---- set operations (U1, U2) ----------------------------------------------

@register("union_national", O.query("SELECT * FROM nat_union"))
def union_national(spark, src):
    return staging.union_national(models.raw_national_history(spark, src),
                                  models.raw_national_realtime(spark, src))


@register("union_regional", O.query("SELECT * FROM reg_union"))
def union_regional(spark, src):
    return staging.union_regional(models.raw_regional_history(spark, src),
                                  models.raw_regional_realtime(spark, src))


# ---- windows (W1-W4) and top-k (F5, L4) -----------------------------------

_DEDUP_NAT_SQL = (
    "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY date_heure "
    "ORDER BY _loaded_at DESC NULLS FIRST, _row_key DESC NULLS LAST) AS rn FROM nat_union) "
    "WHERE rn = 1")
_DEDUP_REG_SQL = (
    "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY date_heure, "
    "libelle_region ORDER BY _loaded_at DESC NULLS FIRST, _row_key DESC NULLS LAST) AS rn "
    "FROM reg_union) WHERE rn = 1")


@register("dedup_national", O.query(_DEDUP_NAT_SQL))
def dedup_national(spark, src):
    """Keep the latest load per timestamp (row kept with its ``_row_key``)."""
    return keep_latest(union_national(spark, src), ["date_heure"])


@register("dedup_regional", O.query(_DEDUP_REG_SQL))
def dedup_regional(spark, src):
    return keep_latest(union_regional(spark, src), ["date_heure", "libelle_region"])


@register("rank_by_season", O.query(
    "SELECT *, CAST(rank() OVER (PARTITION BY saison ORDER BY avg_taux_co2 ASC NULLS LAST) "
    "AS INTEGER) AS rang_heure_par_saison FROM pattern_cells"))
def rank_by_season(spark, src):
    return marts.rank_by_season(marts.pattern_aggregates(models.int_national(spark, src)))


@register("rank_global", O.query(
    "SELECT *, CAST(rank() OVER (ORDER BY avg_taux_co2 ASC NULLS LAST) AS INTEGER) "
    "AS rang_global FROM pattern_cells"))
def rank_global(spark, src):
    return marts.rank_global(marts.pattern_aggregates(models.int_national(spark, src)))


@register("top3_per_season", O.query(
    "SELECT * FROM mart_patterns WHERE rang_heure_par_saison <= 3"))
def top3_per_season(spark, src):
    return models.mart_patterns(spark, src).filter(F.col("rang_heure_par_saison") <= marts.TOP_N)


@register("season_peak", O.query("SELECT * FROM season_peak"))
def season_peak(spark, src):
    return marts.season_peak(models.mart_patterns(spark, src))


# ---- scalar expressions (E1-E19) ------------------------------------------

def _proj(model, cols, cte, sql_cols=None):
    """Register helper: a projection of a model, with the same projection in SQL."""
    def fn(spark, src):
        return model(spark, src).select(*cols)
    return fn, O.query(f"SELECT {sql_cols or ', '.join(cols)} FROM {cte}")


_SCALAR_KEYS = {
    "time_dims": (models.int_national, ["date_heure", "heure", "mois", "annee"], "int_national"),
    "day_name_fr": (models.int_national, ["date_heure", "jour_semaine"], "int_national"),
    "flag_weekend": (models.int_national, ["date_heure", "flag_weekend"], "int_national"),
    "season": (models.int_national, ["date_heure", "saison"], "int_national"),
    "flag_covid": (models.int_national, ["date_heure", "flag_covid"], "int_national"),
    "flag_2022": (models.int_national, ["date_heure", "flag_crise_nuc_2022"], "int_national"),
    "green_index": (models.int_national, ["date_heure", "taux_co2", "indice_vert"], "int_national"),
    "share_low_carbon": (models.int_national, ["date_heure", "part_bas_carbone"], "int_national"),
    "share_renewable": (models.int_national, ["date_heure", "part_renouvelables"], "int_national"),
    "share_fossil": (models.int_national, ["date_heure", "part_fossiles"], "int_national"),
    "production_total": (models.int_regional,
                         ["date_heure", "libelle_region", "production_totale_mw"], "int_regional"),
    "self_sufficiency": (models.int_regional,
                         ["date_heure", "libelle_region", "autosuffisance"], "int_regional"),
    "flag_importer": (models.int_regional,
                      ["date_heure", "libelle_region", "ech_physiques_mw", "flag_importatrice"],
                      "int_regional"),
    "tco_renewable": (models.int_regional,
                      ["date_heure", "libelle_region", "tco_renouvelables"], "int_regional"),
    "forecast_gap": (models.mart_national,
                     ["date_heure", "consommation_mw", "prevision_j_mw", "ecart_prevision_mw"],
                     "mart_national"),
}
for _key, (_model, _cols, _cte) in _SCALAR_KEYS.items():
    _fn, _sql = _proj(_model, _cols, _cte)
    register(_key, _sql)(_fn)


@register("ev_charge_emissions", O.query(
    f"SELECT heure, saison, jour_semaine, flag_weekend, avg_taux_co2, "
    f"{O.rnd('avg_taux_co2 * 52 / 1000', 2)} AS emission_kg_co2 FROM pattern_cells"))
def ev_charge_emissions(spark, src):
    """CO2 of one 52 kWh EV charge at each cell's mean intensity."""
    cells = marts.pattern_aggregates(models.int_national(spark, src))
    return cells.select(*marts.PATTERN_KEYS, "avg_taux_co2",
                        kpis.ev_charge_kg("avg_taux_co2").alias("emission_kg_co2"))
