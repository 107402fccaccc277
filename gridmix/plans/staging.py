"""Staging (silver) models: type, pad, union history with real time, filter,
keep the latest load per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmix.functions.cleaning import (lenient_double, lenient_timestamp,
                                        null_double, strict_double, wall_clock)
from gridmix.operators.dedup import keep_latest

NATIONAL_MEASURES = [
    ("consommation", "consommation_mw"), ("prevision_j1", "prevision_j1_mw"),
    ("prevision_j", "prevision_j_mw"), ("nucleaire", "nucleaire_mw"),
    ("hydraulique", "hydraulique_mw"), ("eolien", "eolien_mw"),
    ("solaire", "solaire_mw"), ("gaz", "gaz_mw"), ("fioul", "fioul_mw"),
    ("charbon", "charbon_mw"), ("bioenergies", "bioenergies_mw"),
    ("pompage", "pompage_mw"), ("ech_physiques", "ech_physiques_mw"),
]
NATIONAL_EXCHANGES = [
    ("ech_comm_angleterre", "ech_angleterre_mw"), ("ech_comm_espagne", "ech_espagne_mw"),
    ("ech_comm_italie", "ech_italie_mw"), ("ech_comm_suisse", "ech_suisse_mw"),
    ("ech_comm_allemagne_belgique", "ech_allemagne_belgique_mw"),
]
REGIONAL_MEASURES = [
    ("consommation", "consommation_mw"), ("thermique", "thermique_mw"),
    ("nucleaire", "nucleaire_mw"), ("eolien", "eolien_mw"), ("solaire", "solaire_mw"),
    ("hydraulique", "hydraulique_mw"), ("pompage", "pompage_mw"),
    ("bioenergies", "bioenergies_mw"), ("ech_physiques", "ech_physiques_mw"),
]
REGIONAL_WIND_SPLIT = [("eolien_terrestre", "eolien_terrestre_mw"),
                       ("eolien_offshore", "eolien_offshore_mw")]
REGIONAL_TCO = ["tco_thermique", "tco_nucleaire", "tco_eolien", "tco_solaire",
                "tco_hydraulique", "tco_bioenergies"]

STG_NATIONAL_COLUMNS = (["date_heure"] + [o for _, o in NATIONAL_MEASURES]
                        + [o for _, o in NATIONAL_EXCHANGES] + ["taux_co2", "_loaded_at"])
STG_REGIONAL_COLUMNS = (["code_insee_region", "libelle_region", "date_heure"]
                        + [o for _, o in REGIONAL_MEASURES] + [o for _, o in REGIONAL_WIND_SPLIT]
                        + REGIONAL_TCO + ["_loaded_at"])


def _keep_row_key(df: DataFrame) -> list:
    """Stable tie-break key when the source has one, else a typed NULL, so
    history and real time always union by name."""
    if "_row_key" in df.columns:
        return [F.col("_row_key").cast("bigint").alias("_row_key")]
    return [F.lit(None).cast("bigint").alias("_row_key")]


def clean_national_history(raw: DataFrame) -> DataFrame:
    """History: lenient time parse, strict numeric casts."""
    return raw.select(
        lenient_timestamp("date_heure").alias("date_heure"),
        *[strict_double(i).alias(o) for i, o in NATIONAL_MEASURES],
        *[strict_double(i).alias(o) for i, o in NATIONAL_EXCHANGES],
        strict_double("taux_co2").alias("taux_co2"),
        F.col("_loaded_at").cast("timestamp_ntz").alias("_loaded_at"),
        *_keep_row_key(raw))


def _realtime_wall_clock(raw: DataFrame):
    """Real-time reading time as Paris wall clock: an instant (feed tables)
    is converted, a zone-less time is kept as it is."""
    if dict(raw.dtypes)["date_heure"] == "timestamp":
        return wall_clock(F.col("date_heure")).alias("date_heure")
    return F.col("date_heure").cast("timestamp_ntz").alias("date_heure")


def realtime_time(raw: DataFrame, *more: str) -> DataFrame:
    """Reading time of real-time rows as wall clock, and further columns as they are."""
    return raw.select(_realtime_wall_clock(raw), *more)


def clean_national_realtime(raw: DataFrame) -> DataFrame:
    """Real time: typed already; the five exchange columns are padded NULL."""
    return raw.select(
        _realtime_wall_clock(raw),
        *[strict_double(i).alias(o) for i, o in NATIONAL_MEASURES],
        *[null_double().alias(o) for _, o in NATIONAL_EXCHANGES],
        strict_double("taux_co2").alias("taux_co2"),
        F.col("_loaded_at").cast("timestamp_ntz").alias("_loaded_at"),
        *_keep_row_key(raw))


def clean_regional_history(raw: DataFrame) -> DataFrame:
    """Regional history: every measure leniently cast (``'ND'`` -> NULL)."""
    return raw.select(
        F.col("code_insee_region").cast("string").alias("code_insee_region"),
        F.col("libelle_region").cast("string").alias("libelle_region"),
        lenient_timestamp("date_heure").alias("date_heure"),
        *[lenient_double(i).alias(o) for i, o in REGIONAL_MEASURES + REGIONAL_WIND_SPLIT],
        *[lenient_double(c).alias(c) for c in REGIONAL_TCO],
        F.col("_loaded_at").cast("timestamp_ntz").alias("_loaded_at"),
        *_keep_row_key(raw))


def clean_regional_realtime(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("code_insee_region").cast("string").alias("code_insee_region"),
        F.col("libelle_region").cast("string").alias("libelle_region"),
        _realtime_wall_clock(raw),
        *[strict_double(i).alias(o) for i, o in REGIONAL_MEASURES],
        *[null_double().alias(o) for _, o in REGIONAL_WIND_SPLIT],
        *[strict_double(c).alias(c) for c in REGIONAL_TCO],
        F.col("_loaded_at").cast("timestamp_ntz").alias("_loaded_at"),
        *_keep_row_key(raw))


def union_national(history_raw: DataFrame, realtime_raw: DataFrame | None = None) -> DataFrame:
    """History ∪ real time (if there is any yet), by column name (never by position)."""
    history = clean_national_history(history_raw)
    return history if realtime_raw is None else history.unionByName(clean_national_realtime(realtime_raw))


def union_regional(history_raw: DataFrame, realtime_raw: DataFrame) -> DataFrame:
    return clean_regional_history(history_raw).unionByName(clean_regional_realtime(realtime_raw))


def national_rows(history_raw: DataFrame, realtime_raw: DataFrame | None = None) -> DataFrame:
    """The usable readings, before one per timestamp is kept."""
    return union_national(history_raw, realtime_raw).filter(
        F.col("date_heure").isNotNull() & F.col("consommation_mw").isNotNull()
        & (F.col("consommation_mw") > 0))


def stg_national(history_raw: DataFrame, realtime_raw: DataFrame | None = None) -> DataFrame:
    """One row per timestamp; the most recently loaded reading wins."""
    src = national_rows(history_raw, realtime_raw)
    return keep_latest(src, ["date_heure"], drop=["_row_key"]).select(*STG_NATIONAL_COLUMNS)


def stg_regional(history_raw: DataFrame, realtime_raw: DataFrame) -> DataFrame:
    """One row per timestamp × region; the most recently loaded reading wins."""
    src = union_regional(history_raw, realtime_raw).filter(
        F.col("date_heure").isNotNull() & F.col("consommation_mw").isNotNull()
        & F.col("libelle_region").isNotNull())
    return keep_latest(src, ["date_heure", "libelle_region"], drop=["_row_key"]).select(
        *STG_REGIONAL_COLUMNS)
