"""Declared schemas of the raw (bronze) tables and feed envelopes."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, DoubleType, StringType, StructField,
                               StructType, TimestampNTZType, TimestampType)

NATIONAL_HISTORY_TEXT = [
    "date_heure", "consommation", "prevision_j1", "prevision_j", "nucleaire",
    "hydraulique", "eolien", "solaire", "gaz", "fioul", "charbon", "bioenergies",
    "pompage", "ech_physiques", "ech_comm_angleterre", "ech_comm_espagne",
    "ech_comm_italie", "ech_comm_suisse", "ech_comm_allemagne_belgique", "taux_co2",
]

REGIONAL_HISTORY_TEXT = [
    "code_insee_region", "libelle_region", "date_heure", "consommation", "thermique",
    "nucleaire", "eolien", "solaire", "hydraulique", "pompage", "bioenergies",
    "ech_physiques", "eolien_terrestre", "eolien_offshore", "tco_thermique",
    "tco_nucleaire", "tco_eolien", "tco_solaire", "tco_hydraulique", "tco_bioenergies",
]

# Measures of the real-time feeds, in declared table order.
NATIONAL_RT_MEASURES = [
    "consommation", "prevision_j1", "prevision_j", "fioul", "charbon", "gaz",
    "nucleaire", "eolien", "solaire", "hydraulique", "pompage", "bioenergies",
    "ech_physiques", "taux_co2",
]
REGIONAL_RT_MEASURES = [
    "consommation", "thermique", "nucleaire", "eolien", "solaire", "hydraulique",
    "pompage", "bioenergies", "ech_physiques", "tco_thermique", "tco_nucleaire",
    "tco_eolien", "tco_solaire", "tco_hydraulique", "tco_bioenergies",
]

# Provenance tags written by the real-time loaders.
NATIONAL_RT_SOURCE = "eco2mix-national-tr"
REGIONAL_RT_SOURCE = "eco2mix-regional-tr"


def all_string(names: list[str]) -> StructType:
    """Landing schema: every column read as text (no inference)."""
    return StructType([StructField(n, StringType(), True) for n in names])


def _time_type(instant: bool):
    """Reading time of a real-time table: the instant (feed tables, merged
    on the instant like offset-carrying timestamps) or the zone-less wall
    clock (tables derived from the driver data)."""
    return TimestampType() if instant else TimestampNTZType()


def national_realtime_table(instant: bool = False) -> StructType:
    return StructType(
        [StructField("date_heure", _time_type(instant), True)]
        + [StructField(m, DoubleType(), True) for m in NATIONAL_RT_MEASURES]
        + [StructField("_loaded_at", TimestampNTZType(), True),
           StructField("_source", StringType(), True)])


def regional_realtime_table(instant: bool = False) -> StructType:
    return StructType(
        [StructField("code_insee_region", StringType(), True),
         StructField("libelle_region", StringType(), True),
         StructField("date_heure", _time_type(instant), True)]
        + [StructField(m, DoubleType(), True) for m in REGIONAL_RT_MEASURES]
        + [StructField("_loaded_at", TimestampNTZType(), True),
           StructField("_source", StringType(), True)])


def feed_record(measures: list[str], regional: bool) -> StructType:
    """One API record: ISO text time with offset, numeric measures."""
    keys = ([StructField("code_insee_region", StringType(), True),
             StructField("libelle_region", StringType(), True)] if regional else [])
    return StructType(keys + [StructField("date_heure", StringType(), True)]
                      + [StructField(m, DoubleType(), True) for m in measures])


def feed_envelope(measures: list[str], regional: bool) -> StructType:
    """``{"results": [record, ...]}`` response body."""
    return StructType([StructField("results", ArrayType(feed_record(measures, regional)), True)])


INSTANT = TimestampType()
