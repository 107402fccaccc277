"""CO2 and generation-mix indicators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridmix.functions.cleaning import rnd

# Green-index thresholds in gCO2/kWh (strictly below).
GREEN_BELOW = 50
ORANGE_BELOW = 100
GREEN_LABELS = ["Vert", "Orange", "Rouge"]

# Generation families.
RENEWABLE = ["eolien_mw", "solaire_mw", "hydraulique_mw", "bioenergies_mw"]
LOW_CARBON = ["nucleaire_mw"] + RENEWABLE
FOSSIL = ["gaz_mw", "fioul_mw", "charbon_mw"]
REGIONAL_PRODUCTION = ["thermique_mw", "nucleaire_mw", "eolien_mw", "solaire_mw",
                       "hydraulique_mw", "bioenergies_mw"]
TCO_RENEWABLE = ["tco_eolien", "tco_solaire", "tco_hydraulique", "tco_bioenergies"]

# Fixed value: battery size of the reference EV charge, kWh.
EV_BATTERY_KWH = 52


def coalesce_sum(cols: list[str]) -> Column:
    """Left-to-right sum with NULL counted as 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0)) for c in cols])


def share_of(cols: list[str], denominator: str = "consommation_mw", scale: int = 4) -> Column:
    """Share of a generation family in consumption; NULL when consumption is 0."""
    return rnd(coalesce_sum(cols) / F.nullif(F.col(denominator), F.lit(0)), scale)


def green_index(co2: Column | str = "taux_co2") -> Column:
    c = F.col(co2) if isinstance(co2, str) else co2
    return (F.when(c < GREEN_BELOW, GREEN_LABELS[0])
            .when(c < ORANGE_BELOW, GREEN_LABELS[1])
            .otherwise(GREEN_LABELS[2]))


def share_low_carbon() -> Column:
    return share_of(LOW_CARBON)


def share_renewable() -> Column:
    return share_of(RENEWABLE)


def share_fossil() -> Column:
    return share_of(FOSSIL)


def production_total() -> Column:
    return coalesce_sum(REGIONAL_PRODUCTION)


def self_sufficiency(production: str = "production_totale_mw") -> Column:
    return rnd(F.col(production) / F.nullif(F.col("consommation_mw"), F.lit(0)), 4)


def flag_importer(exchange: str = "ech_physiques_mw") -> Column:
    return F.when(F.col(exchange) < 0, 1).otherwise(0)


def tco_renewable() -> Column:
    return rnd(coalesce_sum(TCO_RENEWABLE), 2)


def forecast_gap() -> Column:
    return rnd(F.col("consommation_mw") - F.col("prevision_j_mw"), 2)


def ev_charge_kg(co2: Column | str, battery_kwh: float = EV_BATTERY_KWH) -> Column:
    c = F.col(co2) if isinstance(co2, str) else co2
    return rnd(c * battery_kwh / 1000, 2)
