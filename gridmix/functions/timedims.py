"""Calendar dimensions and event flags derived from the wall-clock time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmix.functions.cleaning import ntz

# French weekday names, Sunday first (Spark dayofweek 1..7).
WEEKDAYS_FR = ["Dimanche", "Lundi", "Mardi", "Mercredi", "Jeudi", "Vendredi", "Samedi"]

# Meteorological seasons by month.
SEASONS = [
    ("Hiver", (12, 1, 2)),
    ("Printemps", (3, 4, 5)),
    ("Été", (6, 7, 8)),
    ("Automne", (9, 10, 11)),
]
SEASON_NAMES = [name for name, _ in SEASONS]

# First lockdown window (inclusive bounds, upper bound is
# midnight so the rest of 11 May is outside) and the nuclear-crisis year.
COVID_START = "2020-03-17 00:00:00"
COVID_END = "2020-05-11 00:00:00"
CRISIS_YEAR = 2022


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def hour_of(ts: Column | str) -> Column:
    return F.hour(_c(ts))


def weekday_fr(ts: Column | str) -> Column:
    names = F.array(*[F.lit(n) for n in WEEKDAYS_FR])
    return F.element_at(names, F.dayofweek(_c(ts)))


def flag_weekend(ts: Column | str) -> Column:
    return F.when(F.dayofweek(_c(ts)).isin(1, 7), 1).otherwise(0)


def season(ts: Column | str) -> Column:
    m = F.month(_c(ts))
    expr = None
    for name, months in SEASONS:
        expr = (F.when(m.isin(*months), name) if expr is None
                else expr.when(m.isin(*months), name))
    return expr


def flag_covid(ts: Column | str) -> Column:
    return F.when(_c(ts).between(ntz(COVID_START), ntz(COVID_END)), 1).otherwise(0)


def flag_crisis_2022(ts: Column | str) -> Column:
    return F.when(F.year(_c(ts)) == CRISIS_YEAR, 1).otherwise(0)


def national_time_columns(ts: str = "date_heure") -> dict[str, Column]:
    """Calendar columns of the national enriched model, in model order."""
    return {
        "heure": hour_of(ts),
        "jour_semaine": weekday_fr(ts),
        "flag_weekend": flag_weekend(ts),
        "mois": F.month(ts),
        "annee": F.year(ts),
        "saison": season(ts),
        "flag_covid": flag_covid(ts),
        "flag_crise_nuc_2022": flag_crisis_2022(ts),
    }


def regional_time_columns(ts: str = "date_heure") -> dict[str, Column]:
    """Calendar columns of the regional enriched model, in model order."""
    return {
        "heure": hour_of(ts),
        "mois": F.month(ts),
        "annee": F.year(ts),
        "jour_semaine": weekday_fr(ts),
        "flag_weekend": flag_weekend(ts),
        "saison": season(ts),
        "flag_covid": flag_covid(ts),
        "flag_crise_nuc_2022": flag_crisis_2022(ts),
    }


def with_time_dims(df: DataFrame, ts: str = "date_heure") -> DataFrame:
    return df.withColumns(national_time_columns(ts))
