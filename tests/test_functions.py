"""Column functions on hand-made edge rows."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gridmix.functions import kpis, timedims
from gridmix.functions.cleaning import (instant, lenient_double, lenient_timestamp, nan_to_null,
                                        normalize_columns, normalize_name, normalize_text, rnd,
                                        strict_double, wall_clock)


def test_normalize_name_rule():
    assert normalize_name("Éolien (MW) à-ô") == "eolien_mw_a_o"
    assert normalize_name("Taux de CO2 (g/kWh)") == "taux_de_co2_g/kwh"


def test_normalize_text_matches_python(spark):
    labels = ["Éolien (MW) à-ô", "Ech. comm. Allemagne-Belgique", "Prévision J-1"]
    df = spark.createDataFrame([(x,) for x in labels], "x string")
    got = [r[0] for r in df.select(normalize_text("x")).collect()]
    assert got == [normalize_name(x) for x in labels]


def test_normalize_columns_metadata_only(spark):
    df = spark.createDataFrame([(1, 2)], "`Consommation (MW)` int, `Date - Heure` int")
    assert normalize_columns(df).columns == ["consommation_mw", "date___heure"]


def test_nan_before_cast(spark):
    df = spark.createDataFrame([("nan",), ("NaN",), ("12",), (None,)], "c string")
    out = nan_to_null(df).select(lenient_double("c").alias("v")).collect()
    assert out[0]["v"] is None          # exact 'nan' -> NULL
    assert out[1]["v"] != out[1]["v"]   # other spellings still NaN
    assert out[2]["v"] == 12.0 and out[3]["v"] is None


def test_lenient_vs_strict_cast(spark):
    df = spark.createDataFrame([("ND",), ("3.5",)], "c string")
    assert [r[0] for r in df.select(lenient_double("c")).collect()] == [None, 3.5]
    with pytest.raises(PySparkException):
        df.select(strict_double("c")).collect()


def test_timestamp_keeps_wall_clock_and_dst(spark):
    df = spark.createDataFrame([("2024-10-27T02:30:00+02:00",), ("2024-10-27T02:30:00+01:00",),
                                ("2019-07-01T12:00:00+01:00",), ("bad",)], "t string")
    rows = df.select(lenient_timestamp("t").alias("w"),
                     wall_clock(instant("t")).alias("p")).collect()
    assert rows[0]["w"] == rows[1]["w"] == dt.datetime(2024, 10, 27, 2, 30)
    assert rows[2]["p"] == dt.datetime(2019, 7, 1, 13, 0)   # summer: +02:00 in Paris
    assert rows[3]["w"] is None and rows[3]["p"] is None


def test_rnd_half_away_from_zero(spark):
    df = spark.createDataFrame([(1.005,), (-2.5,), (2.675,), (None,)], "x double")
    assert [r[0] for r in df.select(rnd("x", 2)).collect()][:1] == [1.01]
    assert [r[0] for r in df.select(rnd("x", 0)).collect()][1] == -3.0
    assert [r[0] for r in df.select(rnd("x", 2)).collect()][2] == 2.68


def test_calendar_columns(spark):
    days = [dt.datetime(2024, 1, 7, 13, 0) + dt.timedelta(days=i) for i in range(7)]
    df = spark.createDataFrame([(d,) for d in days], "ts timestamp_ntz")
    rows = df.select(timedims.weekday_fr("ts").alias("j"), timedims.flag_weekend("ts").alias("w"),
                     timedims.hour_of("ts").alias("h")).collect()
    assert [r["j"] for r in rows] == timedims.WEEKDAYS_FR
    assert [r["w"] for r in rows] == [1, 0, 0, 0, 0, 0, 1]
    assert {r["h"] for r in rows} == {13}


def test_seasons_and_null(spark):
    df = spark.createDataFrame([(dt.datetime(2021, m, 1),) for m in range(1, 13)] + [(None,)],
                               "ts timestamp_ntz")
    got = [r[0] for r in df.select(timedims.season("ts")).collect()]
    assert got == ["Hiver", "Hiver", "Printemps", "Printemps", "Printemps", "Été", "Été", "Été",
                   "Automne", "Automne", "Automne", "Hiver", None]


def test_covid_boundary_minute(spark):
    ts = [dt.datetime(2020, 3, 16, 23, 30), dt.datetime(2020, 3, 17), dt.datetime(2020, 5, 11),
          dt.datetime(2020, 5, 11, 0, 30), None]
    df = spark.createDataFrame([(t,) for t in ts], "ts timestamp_ntz")
    assert [r[0] for r in df.select(timedims.flag_covid("ts")).collect()] == [0, 1, 1, 0, 0]


def test_green_index_thresholds(spark):
    df = spark.createDataFrame([(None,), (49.99,), (50.0,), (99.99,), (100.0,)], "taux_co2 double")
    assert [r[0] for r in df.select(kpis.green_index()).collect()] == \
        ["Rouge", "Vert", "Orange", "Orange", "Rouge"]


def test_shares_null_and_zero(spark):
    df = spark.createDataFrame(
        [(0.0, 10.0, None, None, None, None), (None, 1.0, 1.0, 1.0, 1.0, 1.0),
         (4.0, 2.0, None, 1.0, None, None)],
        "consommation_mw double, nucleaire_mw double, eolien_mw double, solaire_mw double, "
        "hydraulique_mw double, bioenergies_mw double")
    rows = df.select(kpis.share_low_carbon().alias("b"), kpis.share_renewable().alias("r")).collect()
    assert rows[0]["b"] is None and rows[1]["b"] is None
    assert rows[2]["b"] == 0.75 and rows[2]["r"] == 0.25


def test_regional_kpis(spark):
    df = spark.createDataFrame(
        [(10.0, 5.0, None, 2.0, 1.0, 1.0, 1.0, -3.0, 1.5, None, 2.25, None),
         (0.0, 1.0, 1.0, None, None, None, None, None, None, None, None, None)],
        "consommation_mw double, thermique_mw double, nucleaire_mw double, eolien_mw double, "
        "solaire_mw double, hydraulique_mw double, bioenergies_mw double, ech_physiques_mw double, "
        "tco_eolien double, tco_solaire double, tco_hydraulique double, tco_bioenergies double")
    out = df.select(kpis.production_total().alias("p")).withColumn(
        "c", F.lit(1)).collect()
    assert [r["p"] for r in out] == [10.0, 2.0]
    rows = df.withColumn("production_totale_mw", kpis.production_total()).select(
        kpis.self_sufficiency().alias("a"), kpis.flag_importer().alias("i"),
        kpis.tco_renewable().alias("t")).collect()
    assert rows[0]["a"] == 1.0 and rows[1]["a"] is None
    assert [r["i"] for r in rows] == [1, 0]
    assert [r["t"] for r in rows] == [3.75, 0.0]
