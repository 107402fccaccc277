"""Staging, enriched and mart models on hand-made rows."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from gridmix.operators.dedup import keep_latest
from gridmix.plans import enrich, marts, staging
from gridmix.sources.schemas import NATIONAL_HISTORY_TEXT, national_realtime_table

D = dt.datetime


def hist(spark, rows):
    """National history rows: (date text, consommation text, taux_co2, loaded_at, row_key)."""
    full = []
    for t, c, co2, la, k in rows:
        r = {n: None for n in NATIONAL_HISTORY_TEXT}
        r.update(date_heure=t, consommation=c, taux_co2=co2)
        full.append(tuple(r[n] for n in NATIONAL_HISTORY_TEXT) + (la, k))
    schema = ", ".join(f"{n} string" if n in ("date_heure", "consommation") else f"{n} double"
                       for n in NATIONAL_HISTORY_TEXT) + ", _loaded_at timestamp_ntz, _row_key long"
    return spark.createDataFrame(full, schema)


def empty_rt(spark):
    return spark.createDataFrame([], national_realtime_table()).withColumn(
        "_row_key", F.lit(None).cast("long"))


def test_repeated_autumn_hour_keeps_one(spark):
    la = D(2026, 1, 1)
    h = hist(spark, [("2024-10-27T02:30:00+02:00", "100", 30.0, la, 1),
                     ("2024-10-27T02:30:00+01:00", "200", 40.0, la, 2)])
    out = staging.stg_national(h, empty_rt(spark)).collect()
    assert len(out) == 1
    assert out[0]["consommation_mw"] == 200.0   # tie on load stamp -> higher row key


def test_null_load_stamp_wins_and_filters(spark):
    h = hist(spark, [("2021-01-01T00:00:00+01:00", "10", 1.0, D(2026, 1, 1), 1),
                     ("2021-01-01T00:00:00+01:00", "20", 2.0, None, 2),
                     ("2021-01-01T00:30:00+01:00", "0", 1.0, None, 3),
                     ("2021-01-01T01:00:00+01:00", "-1", 1.0, None, 4),
                     ("2021-01-01T01:30:00+01:00", None, 1.0, None, 5),
                     ("bad", "5", 1.0, None, 6)])
    out = staging.stg_national(h, empty_rt(spark)).collect()
    assert [(r["date_heure"], r["consommation_mw"]) for r in out] == [(D(2021, 1, 1), 20.0)]


def test_realtime_beats_history(spark):
    h = hist(spark, [("2022-03-01T12:00:00+01:00", "10", 1.0, D(2026, 1, 1), 1)])
    rt = spark.createDataFrame(
        [(D(2022, 3, 1, 12), 99.0) + (None,) * 12 + (5.0, D(2026, 2, 1), "tr", 7)],
        national_realtime_table().add("_row_key", LongType()))
    out = staging.stg_national(h, rt).collect()
    assert len(out) == 1 and out[0]["consommation_mw"] == 99.0
    assert out[0]["ech_angleterre_mw"] is None


def test_keep_latest_partial_limit_plan(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("_row_key"),
                                  F.lit(None).cast("timestamp_ntz").alias("_loaded_at"))
    plan = keep_latest(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert sorted(r["_row_key"] for r in keep_latest(df, ["k"]).collect()) == [997, 998, 999]


def _enriched(spark, rows):
    cols = ("date_heure timestamp_ntz, consommation_mw double, prevision_j1_mw double, "
            "prevision_j_mw double, nucleaire_mw double, hydraulique_mw double, eolien_mw double, "
            "solaire_mw double, gaz_mw double, fioul_mw double, charbon_mw double, "
            "bioenergies_mw double, pompage_mw double, ech_physiques_mw double, "
            "ech_angleterre_mw double, ech_espagne_mw double, ech_italie_mw double, "
            "ech_suisse_mw double, ech_allemagne_belgique_mw double, taux_co2 double, "
            "_loaded_at timestamp_ntz")
    full = [(t, 10.0) + (None,) * 17 + (co2, None) for t, co2 in rows]
    return enrich.int_national(spark.createDataFrame(full, cols))


def test_patterns_stddev_single_row_and_flags(spark):
    e = _enriched(spark, [(D(2021, 1, 4, 13), 40.0),          # Monday 13h, winter
                          (D(2021, 1, 11, 13), 50.0),         # same cell
                          (D(2021, 1, 5, 13), 10.0),          # Tuesday, single row
                          (D(2022, 1, 4, 13), 1.0),           # 2022 -> excluded
                          (D(2020, 4, 1, 13), 1.0)])          # covid -> excluded
    p = {(r["jour_semaine"]): r for r in marts.mart_patterns(e).collect()}
    assert set(p) == {"Lundi", "Mardi"}
    assert p["Lundi"]["avg_taux_co2"] == 45.0 and p["Lundi"]["nb_observations"] == 2
    assert p["Lundi"]["stddev_taux_co2"] == 7.07
    assert p["Mardi"]["stddev_taux_co2"] is None
    assert p["Mardi"]["rang_heure_par_saison"] == 1 and p["Lundi"]["rang_global"] == 2


def test_green_hours_ties_and_gains(spark):
    rows = [(D(2021, 7, 5 + d, h), co2) for d, h, co2 in
            [(0, 12, 20.0), (1, 12, 20.0), (2, 12, 30.0), (3, 12, 40.0), (4, 20, 80.0)]]
    g = marts.green_hours(marts.mart_patterns(_enriched(spark, rows))).collect()
    assert [r["rang"] for r in g] == [1, 1, 3]           # ties: rank, 3 rows
    top = g[0]
    assert top["co2_heure_pointe"] == 80.0 and top["gain_vs_pointe_gco2"] == 60.0
    assert top["gain_vs_pointe_pct"] == 75.0
    assert top["emission_zoe_kg_co2"] == 1.04 and top["emission_zoe_pointe_kg_co2"] == 4.16


def test_mart_national_forecast_gap(spark):
    e = _enriched(spark, [(D(2021, 1, 4, 13), 40.0)])
    m = marts.mart_national(e.withColumn("prevision_j_mw", F.lit(7.5)))
    assert m.columns == marts.MART_NATIONAL_COLUMNS
    assert m.first()["ecart_prevision_mw"] == 2.5
