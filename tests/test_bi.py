"""Dashboard questions on hand-made enriched rows (brute-force expectations)."""

import datetime as dt

from gridmix.plans import bi, enrich

D = dt.datetime
COLS = ("date_heure timestamp_ntz, consommation_mw double, prevision_j1_mw double, "
        "prevision_j_mw double, nucleaire_mw double, hydraulique_mw double, eolien_mw double, "
        "solaire_mw double, gaz_mw double, fioul_mw double, charbon_mw double, "
        "bioenergies_mw double, pompage_mw double, ech_physiques_mw double, "
        "ech_angleterre_mw double, ech_espagne_mw double, ech_italie_mw double, "
        "ech_suisse_mw double, ech_allemagne_belgique_mw double, taux_co2 double, "
        "_loaded_at timestamp_ntz")


def enriched(spark, rows):
    full = [(t, 10.0, None, None, nuc) + (None,) * 14 + (co2, None) for t, co2, nuc in rows]
    return enrich.int_national(spark.createDataFrame(full, COLS))


def test_hour_saving_and_missing_evening(spark):
    e = enriched(spark, [(D(2021, 7, 1, 12), 20.0, 5.0), (D(2021, 7, 2, 12), 30.0, 5.0),
                         (D(2021, 7, 1, 19), 50.0, 5.0), (D(2021, 7, 1, 21), 50.0, 5.0),
                         (D(2021, 1, 4, 12), 40.0, 5.0)])           # winter: no evening reading
    got = {r["saison"]: (r["co2_midi"], r["co2_soir"], r["baisse_pct"])
           for r in bi.hour_saving(e).collect()}
    assert got["Été"] == (25.0, 50.0, 50.0)
    assert got["Hiver"] == (40.0, None, None)


def test_best_hour_keeps_ties(spark):
    e = enriched(spark, [(D(2021, 4, 5, 13), 10.0, 1.0), (D(2021, 4, 6, 14), 10.0, 1.0),
                         (D(2021, 4, 7, 20), 30.0, 1.0)])
    got = sorted((r["heure"], r["rang"]) for r in bi.best_hour(e).collect())
    assert got == [(13, 1), (14, 1)]


def test_yearly_ratio_against_first_year(spark):
    from gridmix.plans import marts
    e = enriched(spark, [(D(2016, 3, 1), 60.0, 1.0), (D(2017, 3, 1), 30.0, 1.0),
                         (D(2018, 3, 1), 20.0, 1.0)])
    got = {r["annee"]: r["ratio_vs_first_year"] for r in bi.yearly_co2(marts.mart_national(e)).collect()}
    assert got == {2016: 1.0, 2017: 2.0, 2018: 3.0}


def test_latest_index_is_newest_reading(spark):
    from gridmix.plans import marts
    e = enriched(spark, [(D(2021, 3, 1, h), float(10 * h), 1.0) for h in range(6)])
    r = bi.latest_index(marts.mart_national(e)).collect()
    assert len(r) == 1 and r[0]["date_heure"] == D(2021, 3, 1, 5) and r[0]["indice_vert"] == "Orange"


def test_season_hour_pivot_columns(spark):
    e = enriched(spark, [(D(2021, 1, 4, 8), 40.0, 1.0), (D(2021, 7, 5, 8), 20.0, 1.0)])
    rows = bi.season_hour(e).collect()
    assert rows[0].asDict() == {"heure": 8, "Hiver": 40.0, "Printemps": None, "Été": 20.0,
                                "Automne": None}
