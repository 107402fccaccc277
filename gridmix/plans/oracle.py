"""Reference SQL for every registered query, runnable by DuckDB over the
driver tables (views ``orders lineitem customer nation events ...``).

The SQL restates each layer independently of the Spark code: the same
mapping of driver tables to raw grid tables, then the models. Conventions
that differ between engines are spelled out: NULL ordering is explicit,
rounding goes through ``decimal(20,6)``, DuckDB ``dayofweek`` is 0-based,
and integer-valued results are cast to the Spark result type.
"""

from __future__ import annotations


def rnd(expr: str, n: int) -> str:
    return f"CAST(round(CAST(({expr}) AS DECIMAL(20,6)), {n}) AS DOUBLE)"


def csum(cols: list[str]) -> str:
    return " + ".join(f"coalesce({c}, 0)" for c in cols)


RENEW = ["eolien_mw", "solaire_mw", "hydraulique_mw", "bioenergies_mw"]
LOWC = ["nucleaire_mw"] + RENEW
FOSS = ["gaz_mw", "fioul_mw", "charbon_mw"]
PROD = ["thermique_mw", "nucleaire_mw", "eolien_mw", "solaire_mw", "hydraulique_mw",
        "bioenergies_mw"]
TCO_R = ["tco_eolien", "tco_solaire", "tco_hydraulique", "tco_bioenergies"]

DAYNAME = ("CASE dayofweek(date_heure) WHEN 0 THEN 'Dimanche' WHEN 1 THEN 'Lundi' "
           "WHEN 2 THEN 'Mardi' WHEN 3 THEN 'Mercredi' WHEN 4 THEN 'Jeudi' "
           "WHEN 5 THEN 'Vendredi' WHEN 6 THEN 'Samedi' END")
WEEKEND = "CASE WHEN dayofweek(date_heure) IN (0, 6) THEN 1 ELSE 0 END"
SEASON = ("CASE WHEN month(date_heure) IN (12, 1, 2) THEN 'Hiver' "
          "WHEN month(date_heure) IN (3, 4, 5) THEN 'Printemps' "
          "WHEN month(date_heure) IN (6, 7, 8) THEN 'Été' "
          "WHEN month(date_heure) IN (9, 10, 11) THEN 'Automne' END")
COVID = ("CASE WHEN date_heure BETWEEN TIMESTAMP '2020-03-17 00:00:00' "
         "AND TIMESTAMP '2020-05-11 00:00:00' THEN 1 ELSE 0 END")
CRISIS = "CASE WHEN year(date_heure) = 2022 THEN 1 ELSE 0 END"
GREEN = "CASE WHEN taux_co2 < 50 THEN 'Vert' WHEN taux_co2 < 100 THEN 'Orange' ELSE 'Rouge' END"


def share(cols: list[str]) -> str:
    return rnd(f"({csum(cols)}) / nullif(consommation_mw, 0)", 4)


def fam(rf: str, ls: str) -> str:
    return f"sum(CASE WHEN l_returnflag = '{rf}' AND l_linestatus = '{ls}' THEN l_quantity END)"


ISO = "strftime(dh, '%Y-%m-%dT%H:%M:%S+01:00')"
ITXT = "CAST(CAST({c} AS BIGINT) AS VARCHAR)"

NAT_STG_COLS = ("date_heure, consommation_mw, prevision_j1_mw, prevision_j_mw, nucleaire_mw, "
                "hydraulique_mw, eolien_mw, solaire_mw, gaz_mw, fioul_mw, charbon_mw, "
                "bioenergies_mw, pompage_mw, ech_physiques_mw, ech_angleterre_mw, ech_espagne_mw, "
                "ech_italie_mw, ech_suisse_mw, ech_allemagne_belgique_mw, taux_co2, _loaded_at")
REG_STG_COLS = ("code_insee_region, libelle_region, date_heure, consommation_mw, thermique_mw, "
                "nucleaire_mw, eolien_mw, solaire_mw, hydraulique_mw, pompage_mw, bioenergies_mw, "
                "ech_physiques_mw, eolien_terrestre_mw, eolien_offshore_mw, tco_thermique, "
                "tco_nucleaire, tco_eolien, tco_solaire, tco_hydraulique, tco_bioenergies, _loaded_at")

def stg_national_body(src: str) -> str:
    return f"""
  SELECT {NAT_STG_COLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY date_heure
                                 ORDER BY _loaded_at DESC NULLS FIRST, _row_key DESC NULLS LAST) AS rn
    FROM {src}
    WHERE date_heure IS NOT NULL AND consommation_mw IS NOT NULL AND consommation_mw > 0)
  WHERE rn = 1"""


def int_national_body(src: str) -> str:
    return f"""
  SELECT date_heure, consommation_mw, prevision_j1_mw, prevision_j_mw, nucleaire_mw,
         hydraulique_mw, eolien_mw, solaire_mw, gaz_mw, fioul_mw, charbon_mw, bioenergies_mw,
         pompage_mw, ech_physiques_mw, taux_co2, _loaded_at,
         CAST(hour(date_heure) AS INTEGER) AS heure,
         {DAYNAME} AS jour_semaine,
         {WEEKEND} AS flag_weekend,
         CAST(month(date_heure) AS INTEGER) AS mois,
         CAST(year(date_heure) AS INTEGER) AS annee,
         {SEASON} AS saison,
         {COVID} AS flag_covid,
         {CRISIS} AS flag_crise_nuc_2022,
         {GREEN} AS indice_vert,
         {share(LOWC)} AS part_bas_carbone,
         {share(RENEW)} AS part_renouvelables,
         {share(FOSS)} AS part_fossiles
  FROM {src}"""


MART_NATIONAL_COLS = (
    "date_heure, heure, saison, jour_semaine, mois, annee, flag_weekend, flag_covid, "
    "flag_crise_nuc_2022, consommation_mw, prevision_j1_mw, prevision_j_mw, ecart_prevision_mw, "
    "nucleaire_mw, hydraulique_mw, eolien_mw, solaire_mw, gaz_mw, fioul_mw, charbon_mw, "
    "bioenergies_mw, pompage_mw, ech_physiques_mw, taux_co2, indice_vert, part_bas_carbone, "
    "part_renouvelables, part_fossiles, _loaded_at")


def mart_national_body(src: str) -> str:
    cols = MART_NATIONAL_COLS.replace(
        "ecart_prevision_mw", rnd("consommation_mw - prevision_j_mw", 2) + " AS ecart_prevision_mw")
    return f"""
  SELECT {cols}
  FROM {src}"""


CTES: list[tuple[str, str]] = [
    ("li_agg", f"""
  SELECT l_orderkey AS o_orderkey, sum(l_quantity) AS q_all,
         {fam('A', 'F')} AS q_af, {fam('A', 'O')} AS q_ao, {fam('N', 'F')} AS q_nf,
         {fam('N', 'O')} AS q_no, {fam('R', 'F')} AS q_rf, {fam('R', 'O')} AS q_ro
  FROM lineitem GROUP BY l_orderkey"""),
    ("om", """
  SELECT o.o_orderkey AS k, o.o_custkey, o.o_orderdate, li.q_all, li.q_af, li.q_ao, li.q_nf,
         li.q_no, li.q_rf, li.q_ro
  FROM orders o LEFT JOIN li_agg li ON o.o_orderkey = li.o_orderkey"""),
    ("nat_base", """
  SELECT k AS _row_key, o_orderdate + to_days(7670) + to_minutes(CAST(30 * (k % 48) AS INTEGER)) AS dh,
         q_all AS consommation,
         q_all + CAST(k % 7 - 3 AS DOUBLE) AS prevision_j1,
         q_all + CAST(k % 5 - 2 AS DOUBLE) AS prevision_j,
         q_af AS nucleaire, q_ao AS hydraulique, q_nf AS eolien, q_no AS solaire,
         q_rf AS gaz, q_ro AS fioul,
         CAST(CASE WHEN k % 3 = 0 THEN k % 20 END AS DOUBLE) AS charbon,
         CAST(k % 30 AS DOUBLE) AS bioenergies,
         CAST(-(k % 50) AS DOUBLE) AS pompage,
         CAST(CASE WHEN k % 53 <> 0 THEN (k % 201) - 100 END AS DOUBLE) AS ech_physiques,
         CAST(k % 11 - 5 AS DOUBLE) AS ech_comm_angleterre,
         CAST(k % 13 - 6 AS DOUBLE) AS ech_comm_espagne,
         CAST(k % 17 - 8 AS DOUBLE) AS ech_comm_italie,
         CAST(k % 19 - 9 AS DOUBLE) AS ech_comm_suisse,
         CAST(k % 23 - 11 AS DOUBLE) AS ech_comm_allemagne_belgique,
         CAST((k * 37) % 13000 AS DOUBLE) / 100.0 AS taux_co2
  FROM om"""),
    ("nat_hist_landed", f"""
  SELECT CASE WHEN _row_key % 101 = 0 THEN 'bad' ELSE {ISO} END AS date_heure,
         CASE WHEN _row_key % 89 = 0 THEN 'nan' ELSE {ITXT.format(c='consommation')} END AS consommation,
         prevision_j1, prevision_j, nucleaire, hydraulique, eolien, solaire, gaz, fioul, charbon,
         bioenergies, pompage, ech_physiques, ech_comm_angleterre, ech_comm_espagne,
         ech_comm_italie, ech_comm_suisse, ech_comm_allemagne_belgique, taux_co2,
         TIMESTAMP '2026-01-01 00:00:00' AS _loaded_at, _row_key
  FROM nat_base WHERE year(dh) < 2022"""),
    ("nat_hist_raw", """
  SELECT nullif(date_heure, 'nan') AS date_heure, nullif(consommation, 'nan') AS consommation,
         * EXCLUDE (date_heure, consommation)
  FROM nat_hist_landed"""),
    ("nat_rt_raw", """
  SELECT dh AS date_heure, consommation * 2 AS consommation, prevision_j1, prevision_j, fioul,
         charbon, gaz, nucleaire, eolien, solaire, hydraulique, pompage, bioenergies,
         ech_physiques, taux_co2,
         TIMESTAMP '2026-02-01 00:00:00' + to_seconds(_row_key) AS _loaded_at,
         'eco2mix-national-tr' AS _source, _row_key
  FROM nat_base WHERE year(dh) >= 2022 OR _row_key % 10 = 0"""),
    ("nat_hist_clean", """
  SELECT try_cast(date_heure AS TIMESTAMP) AS date_heure,
         CAST(consommation AS DOUBLE) AS consommation_mw,
         CAST(prevision_j1 AS DOUBLE) AS prevision_j1_mw, CAST(prevision_j AS DOUBLE) AS prevision_j_mw,
         CAST(nucleaire AS DOUBLE) AS nucleaire_mw, CAST(hydraulique AS DOUBLE) AS hydraulique_mw,
         CAST(eolien AS DOUBLE) AS eolien_mw, CAST(solaire AS DOUBLE) AS solaire_mw,
         CAST(gaz AS DOUBLE) AS gaz_mw, CAST(fioul AS DOUBLE) AS fioul_mw,
         CAST(charbon AS DOUBLE) AS charbon_mw, CAST(bioenergies AS DOUBLE) AS bioenergies_mw,
         CAST(pompage AS DOUBLE) AS pompage_mw, CAST(ech_physiques AS DOUBLE) AS ech_physiques_mw,
         CAST(ech_comm_angleterre AS DOUBLE) AS ech_angleterre_mw,
         CAST(ech_comm_espagne AS DOUBLE) AS ech_espagne_mw,
         CAST(ech_comm_italie AS DOUBLE) AS ech_italie_mw,
         CAST(ech_comm_suisse AS DOUBLE) AS ech_suisse_mw,
         CAST(ech_comm_allemagne_belgique AS DOUBLE) AS ech_allemagne_belgique_mw,
         CAST(taux_co2 AS DOUBLE) AS taux_co2, CAST(_loaded_at AS TIMESTAMP) AS _loaded_at, _row_key
  FROM nat_hist_raw"""),
    ("nat_rt_clean", """
  SELECT CAST(date_heure AS TIMESTAMP) AS date_heure, consommation AS consommation_mw,
         prevision_j1 AS prevision_j1_mw, prevision_j AS prevision_j_mw, nucleaire AS nucleaire_mw,
         hydraulique AS hydraulique_mw, eolien AS eolien_mw, solaire AS solaire_mw, gaz AS gaz_mw,
         fioul AS fioul_mw, charbon AS charbon_mw, bioenergies AS bioenergies_mw,
         pompage AS pompage_mw, ech_physiques AS ech_physiques_mw,
         CAST(NULL AS DOUBLE) AS ech_angleterre_mw, CAST(NULL AS DOUBLE) AS ech_espagne_mw,
         CAST(NULL AS DOUBLE) AS ech_italie_mw, CAST(NULL AS DOUBLE) AS ech_suisse_mw,
         CAST(NULL AS DOUBLE) AS ech_allemagne_belgique_mw,
         taux_co2, _loaded_at, _row_key
  FROM nat_rt_raw"""),
    ("nat_union", """
  SELECT * FROM nat_hist_clean UNION ALL BY NAME SELECT * FROM nat_rt_clean"""),
    ("stg_national", stg_national_body("nat_union")),
    ("int_national", int_national_body("stg_national")),
    ("mart_national", mart_national_body("int_national")),
    ("pattern_cells", f"""
  SELECT heure, saison, jour_semaine, flag_weekend,
         {rnd('avg(taux_co2)', 2)} AS avg_taux_co2,
         {rnd('min(taux_co2)', 2)} AS min_taux_co2,
         {rnd('max(taux_co2)', 2)} AS max_taux_co2,
         {rnd('stddev_samp(taux_co2)', 2)} AS stddev_taux_co2,
         count(*) AS nb_observations,
         {rnd('avg(part_bas_carbone)', 4)} AS avg_part_bas_carbone,
         {rnd('avg(part_renouvelables)', 4)} AS avg_part_renouvelables,
         {rnd('avg(part_fossiles)', 4)} AS avg_part_fossiles,
         {rnd('avg(consommation_mw)', 2)} AS avg_consommation_mw,
         {rnd('avg(nucleaire_mw)', 2)} AS avg_nucleaire_mw,
         {rnd('avg(eolien_mw)', 2)} AS avg_eolien_mw,
         {rnd('avg(solaire_mw)', 2)} AS avg_solaire_mw,
         {rnd('avg(gaz_mw)', 2)} AS avg_gaz_mw
  FROM int_national
  WHERE flag_crise_nuc_2022 = 0 AND flag_covid = 0
  GROUP BY heure, saison, jour_semaine, flag_weekend"""),
    ("mart_patterns", """
  SELECT *,
         CAST(rank() OVER (PARTITION BY saison ORDER BY avg_taux_co2 ASC NULLS LAST) AS INTEGER)
           AS rang_heure_par_saison,
         CAST(rank() OVER (ORDER BY avg_taux_co2 ASC NULLS LAST) AS INTEGER) AS rang_global
  FROM pattern_cells"""),
    ("season_peak", """
  SELECT saison, max(avg_taux_co2) AS co2_heure_pointe, min(avg_taux_co2) AS co2_heure_min
  FROM mart_patterns GROUP BY saison"""),
    ("green_hours", f"""
  SELECT p.saison, p.rang_heure_par_saison AS rang, p.heure AS heure_optimale,
         p.avg_taux_co2 AS co2_moyen, ps.co2_heure_pointe,
         {rnd('ps.co2_heure_pointe - p.avg_taux_co2', 2)} AS gain_vs_pointe_gco2,
         {rnd('(ps.co2_heure_pointe - p.avg_taux_co2) / nullif(ps.co2_heure_pointe, 0) * 100', 1)}
           AS gain_vs_pointe_pct,
         {rnd('p.avg_taux_co2 * 52 / 1000', 2)} AS emission_zoe_kg_co2,
         {rnd('ps.co2_heure_pointe * 52 / 1000', 2)} AS emission_zoe_pointe_kg_co2,
         p.nb_observations
  FROM mart_patterns p JOIN season_peak ps ON p.saison = ps.saison
  WHERE p.rang_heure_par_saison <= 3"""),
    # ---- regional ----
    ("reg_base", """
  SELECT om.k AS _row_key, lpad(CAST(c.c_nationkey AS VARCHAR), 2, '0') AS code_insee_region,
         n.n_name AS libelle_region,
         om.o_orderdate + to_days(7670) + to_minutes(CAST(360 * (om.k % 4) AS INTEGER)) AS dh,
         q_all AS consommation, q_rf AS thermique, q_af AS nucleaire, q_nf AS eolien,
         q_no AS solaire, q_ao AS hydraulique, CAST(-(om.k % 50) AS DOUBLE) AS pompage,
         q_ro AS bioenergies,
         CAST(CASE WHEN om.k % 53 <> 0 THEN (om.k % 201) - 100 END AS DOUBLE) AS ech_physiques,
         q_nf AS eolien_terrestre, CAST(NULL AS DOUBLE) AS eolien_offshore,
         CAST((om.k * 13) % 10000 AS DOUBLE) / 100.0 AS tco_thermique,
         CAST((om.k * 17) % 10000 AS DOUBLE) / 100.0 AS tco_nucleaire,
         CAST((om.k * 19) % 10000 AS DOUBLE) / 100.0 AS tco_eolien,
         CAST((om.k * 23) % 10000 AS DOUBLE) / 100.0 AS tco_solaire,
         CAST((om.k * 29) % 10000 AS DOUBLE) / 100.0 AS tco_hydraulique,
         CAST((om.k * 31) % 10000 AS DOUBLE) / 100.0 AS tco_bioenergies
  FROM om LEFT JOIN customer c ON om.o_custkey = c.c_custkey
          LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey"""),
    ("reg_hist_landed", f"""
  SELECT code_insee_region, libelle_region,
         CASE WHEN _row_key % 101 = 0 THEN 'bad' ELSE {ISO} END AS date_heure,
         CASE WHEN _row_key % 89 = 0 THEN 'nan' WHEN _row_key % 97 = 0 THEN 'ND'
              ELSE {ITXT.format(c='consommation')} END AS consommation,
         {ITXT.format(c='thermique')} AS thermique, {ITXT.format(c='nucleaire')} AS nucleaire,
         {ITXT.format(c='eolien')} AS eolien, {ITXT.format(c='solaire')} AS solaire,
         {ITXT.format(c='hydraulique')} AS hydraulique, {ITXT.format(c='pompage')} AS pompage,
         {ITXT.format(c='bioenergies')} AS bioenergies,
         {ITXT.format(c='ech_physiques')} AS ech_physiques,
         {ITXT.format(c='eolien_terrestre')} AS eolien_terrestre,
         {ITXT.format(c='eolien_offshore')} AS eolien_offshore,
         CAST(tco_thermique AS VARCHAR) AS tco_thermique, CAST(tco_nucleaire AS VARCHAR) AS tco_nucleaire,
         CAST(tco_eolien AS VARCHAR) AS tco_eolien, CAST(tco_solaire AS VARCHAR) AS tco_solaire,
         CAST(tco_hydraulique AS VARCHAR) AS tco_hydraulique,
         CAST(tco_bioenergies AS VARCHAR) AS tco_bioenergies,
         TIMESTAMP '2026-01-01 00:00:00' AS _loaded_at, _row_key
  FROM reg_base WHERE year(dh) < 2022"""),
    ("reg_hist_raw", """
  SELECT nullif(code_insee_region, 'nan') AS code_insee_region,
         nullif(libelle_region, 'nan') AS libelle_region,
         nullif(date_heure, 'nan') AS date_heure, nullif(consommation, 'nan') AS consommation,
         nullif(thermique, 'nan') AS thermique, nullif(nucleaire, 'nan') AS nucleaire,
         nullif(eolien, 'nan') AS eolien, nullif(solaire, 'nan') AS solaire,
         nullif(hydraulique, 'nan') AS hydraulique, nullif(pompage, 'nan') AS pompage,
         nullif(bioenergies, 'nan') AS bioenergies, nullif(ech_physiques, 'nan') AS ech_physiques,
         nullif(eolien_terrestre, 'nan') AS eolien_terrestre,
         nullif(eolien_offshore, 'nan') AS eolien_offshore,
         nullif(tco_thermique, 'nan') AS tco_thermique, nullif(tco_nucleaire, 'nan') AS tco_nucleaire,
         nullif(tco_eolien, 'nan') AS tco_eolien, nullif(tco_solaire, 'nan') AS tco_solaire,
         nullif(tco_hydraulique, 'nan') AS tco_hydraulique,
         nullif(tco_bioenergies, 'nan') AS tco_bioenergies, _loaded_at, _row_key
  FROM reg_hist_landed"""),
    ("reg_rt_raw", """
  SELECT code_insee_region, libelle_region, dh AS date_heure, consommation * 2 AS consommation,
         thermique, nucleaire, eolien, solaire, hydraulique, pompage, bioenergies, ech_physiques,
         tco_thermique, tco_nucleaire, tco_eolien, tco_solaire, tco_hydraulique, tco_bioenergies,
         TIMESTAMP '2026-02-01 00:00:00' + to_seconds(_row_key) AS _loaded_at,
         'eco2mix-regional-tr' AS _source, _row_key
  FROM reg_base WHERE year(dh) >= 2022 OR _row_key % 10 = 0"""),
    ("reg_hist_clean", """
  SELECT CAST(code_insee_region AS VARCHAR) AS code_insee_region,
         CAST(libelle_region AS VARCHAR) AS libelle_region,
         try_cast(date_heure AS TIMESTAMP) AS date_heure,
         try_cast(consommation AS DOUBLE) AS consommation_mw,
         try_cast(thermique AS DOUBLE) AS thermique_mw, try_cast(nucleaire AS DOUBLE) AS nucleaire_mw,
         try_cast(eolien AS DOUBLE) AS eolien_mw, try_cast(solaire AS DOUBLE) AS solaire_mw,
         try_cast(hydraulique AS DOUBLE) AS hydraulique_mw, try_cast(pompage AS DOUBLE) AS pompage_mw,
         try_cast(bioenergies AS DOUBLE) AS bioenergies_mw,
         try_cast(ech_physiques AS DOUBLE) AS ech_physiques_mw,
         try_cast(eolien_terrestre AS DOUBLE) AS eolien_terrestre_mw,
         try_cast(eolien_offshore AS DOUBLE) AS eolien_offshore_mw,
         try_cast(tco_thermique AS DOUBLE) AS tco_thermique,
         try_cast(tco_nucleaire AS DOUBLE) AS tco_nucleaire,
         try_cast(tco_eolien AS DOUBLE) AS tco_eolien, try_cast(tco_solaire AS DOUBLE) AS tco_solaire,
         try_cast(tco_hydraulique AS DOUBLE) AS tco_hydraulique,
         try_cast(tco_bioenergies AS DOUBLE) AS tco_bioenergies,
         CAST(_loaded_at AS TIMESTAMP) AS _loaded_at, _row_key
  FROM reg_hist_raw"""),
    ("reg_rt_clean", """
  SELECT code_insee_region, libelle_region, date_heure, consommation AS consommation_mw,
         thermique AS thermique_mw, nucleaire AS nucleaire_mw, eolien AS eolien_mw,
         solaire AS solaire_mw, hydraulique AS hydraulique_mw, pompage AS pompage_mw,
         bioenergies AS bioenergies_mw, ech_physiques AS ech_physiques_mw,
         CAST(NULL AS DOUBLE) AS eolien_terrestre_mw, CAST(NULL AS DOUBLE) AS eolien_offshore_mw,
         tco_thermique, tco_nucleaire, tco_eolien, tco_solaire, tco_hydraulique, tco_bioenergies,
         _loaded_at, _row_key
  FROM reg_rt_raw"""),
    ("reg_union", """
  SELECT * FROM reg_hist_clean UNION ALL BY NAME SELECT * FROM reg_rt_clean"""),
    ("stg_regional", f"""
  SELECT {REG_STG_COLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY date_heure, libelle_region
                                 ORDER BY _loaded_at DESC NULLS FIRST, _row_key DESC NULLS LAST) AS rn
    FROM reg_union
    WHERE date_heure IS NOT NULL AND consommation_mw IS NOT NULL AND libelle_region IS NOT NULL)
  WHERE rn = 1"""),
    ("int_regional_base", f"""
  SELECT date_heure, code_insee_region, libelle_region, consommation_mw, thermique_mw,
         nucleaire_mw, eolien_mw, solaire_mw, hydraulique_mw, pompage_mw, bioenergies_mw,
         ech_physiques_mw, eolien_terrestre_mw, eolien_offshore_mw, tco_thermique, tco_nucleaire,
         tco_eolien, tco_solaire, tco_hydraulique, tco_bioenergies, _loaded_at,
         CAST(hour(date_heure) AS INTEGER) AS heure,
         CAST(month(date_heure) AS INTEGER) AS mois,
         CAST(year(date_heure) AS INTEGER) AS annee,
         {DAYNAME} AS jour_semaine,
         {WEEKEND} AS flag_weekend,
         {SEASON} AS saison,
         {COVID} AS flag_covid,
         {CRISIS} AS flag_crise_nuc_2022,
         {csum(PROD)} AS production_totale_mw
  FROM stg_regional"""),
    ("int_regional", f"""
  SELECT *,
         {rnd('production_totale_mw / nullif(consommation_mw, 0)', 4)} AS autosuffisance,
         CASE WHEN ech_physiques_mw < 0 THEN 1 ELSE 0 END AS flag_importatrice,
         {share(RENEW)} AS part_renouvelables,
         {share(LOWC)} AS part_bas_carbone,
         {rnd(csum(TCO_R), 2)} AS tco_renouvelables
  FROM int_regional_base"""),
    ("mart_regional_monthly", f"""
  SELECT annee, mois, libelle_region, code_insee_region,
         {rnd('avg(consommation_mw)', 2)} AS avg_consommation_mw,
         {rnd('avg(production_totale_mw)', 2)} AS avg_production_mw,
         {rnd('avg(nucleaire_mw)', 2)} AS avg_nucleaire_mw,
         {rnd('avg(eolien_mw)', 2)} AS avg_eolien_mw,
         {rnd('avg(solaire_mw)', 2)} AS avg_solaire_mw,
         {rnd('avg(hydraulique_mw)', 2)} AS avg_hydraulique_mw,
         {rnd('avg(thermique_mw)', 2)} AS avg_thermique_mw,
         {rnd('avg(bioenergies_mw)', 2)} AS avg_bioenergies_mw,
         {rnd('avg(autosuffisance)', 4)} AS autosuffisance_moyenne,
         {rnd('avg(part_renouvelables)', 4)} AS part_renouvelables_moyenne,
         {rnd('avg(part_bas_carbone)', 4)} AS part_bas_carbone_moyenne,
         {rnd('avg(tco_renouvelables)', 2)} AS tco_renouvelables_moyen,
         max(flag_covid) AS flag_covid, max(flag_crise_nuc_2022) AS flag_crise_nuc_2022,
         count(*) AS nb_observations
  FROM int_regional
  GROUP BY annee, mois, libelle_region, code_insee_region"""),
]

_EXTRA: list[tuple[str, str]] = []


def add_cte(name: str, body: str) -> None:
    """Register an additional CTE (used by later layers: upserts, checks, BI)."""
    _EXTRA.append((name, body))


def with_prefix() -> str:
    parts = [f"{name} AS ({body}\n)" for name, body in CTES + _EXTRA]
    return "WITH " + ",\n".join(parts) + "\n"


def query(select: str) -> str:
    return with_prefix() + select
