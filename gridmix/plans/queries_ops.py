"""Registered queries: merges, incremental builds, checks, load/freshness
reports and the half-hour window (SURVEY §2.2, 2.4, 2.6, 2.11, 2.13)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from gridmix.operators import quality
from gridmix.operators.upsert import (NATIONAL_FEED, REGIONAL_FEED, MergeSpec,
                                      incremental_merge, incremental_source, incremental_sync,
                                      upsert)
from gridmix.plans import enrich, marts, models, staging
from gridmix.plans import oracle as O
from gridmix.plans.catalog import register
from gridmix.session import staged
from gridmix.sources import adapter
from gridmix.sources.schemas import NATIONAL_RT_MEASURES, REGIONAL_RT_MEASURES
from gridmix.streaming.feed import half_hour_stream, run_available_now, source_state, table_stream
from gridmix.streaming.windows import half_hour_stats

# Fixed values of the registered scenarios.
BATCH_LOADED_AT = datetime(2026, 3, 1)
LOOKBACK = "3 DAYS"
NATIONAL_MIN_ROWS, REGIONAL_MIN_ROWS = 400_000, 1_000_000
OLD_MART_DROPPED = ["ecart_prevision_mw", "part_fossiles"]
# ---- feed batches: the history re-delivered through the real-time feed ----


def national_feed_batch(spark, src):
    b = adapter.national_base(spark, src).filter(F.year("dh") < adapter.REALTIME_FROM_YEAR)
    return b.select(F.col("dh").alias("date_heure"), *NATIONAL_RT_MEASURES, "_row_key")


def regional_feed_batch(spark, src):
    b = adapter.regional_base(spark, src).filter(F.year("dh") < adapter.REALTIME_FROM_YEAR)
    return b.select("code_insee_region", "libelle_region", F.col("dh").alias("date_heure"),
                    *REGIONAL_RT_MEASURES, "_row_key")


O.add_cte("nat_batch", """
  SELECT dh AS date_heure, consommation, prevision_j1, prevision_j, fioul, charbon, gaz, nucleaire,
         eolien, solaire, hydraulique, pompage, bioenergies, ech_physiques, taux_co2, _row_key
  FROM nat_base WHERE year(dh) < 2022""")
O.add_cte("reg_batch", """
  SELECT code_insee_region, libelle_region, dh AS date_heure, consommation, thermique, nucleaire,
         eolien, solaire, hydraulique, pompage, bioenergies, ech_physiques, tco_thermique,
         tco_nucleaire, tco_eolien, tco_solaire, tco_hydraulique, tco_bioenergies, _row_key
  FROM reg_base WHERE year(dh) < 2022""")

NAT_RT_COLS = ["date_heure"] + NATIONAL_RT_MEASURES + ["_loaded_at", "_source", "_row_key"]
REG_RT_COLS = (["code_insee_region", "libelle_region", "date_heure"] + REGIONAL_RT_MEASURES
               + ["_loaded_at", "_source", "_row_key"])
NAT_BATCH_COLS = ["date_heure"] + NATIONAL_RT_MEASURES + ["_row_key"]
REG_BATCH_COLS = (["code_insee_region", "libelle_region", "date_heure"] + REGIONAL_RT_MEASURES
                  + ["_row_key"])


def merge_sql(target: str, batch: str, spec: MergeSpec, tcols: list[str], bcols: list[str],
              stamp: str) -> str:
    """Reference MERGE as a full outer join, one CASE per target column."""
    keys = list(spec.keys)
    nonnull = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    anynull = " OR ".join(f"{k} IS NULL" for k in keys)
    last = (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY "
            f"{', '.join(keys)} ORDER BY _row_key DESC NULLS LAST) AS rn FROM {batch} "
            f"WHERE {nonnull}) WHERE rn = 1 UNION ALL BY NAME SELECT * FROM {batch} WHERE {anynull}")
    changed = " OR ".join(f"coalesce(t.{c} <> s.{c}, false)" for c in spec.changed_when)
    upd = f"s._s IS NOT NULL AND ({changed})"
    ts = f"TIMESTAMP '{stamp}'"
    cols = []
    for c in tcols:
        if c == spec.stamp_col:
            ins, up = ts, ts
        elif c == spec.tag_col:
            ins, up = f"'{spec.tag_value}'", f"t.{c}"
        else:
            ins = f"s.{c}" if c in bcols else "NULL"
            up = f"s.{c}" if c in spec.update_cols else f"t.{c}"
        cols.append(f"CASE WHEN t._t IS NULL THEN {ins} WHEN {upd} THEN {up} ELSE t.{c} END AS {c}")
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    return (f"SELECT {', '.join(cols)} FROM (SELECT *, true AS _t FROM {target}) t "
            f"FULL OUTER JOIN (SELECT *, true AS _s FROM ({last})) s ON {on}")


@register("upsert_national", O.query(merge_sql(
    "nat_rt_raw", "nat_batch", NATIONAL_FEED, NAT_RT_COLS, NAT_BATCH_COLS, "2026-03-01 00:00:00")))
def upsert_national(spark, src):
    """Merge the re-delivered national history into the real-time table."""
    return upsert(models.raw_national_realtime(spark, src), national_feed_batch(spark, src),
                  NATIONAL_FEED, BATCH_LOADED_AT)


@register("upsert_regional", O.query(merge_sql(
    "reg_rt_raw", "reg_batch", REGIONAL_FEED, REG_RT_COLS, REG_BATCH_COLS, "2026-03-01 00:00:00")))
def upsert_regional(spark, src):
    return upsert(models.raw_regional_realtime(spark, src), regional_feed_batch(spark, src),
                  REGIONAL_FEED, BATCH_LOADED_AT)


# ---- incremental mart (K7, K8, F4, J4, A11, T3) ---------------------------
# The previous build of the incremental mart was made from the history alone
# (before the real-time feed existed); this run sees history + real time.

O.add_cte("nat_hist_union", "SELECT * FROM nat_hist_clean")
O.add_cte("stg_national_hist", O.stg_national_body("nat_hist_union"))
O.add_cte("int_national_hist", O.int_national_body("stg_national_hist"))
O.add_cte("mart_national_hist", O.mart_national_body("int_national_hist"))


def previous_mart(spark, src):
    """The mart as the previous run stored it: built from the history alone,
    written once; mark, kept rows and lookback read the stored table."""
    stg = staging.stg_national(models.raw_national_history(spark, src))
    return staged(marts.mart_national(enrich.int_national(stg)), "previous-mart")


_HW = "(SELECT max(date_heure) FROM mart_national_hist)"


@register("incremental_filter", O.query(f"SELECT * FROM int_national WHERE date_heure > {_HW}"))
def incremental_filter(spark, src):
    """Rows after the target's high-water mark: the latest reading it was made
    from, which needs no deduplication."""
    rows = staging.national_rows(models.raw_national_history(spark, src))
    return incremental_source(models.int_national(spark, src), rows)


@register("mart_national_incremental", O.query(
    f"SELECT * FROM mart_national_hist UNION ALL "
    f"SELECT * FROM mart_national WHERE date_heure > {_HW}"))
def mart_national_incremental(spark, src):
    """Strict incremental run: late and corrected rows at or before the mark
    are not re-read (faithful to the high-water rule)."""
    return incremental_merge(previous_mart(spark, src), models.mart_national(spark, src),
                             ["date_heure"])


O.add_cte("lookback_rows", f"SELECT * FROM mart_national WHERE date_heure > {_HW} - INTERVAL 3 DAY")


@register("incremental_lookback", O.query(
    "SELECT * FROM mart_national_hist WHERE date_heure NOT IN (SELECT date_heure FROM lookback_rows) "
    "UNION ALL SELECT * FROM lookback_rows"))
def incremental_lookback(spark, src):
    """Incremental run that re-reads a lookback window and replaces re-delivered keys."""
    return incremental_merge(previous_mart(spark, src), models.mart_national(spark, src),
                             ["date_heure"], lookback=LOOKBACK)


_KEPT = [c for c in marts.MART_NATIONAL_COLUMNS if c not in OLD_MART_DROPPED]


def _old_mart(spark, src):
    """Previous build under an older model version: two columns missing, one
    since removed (``co2_label``)."""
    return previous_mart(spark, src).select(*_KEPT, F.col("indice_vert").alias("co2_label"))


@register("sync_columns", O.query(
    f"SELECT {', '.join(_KEPT)}, CAST(NULL AS DOUBLE) AS ecart_prevision_mw, "
    f"CAST(NULL AS DOUBLE) AS part_fossiles FROM mart_national_hist UNION ALL "
    f"SELECT {', '.join(_KEPT)}, ecart_prevision_mw, part_fossiles FROM mart_national "
    f"WHERE date_heure > {_HW}"))
def sync_columns_q(spark, src):
    return incremental_sync(_old_mart(spark, src), models.mart_national(spark, src),
                            ["date_heure"])


# ---- data checks (Q1-Q4) ---------------------------------------------------

def _check_sql(c: quality.Check) -> str:
    head = (f"SELECT '{c.model}' AS model, '{c.column}' AS column_name, '{c.test}' AS test, "
            f"'{c.severity}' AS severity, ")
    if c.test == "not_null":
        body = f"(SELECT count(*) FROM {c.model} WHERE {c.column} IS NULL)"
    elif c.test == "unique":
        body = (f"(SELECT count(*) FROM (SELECT {c.column} FROM {c.model} WHERE {c.column} "
                f"IS NOT NULL GROUP BY {c.column} HAVING count(*) > 1))")
    else:
        vals = ", ".join(f"'{v}'" for v in c.values)
        body = (f"(SELECT count(DISTINCT {c.column}) FROM {c.model} WHERE {c.column} IS NOT NULL "
                f"AND {c.column} NOT IN ({vals}))")
    return head + f"CAST({body} AS BIGINT) AS failures"


def _report_sql(checks: list[quality.Check]) -> str:
    rows = " UNION ALL ".join(_check_sql(c) for c in checks)
    return O.query(f"SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' "
                   f"THEN 'warn' ELSE 'fail' END AS status FROM ({rows})")


def _checked_models(spark, src, wanted):
    """The wanted models over the two staging ones, which are stored once: staging
    checks read them, and the enriched models are projections of them."""
    found = {}
    if any("regional" in n for n in wanted):
        stg = staged(models.stg_regional(spark, src), "checked-regional")
        regional = enrich.int_regional(stg)
        found |= {"stg_regional": stg, "int_regional": regional,
                  "mart_regional_monthly": marts.mart_regional_monthly(regional, ordered=False)}
    if any("regional" not in n for n in wanted):
        stg = staged(models.stg_national(spark, src), "checked-national")
        national = enrich.int_national(stg)
        patterns = marts.mart_patterns(national)
        found |= {"stg_national": stg, "int_national": national, "mart_national": marts.mart_national(national),
                  "mart_patterns": patterns, "green_hours": marts.green_hours(patterns, ordered=False)}
    return {n: found[n] for n in sorted(wanted)}


def _report(checks):
    def fn(spark, src):
        return quality.run_checks(_checked_models(spark, src, {c.model for c in checks}), checks)
    return fn


for _key, _test in [("dq_not_null", "not_null"), ("dq_unique", "unique"),
                    ("dq_accepted_values", "accepted_values")]:
    _checks = [c for c in quality.MODEL_CHECKS if c.test == _test]
    register(_key, _report_sql(_checks))(_report(_checks))
register("dq_report", _report_sql(quality.MODEL_CHECKS))(_report(quality.MODEL_CHECKS))


# ---- load and freshness reports (A9, A10, Q5, Q6, T4) ----------------------

@register("load_stats", O.query(
    f"SELECT 'national_history' AS table_name, count(*) AS n_rows, min(date_heure) AS "
    f"min_date_heure, max(date_heure) AS max_date_heure, CAST({NATIONAL_MIN_ROWS} AS BIGINT) "
    f"AS min_rows, count(*) >= {NATIONAL_MIN_ROWS} AS gate_ok FROM nat_hist_raw UNION ALL "
    f"SELECT 'regional_history', count(*), min(date_heure), max(date_heure), "
    f"CAST({REGIONAL_MIN_ROWS} AS BIGINT), count(*) >= {REGIONAL_MIN_ROWS} FROM reg_hist_raw"))
def load_stats(spark, src):
    """Backfill verification: count, min, max of the text time and the gate."""
    return quality.load_stats(models.raw_national_history(spark, src), "national_history",
                              "date_heure", NATIONAL_MIN_ROWS).unionByName(
        quality.load_stats(models.raw_regional_history(spark, src), "regional_history",
                           "date_heure", REGIONAL_MIN_ROWS))


@register("freshness", O.query(
    "SELECT 'national_realtime' AS table_name, count(*) AS n_rows, max(date_heure) AS "
    "max_date_heure, max(_loaded_at) AS checked_at, "
    "max(date_heure) < max(_loaded_at) - INTERVAL 2 HOUR AS is_stale FROM nat_rt_raw UNION ALL "
    "SELECT 'regional_realtime', count(*), max(date_heure), max(_loaded_at), "
    "max(date_heure) < max(_loaded_at) - INTERVAL 2 HOUR FROM reg_rt_raw"))
def freshness(spark, src):
    return quality.freshness(models.raw_national_realtime(spark, src), "national_realtime") \
        .unionByName(quality.freshness(models.raw_regional_realtime(spark, src),
                                       "regional_realtime"))


# ---- half-hour tumbling window (T6) ----------------------------------------

@register("half_hour_window", O.query(
    f"SELECT time_bucket(INTERVAL '30 minutes', ts) AS window_start, "
    f"time_bucket(INTERVAL '30 minutes', ts) + INTERVAL 30 MINUTE AS window_end, "
    f"count(*) AS n_readings, {O.rnd('avg(value)', 4)} AS avg_value, max(value) AS max_value "
    f"FROM events WHERE ts IS NOT NULL GROUP BY 1, 2"))
def half_hour_window(spark, src):
    """Sub-half-hour readings (the event stream) on the 30-minute grid."""
    return half_hour_stats(adapter.table(spark, src, "events"), "ts", "value")


@register("half_hour_window_stream", O.query(
    f"SELECT * FROM (SELECT time_bucket(INTERVAL '30 minutes', ts) AS window_start, "
    f"time_bucket(INTERVAL '30 minutes', ts) + INTERVAL 30 MINUTE AS window_end, "
    f"count(*) AS n_readings, {O.rnd('avg(value)', 4)} AS avg_value, max(value) AS max_value "
    f"FROM events WHERE ts IS NOT NULL GROUP BY 1, 2) "
    f"WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR"))
def half_hour_window_stream(spark, src):
    """The same windows as a Structured Streaming query over the event table:
    2-hour watermark, append mode, run with ``availableNow``. A window is
    emitted once the watermark (latest event time - 2 h) has passed its end."""
    stream = table_stream(spark, src, "events").select("ts", "value")
    return run_available_now(half_hour_stream(stream, "ts", "value"), "half-hour-stream",
                             source_state(spark, f"{src}/events.parquet"))
