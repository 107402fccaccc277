"""Registered queries: corrected and late readings through the marts, overlapping
deliveries through a stream, types of landed columns (SURVEY §2: T3, T5, P4)."""

from __future__ import annotations

import hashlib
import re
from datetime import datetime

from pyspark.sql import functions as F

from gridmix.operators.upsert import NATIONAL_FEED, REGIONAL_FEED, changed_keys, upsert, upsert_changes
from gridmix.plans import changes, enrich, marts, models, staging
from gridmix.plans import oracle as O
from gridmix.plans.catalog import register
from gridmix.plans.queries_ops import (NAT_BATCH_COLS, NAT_RT_COLS, REG_BATCH_COLS, REG_RT_COLS, merge_sql)
from gridmix.session import checkpoint_dir, staged
from gridmix.sources import adapter, types
from gridmix.sources.bronze import load_history
from gridmix.sources.schemas import NATIONAL_RT_MEASURES, REGIONAL_RT_MEASURES
from gridmix.streaming import dedup
from gridmix.streaming.feed import run_available_now, source_state

# Fixed values of the scenario: the latest days come again with other values, a month comes late.
CORRECTED_AT = datetime(2026, 3, 1)
CORRECTED_DAYS, LATE_YEAR, LATE_MONTH = 31, 2021, 12

# ---- corrected and late readings (T3) ----------------------------------------------


def _correction(base, measures, keys):
    """The latest days of the feed with a higher consumption, and a month of the
    past that is delivered for the first time."""
    newest = base.select(F.max("dh")).scalar()
    latest = F.col("dh") >= newest - F.expr(f"INTERVAL {CORRECTED_DAYS} DAYS")
    late = (F.year("dh") == LATE_YEAR) & (F.month("dh") == LATE_MONTH)
    b = base.where(latest | late).withColumn("consommation", F.col("consommation") * 2 + F.when(latest, 100).otherwise(0))
    return b.select(*keys, F.col("dh").alias("date_heure"), *measures, "_row_key")


def _national_tables(spark, src):
    """Raw history, raw real time and the correction. The readings they are made
    from are written once: later steps read them instead of joining the driver tables again."""
    base = staged(adapter.national_base(spark, src), "national-base")
    return (load_history(adapter.national_history_of(base)), adapter.national_realtime_of(base),
            _correction(base, NATIONAL_RT_MEASURES, []))


def _regional_tables(spark, src):
    base = staged(adapter.regional_base(spark, src), "regional-base")
    return (load_history(adapter.regional_history_of(base)), adapter.regional_realtime_of(base),
            _correction(base, REGIONAL_RT_MEASURES, ["code_insee_region", "libelle_region"]))


def _corrected_sql(base, batch, measures, keys):
    latest = f"dh >= (SELECT max(dh) FROM {base}) - INTERVAL {CORRECTED_DAYS} DAY"
    rest = ", ".join(m for m in measures if m != "consommation")
    O.add_cte(batch, f"""
  SELECT {''.join(k + ', ' for k in keys)}dh AS date_heure,
         consommation * 2 + CASE WHEN {latest} THEN 100 ELSE 0 END AS consommation, {rest}, _row_key
  FROM {base} WHERE {latest} OR (year(dh) = {LATE_YEAR} AND month(dh) = {LATE_MONTH})""")


# the models over the merged tables: every CTE after the raw table, under a second name
_AFTER = ["nat_rt_clean", "nat_union", "stg_national", "int_national", "mart_national", "pattern_cells",
          "mart_patterns", "reg_rt_clean", "reg_union", "stg_regional", "int_regional_base", "int_regional",
          "mart_regional_monthly"]


def _second_names(body):
    names = "|".join(["nat_rt_raw", "reg_rt_raw", *_AFTER])
    return re.sub(rf"(FROM|JOIN) ({names})\b", r"\1 \2_fixed", body)


_corrected_sql("nat_base", "nat_fix", NATIONAL_RT_MEASURES, [])
_corrected_sql("reg_base", "reg_fix", REGIONAL_RT_MEASURES, ["code_insee_region", "libelle_region"])
O.add_cte("nat_rt_raw_fixed", merge_sql("nat_rt_raw", "nat_fix", NATIONAL_FEED, NAT_RT_COLS, NAT_BATCH_COLS,
                                        "2026-03-01 00:00:00"))
O.add_cte("reg_rt_raw_fixed", merge_sql("reg_rt_raw", "reg_fix", REGIONAL_FEED, REG_RT_COLS, REG_BATCH_COLS,
                                        "2026-03-01 00:00:00"))
_BODIES = dict(O.CTES)
for _name in _AFTER:
    O.add_cte(f"{_name}_fixed", _second_names(_BODIES[_name]))


def _national(spark, src):
    """(changed mart, stored mart, touched times): the stored mart with the touched readings replaced."""
    history, target, batch = _national_tables(spark, src)
    found = upsert_changes(target, batch, NATIONAL_FEED, CORRECTED_AT)
    times = staged(changes.touched_times(changed_keys(found)), "touched-times")
    after = staging.stg_national(history, upsert(target, batch, NATIONAL_FEED, CORRECTED_AT))
    old = staged(marts.mart_national(enrich.int_national(staging.stg_national(history, target))), "mart-before")
    return changes.mart_national(old, after, times), old, times


@register("feed_changes", O.query(
    "SELECT f.date_heure, f._row_key, f.n AS n_after, coalesce(t.n, 0) AS n_before FROM "
    "(SELECT date_heure, _row_key, count(*) AS n FROM (SELECT * FROM nat_rt_raw_fixed EXCEPT ALL "
    "SELECT * FROM nat_rt_raw) GROUP BY ALL) f LEFT JOIN (SELECT date_heure, _row_key, count(*) AS n FROM "
    "(SELECT * FROM nat_rt_raw EXCEPT ALL SELECT * FROM nat_rt_raw_fixed) GROUP BY ALL) t "
    "ON t.date_heure = f.date_heure AND t._row_key = f._row_key"))
def feed_changes(spark, src):
    """Change rows of a merge: for each changed reading how many rows came and went."""
    _, target, batch = _national_tables(spark, src)
    found = upsert_changes(target, batch, NATIONAL_FEED, CORRECTED_AT)
    return found.groupBy(F.col("after.date_heure").alias("date_heure"), F.col("after._row_key").alias("_row_key")).agg(
        F.count(F.lit(1)).alias("n_after"), F.count("before").alias("n_before"))


@register("mart_national_corrected", O.query("SELECT * FROM mart_national_fixed"))
def mart_national_corrected(spark, src):
    """Corrected and late readings replace only the touched rows; equal to a full build."""
    return _national(spark, src)[0]


@register("mart_patterns_corrected", O.query("SELECT * FROM mart_patterns_fixed"))
def mart_patterns_corrected(spark, src):
    """Touched cells are computed anew; the others are those of the stored mart, which
    has every column that cells need."""
    readings, old, times = _national(spark, src)
    return changes.mart_patterns(marts.mart_patterns(old), staged(readings, "mart-after"), times)


@register("mart_regional_monthly_corrected", O.query("SELECT * FROM mart_regional_monthly_fixed"))
def mart_regional_monthly_corrected(spark, src):
    history, target, batch = _regional_tables(spark, src)
    found = upsert_changes(target, batch, REGIONAL_FEED, CORRECTED_AT)
    readings = staged(changes.touched_readings(changed_keys(found)), "touched-readings")
    after = staging.stg_regional(history, upsert(target, batch, REGIONAL_FEED, CORRECTED_AT))
    before = staged(enrich.int_regional(staging.stg_regional(history, target)), "readings-before")
    return changes.mart_regional_monthly(marts.mart_regional_monthly(before, ordered=False), before, after, readings)


# ---- overlapping deliveries (T5) -----------------------------------------------------

EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value"]
POLLED_FILES = 4            # files of a micro-batch: several batches on any table
KEEP_KEYS = "8 days"        # a delivery's span: a week and the day before it


@register("events_once_stream", "SELECT event_id, ts, user_id, event_type, value FROM events WHERE ts IS NOT NULL")
def events_once_stream(spark, src):
    """The event table delivered in weekly polls that overlap by a day, as a stream
    in which each event passes once."""
    state = source_state(spark, f"{src}/events.parquet")
    folder = f"{checkpoint_dir(spark)}/event-polls-{hashlib.sha1(state.encode()).hexdigest()[:12]}"
    events = adapter.table(spark, src, "events").select(*EVENT_COLUMNS)
    dedup.deliver(events, folder, "ts")
    stream = (spark.readStream.schema(events.schema).option("maxFilesPerTrigger", POLLED_FILES)
              .option("recursiveFileLookup", True).parquet(folder))
    return run_available_now(dedup.once(stream, ["event_id"], "ts", KEEP_KEYS), "events-once", state)


# ---- types of landed columns (P4) -----------------------------------------------------

LANDED_TEXT = ["consommation", "nucleaire", "thermique", "eolien", "solaire", "hydraulique", "bioenergies",
               "tco_eolien", "date_heure", "libelle_region"]


def _kind_sql(c):
    text = f"CAST({c} AS VARCHAR)"
    counts = (f"count({c}) AS n_values, count(*) FILTER (regexp_matches({text}, '{types.NUMBER}')) AS n_numbers, "
              f"count(*) FILTER (regexp_matches({text}, '{types.WHOLE}')) AS n_whole, count(*) AS n_rows")
    return f"SELECT '{c}' AS column_name, {counts} FROM reg_hist_text"


O.add_cte("reg_hist_text", "SELECT " + ", ".join(
    f"CAST({c} AS VARCHAR) AS {c}" for c in LANDED_TEXT) + " FROM reg_hist_raw")


@register("column_kinds", O.query(
    "SELECT column_name, n_values, n_numbers, n_whole, CASE WHEN n_numbers < n_values THEN 'text' "
    "WHEN n_whole = n_values AND n_values = n_rows AND n_rows > 0 THEN 'whole' ELSE 'number' END AS kind FROM ("
    + " UNION ALL ".join(_kind_sql(c) for c in LANDED_TEXT) + ")"))
def column_kinds(spark, src):
    """Least type that holds every landed value, per column of the regional history."""
    raw = models.raw_regional_history(spark, src)
    return types.column_kinds(raw.select(*[F.col(c).cast("string").alias(c) for c in LANDED_TEXT]))
