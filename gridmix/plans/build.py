"""Warehouse refresh: raw (bronze) -> enriched (silver) -> marts (gold).

A warehouse is a folder ``wh`` with a database per layer (:func:`table_of`)::

    raw.national_history, raw.regional_history       text columns, kept by year
    raw.national_realtime, raw.regional_realtime     instants, kept by day
    raw.load_log                                     what each load wrote
    raw.*_quarantine                                 rejected rows and responses
    silver.int_national, silver.int_regional         full refresh, read by several marts
    gold.mart_national                               incremental, kept by month
    gold.mart_patterns, gold.green_hours,
    gold.mart_regional_monthly                       full refresh
    gold.check_failures                              failing rows of the checks, by run

Staging is a lazy view, as in the source design (:func:`register_views` names
it); the enriched models are materialised once because three marts read the
national one. The green-hour mart reads the stored patterns mart instead of
recomputing it.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from gridmix.functions.cleaning import instant_of, ntz_of
from gridmix.operators import quality
from gridmix.operators.upsert import incremental_source, sync_columns
from gridmix.plans import changes, enrich, marts, staging
from gridmix.session import staged
from gridmix.sources import adapter, readers, sinks
from gridmix.sources.bronze import load_history
from gridmix.sources.schemas import NATIONAL_HISTORY_TEXT, REGIONAL_HISTORY_TEXT
from gridmix.streaming.feed import FEED_GRAIN, feed_schema, ingest_feed, run_feed

# A lookback run rewrites the one or two months it re-reads, not the year.
MART_GRAIN = "month"


# ---- names ---------------------------------------------------------------------

def database_of(wh: str, layer: str) -> str:
    """Database of a layer: the folder's last two names and the layer's."""
    parts = [p for p in re.split(r"[/\\]", wh) if p][-2:]
    return re.sub(r"\W", "_", "_".join([*parts, layer])).lower()


def table_of(spark: SparkSession, wh: str, layer: str, name: str) -> str:
    """Qualified name of a table; its database is created if there is none."""
    database = database_of(wh, layer)
    sinks.ensure_database(spark, database, os.path.join(wh, layer))
    return f"{database}.{name}"


def read(spark: SparkSession, wh: str, layer: str, name: str, values: list[str] | None = None) -> DataFrame:
    return sinks.read_table(spark, table_of(spark, wh, layer, name), values)


def register_views(spark: SparkSession, wh: str) -> list[str]:
    """Name the staging models for SQL: views over the raw tables that every
    session of the application sees. The stored models have their names in the
    catalog already. Returns the qualified names."""
    names = []
    for name, model in (("stg_national", stg_national), ("stg_regional", stg_regional)):
        view = f"{database_of(wh, 'staging')}_{name}"
        model(spark, wh).createOrReplaceGlobalTempView(view)
        names.append(f"global_temp.{view}")
    return names


# ---- raw -----------------------------------------------------------------------

def _as_text(history: DataFrame) -> DataFrame:
    """Raw history keeps every column as text but the load stamp."""
    return history.select(*[F.col(c) if c == "_loaded_at" else F.col(c).cast("string").alias(c)
                            for c in history.columns])


def feed_form(realtime: DataFrame, regional: bool) -> DataFrame:
    """Zone-less Paris readings in the form of a raw real-time table."""
    return realtime.withColumn("date_heure", instant_of(F.col("date_heure"))).select(
        *feed_schema(regional).fieldNames())


def land_raw(spark: SparkSession, src_dir: str, wh: str) -> None:
    """Derive the four raw tables whole from the driver tables."""
    for name, landed in (("national_history", adapter.national_history_landed),
                         ("regional_history", adapter.regional_history_landed)):
        rows, load = observed(_as_text(load_history(landed(spark, src_dir))))
        sinks.rewrite(rows, table_of(spark, wh, "raw", name))
        log_load(spark, wh, name, load(), replaces=True)
    for name, realtime, regional in (("national_realtime", adapter.national_realtime, False),
                                     ("regional_realtime", adapter.regional_realtime, True)):
        sinks.rewrite(feed_form(realtime(spark, src_dir), regional), table_of(spark, wh, "raw", name),
                      grain=FEED_GRAIN)


# ---- load report: metrics of the write's own pass --------------------------------

LOAD_LOG = ("table_name string, n_rows bigint, rows_without_time bigint, min_date_heure string, "
            "max_date_heure string, replaces boolean, loaded_at timestamp_ntz")


def observed(rows: DataFrame) -> tuple[DataFrame, Callable[[], dict]]:
    """``rows``, and the figures of a load report taken while they are written.

    A plan that turns out to have no rows is dropped with its counters; the
    figures are then asked of the rows themselves.
    """
    load = Observation()
    wanted = [F.count(F.lit(1)).alias("n_rows"), sinks.rows_without_time(rows).alias("rows_without_time"),
              F.min("date_heure").alias("min_date_heure"), F.max("date_heure").alias("max_date_heure")]

    def figures() -> dict:
        try:
            return load.get
        except Py4JJavaError:
            return rows.agg(*wanted).first().asDict()
    return rows.observe(load, *wanted), figures


def log_load(spark: SparkSession, wh: str, name: str, got: dict, replaces: bool = False) -> None:
    """Note a load; ``replaces``: its figures are those of the whole table."""
    row = (name, got["n_rows"], got["rows_without_time"], got["min_date_heure"], got["max_date_heure"], replaces,
           datetime.now(timezone.utc).replace(tzinfo=None))
    spark.createDataFrame([row], LOAD_LOG).coalesce(1).write.mode("append").saveAsTable(
        table_of(spark, wh, "raw", "load_log"), format="parquet")


def logged(spark: SparkSession, wh: str, name: str, min_rows: int) -> DataFrame:
    """Load report of a raw table from the log of its loads: those since the last that replaced it."""
    log = spark.table(table_of(spark, wh, "raw", "load_log")).where(F.col("table_name") == name)
    since = log.where("replaces").select(F.max("loaded_at")).scalar()
    now = log.where((F.col("loaded_at") >= since) | since.isNull())
    return now.agg(F.lit(name).alias("table_name"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
                   F.min("min_date_heure").alias("min_date_heure"),
                   F.max("max_date_heure").alias("max_date_heure")).select(
        "*", F.lit(min_rows).cast("bigint").alias("min_rows"), (F.col("n_rows") >= min_rows).alias("gate_ok"))


# Minimum rows after a full backfill.
NATIONAL_MIN_ROWS, REGIONAL_MIN_ROWS = 400_000, 1_000_000


def verify_load(spark: SparkSession, wh: str, national_min: int = NATIONAL_MIN_ROWS,
                regional_min: int = REGIONAL_MIN_ROWS) -> DataFrame:
    """Backfill check: count / min / max per history table; raises when a
    table holds fewer rows than its minimum. Returns the two-row report."""
    report = quality.load_stats(_raw(spark, wh, "national_history"), "national_history",
                                "date_heure", national_min).unionByName(
        quality.load_stats(_raw(spark, wh, "regional_history"), "regional_history",
                           "date_heure", regional_min))
    rows = report.collect()          # two rows
    short = [r for r in rows if not r["gate_ok"]]
    if short:
        raise quality.CheckFailed("; ".join(
            f"{r['table_name']}: only {r['n_rows']} rows, expected at least {r['min_rows']}"
            for r in short))
    return report


def backfill_exports(spark: SparkSession, export_paths: str | list[str], wh: str,
                     regional: bool = False, loaded_at=None, min_rows: int | None = None,
                     whole_years: bool = False, bad_rows: str = "raise") -> DataFrame:
    """Load landed ``;`` exports into a raw history table.

    Columns go by their header names (extra ones are kept, a missing needed one
    is an error); the load step stamps the batch. Rows are appended: staging
    keeps the latest load of a reading, so a part of a year, or a year again,
    loses nothing. ``whole_years`` says that the files hold every reading of
    each year they touch, whose earlier loads are then replaced; rows without a
    usable time are appended even so. Exports without rows load nothing.

    A row with too many fields, or a file with an open quote, fails the load
    before anything is written; with ``bad_rows="quarantine"`` such rows go to
    the table's quarantine instead and are counted in the report.

    Returns the load report, with the rows of this load and those of them whose
    time can't be parsed; raises below ``min_rows``. Its figures are taken while
    the rows are written and added to the log of earlier loads; only a load that
    replaces years counts the table anew.
    """
    if bad_rows not in ("raise", "quarantine"):
        raise ValueError(f"bad_rows is raise or quarantine, not {bad_rows}")
    needed = REGIONAL_HISTORY_TEXT if regional else NATIONAL_HISTORY_TEXT
    name = "regional_history" if regional else "national_history"
    table = table_of(spark, wh, "raw", name)
    stamp = loaded_at or datetime.now(timezone.utc).replace(tzinfo=None)
    n_rejected = 0
    if bad_rows == "raise":
        landed = readers.read_export(spark, export_paths, needed)
    else:
        scanned = readers.scan_export(spark, export_paths, needed)
        bad = staged(scanned.where(F.col(readers.REASON).isNotNull()).select(
            F.col(readers.FILE).alias("file"), F.col(readers.REASON).alias("reason"),
            F.col(readers.RECORD).alias("record"), ntz_of(stamp).alias("at")), "rejected-rows")
        n_rejected = bad.count()
        landed = scanned.where(F.col(readers.REASON).isNull()).drop(
            readers.REASON, readers.RECORD, readers.FILE)
    rows, load = observed(_as_text(load_history(landed, stamp)))
    if whole_years:
        if sinks.exists(spark, table):      # rows without a time stay, beside the new ones
            rows = rows.unionByName(sinks.read_table(spark, table, [sinks.NO_VALUE]), allowMissingColumns=True)
        sinks.overwrite_partitions(rows, table)
    else:
        sinks.append(rows, table)
    got = load()
    if n_rejected:
        bad.write.mode("append").saveAsTable(f"{table}_quarantine", format="parquet")
    floor = min_rows if min_rows is not None else (
        REGIONAL_MIN_ROWS if regional else NATIONAL_MIN_ROWS)
    if whole_years:
        whole = quality.load_stats(sinks.read_table(spark, table), name, "date_heure", floor).first()
        log_load(spark, wh, name, {**whole.asDict(), "rows_without_time": got["rows_without_time"]}, replaces=True)
    else:
        log_load(spark, wh, name, got)
    report = (logged(spark, wh, name, floor)
              .withColumn("rows_loaded", F.lit(got["n_rows"]).cast("bigint"))
              .withColumn("rows_without_time", F.lit(got["rows_without_time"]).cast("bigint"))
              .withColumn("rows_rejected", F.lit(n_rejected).cast("bigint")))
    row = report.first()
    if got["n_rows"] and not row["gate_ok"]:
        raise quality.CheckFailed(f"{name}: only {row['n_rows']} rows, expected at least {floor}")
    return report


def _feed_places(spark: SparkSession, wh: str, regional: bool) -> tuple[str, str]:
    """(raw table, checkpoint folder) of a feed."""
    name = "regional_realtime" if regional else "national_realtime"
    return table_of(spark, wh, "raw", name), os.path.join(wh, "_checkpoints", name)


def ingest_realtime(spark: SparkSession, landing_dir: str, wh: str, regional: bool = False,
                    available_now: bool = True):
    """Start the feed stream into the warehouse's raw real-time table (checkpoint
    kept next to the tables)."""
    return ingest_feed(spark, landing_dir, *_feed_places(spark, wh, regional), regional, available_now)


def run_realtime(spark: SparkSession, landing_dir: str, wh: str, regional: bool = False) -> None:
    """Hourly feed run, responses in quarantine included; raises
    :class:`gridmix.streaming.feed.RejectedResponses` while any can't be read."""
    run_feed(spark, landing_dir, *_feed_places(spark, wh, regional), regional)


def verify_recent(spark: SparkSession, wh: str, regional: bool = False,
                  max_age_hours: int = 2, now: datetime | None = None) -> DataFrame:
    """Freshness report after a feed run: row count, newest reading and
    whether it is older than ``max_age_hours`` at ``now`` (by default the time
    of the call, so a feed that has stopped shows). Reported, not enforced (as
    in the source). Feed tables hold instants; they are compared as UTC wall
    clock."""
    name = "regional_realtime" if regional else "national_realtime"
    table = table_of(spark, wh, "raw", name)
    df = sinks.read_table(spark, table) if sinks.exists(spark, table) else \
        spark.createDataFrame([], feed_schema(regional))
    utc = F.convert_timezone(None, F.lit("UTC"), F.col("date_heure").cast("timestamp_ntz"))
    at = ntz_of(now or datetime.now(timezone.utc))
    return quality.freshness(df.withColumn("date_heure", utc), name, "date_heure", now=at,
                             max_age_hours=max_age_hours)


def _raw(spark: SparkSession, wh: str, name: str) -> DataFrame:
    """A raw table; one that no load has made yet is empty."""
    table = table_of(spark, wh, "raw", name)
    if not sinks.exists(spark, table) and name.endswith("_realtime"):
        sinks.ensure_table(spark, table, feed_schema(name.startswith("regional")), FEED_GRAIN)
    return sinks.read_table(spark, table)


def raw_year(spark: SparkSession, wh: str, year: int, regional: bool = False) -> DataFrame:
    """One year of raw history, half-open on the instant; reads only the years
    by wall clock that can hold its instants."""
    name = "regional_history" if regional else "national_history"
    years = [str(y) for y in (year - 1, year, year + 1)]
    return readers.year_slice(read(spark, wh, "raw", name, years), year)


def stg_national(spark: SparkSession, wh: str) -> DataFrame:
    return staging.stg_national(_raw(spark, wh, "national_history"),
                                _raw(spark, wh, "national_realtime"))


def stg_regional(spark: SparkSession, wh: str) -> DataFrame:
    return staging.stg_regional(_raw(spark, wh, "regional_history"),
                                _raw(spark, wh, "regional_realtime"))


def build_silver(spark: SparkSession, wh: str) -> None:
    sinks.full_refresh(enrich.int_national(stg_national(spark, wh)), table_of(spark, wh, "silver", "int_national"))
    sinks.full_refresh(enrich.int_regional(stg_regional(spark, wh)), table_of(spark, wh, "silver", "int_regional"))
    register_views(spark, wh)


def _synced_schema(kept: StructType, model: StructType) -> StructType:
    """The stored columns that the model still has, with its types, then its new ones."""
    types = {f.name: f.dataType for f in model}
    old = [f.name for f in kept if f.name in types]
    return StructType([StructField(n, types[n], True) for n in old]
                      + [StructField(f.name, f.dataType, True) for f in model if f.name not in old])


def build_mart_national(spark: SparkSession, wh: str, lookback: str | None = None) -> None:
    """Incremental mart. First run: everything. Later runs: rows after the
    stored high-water mark are appended. With ``lookback`` the months of the
    re-read rows are rewritten. The stored columns follow the model's: new ones
    read as NULL in older rows; after one vanished, or a change of type, the
    table is rewritten."""
    table = table_of(spark, wh, "gold", "mart_national")
    source = marts.mart_national(read(spark, wh, "silver", "int_national"))
    kept = sinks.schema_of(spark, table)
    if kept is None:
        sinks.append(source, table, grain=MART_GRAIN)
        return
    schema = _synced_schema(kept, source.schema)
    types = {f.name: f.dataType for f in schema}
    if any(types.get(f.name) != f.dataType for f in kept):
        target = sinks.read_table(spark, table)
        cast = target.select(*[F.col(f.name).cast(types[f.name]).alias(f.name) for f in kept if f.name in types])
        sinks.rewrite(sync_columns(cast, source).select(*schema.fieldNames()), table, grain=MART_GRAIN)
    target = sync_columns(sinks.read_table(spark, table), source)
    new = incremental_source(source, target, "date_heure", lookback).select(*schema.fieldNames())
    if lookback is None:
        sinks.append(new, table, grain=MART_GRAIN)
        return
    new = staged(new, "reread")     # its months, the rows it replaces and the write read it
    replace_rows(spark, table, new, MART_GRAIN)


def replace_rows(spark: SparkSession, table: str, new: DataFrame, grain: str, ts: str = "date_heure") -> None:
    """Replace the table's rows of the times in ``new`` (a written table), in the partitions they lie in."""
    values = sinks.touched(new, grain, ts)      # a handful of months
    if not values:
        return
    others = sync_columns(sinks.read_table(spark, table, values), new).join(new.select(ts), ts, "left_anti")
    sinks.overwrite_partitions(others.select(*new.columns).unionByName(new), table, ts, grain)


def build_gold(spark: SparkSession, wh: str) -> None:
    int_nat, int_reg = read(spark, wh, "silver", "int_national"), read(spark, wh, "silver", "int_regional")
    build_mart_national(spark, wh)
    sinks.full_refresh(marts.mart_patterns(int_nat), table_of(spark, wh, "gold", "mart_patterns"))
    patterns = read(spark, wh, "gold", "mart_patterns")
    sinks.full_refresh(marts.green_hours(patterns), table_of(spark, wh, "gold", "green_hours"))
    sinks.full_refresh(marts.mart_regional_monthly(int_reg), table_of(spark, wh, "gold", "mart_regional_monthly"))


# ---- corrected and late readings: only what they touch ---------------------------

REFRESHED = "table_name string, upto timestamp_ntz"


def _new_changes(spark: SparkSession, wh: str, name: str) -> tuple[DataFrame | None, datetime | None]:
    """Change keys of a raw table since the last refresh of the marts, and the time of the last of them."""
    log = sinks.changes_of(table_of(spark, wh, "raw", name))
    if not sinks.exists(spark, log):
        return None, None
    marks = table_of(spark, wh, "gold", "refreshed")
    if not sinks.exists(spark, marks):
        spark.createDataFrame([], REFRESHED).write.saveAsTable(marks, format="parquet")
    upto = spark.table(marks).where(F.col("table_name") == name).agg(F.max("upto")).first()[0]
    keys = spark.table(log)
    if upto is not None:
        keys = keys.where(F.col("at") > ntz_of(upto))
    return keys, keys.agg(F.max("at")).first()[0]


def _mark(spark: SparkSession, wh: str, name: str, upto: datetime) -> None:
    spark.createDataFrame([(name, upto)], REFRESHED).coalesce(1).write.mode("append").saveAsTable(
        table_of(spark, wh, "gold", "refreshed"), format="parquet")


def refresh_touched(spark: SparkSession, wh: str) -> dict[str, int]:
    """Bring the stored models up to the feeds' merges since the last refresh.

    Readings that came late or again with other values replace their rows of the
    enriched models and of the national mart; of the patterns and the monthly
    mart the cells they lie in are aggregated anew. A run that is lost is
    repeated whole: every step replaces by key. Returns the number of changed
    readings by table.
    """
    done = {}
    keys, upto = _new_changes(spark, wh, "national_realtime")
    if upto is not None:
        times = staged(changes.touched_times(keys), "touched-times")
        new = staged(enrich.int_national(stg_national(spark, wh).join(times, "date_heure", "left_semi")), "touched")
        silver = table_of(spark, wh, "silver", "int_national")
        sinks.full_refresh(changes.replaced(sinks.read_table(spark, silver), new, times), silver)
        gold = table_of(spark, wh, "gold", "mart_national")
        replace_rows(spark, gold, marts.mart_national(new), MART_GRAIN)
        patterns = table_of(spark, wh, "gold", "mart_patterns")
        sinks.full_refresh(changes.mart_patterns(sinks.read_table(spark, patterns),
                                                 sinks.read_table(spark, gold), times), patterns)
        sinks.full_refresh(marts.green_hours(sinks.read_table(spark, patterns)),
                           table_of(spark, wh, "gold", "green_hours"))
        _mark(spark, wh, "national_realtime", upto)
        done["national_realtime"] = times.count()
    keys, upto = _new_changes(spark, wh, "regional_realtime")
    if upto is not None:
        readings = staged(changes.touched_readings(keys), "touched-readings")
        silver, monthly = (table_of(spark, wh, *t) for t in (("silver", "int_regional"),
                                                             ("gold", "mart_regional_monthly")))
        before, stg = sinks.read_table(spark, silver), stg_regional(spark, wh)
        # the cells first: they ask where the readings were before
        sinks.full_refresh(changes.mart_regional_monthly(sinks.read_table(spark, monthly), before, stg, readings),
                           monthly)
        sinks.full_refresh(changes.replaced(before, enrich.int_regional(stg), readings), silver)
        _mark(spark, wh, "regional_realtime", upto)
        done["regional_realtime"] = readings.count()
    register_views(spark, wh)
    return done


MODEL_KEYS = {
    "stg_national": ["date_heure"], "stg_regional": ["date_heure", "libelle_region"],
    "int_national": ["date_heure"], "int_regional": ["date_heure", "libelle_region"],
    "mart_national": ["date_heure"], "mart_patterns": marts.PATTERN_KEYS, "green_hours": ["saison", "rang"],
    "mart_regional_monthly": marts.REGIONAL_MONTH_KEYS,
}


def check_gold(spark: SparkSession, wh: str, checked_at: datetime | None = None) -> DataFrame:
    """The declared checks over the models (staging read lazily).

    Failing rows are stored by key and check in ``gold.check_failures``, taken
    in one pass over each model; the report counts them.
    """
    tables = {"stg_national": stg_national(spark, wh), "stg_regional": stg_regional(spark, wh),
              "int_national": read(spark, wh, "silver", "int_national"),
              "int_regional": read(spark, wh, "silver", "int_regional"),
              **{n: read(spark, wh, "gold", n) for n in
                 ("mart_national", "mart_patterns", "green_hours", "mart_regional_monthly")}}
    at = checked_at or datetime.now(timezone.utc).replace(tzinfo=None)
    found = quality.failing_rows(tables, MODEL_KEYS).withColumn("checked_at", ntz_of(at))
    failures = table_of(spark, wh, "gold", "check_failures")
    found.write.mode("append").saveAsTable(failures, format="parquet")
    mine = spark.table(failures).where(F.col("checked_at") == ntz_of(at))
    return quality.report_of(mine)


def refresh(spark: SparkSession, src_dir: str, wh: str, land: bool = True,
            min_rows: tuple[int, int] = (NATIONAL_MIN_ROWS, REGIONAL_MIN_ROWS)) -> DataFrame:
    """Full refresh run; returns the check report (error failures raise)."""
    if land:
        land_raw(spark, src_dir, wh)
        verify_load(spark, wh, *min_rows)
    build_silver(spark, wh)
    build_gold(spark, wh)
    report = check_gold(spark, wh)
    quality.assert_report(report)
    return report
