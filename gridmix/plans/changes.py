"""Marts that follow corrected and late readings cell by cell.

A merge into a raw table gives change rows (:func:`gridmix.operators.upsert.
upsert_changes`). From them come the touched times, and from those the touched
cells of each mart; only these are computed anew, from the readings that lie in
them, and put in the place of the old ones. Touched times and cells are joined
without a hint: they are few after an hourly run, but nothing depends on it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmix.functions.timedims import national_time_columns
from gridmix.plans import enrich, marts, staging


def touched_times(keys: DataFrame) -> DataFrame:
    """Wall-clock times of the changed readings."""
    return staging.realtime_time(keys).where("date_heure IS NOT NULL").distinct()


def touched_readings(keys: DataFrame) -> DataFrame:
    """(date_heure, libelle_region) of the changed regional readings."""
    return (staging.realtime_time(keys, "libelle_region")
            .where("date_heure IS NOT NULL AND libelle_region IS NOT NULL").distinct())


def replaced(old: DataFrame, new: DataFrame, touched: DataFrame) -> DataFrame:
    """``old`` with the rows of the touched keys replaced by those of ``new``."""
    keys = touched.columns
    return old.join(touched, keys, "left_anti").unionByName(new.join(touched, keys, "left_semi"))


def mart_national(old: DataFrame, staged: DataFrame, times: DataFrame) -> DataFrame:
    """The mart with the readings of the touched times replaced. ``staged``: staging of the changed tables."""
    return replaced(old, marts.mart_national(enrich.int_national(staged)), times)


def pattern_cells(times: DataFrame) -> DataFrame:
    """Cells of the patterns mart that the times lie in."""
    dims = national_time_columns("date_heure")
    return times.select(*[dims[k].alias(k) for k in marts.PATTERN_KEYS]).distinct()


def mart_patterns(old: DataFrame, readings: DataFrame, times: DataFrame) -> DataFrame:
    """The patterns mart with the touched cells aggregated anew and all cells (at most 672) ranked.

    ``readings``: the changed national mart, which has every column the cells need.
    """
    cells = pattern_cells(times)
    new = marts.pattern_aggregates(readings.join(cells, marts.PATTERN_KEYS, "left_semi"))
    kept = old.join(cells, marts.PATTERN_KEYS, "left_anti").select(*new.columns)
    return marts.ranked_patterns(kept.unionByName(new))


def mart_regional_monthly(old: DataFrame, before: DataFrame, staged: DataFrame, readings: DataFrame) -> DataFrame:
    """The monthly mart with the touched cells aggregated anew.

    ``before``: the enriched readings as they were; ``staged``: staging of the
    changed tables, read in the touched months only. A reading that changes its
    region code leaves one cell and enters another, so cells come from both.
    """
    months = readings.select(F.trunc("date_heure", "month").alias("_month")).distinct()
    now = enrich.int_regional(staged.withColumn("_month", F.trunc("date_heure", "month"))
                              .join(months, "_month", "left_semi").drop("_month"))
    keys = ["date_heure", "libelle_region"]
    columns = ["date_heure", *marts.REGIONAL_MONTH_KEYS]
    both = before.select(*columns).unionByName(now.select(*columns))
    cells = both.join(readings, keys, "left_semi").select(*marts.REGIONAL_MONTH_KEYS).distinct()
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"c.{k}")) for k in marts.REGIONAL_MONTH_KEYS]    # codes may be NULL
    new = marts.mart_regional_monthly(now.alias("r").join(cells.alias("c"), same, "left_semi"), ordered=False)
    return old.alias("r").join(cells.alias("c"), same, "left_anti").unionByName(new)
