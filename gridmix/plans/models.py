"""Model graph over a source directory: raw -> staging -> enriched -> marts.

Each function takes ``(spark, src_dir)`` and returns a lazy DataFrame; the
composition mirrors the model references so Catalyst optimises across
layers (column pruning into the scans, filter push-through). The inputs are
read-only, so each model's DataFrame is built once per session and reused by
the models downstream of it (no data is cached — only the plan object).
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from gridmix.plans import enrich, marts, staging
from gridmix.sources import adapter
from gridmix.sources.bronze import load_history


def _model(fn):
    """Build the decorated model once per session and source directory."""
    @functools.wraps(fn)
    def wrapper(spark: SparkSession, src: str) -> DataFrame:
        return adapter._memo(spark, ("model", fn.__name__, src), lambda: fn(spark, src))
    return wrapper


@_model
def raw_national_history(spark: SparkSession, src: str) -> DataFrame:
    return load_history(adapter.national_history_landed(spark, src))


@_model
def raw_national_realtime(spark: SparkSession, src: str) -> DataFrame:
    return adapter.national_realtime(spark, src)


@_model
def raw_regional_history(spark: SparkSession, src: str) -> DataFrame:
    return load_history(adapter.regional_history_landed(spark, src))


@_model
def raw_regional_realtime(spark: SparkSession, src: str) -> DataFrame:
    return adapter.regional_realtime(spark, src)


@_model
def stg_national(spark: SparkSession, src: str) -> DataFrame:
    return staging.stg_national(raw_national_history(spark, src), raw_national_realtime(spark, src))


@_model
def stg_regional(spark: SparkSession, src: str) -> DataFrame:
    return staging.stg_regional(raw_regional_history(spark, src), raw_regional_realtime(spark, src))


@_model
def int_national(spark: SparkSession, src: str) -> DataFrame:
    return enrich.int_national(stg_national(spark, src))


@_model
def int_regional(spark: SparkSession, src: str) -> DataFrame:
    return enrich.int_regional(stg_regional(spark, src))


@_model
def mart_national(spark: SparkSession, src: str) -> DataFrame:
    return marts.mart_national(int_national(spark, src))


@_model
def mart_patterns(spark: SparkSession, src: str) -> DataFrame:
    return marts.mart_patterns(int_national(spark, src))


@_model
def green_hours(spark: SparkSession, src: str) -> DataFrame:
    return marts.green_hours(mart_patterns(spark, src))


@_model
def mart_regional_monthly(spark: SparkSession, src: str) -> DataFrame:
    return marts.mart_regional_monthly(int_regional(spark, src))
