"""Tumbling half-hour windows, shared by the batch and streaming paths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmix.functions.cleaning import rnd

# Fixed value: the reading step of the grid data.
STEP = "30 minutes"


def half_hour_stats(df: DataFrame, ts: str, value: str) -> DataFrame:
    """Count, mean and max of ``value`` per 30-minute window of ``ts``."""
    return (df.groupBy(F.window(ts, STEP).alias("w"))
            .agg(F.count(F.lit(1)).alias("n_readings"),
                 rnd(F.avg(value), 4).alias("avg_value"),
                 F.max(value).alias("max_value"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "n_readings", "avg_value", "max_value"))
