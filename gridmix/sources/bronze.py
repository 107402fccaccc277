"""Landed rows -> bronze (raw) tables: the load-step hygiene.

The load step normalises column names, stamps ``_loaded_at`` once per batch
and turns the text ``'nan'`` into NULL. Everything else is kept as text so
typing happens in staging, where bad values are handled per column.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from gridmix.functions.cleaning import nan_to_null, normalize_columns, ntz_of


def load_history(landed: DataFrame, loaded_at: datetime | None = None) -> DataFrame:
    """Bronze form of a yearly export batch.

    ``loaded_at`` is passed in (one value per batch, reproducible); when the
    landed frame already carries ``_loaded_at`` it is kept.
    """
    df = normalize_columns(landed)
    if loaded_at is not None:
        df = df.withColumn("_loaded_at", ntz_of(loaded_at))
    return nan_to_null(df)
