"""Keep-latest deduplication (``QUALIFY row_number() ... = 1``).

Spark SQL has no QUALIFY; the DataFrame form is row_number + filter. For
``rank``/``row_number`` filters Catalyst inserts a *partial* group limit
before the shuffle, so a hot key (one timestamp holding a large share of
all rows) is cut to one row per map task before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_order(loaded_at: str = "_loaded_at", tie_break: str | None = "_row_key") -> list[Column]:
    """Newest load first; a NULL load stamp sorts as the newest (warehouse
    NULL-is-highest rule); ``tie_break`` makes the survivor deterministic."""
    order = [F.col(loaded_at).desc_nulls_first()]
    if tie_break:
        order.append(F.col(tie_break).desc_nulls_last())
    return order


def keep_latest(df: DataFrame, keys: list[str], order: list[Column] | None = None,
                drop: list[str] | None = None) -> DataFrame:
    """One row per ``keys``: the first by ``order`` (default :func:`latest_order`).

    What ``order`` leaves open is decided by all other columns, largest values
    first, so the survivor never depends on the order of rows.
    """
    order = list(order or latest_order(tie_break="_row_key" if "_row_key" in df.columns else None))
    order += [F.col(f"`{c}`").desc_nulls_last() for c in sorted(df.columns) if c not in keys]
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
    return out.drop(*(drop or []))
