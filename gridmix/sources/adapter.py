"""Driver tables -> raw-shaped grid tables.

The test tables are TPC-H-like. Each order becomes one half-hourly reading
(national) and one reading of the customer's nation (regional); the order's
line quantities become generation figures. The mapping is fixed (see
FIXTURES.md §4) so results are reproducible and equal in any SQL engine.
It is written as SQL expressions: one analyser call per column.

Plan shape: ``lineitem`` is aggregated by order (partial aggregation before
the shuffle), the result stays hash-partitioned on the order key, so the
sort-merge join with ``orders`` shuffles only ``orders``. The regional side adds a join
to ``customer`` (AQE splits a customer holding many orders) and to
``nation``, which the planner broadcasts from its size statistics, falling
back to a shuffle join if it is large.

The driver tables are read-only inputs, so their scans and the derived base
frames are built once per session and shared by the history and real-time
branches (identical subtrees, so their exchanges are reused).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmix.sources.schemas import (NATIONAL_RT_MEASURES, NATIONAL_RT_SOURCE,
                                     REGIONAL_RT_MEASURES, REGIONAL_RT_SOURCE)

# Fixed values of the mapping.
DAY_SHIFT = 7670                 # 1995-01-01 -> 2016-01-01
NATIONAL_STEP_MIN, NATIONAL_SLOTS = 30, 48
REGIONAL_STEP_MIN, REGIONAL_SLOTS = 360, 4
REALTIME_FROM_YEAR = 2022
REALTIME_EVERY = 10
HISTORY_LOADED_AT = "2026-01-01 00:00:00"
REALTIME_LOADED_AT = "2026-02-01 00:00:00"
BAD_DATE_EVERY, NAN_EVERY, ND_EVERY = 101, 89, 97
ISO_OFFSET = "+01:00"
# quantity families: (return flag, line status)
FAMILIES = {"q_af": ("A", "F"), "q_ao": ("A", "O"), "q_nf": ("N", "F"),
            "q_no": ("N", "O"), "q_rf": ("R", "F"), "q_ro": ("R", "O")}
# commercial exchanges: column -> (modulus, offset)
EXCHANGES = {"ech_comm_angleterre": (11, 5), "ech_comm_espagne": (13, 6),
             "ech_comm_italie": (17, 8), "ech_comm_suisse": (19, 9),
             "ech_comm_allemagne_belgique": (23, 11)}
# coverage rates: column -> multiplier
TCO = {"tco_thermique": 13, "tco_nucleaire": 17, "tco_eolien": 19,
       "tco_solaire": 23, "tco_hydraulique": 29, "tco_bioenergies": 31}

_MEMO: dict[tuple, tuple[tuple, DataFrame]] = {}


def _listing(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times in a source folder: a changed source is planned anew."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime())
                        for f in fs.listStatus(hpath)))


def _memo(spark: SparkSession, key: tuple, build) -> DataFrame:
    """``key`` ends with the source folder."""
    k = (spark.sparkContext.applicationId,) + key
    state = _listing(spark, key[-1])
    if k not in _MEMO or _MEMO[k][0] != state:
        _MEMO[k] = (state, build())
    return _MEMO[k][1]


def clear_cache() -> None:
    _MEMO.clear()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = os.path.join(sf_dir, f"{name}.parquet")
    return _memo(spark, ("table", name, sf_dir), lambda: spark.read.parquet(path))


def _exprs(cols: dict[str, str]) -> list:
    return [F.expr(sql).alias(name) for name, sql in cols.items()]


def order_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: key, customer, date and quantity sums by family."""
    def build():
        li = table(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_quantity", "l_returnflag", "l_linestatus")
        aggs = {"q_all": "sum(l_quantity)"}
        aggs.update({name: f"sum(CASE WHEN l_returnflag = '{rf}' AND l_linestatus = '{ls}' "
                           f"THEN l_quantity END)" for name, (rf, ls) in FAMILIES.items()})
        per_order = li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(*_exprs(aggs))
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
        # Both sides hold one row per order, so this join is large x large at
        # any real size. The per-order aggregate is already hash-partitioned
        # on the key, so a sort-merge join shuffles only ``orders``, and the
        # row-level mapping after it runs over all shuffle partitions instead
        # of the few scan tasks of ``orders`` (as a broadcast would).
        return orders.join(per_order.hint("merge"), "o_orderkey", "left")
    return _memo(spark, ("order_measures", sf_dir), build)


def _shifted(step_min: int, slots: int) -> str:
    return (f"o_orderdate + make_dt_interval({DAY_SHIFT}) "
            f"+ make_dt_interval(0, 0, CAST((o_orderkey % {slots}) * {step_min} AS INT))")


_COMMON = {
    "pompage": "CAST(-(o_orderkey % 50) AS DOUBLE)",
    "ech_physiques": "CAST(CASE WHEN o_orderkey % 53 <> 0 THEN o_orderkey % 201 - 100 END AS DOUBLE)",
}


def national_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed national readings before the history / real-time split."""
    def build():
        cols = {
            "_row_key": "o_orderkey",
            "dh": _shifted(NATIONAL_STEP_MIN, NATIONAL_SLOTS),
            "_ordered": "o_orderdate",
            "consommation": "q_all",
            "prevision_j1": "q_all + CAST(o_orderkey % 7 - 3 AS DOUBLE)",
            "prevision_j": "q_all + CAST(o_orderkey % 5 - 2 AS DOUBLE)",
            "nucleaire": "q_af", "hydraulique": "q_ao", "eolien": "q_nf", "solaire": "q_no",
            "gaz": "q_rf", "fioul": "q_ro",
            "charbon": "CAST(CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 20 END AS DOUBLE)",
            "bioenergies": "CAST(o_orderkey % 30 AS DOUBLE)",
            **_COMMON,
            **{c: f"CAST(o_orderkey % {mod} - {off} AS DOUBLE)"
               for c, (mod, off) in EXCHANGES.items()},
            "taux_co2": "CAST((o_orderkey * 37) % 13000 AS DOUBLE) / CAST(100 AS DOUBLE)",
        }
        return order_measures(spark, sf_dir).select(*_exprs(cols))
    return _memo(spark, ("national_base", sf_dir), build)


def regional_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed regional readings (one per order, region = customer's nation)."""
    def build():
        cust = table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("o_custkey"), "c_nationkey")
        nation = table(spark, sf_dir, "nation").select(
            F.col("n_nationkey").alias("c_nationkey"), "n_name")
        m = order_measures(spark, sf_dir).join(cust, "o_custkey", "left") \
            .join(nation, "c_nationkey", "left")
        cols = {
            "_row_key": "o_orderkey",
            "code_insee_region": "lpad(CAST(c_nationkey AS STRING), 2, '0')",
            "libelle_region": "n_name",
            "dh": _shifted(REGIONAL_STEP_MIN, REGIONAL_SLOTS),
            "_ordered": "o_orderdate",
            "consommation": "q_all", "thermique": "q_rf", "nucleaire": "q_af",
            "eolien": "q_nf", "solaire": "q_no", "hydraulique": "q_ao",
            "pompage": _COMMON["pompage"], "bioenergies": "q_ro",
            "ech_physiques": _COMMON["ech_physiques"],
            "eolien_terrestre": "q_nf", "eolien_offshore": "CAST(NULL AS DOUBLE)",
            **{c: f"CAST((o_orderkey * {p}) % 10000 AS DOUBLE) / CAST(100 AS DOUBLE)"
               for c, p in TCO.items()},
        }
        return m.select(*_exprs(cols))
    return _memo(spark, ("regional_base", sf_dir), build)


def _from_year(year: int) -> str:
    """First order date of the readings from ``year`` on: a bound the scan can use."""
    return f"CAST(DATE '{year}-01-01' - make_dt_interval({DAY_SHIFT}) AS TIMESTAMP_NTZ)"


_HISTORY = f"_ordered < {_from_year(REALTIME_FROM_YEAR)} AND year(dh) < {REALTIME_FROM_YEAR}"
_REALTIME = f"year(dh) >= {REALTIME_FROM_YEAR} OR _row_key % {REALTIME_EVERY} = 0"
# zone-free formatting: the text of a zone-less timestamp, ISO 'T', fixed offset
_ISO_TEXT = (f"CASE WHEN _row_key % {BAD_DATE_EVERY} = 0 THEN 'bad' "
             f"ELSE concat(replace(CAST(dh AS STRING), ' ', 'T'), '{ISO_OFFSET}') END")


def _int_text(c: str) -> str:
    return f"CAST(CAST({c} AS BIGINT) AS STRING)"


def national_history_of(base: DataFrame, years: tuple[int, int] | None = None) -> DataFrame:
    """History rows of ``base`` as landed: time and consumption as text."""
    b = base.filter(F.expr(_HISTORY))
    if years:
        b = b.filter(F.expr(f"_ordered >= {_from_year(years[0])} AND "
                            f"_ordered < {_from_year(years[1] + 1)}"))
    measures = ["prevision_j1", "prevision_j", "nucleaire", "hydraulique", "eolien", "solaire",
                "gaz", "fioul", "charbon", "bioenergies", "pompage", "ech_physiques",
                *EXCHANGES, "taux_co2"]
    cols = {"date_heure": _ISO_TEXT,
            "consommation": f"CASE WHEN _row_key % {NAN_EVERY} = 0 THEN 'nan' "
                            f"ELSE {_int_text('consommation')} END",
            **{m: m for m in measures},
            "_loaded_at": f"TIMESTAMP_NTZ '{HISTORY_LOADED_AT}'",
            "_row_key": "_row_key"}
    return b.select(*_exprs(cols))


def national_history_landed(spark: SparkSession, sf_dir: str,
                            years: tuple[int, int] | None = None) -> DataFrame:
    """National yearly export as landed: time and consumption as text.
    ``years``: only the exports of these years, first to last."""
    return _memo(spark, ("nat_hist", years, sf_dir),
                 lambda: national_history_of(national_base(spark, sf_dir), years))


def regional_history_of(base: DataFrame) -> DataFrame:
    """History rows of ``base`` as landed: every measure as text."""
    b = base.filter(F.expr(_HISTORY))
    whole = ["thermique", "nucleaire", "eolien", "solaire", "hydraulique", "pompage",
             "bioenergies", "ech_physiques", "eolien_terrestre", "eolien_offshore"]
    cols = {"code_insee_region": "code_insee_region", "libelle_region": "libelle_region",
            "date_heure": _ISO_TEXT,
            "consommation": f"CASE WHEN _row_key % {NAN_EVERY} = 0 THEN 'nan' "
                            f"WHEN _row_key % {ND_EVERY} = 0 THEN 'ND' "
                            f"ELSE {_int_text('consommation')} END",
            **{c: _int_text(c) for c in whole},
            **{c: f"CAST({c} AS STRING)" for c in TCO},
            "_loaded_at": f"TIMESTAMP_NTZ '{HISTORY_LOADED_AT}'",
            "_row_key": "_row_key"}
    return b.select(*_exprs(cols))


def regional_history_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regional yearly export as landed: every measure as text."""
    return _memo(spark, ("reg_hist", sf_dir), lambda: regional_history_of(regional_base(spark, sf_dir)))


_RT_LOADED_AT = f"TIMESTAMP_NTZ '{REALTIME_LOADED_AT}' + make_dt_interval(0, 0, 0, _row_key)"


def national_realtime_of(base: DataFrame) -> DataFrame:
    """Feed rows of ``base`` (declared schema + ``_row_key``)."""
    cols = {"date_heure": "dh", **{m: m for m in NATIONAL_RT_MEASURES},
            "_loaded_at": _RT_LOADED_AT, "_source": f"'{NATIONAL_RT_SOURCE}'",
            "_row_key": "_row_key"}
    cols["consommation"] = "consommation * 2"
    return base.filter(F.expr(_REALTIME)).select(*_exprs(cols))


def national_realtime(spark: SparkSession, sf_dir: str) -> DataFrame:
    """National real-time feed rows (declared schema + ``_row_key``)."""
    return _memo(spark, ("nat_rt", sf_dir), lambda: national_realtime_of(national_base(spark, sf_dir)))


def regional_realtime_of(base: DataFrame) -> DataFrame:
    """Feed rows of ``base`` (declared schema + ``_row_key``)."""
    cols = {"code_insee_region": "code_insee_region", "libelle_region": "libelle_region",
            "date_heure": "dh", **{m: m for m in REGIONAL_RT_MEASURES},
            "_loaded_at": _RT_LOADED_AT, "_source": f"'{REGIONAL_RT_SOURCE}'",
            "_row_key": "_row_key"}
    cols["consommation"] = "consommation * 2"
    return base.filter(F.expr(_REALTIME)).select(*_exprs(cols))


def regional_realtime(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regional real-time feed rows (declared schema + ``_row_key``)."""
    return _memo(spark, ("reg_rt", sf_dir), lambda: regional_realtime_of(regional_base(spark, sf_dir)))
