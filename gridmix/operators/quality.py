"""Declarative data checks (not_null, unique, accepted_values) and load gates.

All ``not_null`` and ``accepted_values`` checks of one model are computed in
a single aggregation pass over it (rows counted by the listed columns' values,
which are judged on the few counted rows); each ``unique`` check is one grouped
count with map-side partial aggregation (a hot key is pre-counted in every
task, so skew does not concentrate rows). The report is one row per check
(a few dozen rows), the only thing ever brought to the driver.

Failure counts follow the usual test-query semantics: ``not_null`` counts
NULL rows; ``unique`` counts distinct non-NULL values occurring more than
once; ``accepted_values`` counts distinct non-NULL values outside the list
(NULL passes).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmix.functions.kpis import GREEN_LABELS
from gridmix.functions.timedims import SEASON_NAMES


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    test: str                      # not_null | unique | accepted_values
    severity: str = "error"        # error | warn
    values: tuple[str, ...] = ()


def _nn(m, c, sev="error"):
    return Check(m, c, "not_null", sev)


def _uq(m, c):
    return Check(m, c, "unique")


def _av(m, c, vals):
    return Check(m, c, "accepted_values", "error", tuple(vals))


# The 37 declared model assertions.
MODEL_CHECKS: list[Check] = [
    # staging (7)
    _nn("stg_national", "date_heure"), _uq("stg_national", "date_heure"),
    _nn("stg_national", "consommation_mw"), _nn("stg_national", "taux_co2"),
    _nn("stg_regional", "date_heure"), _nn("stg_regional", "libelle_region"),
    _nn("stg_regional", "consommation_mw"),
    # intermediate (11)
    _nn("int_national", "date_heure"), _uq("int_national", "date_heure"),
    _nn("int_national", "saison"), _av("int_national", "saison", SEASON_NAMES),
    _nn("int_national", "indice_vert"), _av("int_national", "indice_vert", GREEN_LABELS),
    _nn("int_national", "part_bas_carbone"),
    _nn("int_regional", "date_heure"), _nn("int_regional", "libelle_region"),
    _nn("int_regional", "autosuffisance", "warn"), _nn("int_regional", "part_bas_carbone", "warn"),
    # marts (19)
    _nn("mart_national", "date_heure"), _uq("mart_national", "date_heure"),
    _nn("mart_national", "taux_co2"), _nn("mart_national", "indice_vert"),
    _av("mart_national", "indice_vert", GREEN_LABELS), _nn("mart_national", "consommation_mw"),
    _nn("mart_patterns", "heure"), _nn("mart_patterns", "saison"),
    _av("mart_patterns", "saison", SEASON_NAMES), _nn("mart_patterns", "avg_taux_co2"),
    _nn("mart_patterns", "nb_observations"),
    _nn("green_hours", "saison"), _nn("green_hours", "rang"),
    _nn("green_hours", "heure_optimale"), _nn("green_hours", "gain_vs_pointe_pct"),
    _nn("mart_regional_monthly", "annee"), _nn("mart_regional_monthly", "mois"),
    _nn("mart_regional_monthly", "libelle_region"),
    _nn("mart_regional_monthly", "tco_renouvelables_moyen"),
]


def _sql_str(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def _label(c: Check) -> list[str]:
    return [f"{_sql_str(c.model)} AS model", f"{_sql_str(c.column)} AS column_name",
            f"{_sql_str(c.test)} AS test", f"{_sql_str(c.severity)} AS severity"]


def check_model(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Report rows for the checks of one model."""
    return with_status(_check_parts(df, checks))


def _check_parts(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Report rows (without status): one aggregation pass for the row-level
    checks, one grouped count per ``unique`` check."""
    nulls = [c for c in checks if c.test == "not_null"]
    listed = [c for c in checks if c.test == "accepted_values"]
    parts: list[DataFrame] = []
    if nulls or listed:
        # one pass: rows are counted by the checked values (few distinct ones), which
        # are judged afterwards; distinct counts over all rows would multiply the rows
        columns = list(dict.fromkeys(c.column for c in listed))
        counts = [F.expr(f"count_if(`{c.column}` IS NULL)").alias(f"f{i}") for i, c in enumerate(nulls)]
        grouped = df.groupBy(*columns).agg(*(counts or [F.count(F.lit(1)).alias("n")]))
        if nulls:
            rows = ", ".join(f"struct({', '.join(_label(c))}, CAST(coalesce(f{i}, 0) AS BIGINT) AS failures)"
                             for i, c in enumerate(nulls))
            sums = [F.sum(f"f{i}").alias(f"f{i}") for i in range(len(nulls))]
            parts.append(grouped.agg(*sums).selectExpr(f"inline(array({rows}))"))
        if listed:
            bad = ", ".join(
                f"struct({i} AS k, CASE WHEN `{c.column}` NOT IN ({', '.join(map(_sql_str, c.values))}) "
                f"THEN `{c.column}` END AS v)" for i, c in enumerate(listed))
            found = (grouped.selectExpr(f"inline(array({bad}))").where("v IS NOT NULL").distinct()
                     .groupBy("k").agg(F.count(F.lit(1)).alias("n"))
                     .agg(*[F.sum(F.expr(f"CASE WHEN k = {i} THEN n END")).alias(f"f{i}")
                            for i in range(len(listed))]))
            rows = ", ".join(f"struct({', '.join(_label(c))}, CAST(coalesce(f{i}, 0) AS BIGINT) AS failures)"
                             for i, c in enumerate(listed))
            parts.append(found.selectExpr(f"inline(array({rows}))"))
    for c in checks:
        if c.test != "unique":
            continue
        dup = (df.where(F.col(c.column).isNotNull()).groupBy(c.column)
               .agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
        parts.append(dup.agg(F.count(F.lit(1)).alias("failures")).selectExpr(*_label(c), "failures"))
    return _union_all(parts)


def _union_all(parts: list[DataFrame]) -> DataFrame:
    """Union in a balanced tree (keeps the analysed plan depth logarithmic)."""
    while len(parts) > 1:
        parts = [parts[i].unionByName(parts[i + 1]) if i + 1 < len(parts) else parts[i]
                 for i in range(0, len(parts), 2)]
    return parts[0]


def with_status(report: DataFrame) -> DataFrame:
    return report.withColumn("status", F.expr(
        "CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END"))


def run_checks(models: dict[str, DataFrame], checks: list[Check] = MODEL_CHECKS) -> DataFrame:
    """Report for every check whose model is given (one row per check)."""
    parts = []
    for name, df in models.items():
        mine = [c for c in checks if c.model == name]
        if mine:
            parts.append(_check_parts(df, mine))
    return with_status(_union_all(parts))


def failing_rows(models: dict[str, DataFrame], keys: dict[str, list[str]],
                 checks: list[Check] = MODEL_CHECKS) -> DataFrame:
    """The rows that fail a check, by key: model, column_name, test, severity, row_key (JSON of the
    key columns), value, n_rows.

    One pass over a model finds its rows that fail ``not_null`` and
    ``accepted_values``; a ``unique`` check gives a row for each repeated value,
    whose key is the value, from one grouped count.
    """
    parts = []
    for name, df in models.items():
        mine = [c for c in checks if c.model == name]
        tests = []
        for c in mine:
            if c.test == "unique":
                continue
            bad = (F.col(c.column).isNull() if c.test == "not_null" else
                   F.col(c.column).isNotNull() & ~F.col(c.column).isin(*c.values))
            told = F.struct(*[F.expr(x) for x in _label(c)], F.col(c.column).cast("string").alias("value"))
            tests.append(F.when(bad, told))
        if tests:
            failed = F.filter(F.array(*tests), lambda t: t.isNotNull())
            parts.append(df.select(F.to_json(F.struct(*keys[name]), {"ignoreNullFields": "false"}).alias("row_key"),
                                   F.explode(failed).alias("t"))
                         .select("t.*", "row_key", F.lit(1).cast("bigint").alias("n_rows")))
        for c in mine:
            if c.test == "unique":
                dup = (df.where(F.col(c.column).isNotNull()).groupBy(c.column)
                       .agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1"))
                parts.append(dup.select(*[F.expr(x) for x in _label(c)], F.col(c.column).cast("string").alias("value"),
                                        F.to_json(F.struct(c.column)).alias("row_key"), "n_rows"))
    return _union_all(parts)


def report_of(failures: DataFrame, checks: list[Check] = MODEL_CHECKS) -> DataFrame:
    """The report of :func:`run_checks` from the stored rows of :func:`failing_rows`."""
    spark = failures.sparkSession
    every = spark.createDataFrame([(c.model, c.column, c.test, c.severity) for c in checks],
                                  "model string, column_name string, test string, severity string")
    keys = ["model", "column_name", "test", "severity"]
    # accepted_values counts distinct values, the others rows or repeated values: one row each
    counts = (failures.groupBy(*keys, F.when(F.col("test") == "accepted_values", F.col("value")).alias("v"))
              .agg(F.count(F.lit(1)).alias("n"))
              .groupBy(*keys).agg(F.sum(F.when(F.col("test") == "accepted_values", 1).otherwise(F.col("n"))).alias("n")))
    return with_status(every.join(counts, keys, "left").select(
        *keys, F.coalesce("n", F.lit(0)).cast("bigint").alias("failures")))


class CheckFailed(AssertionError):
    pass


def assert_report(report: DataFrame) -> list[tuple]:
    """Raise if an ``error`` check failed; return the warnings."""
    rows = report.filter(F.col("status") != "pass").collect()
    errors = [r for r in rows if r["status"] == "fail"]
    if errors:
        raise CheckFailed("; ".join(f"{r['model']}.{r['column_name']} {r['test']}: "
                                    f"{r['failures']}" for r in errors))
    return [tuple(r) for r in rows]


def assert_min_rows(df: DataFrame, n: int) -> int:
    """Row-count gate: the number of rows; raises when it is below ``n``."""
    seen = df.count()
    if seen < n:
        raise CheckFailed(f"only {seen} rows loaded, expected at least {n}")
    return seen


def load_stats(df: DataFrame, name: str, ts: str, min_rows: int) -> DataFrame:
    """Load report: count, min, max of ``ts`` and the row-count gate."""
    return df.agg(
        F.lit(name).alias("table_name"),
        F.count(F.lit(1)).alias("n_rows"),
        F.min(ts).alias("min_date_heure"),
        F.max(ts).alias("max_date_heure")).select(
        "table_name", "n_rows", "min_date_heure", "max_date_heure",
        F.lit(min_rows).cast("bigint").alias("min_rows"),
        (F.col("n_rows") >= min_rows).alias("gate_ok"))


def freshness(df: DataFrame, name: str, ts: str = "date_heure", now=None,
              max_age_hours: int = 2) -> DataFrame:
    """Freshness report: count, newest reading, and whether it is older than
    ``max_age_hours`` at ``now`` (a Column; default: the latest load stamp)."""
    now_col = now if now is not None else F.max("_loaded_at")
    return df.agg(
        F.lit(name).alias("table_name"),
        F.count(F.lit(1)).alias("n_rows"),
        F.max(ts).alias("max_date_heure"),
        now_col.alias("checked_at")).select(
        "table_name", "n_rows", "max_date_heure", "checked_at",
        (F.col("max_date_heure") < F.col("checked_at")
         - F.make_dt_interval(hours=F.lit(max_age_hours))).alias("is_stale"))
