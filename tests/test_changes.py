"""Corrected and late readings, overlapping deliveries, types of landed columns."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from gridmix.functions.cleaning import ntz_of
from gridmix.operators.upsert import MergeSpec, upsert, upsert_changes
from gridmix.plans import build, catalog, changes, enrich, marts
from gridmix.sources import sinks, types
from gridmix.streaming import dedup

D = dt.datetime


def _rows(df, cols=None):
    return sorted(map(tuple, df.select(*(cols or sorted(df.columns))).collect()), key=str)


def test_change_rows_equal_the_difference_of_the_merge(spark):
    spec = MergeSpec(keys=("date_heure",), changed_when=("v",), update_cols=("v",), tag_value="t")
    schema = "date_heure timestamp_ntz, v double, w double, _loaded_at timestamp_ntz, _source string"
    at = D(2026, 1, 1)
    target = spark.createDataFrame([(D(2024, 1, i), float(i), 0.0, at, "old") for i in (1, 2, 3, 3)]
                                   + [(D(2024, 1, 4), None, 0.0, at, "old"), (None, 5.0, 0.0, at, "old")], schema)
    batch = spark.createDataFrame([(D(2024, 1, 1), 1.0, 9.0), (D(2024, 1, 2), 7.0, 9.0), (D(2024, 1, 3), 8.0, 9.0),
                                   (D(2024, 1, 4), 1.0, 9.0), (D(2024, 1, 9), 9.0, 9.0), (None, 6.0, 9.0)],
                                  "date_heure timestamp_ntz, v double, w double")
    found = upsert_changes(target, batch, spec, D(2026, 2, 1))
    merged = upsert(target, batch, spec, D(2026, 2, 1))
    assert _rows(found.select("after.*")) == _rows(merged.exceptAll(target))
    assert _rows(found.where("op = 'update'").select("before.*")) == _rows(target.exceptAll(merged))
    assert sorted((r["op"], str(r["after"]["date_heure"])) for r in found.collect()) == [
        ("insert", "2024-01-09 00:00:00"), ("insert", "None"), ("update", "2024-01-02 00:00:00"),
        ("update", "2024-01-03 00:00:00"), ("update", "2024-01-03 00:00:00")]


def _write(path, records):
    path.write_text(json.dumps({"results": records}))


def test_corrections_reach_the_marts_and_leave_other_cells(spark, tmp_path, sf_small):
    wh = str(tmp_path / "wht")
    build.land_raw(spark, sf_small, wh)
    build.build_silver(spark, wh)
    build.build_gold(spark, wh)
    assert build.refresh_touched(spark, wh) == {}
    names = ["mart_national", "mart_patterns", "mart_regional_monthly"]
    before = {n: _rows(build.read(spark, wh, "gold", n)) for n in names}
    files = {f for (f,) in spark.table(build.table_of(spark, wh, "gold", "mart_national")).select(
        "_metadata.file_path").distinct().collect()}
    one = build.read(spark, wh, "gold", "mart_national").orderBy(F.desc("date_heure")).first()["date_heure"]
    land, regions = tmp_path / "l", tmp_path / "r"
    land.mkdir(), regions.mkdir()
    _write(land / "a.json", [{"date_heure": f"{one.isoformat()}+00:00", "consommation": 77.0, "taux_co2": 120.0},
                             {"date_heure": "2019-03-05T10:00:00+01:00", "consommation": 5.0, "taux_co2": 6.0}])
    _write(regions / "a.json", [{"date_heure": "2019-03-05T10:00:00+01:00", "consommation": 5.0,
                                 "code_insee_region": "84", "libelle_region": "Nouvelle"}])
    build.run_realtime(spark, str(land), wh)
    build.run_realtime(spark, str(regions), wh, regional=True)
    assert build.refresh_touched(spark, wh) == {"national_realtime": 2, "regional_realtime": 1}
    assert build.refresh_touched(spark, wh) == {}
    full = enrich.int_national(build.stg_national(spark, wh))
    want = {"mart_national": marts.mart_national(full), "mart_patterns": marts.mart_patterns(full),
            "mart_regional_monthly": marts.mart_regional_monthly(enrich.int_regional(build.stg_regional(spark, wh)))}
    for n in names:
        got = build.read(spark, wh, "gold", n)
        assert _rows(got, sorted(want[n].columns)) == _rows(want[n]), n
        assert _rows(got) != before[n]
    assert _rows(build.read(spark, wh, "silver", "int_national")) == _rows(full)
    kept = {f for (f,) in spark.table(build.table_of(spark, wh, "gold", "mart_national")).select(
        "_metadata.file_path").distinct().collect()}
    assert len(files - kept) <= 2          # two months were rewritten, the others' files are the same


def test_only_touched_cells_are_aggregated(spark):
    """Old values of cells that no change touches come through as they are stored."""
    names = [c for c in marts.MART_NATIONAL_COLUMNS if c not in ("date_heure", "_loaded_at")]
    text = {"saison", "jour_semaine", "indice_vert"}
    whole = {"heure", "mois", "annee", "flag_weekend", "flag_covid", "flag_crise_nuc_2022"}
    times = spark.createDataFrame([(D(2024, 1, 1, 10),), (D(2024, 7, 2, 11),)], "date_heure timestamp_ntz")
    dims = enrich.national_time_columns("date_heure")
    readings = times.select("date_heure", *[
        (dims[c] if c in dims else F.lit("x") if c in text else F.lit(1) if c in whole else F.lit(3.0)).alias(c)
        for c in names])
    old = marts.mart_patterns(readings).withColumn("avg_taux_co2", F.lit(-1.0))
    got = {r["saison"]: r["avg_taux_co2"] for r in
           changes.mart_patterns(old, readings, times.where("month(date_heure) = 7")).collect()}
    assert got == {"Hiver": -1.0, "Été": 3.0}


# ---- overlapping deliveries ----------------------------------------------------------

def _run(spark, landing, out, ckpt, files=1):
    stream = (spark.readStream.schema("k long, ts timestamp_ntz, v string").option("maxFilesPerTrigger", files)
              .option("recursiveFileLookup", True).parquet(str(landing)))
    q = (dedup.once(stream, ["k"], "ts", "8 days").writeStream.format("parquet").option("path", str(out))
         .option("checkpointLocation", str(ckpt)).trigger(availableNow=True).start())
    q.awaitTermination(180)
    return sorted(r["k"] for r in spark.read.parquet(str(out)).collect())


def test_overlapping_deliveries_pass_once_and_state_survives_a_restart(spark, tmp_path):
    rows = [(i, D(2024, 1, 1) + dt.timedelta(hours=6 * i), "x") for i in range(120)]
    df = spark.createDataFrame([*rows, (999, None, "x")], "k long, ts timestamp_ntz, v string")
    whole = tmp_path / "all"
    numbers = dedup.deliver(df, str(whole), "ts")
    assert len(numbers) >= 5
    assert spark.read.parquet(str(whole)).count() > 120          # the overlap comes twice
    landing = tmp_path / "landing"
    for n, upto in enumerate((3, len(numbers))):
        for k in numbers[:upto]:
            if not (landing / f"poll={k}").exists():
                os.makedirs(landing, exist_ok=True)
                os.rename(whole / f"poll={k}", landing / f"poll={k}")
        got = _run(spark, landing, tmp_path / "out", tmp_path / "ck")
        assert len(got) == len(set(got))
    assert got == list(range(120))


def test_a_delivery_in_any_order_loses_nothing(spark, tmp_path):
    rows = [(i, D(2024, 1, 8) + dt.timedelta(hours=i), "x") for i in range(160)]
    for n, part in enumerate((rows[80:], rows[:80], rows[40:120])):       # the newest first, then the old, then again
        spark.createDataFrame(part, "k long, ts timestamp_ntz, v string").coalesce(1).write.parquet(
            str(tmp_path / "l" / f"p{n}"))
    assert _run(spark, tmp_path / "l", tmp_path / "o", tmp_path / "c") == list(range(160))


# ---- types ---------------------------------------------------------------------------

def test_types_of_columns(spark):
    df = spark.createDataFrame(
        [("1", "1.5", "3", "ND", None, "a"), (" 2 ", "-.5e3", None, "4", None, "b"), ("-3", "7", "5", "6", None, "")],
        "w string, d string, gap string, mixed string, none string, t string").withColumn("n", F.lit(1))
    kinds = {r["column_name"]: (r["n_values"], r["n_numbers"], r["n_whole"], r["kind"])
             for r in types.column_kinds(df).collect()}
    assert kinds == {"w": (3, 3, 3, "whole"), "d": (3, 3, 1, "number"), "gap": (2, 2, 2, "number"),
                     "mixed": (3, 2, 2, "text"), "none": (0, 0, 0, "number"), "t": (3, 0, 0, "text")}
    out = types.typed(df)
    assert dict(out.dtypes) == {"w": "bigint", "d": "double", "gap": "double", "mixed": "string",
                                "none": "double", "t": "string", "n": "int"}
    assert [r["w"] for r in out.collect()] == [1, 2, -3] and [r["d"] for r in out.collect()] == [1.5, -500.0, 7.0]
    assert types.column_kinds(df.limit(0)).where("kind = 'number'").count() == 6
    plan = types.column_kinds(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") <= 1


def test_corrected_queries_join_the_driver_tables_once(spark, sf_small):
    """What follows the correction reads the written readings, not the orders and their lines again."""
    for name in ("feed_changes", "mart_national_corrected", "mart_patterns_corrected", "mart_regional_monthly_corrected"):
        files = catalog.queries()[name](spark, sf_small).inputFiles()
        assert files and not [f for f in files if f.startswith("file:") and sf_small in f], name
