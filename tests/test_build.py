"""Warehouse refresh end to end on sf0.001."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from gridmix.operators.quality import CheckFailed
from gridmix.plans import build, enrich, marts, models, staging
from gridmix.sources import adapter, readers, sinks
from gridmix.sources.schemas import NATIONAL_HISTORY_TEXT


def _rows(df, cols=None):
    cols = cols or sorted(df.columns)
    return sorted(map(tuple, df.select(*cols).collect()), key=str)


def _expected_int_national(spark, src):
    """The enriched model over what land_raw lands: real-time readings as instants."""
    realtime = build.feed_form(adapter.national_realtime(spark, src), regional=False)
    return enrich.int_national(staging.stg_national(models.raw_national_history(spark, src), realtime))


def _files(spark, table):
    return {(r["p"], r["f"]) for r in spark.table(table).select(
        F.col("_part").alias("p"), F.col("_metadata.file_path").alias("f")).distinct().collect()}


def test_refresh_matches_models_and_is_incremental(spark, tmp_path, sf_small):
    wh = str(tmp_path / "wh")
    # the test tables are far below the production backfill minimums
    report = build.refresh(spark, sf_small, wh, min_rows=(1, 1))
    statuses = {r["status"] for r in report.collect()}
    assert report.count() == 37 and statuses <= {"pass", "warn"}
    expected = _expected_int_national(spark, sf_small)
    gold_green = build.read(spark, wh, "gold", "green_hours")
    assert _rows(gold_green) == _rows(marts.green_hours(marts.mart_patterns(expected)))
    gold = build.table_of(spark, wh, "gold", "mart_national")
    q = marts.mart_national(expected)
    assert _rows(sinks.read_table(spark, gold), sorted(q.columns)) == _rows(q)
    # a second run with nothing new appends nothing
    build.build_mart_national(spark, wh)
    assert sinks.read_table(spark, gold).count() == q.count()
    # a lookback run rewrites the affected partitions with the same content
    before = _files(spark, gold)
    build.build_mart_national(spark, wh, lookback="3 DAYS")
    assert 0 < len({p for p, _ in before - _files(spark, gold)}) <= 2
    assert _rows(sinks.read_table(spark, gold), sorted(q.columns)) == _rows(q)
    # SQL sessions find every model by name: staging views and the stored models
    other = spark.newSession()
    for name, view in zip(("stg_national", "stg_regional"), build.register_views(spark, wh)):
        df = getattr(build, name)(spark, wh)
        assert other.sql(f"SELECT * FROM {view}").columns == df.columns
        assert other.sql(f"SELECT count(*) FROM {view}").first()[0] == df.count()
        same = other.table(view)._jdf.queryExecution().optimizedPlan().sameResult(df._jdf.queryExecution().optimizedPlan())
        assert same
    silver, mart = build.database_of(wh, "silver"), build.database_of(wh, "gold")
    assert other.sql(f"SELECT count(*) FROM {silver}.int_national i JOIN {mart}.mart_national m USING (date_heure)"
                     ).first()[0] == q.count()
    # landing again derives the same raw tables
    n = build.read(spark, wh, "raw", "national_history").count()
    build.land_raw(spark, sf_small, wh)
    assert build.read(spark, wh, "raw", "national_history").count() == n


def test_raw_tables_are_kept_by_year_and_day(spark, tmp_path, sf_small):
    wh = str(tmp_path / "wh2")
    build.land_raw(spark, sf_small, wh)
    years = sinks.partitions(spark, build.table_of(spark, wh, "raw", "national_history"))
    assert years <= {"none"} | {str(y) for y in range(2016, 2022)} and len(years) > 3
    days = sinks.partitions(spark, build.table_of(spark, wh, "raw", "national_realtime"))
    assert all(len(d) == 10 for d in days)


def test_checks_keep_their_failing_rows(spark, tmp_path):
    """A planted null and a repeated key come back with their keys, from staging itself."""
    from gridmix.operators import quality
    stg = spark.createDataFrame([(dt.datetime(2026, 1, 1), 5.0, 1.0), (dt.datetime(2026, 1, 2), None, 2.0),
                                 (dt.datetime(2026, 1, 3), 1.0, None), (dt.datetime(2026, 1, 3), 2.0, None)],
                                "date_heure timestamp_ntz, consommation_mw double, taux_co2 double")
    enriched = stg.select("date_heure", F.lit("Automne").alias("saison"), F.lit("Bleu").alias("indice_vert"),
                          F.lit(0.5).alias("part_bas_carbone"))
    models_ = {"stg_national": stg, "int_national": enriched}
    checks = [c for c in quality.MODEL_CHECKS if c.model in models_]
    found = quality.failing_rows(models_, build.MODEL_KEYS, checks)
    got = {(r["model"], r["column_name"], r["test"], json.loads(r["row_key"])["date_heure"][:10]): r["n_rows"]
           for r in found.collect() if r["model"] == "stg_national"}
    assert got == {("stg_national", "consommation_mw", "not_null", "2026-01-02"): 1,
                   ("stg_national", "taux_co2", "not_null", "2026-01-03"): 1,
                   ("stg_national", "date_heure", "unique", "2026-01-03"): 2}
    assert _rows(quality.report_of(found, checks)) == _rows(quality.run_checks(models_, checks))


def test_check_run_stores_failures(spark, tmp_path, sf_small):
    wh = str(tmp_path / "whf")
    build.land_raw(spark, sf_small, wh)
    build.build_silver(spark, wh)
    build.build_gold(spark, wh)
    report = build.check_gold(spark, wh, dt.datetime(2026, 1, 1))
    assert report.count() == 37 and {r["status"] for r in report.collect()} <= {"pass", "warn"}
    stored = build.read(spark, wh, "gold", "check_failures")
    n = sum(r["failures"] for r in report.collect() if r["test"] == "not_null")
    assert stored.filter("test = 'not_null'").count() == n


def test_load_report_comes_from_the_writes_own_pass(spark, tmp_path, monkeypatch):
    """Neither the batch nor the table is scanned again for the report."""
    wh = str(tmp_path / "who")
    files = _exports(tmp_path / "o", [2019, 2020])
    build.backfill_exports(spark, files, wh, loaded_at=dt.datetime(2026, 1, 1), min_rows=1)
    scans, tables = [], []
    read_export, read_table = readers.read_export, sinks.read_table

    def counted(*args):
        df = read_export(*args)
        seen = spark.sparkContext.accumulator(0)
        scans.append(seen)

        def count(batches):
            for b in batches:
                seen.add(b.num_rows)
                yield b
        return df.mapInArrow(count, df.schema)
    monkeypatch.setattr(readers, "read_export", counted)
    monkeypatch.setattr(sinks, "read_table", lambda *a: tables.append(a) or read_table(*a))
    rep = build.backfill_exports(spark, _exports(tmp_path / "o2", [2021]), wh, loaded_at=dt.datetime(2026, 1, 2),
                                 min_rows=1).first()
    assert [s.value for s in scans] == [3] and tables == []
    assert (rep["n_rows"], rep["rows_loaded"], rep["rows_without_time"]) == (9, 3, 0)
    assert (rep["min_date_heure"][:4], rep["max_date_heure"][:4]) == ("2019", "2021")
    monkeypatch.undo()
    whole = build.verify_load.__globals__["quality"].load_stats(
        build.read(spark, wh, "raw", "national_history"), "national_history", "date_heure", 1).first()
    assert (whole["n_rows"], whole["min_date_heure"], whole["max_date_heure"]) == (
        rep["n_rows"], rep["min_date_heure"], rep["max_date_heure"])


def test_feed_run_after_landing(spark, tmp_path, sf_small):
    """One layout for both writers of a raw real-time table."""
    wh = str(tmp_path / "wh2b")
    build.land_raw(spark, sf_small, wh)
    before = build.stg_national(spark, wh).count()
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "r.json").write_text(json.dumps({"results": [
        {"date_heure": "2031-01-05T10:00:00+01:00", "consommation": 5.0, "taux_co2": 2.0}]}))
    build.ingest_realtime(spark, str(landing), wh).awaitTermination(120)
    stg = build.stg_national(spark, wh)
    assert stg.count() == before + 1
    assert [r["consommation_mw"] for r in stg.filter("date_heure > '2030-01-01'").collect()] == [5.0]


def test_load_gate_raises_below_minimum(spark, tmp_path, sf_small):
    wh = str(tmp_path / "wh3")
    build.land_raw(spark, sf_small, wh)
    rep = {r["table_name"]: r for r in build.verify_load(spark, wh, 1, 1).collect()}
    assert rep["national_history"]["n_rows"] > 0 and rep["national_history"]["gate_ok"]
    with pytest.raises(CheckFailed):
        build.verify_load(spark, wh)          # production minimums: 400,000 / 1,000,000


def test_stored_mart_follows_the_models_columns(spark, tmp_path, sf_small):
    """A stored mart of an older model: a column that is new reads as NULL in its
    rows, one that has vanished is gone, one of another type is converted."""
    wh = str(tmp_path / "wh4")
    build.land_raw(spark, sf_small, wh)
    build.build_silver(spark, wh)
    int_nat = build.read(spark, wh, "silver", "int_national")
    full = marts.mart_national(int_nat)
    cutoff = F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")
    old = full.filter(F.col("date_heure") <= cutoff).drop("part_fossiles") \
        .withColumn("co2_label", F.lit("x"))
    table = build.table_of(spark, wh, "gold", "mart_national")
    for kind in ("double", "string"):
        sinks.rewrite(old.withColumn("taux_co2", F.col("taux_co2").cast(kind)), table, grain=build.MART_GRAIN)
        build.build_mart_national(spark, wh)
        got = sinks.read_table(spark, table)
        assert sorted(got.columns) == sorted(full.columns)
        assert dict(got.dtypes) == dict(full.dtypes)
        assert got.count() == full.count()
        assert got.filter(F.col("part_fossiles").isNull()).count() == old.count()
        both = [c for c in full.columns if c != "part_fossiles"]
        assert _rows(got, both) == _rows(full, both)


def _exports(folder, years, hours=3, extra=""):
    folder.mkdir(exist_ok=True)
    names = list(NATIONAL_HISTORY_TEXT)
    for y in years:
        lines = [";".join(names) + (";nature" if extra else "")]
        for h in range(hours):
            vals = {c: "" for c in names}
            vals.update(date_heure=f"{y}-06-01T0{h}:00:00+02:00", consommation=str(100 + h),
                        gaz="NA", taux_co2="nan" if h == 2 else "25.5")
            lines.append(";".join(vals[c] for c in names) + (f";{extra}" if extra else ""))
        (folder / f"eco2mix_{y}.csv").write_text("\n".join(lines) + "\n")
    return str(folder)


def test_backfills_add_and_lose_nothing(spark, tmp_path):
    wh = str(tmp_path / "wh6")
    raw = build.table_of(spark, wh, "raw", "national_history")
    first = _exports(tmp_path / "a", [2019, 2020])
    with open(os.path.join(first, "eco2mix_2020.csv"), "a") as f:
        f.write("bad;1" + ";" * (len(NATIONAL_HISTORY_TEXT) - 2) + "\n")
    stamp = dt.datetime(2026, 1, 1)
    rep = build.backfill_exports(spark, first, wh, loaded_at=stamp, min_rows=7).first()
    assert (rep["n_rows"], rep["rows_loaded"], rep["rows_without_time"], rep["gate_ok"]) == (7, 7, 1, True)
    # a part of a year, a second year with a column more, nothing, a whole year again
    build.backfill_exports(spark, _exports(tmp_path / "b", [2019], 1), wh, loaded_at=dt.datetime(2026, 1, 2), min_rows=1)
    build.backfill_exports(spark, _exports(tmp_path / "c", [2021], extra="def"), wh, loaded_at=stamp, min_rows=1)
    rep = build.backfill_exports(spark, _exports(tmp_path / "d", [2022], 0), wh, loaded_at=stamp).first()
    assert rep["rows_loaded"] == 0 and rep["n_rows"] == 7 + 1 + 3
    got = sinks.read_table(spark, raw)
    assert got.filter("date_heure = 'bad'").count() == 1 and got.filter("nature = 'def'").count() == 3
    build.backfill_exports(spark, _exports(tmp_path / "e", [2019], 2), wh, loaded_at=stamp, min_rows=1, whole_years=True)
    assert sinks.partitions(spark, raw) == {"2019", "2020", "2021", "none"}
    assert sinks.read_table(spark, raw, ["2019"]).count() == 2 and sinks.read_table(spark, raw, ["none"]).count() == 1
    with pytest.raises(CheckFailed):
        build.backfill_exports(spark, first, wh, loaded_at=stamp)   # 400,000 minimum


def test_repeated_autumn_hour_of_an_export_has_one_survivor(spark):
    """No row key, one load stamp: all columns decide, whatever the order of rows."""
    names = list(NATIONAL_HISTORY_TEXT)
    rows = []
    for i, offset in enumerate(("+02:00", "+01:00")):
        vals = dict.fromkeys(names)
        vals.update(date_heure=f"2024-10-27T02:30:00{offset}", consommation="100", taux_co2="5", gaz=str(i))
        rows.append(tuple(vals[c] for c in names) + (dt.datetime(2026, 1, 1),))
    schema = ", ".join(f"{c} string" for c in names) + ", _loaded_at timestamp_ntz"
    kept = {tuple(staging.stg_national(spark.createDataFrame(order, schema).repartition(n)).first())
            for order in (rows, rows[::-1]) for n in (1, 2, 3)}
    assert len(kept) == 1


def test_freshness_sees_a_feed_that_stopped(spark, tmp_path):
    wh = str(tmp_path / "wh7")
    assert build.verify_recent(spark, wh).first()["n_rows"] == 0      # no table yet
    landing = tmp_path / "l7"
    landing.mkdir()
    (landing / "r.json").write_text(json.dumps({"results": [
        {"date_heure": "2025-01-05T10:00:00+01:00", "consommation": 5.0, "taux_co2": 2.0}]}))
    build.ingest_realtime(spark, str(landing), wh).awaitTermination(120)
    assert build.verify_recent(spark, wh).first()["is_stale"] is True
    at = dt.datetime(2025, 1, 5, 10, 30, tzinfo=dt.timezone.utc)
    assert build.verify_recent(spark, wh, now=at).first()["is_stale"] is False


def test_backfill_and_feed_run_meet_in_staging(spark, tmp_path):
    wh = str(tmp_path / "wh5")
    rep = build.backfill_exports(spark, _exports(tmp_path / "exports", [2019, 2020]), wh,
                                 loaded_at=dt.datetime(2026, 1, 1), min_rows=6).first()
    assert rep["n_rows"] == 6 and rep["gate_ok"]
    raw = build.read(spark, wh, "raw", "national_history")
    assert raw.filter("taux_co2 IS NULL").count() == 2 and raw.filter("gaz IS NULL").count() == 6
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "r1.json").write_text(json.dumps({"results": [
        {"date_heure": "2026-01-05T10:00:00+01:00", "consommation": 50000.0, "taux_co2": 20.0}]}))
    build.ingest_realtime(spark, str(landing), wh).awaitTermination(120)
    rt = build.read(spark, wh, "raw", "national_realtime")
    assert rt.count() == 1 and rt.first()["_source"] == "eco2mix-national-tr"
    assert build.stg_national(spark, wh).count() == 6 + 1   # without CO2 they are kept
    fresh = build.verify_recent(spark, wh).first()
    assert fresh["n_rows"] == 1 and str(fresh["max_date_heure"]) == "2026-01-05 09:00:00"
