"""Readers, source queries and sinks (round trips in scratch folders)."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmix.operators.upsert import NATIONAL_FEED
from gridmix.plans import build
from gridmix.sources import readers, sinks
from gridmix.sources.schemas import (NATIONAL_HISTORY_TEXT, NATIONAL_RT_MEASURES, feed_envelope,
                                     national_realtime_table)

D = dt.datetime


def test_read_export_all_text(spark, tmp_path):
    d = tmp_path / "export"
    d.mkdir()
    for y in (2019, 2020):
        (d / f"{y}.csv").write_text(
            "date_heure;consommation;taux_co2\n"
            f"{y}-01-01T00:00:00+01:00;100;ND\n{y}-01-01T00:30:00+01:00;;12.5\n")
    df = readers.read_export(spark, str(d), ["date_heure", "consommation", "taux_co2"])
    assert dict(df.dtypes) == {"date_heure": "string", "consommation": "string", "taux_co2": "string"}
    assert df.count() == 4
    assert sorted(r["taux_co2"] for r in df.collect() if r["taux_co2"]) == ["12.5", "12.5", "ND", "ND"]


def test_read_feed_envelope(spark, tmp_path):
    p = tmp_path / "feed.json"
    p.write_text(json.dumps({"results": [
        {"date_heure": "2026-01-01T10:00:00+01:00", "consommation": 50000, "taux_co2": 30},
        {"date_heure": "2026-01-01T10:30:00+01:00", "taux_co2": 31.5}]}))
    df = readers.read_feed(spark, str(p), feed_envelope(NATIONAL_RT_MEASURES, regional=False))
    rows = df.orderBy("date_heure").collect()
    assert len(rows) == 2 and rows[1]["consommation"] is None and rows[1]["taux_co2"] == 31.5


def test_year_slice_half_open_on_instant(spark):
    df = spark.createDataFrame([("2018-12-31T23:30:00+01:00",), ("2019-01-01T00:00:00+01:00",),
                                ("2019-12-31T23:30:00+01:00",), ("2020-01-01T00:00:00+01:00",),
                                ("2019-01-01T00:30:00+02:00",), ("bad",)], "date_heure string")
    got = [r[0] for r in readers.year_slice(df, 2019).collect()]
    assert got == ["2019-01-01T00:00:00+01:00", "2019-12-31T23:30:00+01:00"]


def test_latest_n_top_k(spark):
    df = spark.createDataFrame([(D(2024, 1, 1, h), h) for h in range(24)],
                               "date_heure timestamp_ntz, _row_key long")
    out = readers.latest_n(df, 3)
    assert [r["_row_key"] for r in out.collect()] == [23, 22, 21]
    assert "TakeOrderedAndProject" in out._jdf.queryExecution().executedPlan().toString()


def test_append_and_replace(spark, db):
    t = f"{db}.raw"
    b = spark.createDataFrame([("2019-05-01T00:00:00+01:00", "1"), ("2020-05-01T00:00:00+01:00", "2"),
                               ("bad", "3")], "date_heure string, consommation string")
    sinks.append(b, t)
    sinks.append(b, t)
    assert sinks.read_table(spark, t).count() == 6              # re-run duplicates
    sinks.overwrite_partitions(b.filter(F.col("consommation") == "1"), t)
    got = sorted(r["consommation"] for r in sinks.read_table(spark, t).collect())
    assert got == ["1", "2", "2", "3", "3"]                # only 2019 replaced
    assert [r["consommation"] for r in sinks.read_table(spark, t, ["2019"]).collect()] == ["1"]
    sinks.append(b.withColumn("extra", F.lit("e")), t)     # a new column is added
    assert sinks.read_table(spark, t).filter("extra IS NULL").count() == 5
    assert spark.sql(f"SELECT count(*) FROM {t} WHERE _part = 'none'").first()[0] == 3    # a table for SQL too


def test_replace_is_dynamic_whatever_the_session_says(spark, db):
    b = spark.createDataFrame([(D(2019, 5, 1), 1), (D(2020, 5, 1), 2)], "date_heure timestamp_ntz, v int")
    sinks.append(b, f"{db}.t")
    before = spark.conf.get(sinks.OVERWRITE_MODE)
    spark.conf.set(sinks.OVERWRITE_MODE, "static")
    try:
        sinks.overwrite_partitions(b.filter("v = 2").withColumn("v", F.lit(9)), f"{db}.t")
        assert spark.conf.get(sinks.OVERWRITE_MODE) == "static"
    finally:
        spark.conf.set(sinks.OVERWRITE_MODE, before)
    assert sorted(r["v"] for r in sinks.read_table(spark, f"{db}.t").collect()) == [1, 9]


def test_one_layout_per_table(spark, db):
    t = f"{db}.raw"
    b = spark.createDataFrame([(D(2019, 5, 1), 1)], "date_heure timestamp_ntz, v int")
    sinks.append(b, t)
    with pytest.raises(ValueError):
        sinks.append(b, t, grain="day")
    with pytest.raises(ValueError):
        sinks.append(b.withColumn("v", F.col("v").cast("string")), t)
    with pytest.raises(ValueError):
        sinks.ensure_table(spark, t, b.schema, "day")
    assert sinks.read_table(spark, t).count() == 1


def _failing(df):
    """The same rows, but their task fails half way."""
    return df.withColumn("id", F.when(F.col("id") >= 4, F.raise_error(F.lit("lost")).cast("bigint"))
                         .otherwise(F.col("id")))


def test_full_refresh_keeps_the_old_model_when_it_fails(spark, db):
    t = f"{db}.mart"
    sinks.full_refresh(spark.range(3), t)
    sinks.full_refresh(sinks.read_table(spark, t).filter("id > 0"), t)      # from the model itself
    assert sinks.read_table(spark, t).count() == 2
    with pytest.raises(Exception, match="lost"):
        sinks.full_refresh(_failing(spark.range(9)), t)
    assert sinks.read_table(spark, t).count() == 2 and len(sinks._versions(spark, t)) == 2
    sinks.full_refresh(spark.range(9).withColumn("x", F.lit(1)), t)
    assert sinks.read_table(spark, t).columns == ["id", "x"]
    sinks.full_refresh(spark.range(0), t)
    assert sinks.read_table(spark, t).count() == 0                          # empty is a state too


def test_failed_replace_leaves_the_partitions(spark, db):
    t = f"{db}.part"
    rows = spark.range(8).withColumn("date_heure", F.make_timestamp_ntz(
        F.lit(2019) + (F.col("id") % 2).cast("int"), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)))
    sinks.append(rows, t)
    before = sorted(map(tuple, sinks.read_table(spark, t).collect()))
    with pytest.raises(Exception, match="lost"):
        sinks.overwrite_partitions(_failing(sinks.read_table(spark, t, ["2019"])), t)
    with pytest.raises(Exception, match="lost"):
        sinks.append(_failing(rows), t)
    assert sorted(map(tuple, sinks.read_table(spark, t).collect())) == before
    sinks.overwrite_partitions(sinks.read_table(spark, t, ["2019"]).filter("id > 2"), t)    # reads what it replaces
    assert sorted(r["id"] for r in sinks.read_table(spark, t).collect()) == [1, 3, 4, 5, 6, 7]


def test_rewrite_changes_columns_and_layout(spark, db):
    t = f"{db}.w"
    rows = spark.createDataFrame([(D(2019, 5, 1), 1, "x"), (D(2020, 5, 1), 2, "y")],
                                 "date_heure timestamp_ntz, v int, gone string")
    sinks.append(rows, t)
    with pytest.raises(Exception):
        sinks.rewrite(sinks.read_table(spark, t).withColumn("v", F.raise_error(F.lit("lost")).cast("int")), t)
    assert sinks.read_table(spark, t).count() == 2
    sinks.rewrite(sinks.read_table(spark, t).drop("gone").withColumn("v", F.col("v").cast("string")), t, grain="month")
    assert dict(sinks.read_table(spark, t).dtypes) == {"date_heure": "timestamp_ntz", "v": "string"}
    assert sinks.partitions(spark, t) == {"2019-05", "2020-05"}


def test_files_of_a_lost_catalog_are_found_again(spark, db):
    t = f"{db}.again"
    b = spark.createDataFrame([(D(2019, 5, 1), 1)], "date_heure timestamp_ntz, v int")
    sinks.append(b, t)
    spark.sql(f"DROP TABLE {t}")        # as when an application without a metastore ends
    sinks.ensure_table(spark, t, b.schema)
    assert sinks.read_table(spark, t).collect() == b.collect()


def test_layer_name_rule():
    assert sinks.layer_name(None, "dev_schema") == "dev_schema"
    assert sinks.layer_name("  marts ", "dev_schema") == "MARTS"


def test_ensure_table_and_database(spark, db, tmp_path):
    t = f"{db}.rt"
    sinks.ensure_table(spark, t, national_realtime_table())
    sinks.ensure_table(spark, t, national_realtime_table())
    df = sinks.read_table(spark, t)
    assert df.count() == 0 and "taux_co2" in df.columns
    sinks.ensure_database(spark, "gridmix_test_db")
    assert any(d.name == "gridmix_test_db" for d in spark.catalog.listDatabases())
    with pytest.raises(ValueError, match="lies in"):
        sinks.ensure_database(spark, db, str(tmp_path / "elsewhere"))


def _batch(spark, rows):
    measures = {m: None for m in NATIONAL_RT_MEASURES}
    recs = [(ts, *(dict(measures, consommation=cons, taux_co2=2.0)[m] for m in NATIONAL_RT_MEASURES), k)
            for k, (ts, cons) in enumerate(rows)]
    schema = T.StructType([f for f in national_realtime_table() if not f.name.startswith("_")])
    return spark.createDataFrame(recs, schema.add("_row_key", "long"))


def _files(spark, table):
    return {(r["p"], r["f"]) for r in spark.table(table).select(
        F.col("_part").alias("p"), F.col("_metadata.file_path").alias("f")).distinct().collect()}


def test_merge_rewrites_only_the_partitions_of_the_batch(spark, db):
    schema = national_realtime_table()
    for grain in ("year", "day"):
        t = f"{db}.by_{grain}"
        days = [D(2021 + d, 1, 1 + d, 12) for d in range(5)]
        sinks.merge_into(spark, t, _batch(spark, [(x, 1.0) for x in days]), NATIONAL_FEED, D(2026, 1, 6), schema,
                         grain=grain)
        before = _files(spark, t)
        sinks.merge_into(spark, t, _batch(spark, [(days[-1], 2.0), (D(2030, 1, 6), 3.0)]), NATIONAL_FEED,
                         D(2026, 2, 1), schema, grain=grain)
        after = _files(spark, t)
        assert len(before) == 5 and len(after) == 6
        assert {p for p, _ in before - after} == {max(p for p, _ in before)}
        got = {r["date_heure"]: (r["consommation"], r["_loaded_at"]) for r in sinks.read_table(spark, t).collect()}
        assert got == {**{x: (1.0, D(2026, 1, 6)) for x in days[:-1]}, days[-1]: (2.0, D(2026, 2, 1)),
                       D(2030, 1, 6): (3.0, D(2026, 2, 1))}


def test_full_refresh_keeps_the_newest_tables(spark, db):
    t = f"{db}.mart_v"
    for i in range(4):
        sinks.full_refresh(spark.range(i + 1), t)
    assert len(sinks._versions(spark, t)) == 2
    assert sinks.read_table(spark, t).count() == 4


def test_pruned_year_of_a_stored_table(spark, tmp_path):
    wh = str(tmp_path / "wh")
    rows = [(f"{y}-06-01T00:00:00+01:00", "1") for y in range(2015, 2025)]
    rows += [("2019-12-31T23:30:00-05:00", "2"), ("2021-01-01T00:00:00+02:00", "3")]
    sinks.append(spark.createDataFrame(rows, "date_heure string, consommation string"),
                 build.table_of(spark, wh, "raw", "national_history"))
    got = build.raw_year(spark, wh, 2020)
    assert sorted(r["consommation"] for r in got.collect()) == ["1", "2", "3"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_part" in plan and "2019" in plan


# ---- exports by header --------------------------------------------------------

NEEDED = ["date_heure", "consommation", "taux_co2"]


def _export(folder, name, lines, encoding="utf-8"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + ("\n" if lines else ""), encoding=encoding)


def test_exports_go_by_header_names(spark, tmp_path):
    d = tmp_path / "e"
    _export(d, "2019.csv", ["perimetre;Nature;Date-Heure;consommation;taux_co2",
                            "France;def;2019-01-01T00:00:00+01:00;100;NA", "France;def;2019-02-01T00:00:00+01:00;;nan"])
    _export(d, "2020.csv", ["taux_co2;consommation;Prévision (J);date_heure", "5;200;7;2020-01-01T00:00:00+01:00"],
            "utf-8-sig")
    _export(d, "2021.csv", ["date_heure;consommation;taux_co2"])
    _export(d, "2022.csv", [])
    df = readers.read_export(spark, str(d), NEEDED)
    assert set(df.columns) == {"perimetre", "nature", "date_heure", "consommation", "taux_co2", "prevision_j"}
    assert set(dict(df.dtypes).values()) == {"string"}
    got = sorted((r["date_heure"][:7], r["consommation"], r["taux_co2"], r["nature"], r["prevision_j"])
                 for r in df.collect())
    assert got == [("2019-01", "100", None, "def", None), ("2019-02", None, None, "def", None),
                   ("2020-01", "200", "5", None, "7")]


def test_export_without_a_needed_column_or_with_one_twice(spark, tmp_path):
    _export(tmp_path / "a", "x.csv", ["date_heure;taux_co2", "1;2"])
    with pytest.raises(ValueError, match="consommation"):
        readers.read_export(spark, str(tmp_path / "a"), NEEDED).collect()
    _export(tmp_path / "b", "x.csv", ["date_heure;date-heure;consommation;taux_co2", "1;2;3;4"])
    with pytest.raises(ValueError, match="two columns"):
        readers.read_export(spark, str(tmp_path / "b"), NEEDED).collect()


def test_exports_without_rows(spark, tmp_path):
    _export(tmp_path / "h", "x.csv", [";".join(NEEDED)])
    assert readers.read_export(spark, str(tmp_path / "h"), NEEDED).count() == 0
    _export(tmp_path / "z", "x.csv", [])
    assert readers.read_export(spark, str(tmp_path / "z"), NEEDED).columns == NEEDED


# ---- width and quotes ------------------------------------------------------------

def test_too_many_fields_fail_the_read_and_are_told(spark, tmp_path):
    _export(tmp_path / "w", "x.csv", [";".join(NEEDED), "2019-01-01T00:00:00+01:00;1;2", "t;1;2;3;4"])
    with pytest.raises(Exception, match="more than 3 fields: 5"):
        readers.read_export(spark, str(tmp_path / "w"), NEEDED).collect()
    with pytest.raises(Exception, match="more than 3 fields"):     # also where no column is asked for
        readers.read_export(spark, str(tmp_path / "w"), NEEDED).count()
    rows = readers.scan_export(spark, str(tmp_path / "w"), NEEDED)
    bad = rows.filter(F.col(readers.REASON).isNotNull()).collect()
    assert [(r["_reason"], r["_record"], r["_file"].endswith("x.csv")) for r in bad] == [
        ("more than 3 fields: 5", "t;1;2;3;4", True)]
    assert rows.filter(F.col(readers.REASON).isNull()).count() == 1


def test_too_few_fields_are_padded_and_blank_lines_skipped(spark, tmp_path):
    _export(tmp_path / "f", "x.csv", [";".join(NEEDED), "a;1", "", ";;", "b"])
    got = sorted(map(tuple, readers.read_export(spark, str(tmp_path / "f"), NEEDED).collect()), key=str)
    assert got == sorted([("a", "1", None), ("b", None, None), (None, None, None)], key=str)


def test_quotes_doubled_quotes_and_line_breaks(spark, tmp_path):
    d = tmp_path / "q"
    _export(d, "x.csv", [";".join(NEEDED), '"a ""b""";"1;5";"x', 'y"', '"c";2;""', 'd;"3";z'])
    _export(d, "y.csv", [";".join(NEEDED), 'e "quoted" here;4;stray"'])
    got = sorted(map(tuple, readers.read_export(spark, str(d), NEEDED).collect()), key=str)
    want = [('a "b"', "1;5", "x\ny"), ("c", "2", None), ("d", "3", "z"), ('e "quoted" here', "4", 'stray"')]
    assert got == sorted(want, key=str)


def test_open_quote_rejects_the_file(spark, tmp_path):
    d = tmp_path / "o"
    _export(d, "x.csv", [";".join(NEEDED), "a;1;2", 'b;"1;2', "c;1;2"])
    _export(d, "y.csv", [";".join(NEEDED), "d;1;2"])
    with pytest.raises(Exception, match="x.csv: open quote"):
        readers.read_export(spark, str(d), NEEDED).collect()
    rows = readers.scan_export(spark, str(d), NEEDED).select("date_heure", "_reason").collect()
    assert sorted(map(tuple, rows), key=str) == [("d", None), (None, "open quote")]


def test_backfill_with_bad_rows(spark, tmp_path):
    wh, d = str(tmp_path / "wq"), tmp_path / "e"
    full = list(NATIONAL_HISTORY_TEXT)
    good = ["2019-06-01T00:00:00+02:00", "7"] + [""] * (len(full) - 2)
    _export(d, "2019.csv", [";".join(full), ";".join(good), ";".join(good + ["extra"])])
    with pytest.raises(Exception, match=f"more than {len(full)} fields"):
        build.backfill_exports(spark, str(d), wh, min_rows=1)
    assert build.read(spark, wh, "raw", "national_history").count() == 0       # nothing of the failed load
    rep = build.backfill_exports(spark, str(d), wh, min_rows=1, bad_rows="quarantine").first()
    assert (rep["n_rows"], rep["rows_loaded"], rep["rows_rejected"]) == (1, 1, 1)
    (bad,) = build.read(spark, wh, "raw", "national_history_quarantine").collect()
    assert bad["record"].endswith(";extra") and bad["reason"] == f"more than {len(full)} fields: {len(full) + 1}"


# ---- responses --------------------------------------------------------------------

BODIES = {
    "good.json": '{"results": [{"date_heure": "2026-01-01T10:00:00+01:00", "consommation": 5.0}]}',
    "none.json": '{"results": []}',
    "cut.json": '{"results": [{"date_heure": "2026-01-01T10:00:00+01:00", "conso',
    "foreign.json": '{"error": "rate limit"}', "page.json": "<html>busy</html>", "list.json": "[1, 2]",
    "empty.json": "", "object.json": '{"results": {"date_heure": "x"}}', "null.json": '{"results": null}',
    "value.json": '{"results": [{"date_heure": "2026-01-01T11:00:00+01:00", "consommation": "much"}]}',
    "hole.json": '{"results": [null]}', "tail.json": '{"results": []} and more',
}


def test_responses_that_cannot_be_read_are_told(spark, tmp_path):
    for name, body in BODIES.items():
        (tmp_path / name).write_text(body)
    read = readers.responses(readers.response_files(spark, str(tmp_path / "*.json")),
                             feed_envelope(NATIONAL_RT_MEASURES, False)).collect()
    assert {os.path.basename(r["file"]): r["reason"] for r in read} == {
        "good.json": None, "none.json": None, "cut.json": "no JSON object", "foreign.json": "no results",
        "page.json": "no JSON object", "list.json": "no JSON object", "empty.json": "empty",
        "object.json": "a value that does not fit", "null.json": "results is no list",
        "value.json": "a value that does not fit", "hole.json": "a value that does not fit",
        "tail.json": "no JSON object"}
    assert all((r["records"] is None) == (r["reason"] is not None) for r in read)
    with pytest.raises(Exception, match="cut.json: no JSON object"):
        readers.read_feed(spark, [str(tmp_path / n) for n in ("good.json", "cut.json")],
                          feed_envelope(NATIONAL_RT_MEASURES, False)).collect()
