"""Incremental model builds: high-water filter, lookback, column sync."""

import datetime as dt

from gridmix.operators.upsert import (high_water, incremental_merge, incremental_source,
                                      incremental_sync, sync_columns)

D = dt.datetime
S = "date_heure timestamp_ntz, v double"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_first_run_loads_everything(spark):
    src = spark.createDataFrame([(D(2024, 1, 1), 1.0), (D(2024, 1, 2), 2.0)], S)
    assert rows(incremental_merge(None, src, ["date_heure"])) == rows(src)


def test_empty_target_gives_no_rows(spark):
    src = spark.createDataFrame([(D(2024, 1, 1), 1.0)], S)
    empty = spark.createDataFrame([], S)
    assert incremental_source(src, empty).count() == 0


def test_strict_drops_late_and_corrected_rows(spark):
    target = spark.createDataFrame([(D(2024, 1, 1), 1.0), (D(2024, 1, 3), 3.0)], S)
    src = spark.createDataFrame([(D(2024, 1, 1), 9.0), (D(2024, 1, 2), 2.0),
                                 (D(2024, 1, 3), 3.0), (D(2024, 1, 4), 4.0)], S)
    out = rows(incremental_merge(target, src, ["date_heure"]))
    assert out == [(D(2024, 1, 1), 1.0), (D(2024, 1, 3), 3.0), (D(2024, 1, 4), 4.0)]


def test_lookback_picks_late_rows_and_replaces(spark):
    target = spark.createDataFrame([(D(2024, 1, 1), 1.0), (D(2024, 1, 3), 3.0)], S)
    src = spark.createDataFrame([(D(2024, 1, 1), 9.0), (D(2024, 1, 2), 2.0),
                                 (D(2024, 1, 3), 7.0), (D(2024, 1, 4), 4.0)], S)
    out = rows(incremental_merge(target, src, ["date_heure"], lookback="2 DAYS"))
    assert out == [(D(2024, 1, 1), 1.0), (D(2024, 1, 2), 2.0), (D(2024, 1, 3), 7.0),
                   (D(2024, 1, 4), 4.0)]


def test_high_water_is_a_scalar_subquery(spark, tmp_path):
    p = str(tmp_path / "src")
    spark.createDataFrame([(D(2024, 1, i), float(i)) for i in range(1, 9)], S).write.parquet(p)
    src = spark.read.parquet(p)
    target = spark.createDataFrame([(D(2024, 1, 5), 0.0)], S)
    q = incremental_source(src, target)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" in plan
    assert rows(q) == [(D(2024, 1, i), float(i)) for i in range(6, 9)]
    assert target.select(high_water(target).alias("m")).first()["m"] == D(2024, 1, 5)


def test_sync_columns_adds_and_drops(spark):
    target = spark.createDataFrame([(D(2024, 1, 1), 1.0, "old")], "date_heure timestamp_ntz, v double, gone string")
    model = spark.createDataFrame([(D(2024, 1, 2), 2.0, 5)], "date_heure timestamp_ntz, v double, extra int")
    synced = sync_columns(target, model)
    assert synced.columns == ["date_heure", "v", "extra"]
    assert dict(synced.dtypes)["extra"] == "int"
    out = rows(incremental_sync(target, model, ["date_heure"]))
    assert out == [(D(2024, 1, 1), 1.0, None), (D(2024, 1, 2), 2.0, 5)]


def test_incremental_equals_rebuild_when_data_move_forward(spark):
    all_rows = [(D(2024, 1, 1) + dt.timedelta(hours=i), float(i)) for i in range(48)]
    full = spark.createDataFrame(all_rows, S)
    first = spark.createDataFrame(all_rows[:20], S)
    step = incremental_merge(first, full, ["date_heure"])
    assert rows(step) == rows(full)
    assert rows(incremental_merge(step, full, ["date_heure"])) == rows(full)
