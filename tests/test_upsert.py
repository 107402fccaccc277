"""Set-based MERGE semantics (null-blind change test, partial updates)."""

import datetime as dt

from gridmix.operators.upsert import NATIONAL_FEED, REGIONAL_FEED, upsert

D = dt.datetime
T0, T1 = D(2026, 1, 1), D(2026, 3, 1)
NAT = ("date_heure timestamp_ntz, consommation double, taux_co2 double, nucleaire double, "
       "hydraulique double, _loaded_at timestamp_ntz, _source string, _row_key long")
NAT_BATCH = ("date_heure timestamp_ntz, consommation double, taux_co2 double, nucleaire double, "
             "hydraulique double, _row_key long")


def run(spark, target, batch, spec=NATIONAL_FEED, tschema=NAT, bschema=NAT_BATCH):
    t = spark.createDataFrame(target, tschema)
    b = spark.createDataFrame(batch, bschema)
    return sorted((tuple(r) for r in upsert(t, b, spec, T1).collect()),
                  key=lambda r: (str(r[0]), str(r[1]), str(r[-1])))


def test_null_blind_change_and_partial_update(spark):
    h = D(2024, 1, 1)
    target = [
        (h, 10.0, 5.0, 1.0, 1.0, T0, "tr", 1),                           # co2 changes -> update
        (h.replace(hour=1), 10.0, 5.0, 1.0, 1.0, T0, "tr", 2),            # value -> NULL: no update
        (h.replace(hour=2), None, 5.0, 1.0, 1.0, T0, "tr", 3),            # NULL -> value: no update
        (h.replace(hour=3), 10.0, 5.0, 1.0, 1.0, T0, "tr", 4),            # only unlisted changed
        (h.replace(hour=4), 10.0, 5.0, 1.0, 1.0, T0, "tr", 5),            # not in batch
    ]
    batch = [
        (h, 10.0, 6.0, 9.0, 9.0, 11),
        (h.replace(hour=1), None, 5.0, 9.0, 9.0, 12),
        (h.replace(hour=2), 10.0, 5.0, 9.0, 9.0, 13),
        (h.replace(hour=3), 10.0, 5.0, 1.0, 9.0, 14),
        (h.replace(hour=5), 7.0, 3.0, 2.0, 2.0, 15),                     # new -> insert
    ]
    got = run(spark, target, batch)
    assert got == [
        (h, 10.0, 6.0, 9.0, 1.0, T1, "tr", 1),          # listed cols + stamp, hydraulique kept
        (h.replace(hour=1), 10.0, 5.0, 1.0, 1.0, T0, "tr", 2),
        (h.replace(hour=2), None, 5.0, 1.0, 1.0, T0, "tr", 3),
        (h.replace(hour=3), 10.0, 5.0, 1.0, 1.0, T0, "tr", 4),
        (h.replace(hour=4), 10.0, 5.0, 1.0, 1.0, T0, "tr", 5),
        (h.replace(hour=5), 7.0, 3.0, 2.0, 2.0, T1, "eco2mix-national-tr", 15),
    ]


def test_duplicate_key_in_batch_last_arrival(spark):
    h = D(2024, 1, 1)
    got = run(spark, [], [(h, 1.0, 1.0, 1.0, 1.0, 1), (h, 2.0, 2.0, 2.0, 2.0, 2)])
    assert got == [(h, 2.0, 2.0, 2.0, 2.0, T1, "eco2mix-national-tr", 2)]


def test_null_region_key_inserted_every_run(spark):
    schema = ("code_insee_region string, date_heure timestamp_ntz, consommation double, "
              "thermique double, _loaded_at timestamp_ntz, _source string, _row_key long")
    bschema = "code_insee_region string, date_heure timestamp_ntz, consommation double, " \
              "thermique double, _row_key long"
    h = D(2024, 1, 1)
    target = [(None, h, 1.0, 1.0, T0, "eco2mix-regional-tr", 1), ("11", h, 1.0, 1.0, T0, "x", 2)]
    batch = [(None, h, 1.0, 1.0, 3), (None, h, 1.0, 1.0, 4), ("11", h, 2.0, 5.0, 5)]
    got = run(spark, target, batch, REGIONAL_FEED, schema, bschema)
    assert len(got) == 4
    assert ("11", h, 2.0, 5.0, T1, "x", 2) in got
    assert sum(1 for r in got if r[0] is None) == 3


def test_rerun_is_idempotent(spark):
    h = D(2024, 1, 1)
    t = spark.createDataFrame([(h, 10.0, 5.0, 1.0, 1.0, T0, "tr", 1)], NAT)
    b = spark.createDataFrame([(h, 11.0, 5.0, 2.0, 2.0, 9), (h.replace(hour=1), 1.0, 1.0, 1.0,
                                                             1.0, 10)], NAT_BATCH)
    once = upsert(t, b, NATIONAL_FEED, T1)
    twice = upsert(once, b, NATIONAL_FEED, D(2026, 4, 1))
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str)


def test_hot_target_key_split_by_aqe(spark):
    """One key holds a third of the target: the join is split by AQE, and gives
    the rows of a broadcast join (chosen by AQE with the usual threshold)."""
    from pyspark.sql import functions as F
    hot = D(2024, 1, 1)
    n = 30000
    target = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(
            F.lit(hot) + F.make_dt_interval(mins=F.col("id").cast("int"))).alias("date_heure"),
        (F.col("id") % 7).cast("double").alias("consommation"),
        F.lit(5.0).alias("taux_co2"), F.lit(1.0).alias("nucleaire"), F.lit(1.0).alias("hydraulique"),
        F.lit(T0).alias("_loaded_at"), F.lit("tr").alias("_source"), F.col("id").alias("_row_key"))
    batch = spark.createDataFrame([(hot, 99.0, 6.0, 2.0, 2.0, 10_000),
                                   (D(2030, 1, 1), 1.0, 1.0, 1.0, 1.0, 10_001)], NAT_BATCH)
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        shuffled = upsert(target, batch, NATIONAL_FEED, T1)
        got = sorted(map(tuple, shuffled.collect()), key=str)
        plan = shuffled._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    want = sorted(map(tuple, upsert(target, batch, NATIONAL_FEED, T1).collect()), key=str)
    assert got == want and len(got) == n + 1
    assert sum(1 for r in got if r[0] == hot and r[1] == 99.0) == n // 3
    assert "SortMergeJoin(skew=true)" in plan      # the hot partition was split
