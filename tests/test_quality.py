"""Declarative checks and load gates."""

import pytest

from gridmix.operators import quality
from gridmix.operators.quality import Check, CheckFailed


def report(df):
    return {(r["column_name"], r["test"]): (r["failures"], r["status"]) for r in df.collect()}


def test_starter_pair_fails_not_null_passes_unique(spark):
    df = spark.createDataFrame([(1,), (None,)], "id int")
    rep = report(quality.check_model(df, [Check("m", "id", "unique"), Check("m", "id", "not_null")]))
    assert rep[("id", "unique")] == (0, "pass")
    assert rep[("id", "not_null")] == (1, "fail")


def test_unique_counts_duplicated_values(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (2,), (2,), (3,), (None,), (None,)], "k int")
    assert report(quality.check_model(df, [Check("m", "k", "unique")]))[("k", "unique")] == (2, "fail")


def test_accepted_values_null_passes(spark):
    df = spark.createDataFrame([("Vert",), (None,), ("Bleu",), ("Bleu",), ("Noir",)], "c string")
    rep = report(quality.check_model(df, [Check("m", "c", "accepted_values", values=("Vert",))]))
    assert rep[("c", "accepted_values")] == (2, "fail")


def test_warn_severity_does_not_raise(spark):
    df = spark.createDataFrame([(None,)], "a double")
    rep = quality.check_model(df, [Check("m", "a", "not_null", "warn")])
    assert report(rep)[("a", "not_null")] == (1, "warn")
    assert quality.assert_report(rep)
    with pytest.raises(CheckFailed):
        quality.assert_report(quality.check_model(df, [Check("m", "a", "not_null")]))


def test_min_rows_gate(spark):
    df = spark.range(10)
    assert quality.assert_min_rows(df, 10) == 10
    with pytest.raises(CheckFailed):
        quality.assert_min_rows(df, 11)


def test_min_rows_gate_returns_the_count(spark):
    assert quality.assert_min_rows(spark.range(25), 10) == 25


def test_checks_of_one_model_do_not_multiply_its_rows(spark):
    df = spark.createDataFrame([("Vert", "a", 1), (None, "b", None), ("Bleu", "x", 2), ("Bleu", "y", 3)],
                               "c string, d string, n int")
    checks = [Check("m", "c", "accepted_values", values=("Vert",)), Check("m", "n", "not_null"),
              Check("m", "d", "accepted_values", values=("a", "b")), Check("m", "c", "not_null")]
    found = quality.check_model(df, checks)
    assert report(found) == {("c", "accepted_values"): (1, "fail"), ("n", "not_null"): (1, "fail"),
                             ("d", "accepted_values"): (2, "fail"), ("c", "not_null"): (1, "fail")}
    assert "Expand" not in found._jdf.queryExecution().executedPlan().toString()
    nothing = report(quality.check_model(df.limit(0), checks))
    assert set(nothing.values()) == {(0, "pass")} and len(nothing) == 4


def test_declared_checks_count():
    assert len(quality.MODEL_CHECKS) == 37
    by_layer = {}
    for c in quality.MODEL_CHECKS:
        layer = c.model.split("_")[0] if c.model.startswith(("stg", "int")) else "mart"
        by_layer[layer] = by_layer.get(layer, 0) + 1
    assert by_layer == {"stg": 7, "int": 11, "mart": 19}


def test_freshness_flags_stale(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 13))],
                               "date_heure timestamp_ntz, _loaded_at timestamp_ntz")
    r = quality.freshness(df, "t").first()
    assert r["is_stale"] is True and r["n_rows"] == 1
    r = quality.freshness(df, "t", max_age_hours=4).first()
    assert r["is_stale"] is False


def test_starter_models_as_negative_fixture(spark):
    """First starter model: literal 1 UNION ALL NULL (fails not_null); the
    second keeps id = 1 and passes both checks."""
    first = spark.sql("SELECT 1 AS id UNION ALL SELECT CAST(NULL AS INT) AS id")
    second = first.filter("id = 1")
    checks = [Check("m", "id", "unique"), Check("m", "id", "not_null")]
    assert {s for _, s in report(quality.check_model(first, checks)).values()} == {"pass", "fail"}
    assert {s for _, s in report(quality.check_model(second, checks)).values()} == {"pass"}
