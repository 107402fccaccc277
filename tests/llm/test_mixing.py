import hashlib
import math
from collections import Counter

import pytest

from gridmix.llm import mixing
from .helpers import documents


def copies(doc_id, rate, seed=mixing.SEED):
    text = f"{'' if doc_id is None else doc_id}:{seed}"
    u = int(hashlib.md5(text.encode()).hexdigest()[:13], 16) / 2 ** 52
    n, p, total = 0, math.exp(-rate), math.exp(-rate)
    while total <= u:
        n += 1
        p *= rate / n
        total += p
    return n


def test_counts_equal_the_inverted_distribution(spark):
    docs = documents(spark, ["t"] * 300, source="a").union(documents(spark, ["u"] * 100, source="b", ids=range(300, 400)))
    targets = {"a": 1.0, "b": 3.0, "absent": 5.0}
    rate = {"a": 0.25 * 400 / 300, "b": 0.75 * 400 / 100}
    got = Counter(r.doc_id for r in mixing.mix(docs, targets=targets).collect())
    want = {i: n for i in range(400) if (n := copies(i, rate["a" if i < 300 else "b"]))}
    assert got == want
    assert sum(want.values()) == pytest.approx(400, rel=0.15)


def test_every_rate_has_its_distribution(spark):
    docs = documents(spark, ["t"] * 2000)
    for total in (100, 2000, 90_000):
        rate = total / 2000
        got = Counter(r.doc_id for r in mixing.mix(docs, total=total).select("doc_id").collect())
        assert all(got.get(i, 0) == copies(i, rate) for i in range(0, 2000, 7))
        assert sum(got.values()) == pytest.approx(total, abs=5 * math.sqrt(total))


def test_rate_beyond_the_range_of_exp(spark):
    docs = documents(spark, ["t"] * 3)
    got = Counter(r.doc_id for r in mixing.mix(docs, total=6000).collect())
    assert all(abs(got[i] - 2000) < 6 * math.sqrt(2000) for i in range(3))


def test_global_order_and_defaults(spark):
    docs = documents(spark, ["a\nb"] * 64, source="x").union(documents(spark, ["c"] * 4, source=None, ids=range(64, 68)))
    rows = mixing.mix(docs).collect()
    keys = [r.shuffle_key for r in rows]
    assert keys == sorted(keys) and [r.doc_id for r in rows] != sorted(r.doc_id for r in rows)
    # shares follow the square roots: 8 to 2
    rate = {"x": 0.8 * 68 / 64, None: 0.2 * 68 / 4}
    assert Counter(r.doc_id for r in rows) == {
        i: n for i in range(68) if (n := copies(i, rate["x" if i < 64 else None]))}
    assert all(r.copy >= 1 for r in rows)


def test_edges(spark):
    docs = documents(spark, [None, "", "x", "x"], ids=[None, None, 3, 3]).selectExpr("*", "'old' as copy", "1 as n")
    got = mixing.mix(docs, total=400)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "n", "copy", "shuffle_key"]
    counted = Counter((r.doc_id, r.text) for r in got.collect())
    assert counted == {(None, None): copies(None, 100), (None, ""): copies(None, 100), (3, "x"): 2 * copies(3, 100)}
    assert mixing.mix(docs, targets={}).count() == 0
    assert mixing.mix(docs, targets={"other": 1.0}).count() == 0
    assert mixing.mix(docs.limit(0)).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_columns_named_like_its_own_are_kept(spark):
    names = ["__source", "__RATE", "__cdf", "__u", "__n", "a.b"]
    docs = spark.createDataFrame([(i, "s", *names) for i in range(40)],
                                 "doc_id long, source string, " + ", ".join(f"`{c}` string" for c in names))
    got, plain = mixing.mix(docs).collect(), mixing.mix(docs.select("doc_id", "source")).collect()
    assert [(r.doc_id, r["copy"]) for r in got] == [(r.doc_id, r["copy"]) for r in plain] and got
    assert all([r[c] for c in names] == names for r in got)
