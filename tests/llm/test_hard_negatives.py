import math

import numpy as np
import pytest

from gridmix.llm import hard_negatives as hn

rng = np.random.default_rng(11)
SCHEMA = "vec_id long, label int, embedding array<double>, block int, score string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)


def brute(rows, anchor, n_positives=5, n_negatives=10):
    usable = [(i, l, [math.floor(256 * c) for c in v]) for i, l, v in rows
              if i is not None and l is not None and v is not None
              and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for a, label, x in usable:
        if not anchor(a):
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y)), i, l) for i, l, y in usable if i != a)
        for s, i, l in [t for t in scored if t[2] == label][:n_positives]:
            fit = [(n, -t) for t, n, m in scored if m != label and 30 * -s <= 100 * -t <= 90 * -s]
            out += [(a, i, r, n, -s, t) for r, (n, t) in enumerate(fit[:n_negatives], 1)]
    return sorted(out)


def mined(spark, rows, anchor="vec_id % 10 = 0"):
    return sorted(tuple(r) for r in hn.mine(frame(spark, rows), anchor).collect())


@pytest.mark.parametrize("top", [1, 5, 300, 70_000])
def test_pack_round_trip_and_scores(top):
    values = rng.integers(-top, top + 1, (37, 24))
    planes = hn.pack(values, top.bit_length() + 1)
    assert np.array_equal(hn.unpack(planes), values)
    anchors = rng.integers(-top, top + 1, (5, 24))
    tables = hn.subset_sums(anchors, np.int64)
    found = hn.scores(tables, np.ascontiguousarray(planes.transpose(1, 2, 0)))
    assert np.array_equal(found, values @ anchors.T)


def test_equals_brute_force(spark, monkeypatch):
    for name, value in (("ANCHORS", 8), ("CANDIDATES", 90), ("AT_ONCE", 3), ("CHUNK", 32)):
        monkeypatch.setattr(hn, name, value)
    centres = rng.normal(size=(4, 11))
    rows = [(i, int(rng.integers(0, 4)) if i % 3 else 2, (centres[i % 4] + 0.5 * rng.normal(size=11)).tolist())
            for i in range(400)]
    got = mined(spark, rows)
    assert got == brute(rows, lambda i: i % 10 == 0)
    assert len(got) > 500


def test_copies_ties_and_unusable_rows(spark, monkeypatch):
    monkeypatch.setattr(hn, "CANDIDATES", 64)
    rows = [(i, i % 2, [0.5, 0.25, 0.125]) for i in range(120)]               # copies: all ties
    rows += [(200 + i, 3, [0.3, 0.2, -0.01 * i]) for i in range(60)]
    rows += [(310, None, [1.0, 1.0, 1.0]), (320, 1, None), (330, 1, [None, 1.0, 1.0]), (340, 1, [float("nan")] * 3),
             (350, 0, [float("-inf"), 0.0, 0.0]), (None, 1, [1.0, 1.0, 1.0]), (360, 1, []), (370, 1, [0.4, 0.4]),
             (380, 7, [0.1, 0.1, 0.1]), (390, 8, [-1.0, -1.0, -1.0]), (391, 8, [0.9, 0.9, 0.9])]
    assert mined(spark, rows) == brute(rows, lambda i: i % 10 == 0)


def test_repeated_rows_count_each(spark):
    rows = [(10, 1, [0.5, 0.5]), (10, 1, [0.5, 0.5])] + [(11, 1, [0.4, 0.5])] * 2 + [(12, 2, [0.3, 0.3])] * 3
    got = mined(spark, rows)
    assert [r[:4] for r in got] == [(10, 11, 1, 12)] * 2 + [(10, 11, 2, 12)] * 2 + [(10, 11, 3, 12)] * 2


def test_empty_table_and_no_anchor(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, 1, [0.5]), (2, 1, [0.5]), (3, 2, [0.4])]) == []
    assert hn.mine(frame(spark, []), "vec_id % 10 = 0").columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_large_components_and_overflow(spark):
    rows = [(i, i % 2, [float(v) for v in rng.integers(-900, 900, 5)]) for i in range(50)]
    assert mined(spark, rows) == brute(rows, lambda i: i % 10 == 0)
    with pytest.raises(ValueError):
        mined(spark, [(10, 1, [1e30]), (11, 1, [1.0])])
