"""Property test: the upsert equals a brute-force MERGE model."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from gridmix.operators.upsert import NATIONAL_FEED, upsert

D = dt.datetime
T0, T1 = D(2026, 1, 1), D(2026, 3, 1)
KEYS = [None] + [D(2024, 1, 1, h) for h in range(4)]
VALS = st.sampled_from([None, 1.0, 2.0])
TSCHEMA = ("date_heure timestamp_ntz, consommation double, taux_co2 double, nucleaire double, "
           "hydraulique double, _loaded_at timestamp_ntz, _source string, _row_key long")
BSCHEMA = ("date_heure timestamp_ntz, consommation double, taux_co2 double, nucleaire double, "
           "hydraulique double, _row_key long")

row = st.tuples(st.sampled_from(KEYS), VALS, VALS, VALS, VALS)


def brute_force(target, batch):
    """MERGE with last-arrival dedup of the batch, null-blind change test."""
    last = {}
    nullkey = []
    for r in batch:                       # batch rows carry increasing _row_key
        if r[0] is None:
            nullkey.append(r)
        else:
            last[r[0]] = r
    out, matched = [], set()
    for t in target:
        s = last.get(t[0]) if t[0] is not None else None
        if s is None:
            out.append(t)
            continue
        matched.add(t[0])
        changed = any(a is not None and b is not None and a != b
                      for a, b in [(t[2], s[2]), (t[1], s[1])])    # taux_co2, consommation
        if changed:   # update consommation, taux_co2, nucleaire (listed), keep hydraulique
            out.append((t[0], s[1], s[2], s[3], t[4], T1, t[6], t[7]))
        else:
            out.append(t)
    for k, s in last.items():
        if k not in matched:
            out.append(s[:5] + (T1, "eco2mix-national-tr", s[5]))
    for s in nullkey:
        out.append(s[:5] + (T1, "eco2mix-national-tr", s[5]))
    return sorted(out, key=repr)


@settings(max_examples=12, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, max_size=6), st.lists(row, max_size=6))
def test_upsert_matches_brute_force(spark, target_rows, batch_rows):
    target = [r + (T0, "tr", i) for i, r in enumerate(target_rows)]
    batch = [r + (100 + i,) for i, r in enumerate(batch_rows)]
    want = brute_force(target, batch)
    t = spark.createDataFrame(target, TSCHEMA)
    b = spark.createDataFrame(batch, BSCHEMA)
    got = sorted((tuple(r) for r in upsert(t, b, NATIONAL_FEED, T1).collect()), key=repr)
    assert got == want
