import random

from pyspark.sql import functions as F

from gridmix.llm import revisits as rv

RECORDS = "record_id long, url string, ts long, kind string, headers map<string,string>, payload string"
rng = random.Random(6)


def resolved(spark, rows, span=rv.SPAN):
    table = spark.createDataFrame([(*r, "extra") for r in rows], RECORDS + ", status string")
    return {r.record_id: r for r in rv.resolve(table, span).collect()}


def test_canonical_urls(spark):
    same = ["http://www.Example.com/a/?utm_source=x&b=2&a=1#top", "https://example.com:443/a?a=1&b=2",
            "//user@EXAMPLE.com:80/a/?ref=z&b=2&a=1", " https://example.com/a?a=1&&b=2&gclid=9"]
    other = ["https://example.com/A?a=1&b=2", "https://example.com:8080/a?a=1&b=2", "https://m.example.com/a?a=1&b=2"]
    df = spark.createDataFrame([(u,) for u in [*same, *other, "nonsense", None]], "url string")
    got = [r[0] for r in df.select(rv.canonical_url(F.col("url"))).collect()]
    assert got[:4] == ["example.com/a?a=1&b=2"] * 4
    assert len(set(got[:1] + got[4:7])) == 4 and got[7:] == [None, None]


def test_validators_and_headers(spark):
    u = "http://h.example/x"
    stored = {"content-type": "text/html", "content-length": "5", "date": "d0", "etag": '"a"', "last-modified": "m0", "x": "1"}
    rows = [(1, u, 100, "response", stored, "body0"),
            (2, u, 200, "revisit", {"etag": 'W/"a"', "date": "d1", "content-length": "0", "connection": "close"}, None),
            (3, u, 200, "revisit", {"etag": '"b"', "last-modified": "m0"}, None),   # the ETag decides
            (4, u, 200, "revisit", {"last-modified": "m0", "x": "2"}, None),
            (5, u, 200, "revisit", {"last-modified": "m9"}, None),
            (6, u, 200, "revisit", None, None),
            (7, u, 100, "revisit", {"etag": '"a"'}, None),                          # not earlier
            (8, None, 300, "revisit", {"etag": '"a"'}, None), (9, u, None, "revisit", {"etag": '"a"'}, None),
            (10, "http://h.example/y", 300, "revisit", {"etag": '"a"'}, None),
            (11, u, 400, "response", {"etag": '"c"'}, "body1"), (12, u, 400, "response", None, "body2"),
            (13, u, 500, "revisit", {"etag": '"c"'}, None)]
    got = resolved(spark, rows)
    assert {i: r.status for i, r in got.items()} == {
        2: rv.RESOLVED, 3: rv.MISMATCH, 4: rv.RESOLVED, 5: rv.MISMATCH, 6: rv.NO_VALIDATOR, 7: rv.NOT_FOUND,
        8: rv.NOT_FOUND, 9: rv.NOT_FOUND, 10: rv.NOT_FOUND, 13: rv.MISMATCH}   # of two at 400 the larger id counts
    assert got[2].headers == {**stored, "etag": 'W/"a"', "date": "d1"} and got[2].payload == "body0"
    assert got[4].headers == {**stored, "x": "2"} and got[3].payload is None and got[3].source_id == 1
    assert got[13].source_id == 12


def test_spans_equal_brute_force(spark):
    rows = []
    for i in range(600):
        kind = "response" if i % 3 == 0 else "revisit"
        tag = {"etag": f'"{rng.randrange(3)}"'}
        url = f"http://h.example/{rng.choice('aaaab')}"
        rows.append((i, url, rng.randrange(2000), kind, tag, "p" if kind == "response" else None))
    want = {}
    for i, url, ts, kind, tag, _ in rows:
        if kind == "revisit":
            best = max(((t, j, h) for j, u, t, k, h, _ in rows if k == "response" and u == url and t < ts),
                       key=lambda x: x[:2], default=None)
            want[i] = (rv.NOT_FOUND, None) if best is None else (
                rv.RESOLVED if best[2] == tag else rv.MISMATCH, best[1])
    for span in (7, 100, rv.SPAN):
        got = resolved(spark, rows, span)
        assert {i: (r.status, r.source_id) for i, r in got.items()} == want


def test_repeated_rows_and_empty_table(spark):
    u = "http://h.example/x"
    rows = [(1, u, 1, "response", {"etag": "a"}, "p"), (2, u, 5, "revisit", {"etag": "a"}, None)]
    table = spark.createDataFrame(rows, RECORDS)
    twice = rv.resolve(table.union(table)).collect()
    assert [(r.record_id, r.status, r.payload) for r in twice] == [(2, rv.RESOLVED, "p")] * 2
    assert rv.resolve(table.limit(0)).count() == 0
    assert rv.resolve(table.where("kind = 'response'")).count() == 0
    pages = spark.createDataFrame([(1, None, None), (None, "http://a.example", "x")], "page_id long, url string, html string")
    assert [(r.record_id, r.status) for r in rv.report(rv.resolve(rv.crawl(pages))).collect()] == [(3, rv.NOT_FOUND)]


def test_rows_that_repeat_an_id_keep_their_own_headers(spark):
    u = "http://h.example/x"
    rows = [(1, u, 10, "response", {"etag": "a", "x": "old"}, "p10"), (1, u, 20, "response", {"etag": "b", "x": "new"}, "p20"),
            (2, u, 15, "revisit", {"etag": "a", "date": "d1"}, None), (2, u, 30, "revisit", {"etag": "b", "date": "d2"}, None),
            (2, u, 30, "revisit", {"etag": "b", "date": "d2"}, None), (2, u, 5, "revisit", {"etag": "a"}, None),
            (3, u, 40, "response", {"etag": "c"}, "first"), (3, u, 40, "response", {"etag": "c"}, "second"),
            (4, u, 50, "revisit", {"etag": "c"}, None)]
    got = rv.resolve(spark.createDataFrame(rows, RECORDS)).collect()
    assert sorted((r.record_id, r.ts, r.status, (r.headers or {}).get("date"), (r.headers or {}).get("x"), r.payload)
                  for r in got if r.record_id == 2) == [
        (2, 5, rv.NOT_FOUND, None, None, None), (2, 15, rv.RESOLVED, "d1", "old", "p10"),
        (2, 30, rv.RESOLVED, "d2", "new", "p20"), (2, 30, rv.RESOLVED, "d2", "new", "p20")]
    last = [r for r in got if r.record_id == 4]
    assert len(last) == 1 and last[0].payload in ("first", "second")


def test_unresolved_revisits_join_nothing(spark):
    u = "http://h.example/x"
    rows = [(1, u, 10, "response", {"etag": "a"}, "p")] + [(i, None, i, "revisit", {"etag": "a"}, None) for i in range(2, 300)]
    got = rv.resolve(spark.createDataFrame(rows, RECORDS))
    assert got.where("status = 'not_found' and source_id is null and headers is null and payload is null").count() == 298
