import numpy as np
import pytest
from pyspark.sql import functions as F

from gridmix.llm import ann

rng = np.random.default_rng(4)
SCHEMA = "vec_id long, embedding array<float>, label string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA)


def exact(rows, queries, k):
    """{query row: [(id, score)]} by comparing all pairs; only usable vectors."""
    rows = [(i, np.array(v, np.float32).astype(np.float64)) for i, v in rows
            if i is not None and v and not any(x is None or not np.isfinite(x) for x in v) and any(v)]
    out = []
    for i, q in rows:
        if queries(i):
            near = sorted(((-float((q * v).sum()), j) for j, v in rows if j != i))[:k]
            out.append((i, [(j, -s) for s, j in near]))
    return out


def compare(got, want, k):
    """Mean recall; scores must be exact."""
    by = {}
    for r in got.collect():
        by.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = total = 0
    for i, near in want:
        mine = sorted(by.get(i, []))
        assert [r for r, _, _ in mine] == list(range(1, len(near) + 1)), (i, mine, near)
        hits += len({j for _, j, _ in mine} & {j for j, _ in near})
        total += len(near)
    return hits / max(1, total)


def test_recall_on_lists(spark, monkeypatch):
    monkeypatch.setattr(ann, "LIST_SIZE", 64)
    centres = rng.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + 0.6 * rng.normal(size=16)).tolist()) for i in range(1500)]
    got = ann.search(frame(spark, rows), "vec_id % 20 = 0", k=10)
    assert compare(got, exact(rows, lambda i: i % 20 == 0, 10), 10) >= 0.9


def test_copies_ties_and_unusable_vectors(spark):
    rows = [(i, [1.0, 2.0, 0.5]) for i in range(0, 200)]           # one class of 200
    rows += [(300 + i, [2.0, 1.0, float(i)]) for i in range(30)] + [(400 + i, [-1.0, 0.0, 0.25 * i]) for i in range(30)]
    rows += [(600, None), (620, []), (640, [0.0, 0.0, 0.0]), (660, [1.0, None, 2.0]), (680, [float("nan"), 1.0, 1.0]),
             (700, [float("inf"), 1.0, 1.0]), (720, [1.0, 1.0]), (None, [9.0, 9.0, 9.0])]
    got = ann.search(frame(spark, rows), "vec_id % 20 = 0", k=20)
    by = {}
    for r in got.collect():
        by.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    usable = [(i, v) for i, v in rows if i != 720]
    for i, near in exact(usable, lambda i: i is not None and i % 20 == 0, 20):
        mine = sorted(by.pop(i))
        assert [j for _, j, _ in mine] == [j for j, _ in near]
        assert np.allclose([s for _, _, s in mine], [s for _, s in near], rtol=1e-15)
    assert not by


def test_few_candidates_and_empty_table(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (20, [0.0, 1.0])]
    got = ann.search(frame(spark, rows), "vec_id % 20 = 0", k=20)
    assert [(r.query_id, r["rank"], r.vec_id) for r in got.orderBy("query_id", "rank").collect()] == [
        (0, 1, 1), (0, 2, 20), (20, 1, 1), (20, 2, 0)]
    assert ann.search(frame(spark, []), "vec_id % 20 = 0").count() == 0
    assert ann.search(frame(spark, [(0, [1.0])]), F.col("vec_id") == 0).count() == 0


def test_cells_are_balanced_and_graph_finds_the_nearest():
    points = rng.normal(size=(3000, 8))
    centroids = ann.balanced_centroids(points, 50)
    assert 60 <= len(centroids) <= 128
    graph = ann.CentroidGraph(centroids)
    found = 0
    for q in rng.normal(size=(200, 8)):
        c, d = graph.within(q, 0.2)
        true = np.linalg.norm(centroids - q, axis=1)
        assert np.allclose(d, true[c]) and np.all(np.diff(d) >= 0)
        found += c[0] == true.argmin()
    assert found >= 196


def test_blocks_split_any_list(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 7)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(90)]
    got = ann.search(frame(spark, rows), "vec_id % 3 = 0", k=5)
    assert compare(got, exact(rows, lambda i: i % 3 == 0, 5), 5) == pytest.approx(1.0)


@pytest.mark.parametrize("centres, noise", [(1, 1.0), (40, 0.25), (40, 0.6)])
def test_recall_at_hundreds_of_lists(spark, monkeypatch, centres, noise):
    """Also of vectors without structure, where a fixed ratio of 0.10 finds half."""
    monkeypatch.setattr(ann, "LIST_SIZE", 16)
    some = np.random.default_rng(5)
    middle = some.normal(size=(centres, 64)) if centres > 1 else np.zeros((1, 64))
    x = middle[np.arange(4000) % centres] + noise * some.normal(size=(4000, 64))
    x = (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32).astype(np.float64)
    seen, real = [], ann.calibrated
    monkeypatch.setattr(ann, "calibrated", lambda *a: seen.append(real(*a)) or seen[0])
    got = {}
    for r in ann.search(frame(spark, [(i, v.tolist()) for i, v in enumerate(x)]), "vec_id % 20 = 0", k=20).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for i in range(0, 4000, 20):
        score = x @ x[i]
        score[i] = -np.inf
        hits += len(got[i] & set(np.argsort(-score, kind="stable")[:20].tolist()))
    assert hits >= 0.9 * 20 * 200
    if noise == 0.25:  # clustered: few lists are read
        assert seen[0][2] < 1000


@pytest.mark.parametrize("size, most, whole", [(500, 0.9, 0.3), (6000, 0.75, 0.0)])
def test_results_come_from_lists_at_every_size(spark, monkeypatch, size, most, whole):
    """Of vectors without structure too; replicas count once. ``whole``: share of queries that may open all lists."""
    some = np.random.default_rng(11)
    x = some.normal(size=(size, 64))
    x = (x / np.linalg.norm(x, axis=1)[:, None]).astype(np.float32).astype(np.float64)
    monkeypatch.setattr(ann, "BLOCK", 512)  # several parts
    calls, real = [], ann._in_blocks
    monkeypatch.setattr(ann, "_in_blocks", lambda *a: calls.append(a) or real(*a))
    got = ann.search(frame(spark, [(i, v.tolist()) for i, v in enumerate(x)]), "vec_id % 20 = 0", k=20).collect()
    # the probes of the ratio, the nearest lists' parts, the other parts; no query came out short
    assert len(calls) == 3
    queries = calls[1][0].select("qid", "part", "lists").unionByName(calls[2][0].select("qid", "part", "lists"))
    lists = calls[1][1]
    each = [side.select(key, "part", F.explode("lists").alias("list")) for side, key in ((queries, "qid"), (lists, "cid"))]
    read = [r.n for r in each[0].join(each[1], ["part", "list"]).groupBy("qid")
            .agg(F.countDistinct("cid").alias("n")).collect()]
    assert len(read) == size // 20 and np.mean(read) < most * size
    assert sum(n == size for n in read) <= whole * len(read)
    hits = 0
    for i in range(0, size, 20):
        score = x @ x[i]
        score[i] = -np.inf
        hits += len({r.vec_id for r in got if r.query_id == i} & set(np.argsort(-score, kind="stable")[:20].tolist()))
    assert hits >= 0.9 * 20 * len(read)


def test_queries_that_search_together_find_the_same():
    points = rng.normal(size=(2000, 8))
    graph = ann.CentroidGraph(ann.balanced_centroids(points, 20))
    queries = rng.normal(size=(150, 8))
    for q, (c, d) in zip(queries, graph.search(queries, 0.3)):
        alone, far = graph.within(q, 0.3)
        assert c.tolist() == alone.tolist() and np.allclose(d, far)
    lone = ann.CentroidGraph(points[:1])
    assert [c.tolist() for c, _ in lone.search(queries[:3], 0.1)] == [[0]] * 3


def test_parts_of_neighbouring_lists(monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 4096)
    assert ann.parts_of(np.array([4000, 96, 1, 9000, 0, 5])).tolist() == [0, 0, 1, 1, 3, 3]
    vectors = np.array([np.array([1.0]), None], object)
    rows = list(ann._by_part(np.array([7, 8]), vectors, [np.array([3, 0]), np.array([1])],
                             np.array([0, 0, 1, 1]), ("qid", "vector")))
    assert [(r.qid, r.part, r.home, r.lists.tolist()) for r in rows[0].itertuples()] == [
        (7, 0, False, [0]), (7, 1, True, [3]), (8, 0, True, [1])]
