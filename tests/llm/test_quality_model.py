import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gridmix.llm import quality_model as qm
from gridmix.llm import queries

from .helpers import WORD, documents

rng = random.Random(8)
WORDS = ["".join(rng.choices("abcdefghijk", k=rng.randrange(2, 9))) for _ in range(400)]


def good():
    return " ".join(rng.choices(WORDS, k=rng.randrange(30, 300)))


def bad():
    words = good().split()
    for _ in range(3):
        words.insert(rng.randrange(len(words)), rng.choice(["rotten", "awful", "vile"]))
    return " ".join(words)


def worst():
    return " ".join(w.upper() + "!!" for w in good().split())


def test_held_out_accuracy(spark):
    texts, grades = [], []
    for i in range(1200):
        grade = (0, 1, 2, 2)[i % 4]
        texts.append((worst, bad, good)[grade]())
        grades.append(grade)
    docs = documents(spark, texts)
    ratings = spark.createDataFrame([(i, g) for i, g in enumerate(grades)], "doc_id long, grade int")
    model = qm.fit(docs, ratings.where("doc_id < 800"), grades=3)
    got = {r.doc_id: r for r in qm.score(docs, model).collect()}
    held = range(800, 1200)
    assert np.mean([got[i].kept == (grades[i] == 2) for i in held]) > 0.9
    assert np.mean([abs(got[i].expected_grade - grades[i]) for i in held]) < 0.2
    assert all(0 <= got[i].tail_prob <= 1 for i in range(1200))
    # the sample is bounded, and chosen by hash
    assert qm._sample_features(docs, ratings, 100).count() == 100


def test_gradient():
    nprng = np.random.default_rng(0)
    row, number = np.repeat(np.arange(6), 3), nprng.integers(0, 5, 18)
    grade = np.array([0, 1, 2, 2, 1, 0])
    w, t = nprng.normal(size=5), np.array([-0.5, 0.7])
    value, g, b = qm.loss_and_gradient(w, t, row, number, grade)
    for x, gradient in ((w, g), (t, b)):
        for k in range(len(x)):
            x[k] += 1e-6
            up = qm.loss_and_gradient(w, t, row, number, grade)[0]
            x[k] -= 1e-6
            assert abs((up - value) / 1e-6 - gradient[k]) < 1e-3


def test_minimise():
    a = np.diag([1.0, 10.0, 100.0])
    x = qm.minimise(lambda x: (float(x @ a @ x / 2 - x.sum()), a @ x - 1), np.zeros(3), 60)
    assert np.allclose(x, [1, 0.1, 0.01], atol=1e-2)


def test_features_are_the_same_in_any_batch():
    texts = ["one two two, ONE", None, "", "é 漢字 x1 !!"]
    row, number, counts = qm.features(pa.array(texts, pa.string()))
    assert counts.tolist() == [4, 0, 0, 4]
    for i, text in enumerate(texts):
        alone = qm.features(pa.array([text], pa.string()))[1]
        assert sorted(number[row == i].tolist()) == sorted(alone.tolist())


def test_edges(spark):
    docs = documents(spark, [None, "", " \n", "x"] * 2, ids=[1, 2, 3, 4, 1, 2, None, 4]).withColumn("kept", F.lit("old"))
    none = spark.createDataFrame([], "doc_id long, grade int")
    assert qm.fit(docs, none, grades=3) is None
    free = qm.score(docs, None)
    assert free.count() == 8 and free.where("kept and tail_prob is null").count() == 8
    ratings = spark.createDataFrame([(4, 2), (4, 0), (1, 1), (None, 1), (2, None)], "doc_id long, grade int")
    model = qm.fit(docs, ratings, grades=3)
    got = qm.score(docs, model).collect()
    assert len(got) == 8
    assert all((r.expected_grade, r.tail_prob, r.kept) == (0, 0, False) for r in got if r.doc_id != 4)
    assert qm.score(docs.limit(0), model).count() == 0


def plain_features(text):
    words = WORD.findall(text or "")
    slots = {s for w in words for s in qm.word_slots(w)}
    return slots | {qm._slot(str(20 * len(set(words)) // len(words)), qm.SHARE)} if words else set()


def plain_probabilities(score, thresholds):
    below = [0.0, *(1 / (1 + np.exp(score - t)) for t in thresholds), 1.0]
    return [b - a for a, b in zip(below, below[1:])]


def plain_scores(texts, weight, thresholds):
    """(expected grade, probability of the top grade, kept) of each text."""
    out = []
    for text in texts:
        found = plain_features(text)
        p = plain_probabilities(sum(weight.get(s, 0.0) for s in found), thresholds)
        out.append((sum(g * q for g, q in enumerate(p)), p[-1], bool(p[-1] >= qm.KEEP)) if found else (0, 0, False))
    return out


def plain_fit(texts, grades, n_grades):
    """(weight of each slot, thresholds): accelerated gradient steps on a dense matrix, until they stand still."""
    sets = [plain_features(t) for t in texts]
    counts = {}
    for s in sets:
        for slot in s:
            counts[slot] = counts.get(slot, 0) + 1
    active = sorted(s for s, c in counts.items() if c >= qm.MIN_SLOT_DOCS)
    x = np.array([[slot in s for slot in active] for s in sets], float)
    grades = np.array(grades)
    n, m = x.shape

    def loss(p):
        score, t = x @ p[:m], p[m:]
        edges = np.concatenate([[-60.0], t, [60.0]])
        high = 1 / (1 + np.exp(np.clip(score - edges[grades + 1], -500, 500)))
        low = 1 / (1 + np.exp(np.clip(score - edges[grades], -500, 500)))
        like = np.maximum(high - low, 1e-300)
        gradient = np.concatenate([x.T @ (1 - high - low) / n + qm.PENALTY * p[:m], np.zeros(len(t))])
        for k in range(len(t)):
            gradient[m + k] = (np.sum((low * (1 - low) / like)[grades == k + 1])
                               - np.sum((high * (1 - high) / like)[grades == k])) / n
        return -np.log(like).mean() + qm.PENALTY / 2 * p[:m] @ p[:m], gradient

    shares = np.cumsum([np.sum(grades == g) + 0.5 for g in range(n_grades)][:-1]) / (n + 0.5 * n_grades)
    p = np.concatenate([np.zeros(m), np.log(shares / (1 - shares))])
    rate = 4 / (np.linalg.norm(x, 2) ** 2 / n + 4)
    ahead, k = p, 1.0
    for _ in range(1500):
        new = ahead - rate * loss(ahead)[1]
        after = (1 + np.sqrt(1 + 4 * k * k)) / 2
        if (ahead - new) @ (new - p) > 0:  # momentum that leads astray is dropped
            after = 1.0
        ahead = new + (k - 1) / after * (new - p)
        p, k = new, after
    return dict(zip(active, p[:m])), p[m:], lambda weights, thresholds: loss(
        np.concatenate([[weights[s] for s in active], thresholds]))[0]


def check_scores(got, texts, model):
    """Scores (by doc_id) of texts (by doc_id) are those that plain scoring gives with the model."""
    weights = dict(zip(model.active.tolist(), model.weights))
    for i, want in zip(texts, plain_scores(texts.values(), weights, model.thresholds)):
        assert np.allclose((got[i].expected_grade, got[i].tail_prob), want[:2], atol=1e-9)
        assert got[i].kept == want[2]


def test_equals_a_plain_fit(spark):
    grades = [(0, 1, 2, 2)[i % 4] for i in range(400)]
    texts = dict(enumerate([(worst, bad, good)[g]() for g in grades] + [None, "", "Zz zz!"]))
    docs = documents(spark, list(texts.values()))
    ratings = spark.createDataFrame(list(enumerate(grades[:300])), "doc_id long, grade int")
    plain, thresholds, loss = plain_fit([texts[i] for i in range(300)], grades[:300], 3)
    best = loss(plain, thresholds)
    model = qm.fit(docs, ratings, grades=3, steps=150)
    check_scores({r.doc_id: r for r in qm.score(docs, model).collect()}, texts, model)
    assert sorted(plain) == model.active.tolist()
    assert abs(loss(dict(zip(model.active.tolist(), model.weights)), model.thresholds) - best) < 0.02 * best + 1e-3


def test_query_equals_a_plain_fit(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    graded = qm.grades_of_labels(spark.read.parquet(f"{sf}/labels.parquet")).where("grade is not null")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    got = {r.doc_id: r for r in queries.op3_quality_model(spark, sf).collect()}
    check_scores(got, texts, qm.fit(docs, graded, grades=3))
    ratings = {r.doc_id: r.grade for r in graded.groupBy("doc_id").agg(F.min("grade").alias("grade")).collect()
               if r.doc_id in texts}
    plain, thresholds, _ = plain_fit([texts[i] for i in ratings], list(ratings.values()), 3)
    want = plain_scores(texts.values(), plain, thresholds)
    apart = [abs(got[i].expected_grade - w[0]) for i, w in zip(texts, want)]
    print("mean difference of grades", np.mean(apart), "same verdict", np.mean([got[i].kept == w[2] for i, w in zip(texts, want)]))
    # the steps of the query stop short of the least loss
    assert np.mean(apart) < 0.05
    assert np.mean([got[i].kept == w[2] for i, w in zip(texts, want)]) > 0.97


def test_very_long_text_is_scored_whole(spark):
    model = qm.Model(np.array([qm.word_slots("end")[0]]), np.array([9.0]), np.array([2.0, 4.0]))
    long = "word " * 400_000
    got = {r.doc_id: r for r in qm.score(documents(spark, [long, long + "end"]), model).collect()}
    assert not got[0].kept and got[1].kept
