import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridmix.llm import jaccard_join as jj
from gridmix.llm.components import components

from .helpers import documents, linked_components

rng = random.Random(5)
VOCABULARY = [f"w{i}" for i in range(300)]


def base(n):
    return [rng.choice(VOCABULARY) for _ in range(n)]


def edited(words, edits):
    words = list(words)
    for _ in range(edits):
        k = rng.randrange(len(words))
        words[k:k + 1] = rng.choice([[], [rng.choice(VOCABULARY)], [words[k], "extra"]])
    return words


def corpus():
    texts = []
    passage = base(60)
    for _ in range(12):
        one = base(rng.randrange(5, 120))
        texts += [" ".join(edited(one, rng.randrange(4))) for _ in range(rng.randrange(1, 9))]
    chain = base(100)
    for _ in range(12):  # neighbours link, the ends do not
        texts.append(" ".join(chain))
        chain = edited(chain, 2)
    texts += [" ".join(base(rng.randrange(1, 60)) + passage) for _ in range(25)]
    texts += [None, "", " \n\t", "a", "A", "b", "a b c", "A  b\nc", "É x y z", "é x y z"] * 2
    texts += [texts[0]] * 15 + [texts[0].upper()]
    return texts


@pytest.mark.parametrize("n, percent", [(4, 85), (5, 80), (1, 60)])
def test_equals_brute_force(spark, n, percent):
    texts = corpus()
    order = rng.sample(range(len(texts)), len(texts))
    rows = [(i, texts[k]) for i, k in enumerate(order)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in
           jj.join(documents(spark, [t for _, t in rows]), n, percent).collect()}
    assert [got[i] for i, _ in rows] == linked_components(rows, n, percent)


def test_prefixes_of_linked_sets_share_enough():
    nprng = np.random.default_rng(2)
    loads = nprng.integers(0, 50, jj.LOAD_BUCKETS).astype(np.float32)
    linked = 0
    for _ in range(400):
        common = nprng.integers(0, 2 ** 63, nprng.integers(1, 80), dtype=np.uint64)
        a, b = (np.unique(np.concatenate([common, nprng.integers(0, 2 ** 63, nprng.integers(0, 9), dtype=np.uint64)]))
                for _ in range(2))
        both = len(np.intersect1d(a, b))
        if 100 * both < 80 * (len(a) + len(b) - both):
            continue
        linked += 1
        (la, pa_), (lb, pb) = (jj.prefix(s, loads, 10.0, 80) for s in (a, b))
        l = min(la, lb)
        cut = [p[:len(s) - jj.least_overlap(len(s), 80) + l] for s, p in ((a, pa_), (b, pb))]
        assert len(np.intersect1d(*cut)) >= l
    assert linked > 100


def test_representatives(spark):
    near = " ".join(base(80))
    texts = [near, near + " tail", "other " + " ".join(base(50)), None, "", near]
    docs = documents(spark, texts, ids=[7, 3, 4, 5, 6, 9])
    assert sorted(r.doc_id for r in jj.representatives(docs).collect()) == [3, 4, 5, 6]
    repeated = documents(spark, [near, near, "x y z"], ids=[1, 1, 2])
    assert sorted(r.doc_id for r in jj.representatives(repeated).collect()) == [1, 2]


def test_representatives_of_repeated_ids_with_other_texts(spark):
    """Each component keeps a row, also where the rows of one id are in two of them."""
    a, b = (" ".join(base(80)) for _ in range(2))
    texts = [(5, a), (6, a + " tail"), (5, b), (2, b + " tail"), (5, None), (9, a)]
    docs = documents(spark, [t for _, t in texts], ids=[i for i, _ in texts]).withColumn("own", F.lit(1)) \
        .withColumn("root", F.lit("x"))
    got = sorted((r.doc_id, r.text or "") for r in jj.representatives(docs).collect())
    assert got == sorted([(5, a), (2, b + " tail"), (5, "")])
    texts = [(5, a), (5, b), (5, a + " tail"), (7, b)]
    got = sorted(r.text for r in jj.representatives(
        documents(spark, [t for _, t in texts], ids=[i for i, _ in texts])).collect())
    assert got == sorted([a, b])          # two components share their smallest id


def test_null_ids_and_empty_table(spark):
    near = " ".join(base(80))
    docs = documents(spark, [near, near + " tail", None], ids=[None, 4, None])
    got = {(r.doc_id, r.n_shingles): r.component_id for r in jj.join(docs).collect()}
    assert got == {(None, 76): 4, (4, 77): 4, (None, 0): None}
    assert jj.join(docs.limit(0)).count() == 0


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (8, 7), (5, 5), (3, 1), (20, 21), (21, 20)] + [(100 + i, 101 + i) for i in range(40)]
    got = {(r.node, r.root) for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (7, 7), (8, 7), (9, 7), (20, 20), (21, 20)} | {(100 + i, 100) for i in range(41)}
