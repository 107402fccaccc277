"""Registered queries against their SQL or plain versions on the smallest tables."""

import glob
import hashlib
import os
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline
from gridmix.llm import bpe, mixing, queries, quality_rules

from .helpers import linked_components
from .test_line_dedup import model as without_boilerplate
from .test_mixing import copies
from gridmix.llm import line_dedup

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents():
    return duckdb.sql(f"SELECT * FROM '{SF}/documents.parquet' ORDER BY doc_id").df()


def test_all_are_registered():
    names = set(E.queries())
    assert set(queries.queries()) <= names and "pipeline" in names
    assert {n.split("_")[0] for n in queries.queries()} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equals_its_sql(spark, name):
    db = duckdb.connect()
    for file in glob.glob(f"{SF}/*.parquet"):
        db.sql(f"CREATE VIEW {os.path.basename(file)[:-8]} AS SELECT * FROM '{file}'")
    got = queries.queries()[name](spark, SF)
    want = db.sql(queries.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    left = sorted(repr(tuple(r)) for r in got.select(*columns).collect())
    right = sorted(repr(r) for r in want.select(", ".join(columns)).fetchall())
    assert left == right and left


def test_op1(spark, documents):
    tokens = bpe.read_ranks(public_tokenizers.path(bpe.RANKS))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks={t: i for i, t in enumerate(tokens)})
    got = {r.doc_id: r for r in queries.op1_byte_bpe(spark, SF).collect()}
    for i, text in zip(documents.doc_id, documents.text):
        ids = np.array(library.encode_ordinary(text), "<u4")
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (
            len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_op4(spark, documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got, at = {r.doc_id: r for r in queries.op4_token_frames(spark, SF).collect()}, 0
    for i, text in zip(documents.doc_id, documents.text):
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [2]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (
            at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_op8(spark, documents):
    rows = list(zip(documents.doc_id.tolist(), documents.text))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op8_jaccard_join(spark, SF).collect()}
    assert [got[i] for i, _ in rows] == linked_components(rows, 4, 85)


def test_op7_recall(spark):
    table = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet' ORDER BY vec_id").fetchall()
    x = np.array([v for _, v in table], np.float64)
    hits = 0
    got = {}
    for r in queries.op7_nearest(spark, SF).collect():
        got.setdefault(r.query_id, []).append(r)
    wanted = [i for i, _ in table if i % 20 == 0]
    assert sorted(got) == wanted
    for i in wanted:
        score = x @ x[i]
        score[i] = -np.inf
        assert sorted(r["rank"] for r in got[i]) == list(range(1, 21))
        hits += len({r.vec_id for r in got[i]} & set(np.argsort(-score, kind="stable")[:20].tolist()))
    assert hits >= 0.9 * 20 * len(wanted)


def test_pipeline_stage_by_stage(spark, documents):
    """Each stage's decisions follow its own input; the last one's ids are the library's."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.written(stage(spark, seen[-1], SF), f"test-{name}")
        if name != "byte_bpe":
            assert out.columns == corpus_pipeline.COLUMNS
        seen.append(out)
    rows = [[r.asDict() for r in df.collect()] for df in seen]
    # quality rules: the verdicts of the operator
    kept = {r.doc_id for r in quality_rules.verdicts(docs).collect() if r.kept}
    assert {r["doc_id"] for r in rows[1]} == kept < set(documents.doc_id)
    # line dedup
    want = without_boilerplate([(r["source"], r["text"]) for r in rows[1]], line_dedup.MAX_RATIO, line_dedup.MIN_PAGES)
    assert sorted((r["source"], r["text"]) for r in rows[2]) == sorted(w[:2] for w in want)
    assert all(r["n_chars"] == len(r["text"]) for r in rows[2])
    # one document of each group
    pairs = [(r["doc_id"], r["text"]) for r in rows[2]]
    least = {i for (i, _), (n, c) in zip(pairs, linked_components(pairs, 5, 80)) if c == i or not n}
    assert {r["doc_id"] for r in rows[3]} == least and len(rows[3]) == len(least)
    # Poisson copies
    sizes = {}
    for r in rows[3]:
        sizes[r["source"]] = sizes.get(r["source"], 0) + 1
    roots = sum(n ** mixing.TEMPERATURE for n in sizes.values())
    rate = {s: n ** mixing.TEMPERATURE / roots * len(rows[3]) / n for s, n in sizes.items()}
    expected = sorted(r["doc_id"] for r in rows[3] for _ in range(copies(r["doc_id"], rate[r["source"]])))
    assert sorted(r["doc_id"] for r in rows[4]) == expected
    # token ids
    tokens = bpe.read_ranks(public_tokenizers.path(bpe.RANKS))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks={t: i for i, t in enumerate(tokens)})
    texts = {r["doc_id"]: r["text"] for r in rows[4]}
    assert len(rows[5]) == len(rows[4])
    for r in rows[5]:
        assert np.frombuffer(r["tokens"], "<u4").tolist() == library.encode_ordinary(texts[r["doc_id"]])


def test_pipeline_on_awkward_documents(spark):
    rows = [(i, t, "en", s, 0) for i, (t, s) in enumerate(
        [(None, "a"), ("", "a"), ("x " * 60, None), (" \n\t", None)] * 3)] + [(None, "y", "en", "a", 0)] * 2
    long = " ".join(f"word{i}" for i in range(60))
    rows += [(50, long, None, "a", 0)] * 2 + [(51, long, "en", None, 0), (None, long, "en", "b", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long") \
        .selectExpr("*", "'old' AS copy", "1 AS n_words", "'x' AS ids")
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            frame = corpus_pipeline.written(stage(spark, frame, SF), f"awkward-{name}")
            frame.collect()


def test_op12(spark):
    from .test_conversations import plain, plain_damage
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    got = {r[0]: tuple(r[1:]) for r in queries.op12_conversation_repair(spark, SF).collect()}
    assert got == plain(rows, plain_damage(rows))


def test_op13(spark, documents):
    from .test_packing import check
    texts = dict(zip(documents.doc_id.tolist(), documents.text))
    rows = queries.op13_best_fit(spark, SF).collect()
    n = check(rows, texts)
    assert n <= sum(r.length for r in rows) // 4096 + 2
