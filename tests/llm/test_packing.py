import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gridmix.llm import packing
from tests.llm.helpers import documents

random.seed(13)
TOKENIZER = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
ALPHABET = list("abcdeEHTzZ0123456789 .,;:!?'\"-_()<>|\n\t\r\x0b\x0c\x1c\x85  éÉÀßÿÑ日本語ΣσςÅİıǅ") + [
    "́", "̱", "K", "👍", "'s", "'RE", "'ll", "the", "Hello", "<|endoftext|>", "<|startoftext|>", "  ", "\r\n"]


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encoder():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return packing.WordEncoder(f.read())


def test_ids_equal_the_library(encoder):
    texts = ["".join(random.choices(ALPHABET, k=random.randint(0, 40))) for _ in range(4000)]
    texts += ["H̱ ẖ", "it's THE end.", "a<|endoftext|>b", None, "", " \n "]
    ids, ends = encoder.texts(pa.array(texts, pa.string()))
    for i, t in enumerate(texts):
        assert ids[ends[i]:ends[i + 1]].tolist() == ids_of(t), repr(t)


def test_few_texts_are_in_work_at_once(encoder):
    texts = [f"{'word ' * 1000}{i} 日本{i}" for i in range(1200)]           # 6 MB in one batch
    batch = pa.RecordBatch.from_pydict({"text": texts})
    sizes, seen = [], 0
    for part, ids, ends in encoder.batches(batch, "text"):
        sizes.append(sum(map(len, part.column("text").to_pylist())))
        assert ids[ends[0]:ends[1]].tolist() == ids_of(texts[seen])
        seen += part.num_rows
    assert seen == len(texts) and max(sizes) <= (2 << 20) + 6000


def check(rows, texts, tokens=4096, documents=None, attention=None, end=1):
    """Pieces cover every document and sequences keep every capacity; returns the number of sequences."""
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    longest = min(tokens, int((attention or tokens ** 2) ** 0.5))
    assert set(by_doc) == set(texts)
    for doc, parts in by_doc.items():
        ids = ids_of(texts[doc]) + [end]
        cut = [ids[k:k + longest] for k in range(0, len(ids), longest)]
        got = [(p.piece, p.start, p.length, p.ids_crc32) for p in sorted(parts, key=lambda p: p.piece)]
        assert got == [(k, k * longest, len(c), zlib.crc32(struct.pack(f"<{len(c)}I", *c))) for k, c in enumerate(cut)]
    for parts in by_seq.values():
        parts.sort(key=lambda p: p.offset)
        assert [p.offset for p in parts] == np.cumsum([0, *(p.length for p in parts)])[:-1].tolist()
        assert sum(p.length for p in parts) <= tokens
        assert len(parts) <= (documents or tokens)
        assert sum(p.length ** 2 for p in parts) <= (attention or tokens ** 2)
    return len(by_seq)


def texts_of(n, most):
    return {i: " ".join(random.choices(["the", "power", "of", "wind", "Strom", "élan"], k=random.randint(0, most)))
            for i in range(n)}


def test_pieces_and_sequences(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 100)      # several groups and rounds
    texts = texts_of(700, 60) | {1000: "one two " * 9000, 1001: None, 1002: ""}
    cut, places = packing.pack_documents(documents(spark, list(texts.values()), ids=list(texts)), 128)
    rows = places.collect()
    n = check(rows, texts, 128)
    assert n <= 1.02 * sum(r.length for r in rows) / 128 + 1
    made = {r.sequence_id: r for r in packing.sequences(cut, places).collect()}
    assert len(made) == n
    for r in rows:
        ids = made[r.sequence_id]["ids"][4 * r.offset:4 * (r.offset + r.length)]
        assert zlib.crc32(ids) == r.ids_crc32


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_holds(spark, rule):
    texts = texts_of(300, 80)
    docs = documents(spark, list(texts.values()), ids=list(texts))
    _, places = packing.pack_documents(docs, 100, documents=3, attention=2500, rule=rule)
    check(places.collect(), texts, 100, 3, 2500)


def plain(lengths, capacity):
    """Best fit by the least norm of what is left, one sequence after the other."""
    bins, out = [], []
    for n in lengths:
        need = (n, 1, n * n)
        best = None
        for k, left in enumerate(bins):
            after = [a - b for a, b in zip(left, need)]
            if min(after) >= 0:
                norm = sum(w * (a / c) ** 2 for w, a, c in zip(packing.WEIGHTS, after, capacity))
                if best is None or norm < best[0] - 1e-15:
                    best = (norm, k, after)
        if best is None:
            bins.append([a - b for a, b in zip(capacity, need)])
            out.append(len(bins) - 1)
        else:
            bins[best[1]] = best[2]
            out.append(best[1])
    return out


def test_best_fit_equals_plain_version():
    for capacity in ((100, 100, 10000), (100, 4, 3600), (64, 3, 64 ** 2)):
        lengths = np.sort(np.random.default_rng(3).integers(1, min(61, capacity[0]), 400))[::-1]
        assert packing.best_fit(lengths, capacity).tolist() == plain(lengths.tolist(), capacity)


def test_empty_table_repeated_and_null_ids(spark):
    empty = documents(spark, [])
    assert packing.pack_documents(empty)[1].collect() == []
    docs = documents(spark, ["a b", "a b", None], ids=[5, 5, None]).withColumn("length", F.lit("x")) \
        .withColumn("ids", F.lit(1)).withColumn("group", F.lit(2))
    rows = packing.pack_documents(docs)[1].collect()
    assert sorted((r.doc_id or -1, r.length, r.piece) for r in rows) == [(-1, 1, 0), (5, 3, 0), (5, 3, 0)]
    assert len({r.sequence_id for r in rows}) == 1 and sorted(r.offset for r in rows)[0] == 0
