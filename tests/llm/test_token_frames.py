import io
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import zstandard
from tokenizers import Tokenizer

from gridmix.llm import token_frames as tf
from gridmix.llm.units import UnitEncoder

TEXTS = ["one two", None, "", "  odd \t white", "<|endoftext|> x", "one<|endoftext|><|endoftext|>two", "a\n\nb", "it's, done.\nNew line", "long word " * 20000]


def shard(docs):
    out = io.BytesIO()
    writer = tf.ShardWriter(out)
    for doc_id, ids in docs:
        writer.add(doc_id, ids)
    writer.close()
    return out.getvalue()


def test_shard_is_plain_zstandard():
    docs = [(1, b"abcd" * 10), (None, b"efgh" * 200_000), (3, b"ijkl")]
    data = shard(docs)
    got = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert got == b"".join(ids for _, ids in docs)


def test_only_needed_frames_are_read():
    rng = np.random.default_rng(1)
    docs = [(i, rng.bytes(4 * 30_000)) for i in range(40)]
    reader = tf.ShardReader(pa.BufferReader(shard(docs)))
    assert reader.document(17) == docs[17][1]
    assert reader.frames_read <= 2 < len(reader.sizes)
    assert [reader.document(i) for i in range(40)] == [ids for _, ids in docs]


def test_damage_is_seen():
    data = bytearray(shard([(1, b"abcd" * 1000)]))
    with pytest.raises(ValueError):
        tf.ShardReader(pa.BufferReader(bytes(data[:-1])))
    data[20] ^= 1
    with pytest.raises((ValueError, zstandard.ZstdError)):
        tf.ShardReader(pa.BufferReader(bytes(data))).document(0)


def test_round_trip_equals_the_library(spark, tmp_path):
    rows = [(10 - i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (5, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    folder = str(tmp_path / "shards")
    manifest = tf.write(docs, folder)
    got = {(r.doc_id, r.start): (r.n_tokens, r.ids_crc32) for r in tf.digests(tf.read(spark, manifest, folder)).collect()}
    tokenizer = Tokenizer.from_file(public_tokenizers.path(tf.TOKENIZER))
    sizes = {}
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        sizes.setdefault(doc_id, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted(got.values()) == sorted(x for some in sizes.values() for x in some)
    at = 0
    for (doc_id, start), (n, _) in sorted(got.items(), key=lambda x: x[0][1]):
        assert start == at and got[doc_id, start] in sizes[doc_id]
        at += n
    order = [k[0] for k in sorted(got, key=lambda k: k[1])]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    some = tf.read(spark, manifest, folder, wanted=[5, 7, 99]).collect()
    assert sorted(r.doc_id for r in some) == [5, 5, 7]


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert tf.round_trip(docs, str(tmp_path / "none")).count() == 0


def test_frequent_units_are_encoded_once(monkeypatch):
    monkeypatch.setattr("gridmix.llm.units.MAX_MEMO", 3)
    seen = []

    def encode(found):
        seen.extend(found)
        return [ord(u[-1]).to_bytes(4, "little") for u in found]

    encoder = UnitEncoder(encode, encode)
    for text in ("a b c", "a b d", "a b e f", "a b"):
        ids, offsets = encoder.texts(pa.array([f"x {text}"]))
        assert ids.tolist() == [ord(c) for c in f"x{text}" if c != " "] and offsets.tolist() == [0, len(ids)]
    assert [seen.count(u) for u in ("x", " a", " b", " c", " d")] == [1, 1, 1, 1, 1]
    encoder.texts(pa.array(["q r s"]))          # other words than those kept: kept from now on
    seen.clear()
    encoder.texts(pa.array(["q r s"]))
    assert seen == []


def test_punctuation_that_ends_a_word_is_a_unit_of_its_own():
    seen = []

    def encode(found):
        seen.extend(found)
        return [b"" for _ in found]

    UnitEncoder(encode, encode).texts(pa.array(["as*** as&&& as%) as\" (as as'* don't 12%\nas]"]))
    assert sorted(seen) == sorted(["as", "***", " as", "&&&", "%)", "\"", " (as", " as'*", " don't", " 12", "%", "\n", "]"])


def test_odd_words_equal_the_library():
    rng = np.random.default_rng(7)
    parts = ["the", "Ünter", "ß", "мир", "日本", "don't", "'s", "'", "'ll", "12", "٣", "½", "***", "%", "\"", "(", "])", "...", "–", "…", "_",
             "\\", "`", "^", "~", "$&", "@", "\x7f", "\x00", "e\u0301", "😀", " ", " ", " ", " ", "\n"]
    texts = ["".join(rng.choice(parts, rng.integers(1, 30))) for _ in range(4000)]
    texts += [a + b for a in parts for b in parts] + [f" {a}{b} {a}" for a in parts for b in parts]
    with open(public_tokenizers.path(tf.TOKENIZER), encoding="utf-8") as f:
        encoder = tf.Encoder(f.read())
    ids, offsets = encoder.units.texts(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[offsets[i]:offsets[i + 1]].tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids, text
