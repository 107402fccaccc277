import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from gridmix.llm import bpe

AWKWARD = [
    None, "", " ", "a", " a", "a ", "a\nb", "a\n\nb", "it's fine, isn't it?", "x).\ny", "1,2.3, a'.b",
    "é, ñ! ß? 漢字 テスト, 'S", "\x1c a \x1c", "\x85a", "a\xa0b 　 c", "\x02 ab", "tab\tx \ty", "a.b. c..",
    "don't'll 's 're", " \n", "<|endoftext|>", "😀😀 \U0001F600", "word " * 30000, "x" * 20000,
]


@pytest.fixture(scope="module")
def codec():
    tokens = bpe.read_ranks(public_tokenizers.path(bpe.RANKS))
    return bpe.Codec(tokens, bpe.serialise_model(tokens), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference():
    tokens = bpe.read_ranks(public_tokenizers.path(bpe.RANKS))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                             mergeable_ranks={t: i for i, t in enumerate(tokens)})


def check(codec, reference, texts):
    ids, offsets = codec.units.texts(pa.array(texts, pa.string()))
    raw, ends = codec.decode(ids)
    for i, text in enumerate(texts):
        assert ids[offsets[i]:offsets[i + 1]].tolist() == reference.encode_ordinary(text or "")
        assert raw[ends[offsets[i]]:ends[offsets[i + 1]]].tobytes() == (text or "").encode()


def test_awkward_texts(codec, reference):
    check(codec, reference, AWKWARD)
    check(codec, reference, [])


def test_random_texts(codec, reference):
    rng = random.Random(3)
    letters = "ab'sS .,!\n\t\xa0é漢1²½_\x02\x00\x1c 😀"
    check(codec, reference, ["".join(rng.choices(letters, k=rng.randrange(40))) for _ in range(4000)])


def test_every_plane(codec, reference):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000][::97]
    check(codec, reference, [f"x{chr(c)} {chr(c)}s\n{chr(c)}. y" for c in points])


def test_small_memo_gives_the_same(codec, reference, monkeypatch):
    monkeypatch.setattr("gridmix.llm.units.MAX_MEMO", 3)
    check(codec, reference, ["one two three four five six", "one two", "seven"])


def test_round_trip_in_spark(spark, reference):
    rows = [(i, t, b"old") for i, t in enumerate(AWKWARD)] + [(1, "twice", b""), (1, "twice", b""), (None, "no id", b"")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids binary")
    got = bpe.digests(bpe.round_trip(docs)).collect()
    assert len(got) == len(rows)
    want = sorted((repr(i), len(e), hashlib.sha256(np.array(e, "<u4").tobytes()).hexdigest(),
                   hashlib.sha256((t or "").encode()).hexdigest())
                  for i, t, _ in rows for e in [reference.encode_ordinary(t or "")])
    assert sorted((repr(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want
    assert bpe.digests(bpe.round_trip(docs.limit(0))).count() == 0


def test_ranks_with_a_gap_are_refused(tmp_path):
    (tmp_path / "r").write_text("YQ== 0\nYg== 2\n")
    with pytest.raises(ValueError):
        bpe.read_ranks(str(tmp_path / "r"))


def test_columns_named_like_its_own_are_kept(spark):
    docs = spark.createDataFrame([(1, "a b", "mine", 7)], "doc_id long, text string, __text string, ids int")
    (row,) = bpe.round_trip(docs).collect()
    assert (row["__text"], bytes(row["decoded"])) == ("mine", b"a b") and len(row["ids"]) % 4 == 0
