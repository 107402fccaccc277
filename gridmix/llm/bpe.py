"""Byte-level BPE encoding and decoding through a hand-serialised sentencepiece model.

A rank file (token bytes -> rank) becomes a sentencepiece BPE model: every
token is a piece whose bytes are mapped to one character each, its score is the
negative rank (so the best-scored merge is the lowest rank), and the normaliser
is the identity without dummy prefix, white-space removal or escaping. Each
match of the split pattern is encoded on its own: a match that is itself a
token gives its rank, any other is merged by sentencepiece, whose piece ids are
the ranks. Decoding maps ids back to their bytes.

Edge cases: a null or empty text has no ids and decodes to empty bytes; no text
is cut, whatever its length; equal rows give equal results; input columns named
like the outputs are replaced.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmix.llm.common import binary_column
from gridmix.llm.units import UnitEncoder

RANKS = "byte_bpe_multi_50k.tiktoken"

# one character above U+00FF for each byte: no control, white-space or meta characters
BYTE_CHARACTERS = {b: chr(0x100 + b) for b in range(256)}
UNKNOWN = "<unk>"

# such a text is one match of the split pattern
PLAIN = re.compile("[ ]?[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch

# field numbers and values of sentencepiece's public model format (fixed values)
BPE, NORMAL_PIECE, UNKNOWN_PIECE = 2, 1, 2


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank; ranks must be 0, 1, ... without a gap."""
    with open(path, "rb") as lines:
        pairs = [(int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, lines)]
    tokens = [token for _, token in sorted(pairs)]
    if [rank for rank, _ in sorted(pairs)] != list(range(len(tokens))):
        raise ValueError(f"ranks of {path} are not 0 to {len(tokens) - 1}")
    return tokens


def _varint(n: int) -> bytes:
    out = bytearray()
    n &= (1 << 64) - 1
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out) + bytes([n])


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _bytes(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def _mapped(token: bytes) -> str:
    return token.decode("latin-1").translate(BYTE_CHARACTERS)


def _piece(text: str, score: float, kind: int) -> bytes:
    return _bytes(1, _bytes(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score)
                  + _number(3, kind))


def serialise_model(tokens: list[bytes]) -> bytes:
    """The sentencepiece model whose piece ids are the ranks; <unk> comes after them."""
    pieces = [_piece(_mapped(t), -float(rank), NORMAL_PIECE) for rank, t in enumerate(tokens)]
    pieces.append(_piece(UNKNOWN, 0.0, UNKNOWN_PIECE))
    none = -1
    trainer = (_number(3, BPE) + _number(4, len(pieces)) + _number(40, len(tokens))
               + _number(41, none) + _number(42, none) + _number(43, none)
               + _bytes(45, UNKNOWN.encode()))
    normaliser = _bytes(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(pieces) + _bytes(2, trainer) + _bytes(3, normaliser)


def _little_endian(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


class Codec:
    """Encoder and decoder of one vocabulary, for use inside a task."""

    def __init__(self, tokens: list[bytes], model: bytes, pattern: str):
        self.split = regex.compile(pattern).findall
        self.rank = {token: rank for rank, token in enumerate(tokens)}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.pieces = pa.array(tokens, pa.binary())
        self.lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.units = UnitEncoder(self.encode, self.encode)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [[t] if PLAIN(t) else self.split(t) for t in texts]
        ids: dict[str, bytes] = {}
        merged: list[str] = []
        for match in set().union(*split):
            rank = self.rank.get(match.encode())
            if rank is None:
                merged.append(match)
            else:
                ids[match] = struct.pack("<I", rank)
        encoded = self.model.encode([_mapped(m.encode()) for m in merged], num_threads=1)
        ids.update((m, _little_endian(e)) for m, e in zip(merged, encoded))
        return [ids[matches[0]] if len(matches) == 1 else b"".join([ids[m] for m in matches])
                for matches in split]

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, end of each id's bytes after a leading 0)."""
        found = self.pieces.take(pa.array(ids))
        ends = np.concatenate(([0], np.cumsum(self.lengths[ids])))
        data = found.buffers()[2]
        raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
        return raw[:ends[-1]], ends


_codecs: dict[str, Codec] = {}


def round_trip(docs: DataFrame, text: str = "text", path: str | None = None,
               pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``docs`` without its text, with its ids and the bytes they decode to.

    Adds ``ids`` (binary, little-endian unsigned 32-bit) and ``decoded``
    (binary). The vocabulary file is read on the driver and sent to the
    executors: its size is fixed, not that of the data.
    """
    sc = docs.sparkSession.sparkContext
    tokens = read_ranks(path or public_tokenizers.path(RANKS))
    model = serialise_model(tokens)
    shared = sc.broadcast((tokens, model, pattern))
    key = hashlib.sha256(model + pattern.encode()).hexdigest()
    keep = [c for c in docs.columns if c not in (text, "ids", "decoded")]
    own = "__text"
    while own in keep:
        own += "_"
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text).cast("string").alias(own))
    schema = T.StructType([*(rows.schema[c] for c in keep),
                           T.StructField("ids", T.BinaryType()),
                           T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codecs.get(key) or _codecs.setdefault(key, Codec(*shared.value))
        for batch in batches:
            for part, ids, offsets in codec.units.batches(batch, own):
                raw, ends = codec.decode(ids)
                columns = [part.column(c) for c in keep]
                columns += [binary_column(ids.astype("<u4", copy=False), offsets * 4),
                            binary_column(raw, ends[offsets])]
                yield pa.RecordBatch.from_arrays(columns, [*keep, "ids", "decoded"])

    return rows.mapInArrow(run, schema)


def digests(encoded: DataFrame) -> DataFrame:
    """``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` in place of ids and bytes."""
    keep = [c for c in encoded.columns if c not in ("ids", "decoded")]
    return encoded.select(
        *keep, (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
