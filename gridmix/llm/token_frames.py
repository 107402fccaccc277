"""Token ids in seekable zstandard shards, written and read from Spark tasks.

A shard holds the ids (little-endian unsigned 32-bit) of consecutive documents:

    frame 0 | frame 1 | ... | index | seek table

* frames: independent zstandard frames with content checksum. Documents are
  packed until a frame has FRAME_BYTES; one that is longer is cut into several.
* index: a skippable frame; zstandard-compressed count of documents, then their
  ids (int64), flags (1: null id) and numbers of token ids (int64).
* seek table: the skippable frame of the public seekable format: compressed
  size, decompressed size and checksum (low 32 bits of XXH64) of every frame
  (the index counts as one of decompressed size 0), their number, the
  descriptor (bit 7: checksums) and the magic number.

A reader needs the last 9 bytes, the seek table and the index to decompress
just the frames of the documents asked for. Every frame is checked against its
checksum.

Shards follow document order: rows are range-partitioned and sorted, each task
writes one shard, and the rows the tasks return make up the manifest. The
manifest is a table that Spark commits, so of a task that ran twice only one
file is named in it; files carry the attempt and are never overwritten.

Edge cases: a null or empty text has the end id alone; null document ids come
first; rows of one document id are ordered by text; other columns are ignored;
an empty table gives an empty manifest.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from gridmix.llm.common import binary_column, shared_path, written
from gridmix.llm.units import PUNCTUATION, UnitEncoder

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
FRAME_BYTES = 1 << 18
LEVEL = 3

# fixed values of the public seekable format
SEEK_TABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
INDEX_MAGIC = 0x184D2A50  # first of the magic numbers of skippable frames
CHECKSUMS = 1 << 7

MANIFEST = "shard int, file string, n_docs long, n_tokens long, n_bytes long"
UNITS_AT_ONCE = 4096
OUT_BYTES = 16 << 20


# --- tokenizer ---------------------------------------------------------------

# such a unit is one pre-token: the model takes it directly
LETTERS = "".join(map(chr, [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0xD7), *range(0xD8, 0xF7),
                            *range(0xF8, 0x100)]))
ASCII = "".join(map(chr, range(0x20, 0x7F)))
PLAIN = re.compile(f"[ ]?(?:[{LETTERS}]+|[0-9]+|[{PUNCTUATION}]+)").fullmatch


class Encoder:
    """The tokenizers library over distinct units.

    Texts that hold one of the tokenizer's added tokens go to the library whole:
    their strings are single ids there.
    """

    def __init__(self, definition: str):
        self.tokenizer = Tokenizer.from_str(definition)
        added = [t["content"] for t in json.loads(definition)["added_tokens"]]
        self.added = "|".join(map(re.escape, added))
        (self.newline,) = self._ids("\n")
        self.units = UnitEncoder(self.encode_units, self.encode_texts, self.added)
        parts = json.loads(definition)["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in parts["merges"]]
        # the same model without its cache of words: units come once
        self.model = models.BPE(vocab=parts["vocab"], merges=merges, cache_capacity=0)
        bytes_of = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.packed = [struct.pack("<I", i) for i in range(max(parts["vocab"].values()) + 1)]
        self.mapped = {ord(c): bytes_of(c)[0][0] for c in ASCII + LETTERS}

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        return [np.array(self._ids(t), "<u4").tobytes() for t in texts]

    def encode_units(self, units: list[str]) -> list[bytes]:
        tokenize, packed, mapped, space = self.model.tokenize, self.packed, self.mapped, self.mapped[ord(" ")]
        out = []
        for u in units:
            word = u.removeprefix(" ")
            if word.isascii() and word.isalpha():     # the most by far: only the space is mapped
                tokens = tokenize(space + word if len(word) < len(u) else word)
            elif PLAIN(u):
                tokens = tokenize(u.translate(mapped))
            else:
                tokens = ()
            out.append(b"".join([packed[t.id] for t in tokens]))
        rest = [i for i, u in enumerate(units) if u and not out[i]]
        for begin in range(0, len(rest), UNITS_AT_ONCE):
            some = rest[begin:begin + UNITS_AT_ONCE]
            for i, found in zip(some, self._joined([units[i] for i in some])):
                out[i] = found
        return out

    def _joined(self, units: list[str]) -> list[bytes]:
        """Units joined by newlines are encoded in one call and parted at the newline's id."""
        inner = [u for u in units if "\n" not in u]
        ids = np.array(self._ids("\n".join(inner)), "<u4")
        ends = [*(4 * np.flatnonzero(ids == self.newline)).tolist(), 4 * len(ids)]
        if len(ends) != max(1, len(inner)):
            raise ValueError("a unit holds the newline's id")
        data = ids.tobytes()
        found = iter([data[begin:end] for begin, end in zip([0, *(e + 4 for e in ends)], ends)])
        return [next(found) if "\n" not in u else self.encode_texts([u])[0] for u in units]


_encoders: dict[str, Encoder] = {}


# --- shard files -------------------------------------------------------------

def open_folder(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path of a folder of Spark's (hdfs://, s3://, file:/... or a path)."""
    if "://" in uri and not uri.startswith("file:"):
        return pyarrow.fs.FileSystem.from_uri(uri)
    return pyarrow.fs.LocalFileSystem(), re.sub("^file:/+", "/", uri)


class ShardWriter:
    def __init__(self, out):
        self.out = out
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.pending: list[bytes] = []
        self.pending_bytes = 0
        self.frames: list[tuple[int, int, int]] = []
        self.doc_ids: list[int] = []
        self.null_ids: list[int] = []
        self.counts: list[int] = []
        self.n_bytes = 0

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.n_bytes += len(data)

    def _flush(self) -> None:
        if not self.pending_bytes:
            return
        data = b"".join(self.pending)
        frame = self.compressor.compress(data)
        self._write(frame)
        self.frames.append((len(frame), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.pending, self.pending_bytes = [], 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.doc_ids.append(doc_id or 0)
        self.null_ids.append(doc_id is None)
        self.counts.append(len(ids) // 4)
        for begin in range(0, len(ids), FRAME_BYTES):
            piece = ids[begin:begin + FRAME_BYTES]
            if self.pending_bytes + len(piece) > FRAME_BYTES:
                self._flush()
            self.pending.append(piece)
            self.pending_bytes += len(piece)

    def close(self) -> None:
        self._flush()
        n = len(self.counts)
        index = self.compressor.compress(
            struct.pack("<q", n) + np.array(self.doc_ids, "<i8").tobytes()
            + np.array(self.null_ids, "u1").tobytes() + np.array(self.counts, "<i8").tobytes())
        self._write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        self.frames.append((8 + len(index), 0, 0))
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        table += struct.pack("<IBI", len(self.frames), CHECKSUMS, SEEKABLE_MAGIC)
        self._write(struct.pack("<II", SEEK_TABLE_MAGIC, len(table)) + table)


class ShardReader:
    """Random access to the documents of one shard."""

    def __init__(self, file):
        self.file = file
        self.frames_read = 0
        size = file.size()
        number, descriptor, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE_MAGIC or descriptor != CHECKSUMS:
            raise ValueError("not a seekable shard with checksums")
        begin = size - 9 - 12 * number - 8
        head, *_ = struct.unpack("<II", self._at(begin, 8))
        table = np.frombuffer(self._at(begin + 8, 12 * number), "<u4").reshape(number, 3)
        self.sizes = table[:, 0].astype(np.int64)
        self.raw = table[:, 1].astype(np.int64)
        self.checksums = table[:, 2]
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.raw_begins = np.cumsum(self.raw) - self.raw
        if head != SEEK_TABLE_MAGIC or int(self.sizes.sum()) != begin:
            raise ValueError("the seek table does not fit the file")
        stored = self._at(int(self.begins[-1]) + 8, int(self.sizes[-1]) - 8)
        index = zstandard.ZstdDecompressor().decompress(stored)
        n, = struct.unpack_from("<q", index)
        self.doc_ids = np.frombuffer(index, "<i8", n, 8)
        self.null_ids = np.frombuffer(index, "u1", n, 8 + 8 * n).astype(bool)
        self.counts = np.frombuffer(index, "<i8", n, 8 + 9 * n)
        self.starts = np.cumsum(self.counts) - self.counts
        self.cached: tuple[int, bytes] = (-1, b"")

    def _at(self, place: int, n: int) -> bytes:
        self.file.seek(place)
        data = self.file.read(n)
        if len(data) != n:
            raise ValueError("the shard ends early")
        return data

    def _frame(self, k: int) -> bytes:
        if self.cached[0] != k:
            stored = self._at(int(self.begins[k]), int(self.sizes[k]))
            data = zstandard.ZstdDecompressor().decompress(stored)
            if len(data) != self.raw[k] or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.checksums[k]:
                raise ValueError(f"frame {k} fails its checksum")
            self.cached = (k, data)
            self.frames_read += 1
        return self.cached[1]

    def document(self, i: int) -> bytes:
        """Ids of the shard's i-th document."""
        begin, end = int(self.starts[i]) * 4, int(self.starts[i] + self.counts[i]) * 4
        parts, k = [], int(np.searchsorted(self.raw_begins[:-1], begin, side="right")) - 1
        while begin < end:
            offset = begin - int(self.raw_begins[k])
            part = self._frame(k)[offset:offset + end - begin]
            parts.append(part)
            begin += len(part)
            k += 1
        return b"".join(parts)


# --- Spark jobs --------------------------------------------------------------

def write(docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text",
          path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write the shards of ``docs`` below ``folder``; returns the committed manifest.

    The manifest has a row per shard, with ``start``: ids in all shards before.
    """
    spark = docs.sparkSession
    with open(path or public_tokenizers.path(TOKENIZER), encoding="utf-8") as f:
        definition = spark.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.col(text).cast("string").alias("text"))
    # the hash parts the rows of a repeated id; within a task the text itself orders them
    tie = F.xxhash64("text")
    ordered = (rows.repartitionByRange(F.asc_nulls_first("doc_id"), tie)
               .sortWithinPartitions(F.asc_nulls_first("doc_id"), tie, F.asc_nulls_first("text")))
    end = struct.pack("<I", end_id)
    filesystem, base = open_folder(folder)
    filesystem.create_dir(base, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoders.get(definition.value) or _encoders.setdefault(
            definition.value, Encoder(definition.value))
        context = TaskContext.get()
        place, top = open_folder(folder)
        name = f"shard-{context.partitionId():06d}-{context.taskAttemptId()}.zst"
        writer = out = None
        for batch in batches:
            for part, ids, offsets in encoder.units.batches(batch, "text"):
                if writer is None:
                    out = place.open_output_stream(f"{top}/{name}", compression=None)
                    writer = ShardWriter(out)
                data, ends = ids.astype("<u4", copy=False).tobytes(), offsets * 4
                for i, one in enumerate(part.column("doc_id").to_pylist()):
                    writer.add(one, data[ends[i]:ends[i + 1]] + end)
        if writer is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([context.partitionId()], pa.int32()), "file": [name],
                "n_docs": [len(writer.counts)], "n_tokens": [sum(writer.counts)],
                "n_bytes": [writer.n_bytes]})

    manifest = written(ordered.mapInArrow(run, MANIFEST), "shard-manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # a row per shard
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read(spark: SparkSession, manifest: DataFrame, folder: str,
         wanted: list[int] | None = None) -> DataFrame:
    """Documents of the manifest's shards: doc_id, start, ids (binary).

    ``wanted``: only these document ids; only their frames are decompressed.
    """
    chosen = None if wanted is None else np.array(sorted(wanted), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, top = open_folder(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with place.open_input_file(f"{top}/{row['file']}") as file:
                    shard = ShardReader(file)
                    at = range(len(shard.counts)) if chosen is None else np.flatnonzero(
                        np.isin(shard.doc_ids, chosen) & ~shard.null_ids).tolist()
                    picked, parts, size = [], [], 0
                    for i in at:
                        picked.append(i)
                        parts.append(shard.document(i))
                        size += len(parts[-1])
                        if size > OUT_BYTES:
                            yield _documents(shard, picked, parts, row["start"])
                            picked, parts, size = [], [], 0
                    if picked:
                        yield _documents(shard, picked, parts, row["start"])

    # a task per shard or so: the shards, not their few manifest rows, are the work
    shards = max(1, manifest.count())
    return (manifest.repartitionByRange(shards, "shard")
            .mapInArrow(run, "doc_id long, start long, ids binary"))


def _documents(shard: ShardReader, picked: list[int], parts: list[bytes], start: int,
               ) -> pa.RecordBatch:
    ends = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    return pa.RecordBatch.from_arrays(
        [pa.array(shard.doc_ids[picked], pa.int64(), mask=shard.null_ids[picked]),
         pa.array(shard.starts[picked] + start, pa.int64()),
         binary_column(np.frombuffer(b"".join(parts), np.uint8), ends)],
        ["doc_id", "start", "ids"])


def round_trip(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the shards and read all documents back."""
    spark = docs.sparkSession
    folder = folder or shared_path(spark, "token-shards")
    return read(spark, write(docs, folder), folder)


def digests(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", "start",
                            (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                            F.crc32("ids").alias("ids_crc32"))
