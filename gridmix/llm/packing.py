"""Vector best-fit packing of tokenised documents into sequences of bounded size.

A document becomes the ids of its whole text and an end id; only what is longer
than a sequence is cut, into pieces as long as one. A sequence has three
capacities: tokens, documents (pieces) and attention cost (the sum of squared
piece lengths: pieces don't attend to each other). Pieces are placed in order
of falling length; of the open sequences that have room in every capacity, the
one with the least weighted norm of what would be left is taken (``rule="norm"``),
or the one with the greatest weighted dot product of piece and residual
(``rule="dot"``); ties go to the one opened first. If none has room, one is opened.

Pieces are dealt at random to groups of about GROUP, packed one by one. Small
pieces fill the gaps, so a group leaves few sequences with room; those are taken
apart and packed together in a next round, until one group holds them all or a
round saves nothing. Memory is bounded by a group and a batch of texts.

Texts are encoded by distinct words: the tokenizer drops white space, and
neither its normaliser nor its split looks across it, so a word's ids don't
depend on its neighbours. Texts with one of the tokenizer's special strings are
encoded whole by the library.

Edge cases: a null or empty text is the end id alone; null and repeated document
ids are kept, each row is a document; equal rows are packed each; an empty table
gives no pieces; other columns are ignored; no text is shortened.
"""

from __future__ import annotations

import json
import math
import re
import struct
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from gridmix.llm.common import binary_column, slices, words, written
from gridmix.llm.units import UNIT_BYTES, Memo

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
TOKENS = 4096        # of a sequence
GROUP = 1 << 15      # pieces packed together, about
ROOM = 16            # a sequence with more than 1/ROOM of its tokens free is packed again
DEAL = 13            # seed of the deal to groups
WEIGHTS = (1.0, 0.05, 0.05)   # of tokens, documents and attention cost, as shares of their capacity

PIECES = "piece_id long, doc_id long, piece int, start long, length long, ids binary"
PLACED = ("piece_id long, doc_id long, piece int, start long, length long, ids_crc32 long, "
          "sequence_id long, offset long, room boolean")

# such a word is one match of the tokenizer's split pattern, lower-cased letter by letter
LETTERS = "".join(map(chr, [*range(0x61, 0x7B), *range(0xDF, 0xF7), *range(0xF8, 0x100)]))
PLAIN = re.compile(f"[A-Z{LETTERS}À-ÖØ-Þ]+").fullmatch
# punctuation that ends a word is a match of its own
WORD_END = r"([0-9A-Za-zÀ-ÖØ-öø-ÿ])([.,;:!?]+)([ \n]|\z)"


# --- tokens ------------------------------------------------------------------

class WordEncoder:
    """Ids (little-endian unsigned 32-bit) of whole texts by a memo of distinct words."""

    def __init__(self, definition: str):
        self.tokenizer = Tokenizer.from_str(definition)
        parts = json.loads(definition)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in parts["model"]["merges"]]
        # the same model without its cache of words: words come once
        self.model = models.BPE(vocab=parts["model"]["vocab"], merges=merges, cache_capacity=0,
                                end_of_word_suffix=parts["model"]["end_of_word_suffix"])
        self.special = "|".join(re.escape(t["content"]) for t in parts["added_tokens"]) or r"\z."
        bytes_of = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.mapped = {ord(c): bytes_of(c)[0][0] for c in LETTERS}
        self.memo = Memo(self.encode_words)

    def encode_texts(self, texts: list[str]) -> list[bytes]:
        # one by one: the encodings of a whole batch take far more memory than its texts
        return [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]

    def encode_words(self, found: list[str]) -> list[bytes]:
        out: list[bytes] = []
        odd = []
        for i, word in enumerate(found):
            if PLAIN(word):
                tokens = self.model.tokenize(word.lower().translate(self.mapped))
                out.append(struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens]))
            else:
                odd.append(i)
                out.append(b"")
        for i, ids in zip(odd, self.encode_texts([found[i] for i in odd])):
            out[i] = ids
        return out

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): text i (null: empty) has ids[offsets[i]:offsets[i + 1]]."""
        texts = pc.fill_null(texts, "")
        whole = pc.match_substring_regex(texts, self.special)
        parted = pc.replace_substring_regex(pc.if_else(whole, "", texts), WORD_END, r"\1 \2\3")
        offsets, codes, vocabulary = words(parted)
        found = self.memo.ids_of(vocabulary.to_pylist())
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts = np.concatenate(([0], np.cumsum(lengths)))
        lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()),
                                         pa.array(np.frombuffer(b"".join(found), "<u4")))
        ids = lists.take(pa.array(codes)).flatten().to_numpy()
        ends = np.concatenate(([0], np.cumsum(lengths[codes])))[offsets]
        if not pc.any(whole).as_py():
            return ids, ends
        at = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
        alone = dict(zip(at.tolist(), self.encode_texts(texts.take(pa.array(at)).to_pylist())))
        parts = [np.frombuffer(alone[i], "<u4") if i in alone else ids[ends[i]:ends[i + 1]]
                 for i in range(len(texts))]
        return np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts])))

    def batches(self, batch: pa.RecordBatch, text: str,
                ) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
        """(slice, ids, offsets) for the slices of a batch."""
        for part in slices(batch, text, UNIT_BYTES):
            yield part, *self.texts(part.column(text))


_encoders: dict[str, WordEncoder] = {}


def pieces(docs: DataFrame, tokens: int = TOKENS, doc_id: str = "doc_id", text: str = "text",
           path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Pieces of at most ``tokens`` ids, as a written table.

    ``piece_id`` is unique; ``start`` counts the document's ids before the
    piece; ``ids`` are little-endian unsigned 32-bit integers.
    """
    with open(path or public_tokenizers.path(TOKENIZER), encoding="utf-8") as f:
        definition = docs.sparkSession.sparkContext.broadcast(f.read())   # fixed size
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoders.get(definition.value) or _encoders.setdefault(
            definition.value, WordEncoder(definition.value))
        next_id = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part, ids, ends in encoder.batches(batch, "text"):
                # the end id after each document
                n = part.num_rows
                ids = np.insert(ids, ends[1:], end_id).astype("<u4", copy=False)
                ends = ends + np.arange(n + 1)
                counts = np.diff(ends)
                cut = -(-counts // tokens)
                row = np.repeat(np.arange(n), cut)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(cut) - cut, cut)
                start = piece * tokens
                length = np.minimum(tokens, counts[row] - start)
                bounds = np.concatenate((ends[row] + start, ends[-1:]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(next_id + np.arange(len(row)), pa.int64()),
                     part.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                     binary_column(ids, bounds * 4)],
                    ["piece_id", "doc_id", "piece", "start", "length", "ids"])
                next_id += len(row)

    return written(rows.mapInArrow(run, PIECES), "token-pieces")


# --- packing -----------------------------------------------------------------

def best_fit(lengths: np.ndarray, capacity: tuple[int, int, int], rule: str = "norm",
             weights: tuple[float, float, float] = WEIGHTS) -> np.ndarray:
    """Sequence (0, 1, ...) of each piece; ``lengths`` fall."""
    if rule not in ("norm", "dot"):
        raise ValueError(f"no rule {rule}")
    cap = np.array(capacity, np.float64)
    scale = np.array(weights) / cap ** 2
    out = np.empty(len(lengths), np.int64)
    left = np.empty((3, 1024))      # residuals of the open sequences
    name = np.empty(1024, np.int64)
    n_open = opened = 0
    least = float(lengths.min(initial=capacity[0]))
    for i, length in enumerate(lengths.tolist()):
        need = np.array((length, 1.0, float(length) ** 2))
        after = left[:, :n_open] - need[:, None]
        fits = np.flatnonzero((after >= 0).all(axis=0))
        if len(fits):
            if rule == "norm":
                at = fits[np.argmin(scale @ after[:, fits] ** 2)]
            else:
                at = fits[np.argmax((scale * need) @ left[:, fits])]
            left[:, at] -= need
        else:
            if n_open == len(name):
                # drop the sequences that no piece fits any more before growing
                live = np.flatnonzero((left[0, :n_open] >= least) & (left[1, :n_open] >= 1)
                                      & (left[2, :n_open] >= least ** 2))
                kept, names = left[:, live], name[live]
                if 2 * len(live) > len(name):
                    left, name = np.empty((3, 2 * len(name))), np.empty(2 * len(name), np.int64)
                n_open = len(live)
                left[:, :n_open], name[:n_open] = kept, names
            at = n_open
            left[:, at], name[at] = cap - need, opened
            n_open += 1
            opened += 1
        out[i] = name[at]
    return out


def place(rows: DataFrame, n_groups: int, number: int, capacity: tuple[int, int, int], rule: str,
          weights: tuple[float, float, float]) -> DataFrame:
    """Pieces with their sequence and offset, packed in ``n_groups`` groups; ``number``: round."""
    # rows come from a written table in its order, so the seed deals them alike on a retry
    dealt = (rows.withColumn("group", F.floor(F.rand(DEAL + number) * n_groups).cast("int"))
             .repartition(n_groups, "group")
             .sortWithinPartitions("group", F.col("length").desc(), "piece_id"))

    def pack(group: pa.Table) -> pa.RecordBatch:
        length = group.column("length").to_numpy()
        sequence = best_fit(length, capacity, rule, weights)
        order = np.argsort(sequence, kind="stable")
        before = np.cumsum(length[order]) - length[order]
        first = np.flatnonzero(np.diff(sequence[order], prepend=-1))
        offset = np.empty(len(length), np.int64)
        sizes = np.diff(np.append(first, len(length)))
        offset[order] = before - np.repeat(before[first], sizes)
        used = np.bincount(sequence, weights=length)
        room = ROOM * (capacity[0] - used[sequence]) > capacity[0]
        base = (number << 56) + (int(group.column("group")[0].as_py()) << 24)
        columns = [group.column(c).combine_chunks() for c in
                   ("piece_id", "doc_id", "piece", "start", "length", "ids_crc32")]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(base + sequence), pa.array(offset), pa.array(room)],
            ["piece_id", "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "room"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: list[pa.RecordBatch] = []
        for batch in batches:
            groups = batch.column("group").to_numpy()
            cuts = np.flatnonzero(np.diff(groups)) + 1
            for begin, end in zip([0, *cuts], [*cuts, len(groups)]):
                if begin == end:
                    continue
                part = batch.slice(begin, end - begin)
                if now and now[0].column("group")[0] != part.column("group")[0]:
                    yield pack(pa.Table.from_batches(now))
                    now = []
                now.append(part)
        if now:
            yield pack(pa.Table.from_batches(now))

    return dealt.mapInArrow(run, PLACED)


def pack(rows: DataFrame, tokens: int = TOKENS, documents: int | None = None, attention: int | None = None,
         rule: str = "norm", weights: tuple[float, float, float] = WEIGHTS) -> DataFrame:
    """Sequence and offset of every piece.

    ``rows``: a written table of piece_id, doc_id, piece, start, length and
    ids_crc32, no piece larger than a capacity. ``documents`` and ``attention``
    (by default as many as ``tokens`` allow) are the other two capacities.
    """
    capacity = (tokens, documents or tokens, attention or tokens ** 2)
    done, last = None, None
    number = 0
    while True:
        n_rows = rows.count()
        n_groups = max(1, -(-n_rows // GROUP))
        placed = written(place(rows, n_groups, number, capacity, rule, weights), "placed-pieces")
        n_sequences = placed.select("sequence_id").distinct().count()
        if n_groups == 1 or (last is not None and n_sequences >= last):
            break
        full = placed.where("NOT room")
        done = full if done is None else done.unionByName(full)
        rows = placed.where("room").drop("sequence_id", "offset", "room")
        last = placed.where("room").select("sequence_id").distinct().count()
        number += 1
    out = placed if done is None else done.unionByName(placed)
    return out.drop("room")


def pack_documents(docs: DataFrame, tokens: int = TOKENS, documents: int | None = None,
                   attention: int | None = None, rule: str = "norm", **tokenizer) -> tuple[DataFrame, DataFrame]:
    """(pieces with ids, their places); pieces are short enough for every capacity."""
    longest = min(tokens, math.isqrt(attention or tokens ** 2))
    cut = pieces(docs, longest, **tokenizer)
    rows = cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return cut, pack(rows, tokens, documents, attention, rule)


def sequences(cut: DataFrame, places: DataFrame) -> DataFrame:
    """The packed sequences: sequence_id, ids (binary) and lengths of the pieces, in place order.

    At most a sequence's tokens meet in one group.
    """
    parts = places.select("piece_id", "sequence_id", "offset").join(cut.select("piece_id", "length", "ids"),
                                                                   "piece_id")
    ordered = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    return (parts.groupBy("sequence_id").agg(ordered.alias("p"))
            .select("sequence_id", F.expr("aggregate(p.ids, CAST('' AS BINARY), (a, x) -> concat(a, x))").alias("ids"),
                    F.col("p.length").alias("lengths")))
