"""Hard-negative mining with exact scores by the Method of Four Russians.

Vectors become integers (``floor(scale * x)``). A candidate is stored as its
bit planes: for every plane and every group of eight dimensions one byte, whose
bits are that plane's bits of the eight components (two's complement, so the top
plane counts negative). For a block of anchors a task computes the subset sums
of each group of eight components, a table of 256 rows by anchors; a candidate's
byte picks the row, rows of a plane's groups are added, and planes are shifted
and added (Horner), which gives the full inner product of integers.

Every anchor is scored with every row, in blocks: anchors are dealt to blocks of
about ANCHORS, candidates to slices of about CANDIDATES, and a cell (block,
slice) is one unit of work, so neither a common label nor a common vector makes
a task larger. A first pass scores rows of the anchor's own label (positives), a
second one the others (negatives, whose bounds need the positives): each pair is
scored once. Cells send on their best rows only.

Edge cases: rows with a null id, label or vector, or a null, NaN or infinite
component take no part; shorter vectors are padded with zeros; ties go to the
smaller id; repeated rows of one id are candidates each, but an anchor's id is
no candidate of its own, and of repeated anchors the one of least label, then
least packed vector, stands; a positive without a negative in its bounds, and an
anchor without a positive, give no rows; an empty table gives none; other
columns are ignored. Scores that could pass 55 bits are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmix.llm.common import written

SCALE = 256
GROUP = 8            # dimensions of a byte
ANCHORS = 4096       # of a block, about
CANDIDATES = 8192    # of a slice, about
AT_ONCE = 64         # anchors of one table
CHUNK = 2048         # candidates scored at once
DEAL = 7             # seed of the deal to slices

PACKED = "vec_id long, label int, planes binary"
FOUND = "anchor_id long, key long, vec_id long, score long"


# --- numpy: packing and scoring ----------------------------------------------

def pack(values: np.ndarray, n_planes: int) -> np.ndarray:
    """Integers (rows, 8 g) -> bytes (rows, planes, g); bit b of a byte is dimension 8 g + b."""
    rows, dims = values.shape
    planes = (values[:, None, :] >> np.arange(n_planes, dtype=np.int64)[None, :, None]) & 1
    return np.packbits(planes.astype(np.uint8).reshape(rows, n_planes, dims // GROUP, GROUP),
                       axis=-1, bitorder="little")[..., 0]


def unpack(planes: np.ndarray) -> np.ndarray:
    """The integers of :func:`pack`."""
    n, n_planes, groups = planes.shape
    bits = np.unpackbits(planes.reshape(n, n_planes, groups, 1), axis=-1, bitorder="little")
    weights = 1 << np.arange(n_planes, dtype=np.int64)
    weights[-1] = -weights[-1]
    return np.einsum("npd,p->nd", bits.reshape(n, n_planes, groups * GROUP).astype(np.int64), weights)


def subset_sums(anchors: np.ndarray, kind: type) -> np.ndarray:
    """(groups, 256, anchors): sums of the components that a byte's bits name."""
    n, dims = anchors.shape
    tables = np.zeros((dims // GROUP, 1 << GROUP, n), kind)
    parts = anchors.T.reshape(dims // GROUP, GROUP, n).astype(kind)
    for bit in range(GROUP):
        tables[:, 1 << bit:2 << bit] = tables[:, :1 << bit] + parts[:, bit:bit + 1]
    return tables


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(candidates, anchors): exact inner products by look-ups, shifts and additions.

    ``planes``: bytes (planes, groups, candidates).
    """
    n_planes, groups, n = planes.shape
    total = np.zeros((n, tables.shape[2]), tables.dtype)
    picked = np.empty_like(total)
    for plane in range(n_planes - 1, -1, -1):
        if plane == n_planes - 2:
            np.negative(total, out=total)  # the top plane counts negative
        total <<= 1
        for group in range(groups):
            np.take(tables[group], planes[plane, group], axis=0, out=picked, mode="clip")
            total += picked
    return total if n_planes > 1 else -total


class Best:
    """The ``k`` best (score, then smaller id) of every slot."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.slot = np.empty(0, np.int64)
        self.score = np.empty(0, np.int64)
        self.vec_id = np.empty(0, np.int64)
        self.least = np.full(slots, np.iinfo(np.int64).min)  # a row below it can't enter

    def add(self, slot: np.ndarray, score: np.ndarray, vec_id: np.ndarray) -> None:
        slot = np.concatenate((self.slot, slot))
        score = np.concatenate((self.score, score.astype(np.int64)))
        vec_id = np.concatenate((self.vec_id, vec_id))
        order = np.lexsort((vec_id, -score, slot))
        slot, score, vec_id = slot[order], score[order], vec_id[order]
        first = np.flatnonzero(np.diff(slot, prepend=-1))
        rank = np.arange(len(slot)) - np.repeat(first, np.diff(np.append(first, len(slot))))
        keep = rank < self.k
        self.slot, self.score, self.vec_id = slot[keep], score[keep], vec_id[keep]
        full = rank == self.k - 1
        self.least[slot[full]] = score[full]


def mine_cell(anchors: dict, candidates: dict, k: int, same_label: bool) -> Iterator[tuple]:
    """(anchor ids, keys, candidate ids, scores) of one cell.

    anchors: vec_id, label, planes and ``bounds``, (anchors, keys, 2): least and
    greatest score wanted for each key. candidates: vec_id, label, planes.
    """
    values = unpack(anchors["planes"])
    groups = anchors["planes"].shape[2]
    top = np.abs(values).max(initial=0) * (1 << (candidates["planes"].shape[1] - 1))
    kind = np.int32 if float(top) * groups * GROUP < 2 ** 30 else np.int64
    order = np.argsort(candidates["label"], kind="stable")
    label, vec_id = candidates["label"][order], candidates["vec_id"][order]
    planes = np.ascontiguousarray(candidates["planes"][order].transpose(1, 2, 0))
    by_label = np.argsort(anchors["label"], kind="stable")
    n_keys = anchors["bounds"].shape[1]
    edge = np.iinfo(kind)
    cuts = np.flatnonzero(np.diff(anchors["label"][by_label])) + 1
    for block in np.split(by_label, cuts):      # anchors of one label
        if not len(block):
            continue
        mine = anchors["label"][block[0]]
        lo, hi = np.searchsorted(label, mine), np.searchsorted(label, mine, side="right")
        spans = [(lo, hi)] if same_label else [(0, lo), (hi, len(label))]
        for begin in range(0, len(block), AT_ONCE):
            some = block[begin:begin + AT_ONCE]
            tables = subset_sums(values[some], kind)
            bounds = anchors["bounds"][some]
            best = Best(len(some) * n_keys, k)
            for first, last in spans:
                for at in range(first, last, CHUNK):
                    part = slice(at, min(at + CHUNK, last))
                    found = scores(tables, planes[:, :, part])
                    ids = vec_id[part]
                    for key in range(n_keys):
                        least = np.maximum(bounds[:, key, 0], best.least[key::n_keys])
                        wanted = ((found >= np.clip(least, edge.min, edge.max).astype(kind))
                                  & (found <= np.clip(bounds[:, key, 1], edge.min, edge.max).astype(kind)))
                        row, col = np.nonzero(wanted)
                        other = ids[row] != anchors["vec_id"][some][col]
                        row, col = row[other], col[other]
                        if len(row):
                            best.add(col * n_keys + key, found[row, col], ids[row])
            yield (anchors["vec_id"][some][best.slot // n_keys], best.slot % n_keys,
                   best.vec_id, best.score)


# --- Spark jobs --------------------------------------------------------------

def packed(vectors: DataFrame, scale: int = SCALE, vec_id: str = "vec_id", label: str = "label",
           embedding: str = "embedding") -> tuple[DataFrame, int, int]:
    """(rows that take part with packed bit planes as a written table, planes, groups)."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("int").alias("label"),
                          F.col(embedding).cast("array<double>").alias("x"))
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull()
                      & F.col("x").isNotNull() & F.coalesce(finite, F.lit(False)))
    size = rows.agg(F.max(F.size("x")).alias("dims"),
                    F.max(F.array_max(F.transform("x", F.abs))).alias("top")).first()   # one row
    groups = max(1, -(-(size["dims"] or 0) // GROUP))
    top = int((size["top"] or 0.0) * scale) + 1
    if top * top * groups * GROUP >= 1 << 55:
        raise ValueError(f"components up to {size['top']} give scores beyond 55 bits")
    n_planes = top.bit_length() + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2)
            counts = np.asarray(column.value_lengths(), np.int64)
            flat = np.asarray(column.flatten(), np.float64)
            values = np.zeros((batch.num_rows, groups * GROUP), np.int64)
            row = np.repeat(np.arange(batch.num_rows), counts)
            place = np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts)
            values[row, place] = np.floor(flat * scale).astype(np.int64)
            for begin in range(0, batch.num_rows, CHUNK):
                part = pack(values[begin:begin + CHUNK], n_planes)
                n, data = len(part), pa.py_buffer(part.tobytes())
                ends = np.arange(n + 1, dtype=np.int32) * (n_planes * groups)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, n), batch.column(1).slice(begin, n),
                     pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), data])],
                    ["vec_id", "label", "planes"])

    return written(rows.mapInArrow(run, PACKED), "packed-vectors"), n_planes, groups


def _cells(anchors: DataFrame, rows: DataFrame, n_rows: int, k: int, same_label: bool,
           n_planes: int, groups: int, n_keys: int) -> DataFrame:
    """Best ``k`` rows per anchor and key of every cell.

    ``anchors``: vec_id, label, planes, bounds (array of 2 n_keys longs), block;
    ``rows``: the packed table.
    """
    spark = rows.sparkSession
    n_blocks = anchors.agg(F.max("block")).first()[0]
    if n_blocks is None:
        return spark.createDataFrame([], FOUND)
    n_blocks += 1
    n_slices = max(1, -(-n_rows // CANDIDATES))
    n_cells = n_blocks * n_slices
    blocks = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block")
    slices = F.explode(F.sequence(F.lit(0), F.lit(n_slices - 1))).alias("slice")
    # the seed and the written table's order make the deal the same on a retry
    dealt = rows.withColumn("slice", F.floor(F.rand(DEAL) * n_slices).cast("int"))
    both = (anchors.select("block", slices, F.lit(0).alias("side"), "vec_id", "label", "planes", "bounds")
            .unionByName(dealt.select(blocks, "slice", F.lit(1).alias("side"), "vec_id", "label", "planes",
                                      F.lit(None).cast("array<long>").alias("bounds"))))
    cells = (both.withColumn("cell", F.col("block") * n_slices + F.col("slice"))
             .repartition(n_cells, "cell").sortWithinPartitions("cell", "side", "vec_id"))

    def side_of(parts: list[pa.RecordBatch]) -> dict:
        table = pa.Table.from_batches(parts).combine_chunks()
        planes = np.frombuffer(b"".join(table.column("planes").to_pylist()), np.uint8)
        side = {"vec_id": table.column("vec_id").to_numpy(), "label": table.column("label").to_numpy(),
                "planes": planes.reshape(-1, n_planes, groups)}
        if table.column("side")[0].as_py() == 0:
            bounds = np.asarray(table.column("bounds").combine_chunks().flatten(), np.int64)
            side["bounds"] = bounds.reshape(-1, n_keys, 2)
        return side

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pieces in _by_cell(batches):
            if len(pieces) < 2:
                continue        # a slice or block without rows
            for found in mine_cell(side_of(pieces[0]), side_of(pieces[1]), k, same_label):
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found],
                                                 ["anchor_id", "key", "vec_id", "score"])

    return cells.mapInArrow(run, FOUND)


def _by_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[int, list[pa.RecordBatch]]]:
    """The batches of one cell after the other, by side; holds one cell at a time."""
    now, pieces = None, {}
    for batch in batches:
        cells = batch.column("cell").to_numpy()
        sides = batch.column("side").to_numpy()
        cuts = np.flatnonzero((np.diff(cells) != 0) | (np.diff(sides) != 0)) + 1
        for begin, end in zip([0, *cuts], [*cuts, len(cells)]):
            if begin == end:
                continue
            if cells[begin] != now:
                if pieces:
                    yield pieces
                now, pieces = cells[begin], {}
            pieces.setdefault(int(sides[begin]), []).append(batch.slice(begin, end - begin))
    if pieces:
        yield pieces


def _first(found: DataFrame, k: int, *keys: str) -> DataFrame:
    """The best ``k`` rows of every key, with their rank."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _floor_percent(percent: int) -> str:
    return f"({percent} * positive_score - pmod({percent} * positive_score, 100L)) div 100"


def mine(vectors: DataFrame, is_anchor: str, n_positives: int = 5, n_negatives: int = 10,
         least: int = 30, greatest: int = 90, scale: int = SCALE) -> DataFrame:
    """Hard negatives of every anchor and positive.

    ``vectors``: vec_id, label, embedding. ``is_anchor``: condition on vec_id.
    A negative's score is at least ``least`` and at most ``greatest`` percent of
    the positive's. Returns anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score.
    """
    rows, n_planes, groups = packed(vectors, scale)
    n_rows = rows.count()
    chosen = (rows.where(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "planes")).alias("a"))
              .select("vec_id", "a.label", "a.planes"))
    n_blocks = max(1, -(-rows.where(is_anchor).count() // ANCHORS))
    chosen = chosen.withColumn("block", F.expr(f"CAST(pmod(xxhash64(vec_id), {n_blocks}) AS INT)"))
    any_score = F.array(F.lit(-(1 << 62)).cast("long"), F.lit(1 << 62).cast("long"))
    same = _cells(chosen.withColumn("bounds", any_score), rows, n_rows, n_positives, True,
                  n_planes, groups, 1)
    positives = written(_first(same, n_positives, "anchor_id").select(
        "anchor_id", (F.col("rank") - 1).cast("long").alias("key"), F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score")), "positives")
    bounded = positives.withColumns({"lo": F.expr(f"-({_floor_percent(-least)})"),
                                     "hi": F.expr(_floor_percent(greatest))})
    # at most n_positives of an anchor; keys that it lacks get bounds that nothing meets
    none = F.array(F.lit(1).cast("long"), F.lit(0).cast("long"))
    slots = [F.coalesce(F.max(F.when(F.col("key") == i, F.array("lo", "hi"))), none)
             for i in range(n_positives)]
    wanted = bounded.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.concat(*slots).alias("bounds"))
    others = _cells(chosen.join(wanted, "vec_id"), rows, n_rows, n_negatives, False,
                    n_planes, groups, n_positives)
    best = _first(others, n_negatives, "anchor_id", "key")
    return best.join(positives, ["anchor_id", "key"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def flipped(vectors: DataFrame) -> DataFrame:
    """Every seventh id gets the next of ten labels, which plants false positives."""
    return vectors.withColumn("label", F.expr(
        "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"))


SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
         CAST(list_dot_product(a.x, r.x) AS BIGINT) AS score
  FROM v a JOIN v r ON r.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id
                               ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
 AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""
