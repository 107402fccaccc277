"""Approximate nearest neighbours over balanced posting lists.

Nearness is the largest inner product. Vectors are mapped so that it becomes
Euclidean nearness (one more component makes all norms equal the largest one;
queries get 0 there, after scaling to that norm).

* Centroids: a documented, bounded sample (SAMPLE vectors by hash order) is cut
  in halves, again and again, at the median of the difference of distances to
  two means, until a cell stands for about LIST_SIZE vectors: balanced cells.
* Posting lists: every vector goes to its nearest centroid, and a boundary
  vector also to the up to REPLICAS - 1 next ones that are at most
  (1 + REPLICA_RATIO) times as far, or the ratio by which a share of BOUNDARY of
  JUDGED vectors is on a boundary, if that is less: vectors without structure are
  all nearly on one.
* Search: the centroids are searched by best-first steps on a graph of their
  neighbours, held in memory in every task (MAX_CENTROIDS bounds it); of the
  centroids found, those at most (1 + ratio) times as far as the nearest select
  the lists to read.
* Ratio: PROBES queries are compared with the whole table, in blocks, to measure
  recall. The ratio is LIST_RATIO, or as much more as these queries need to find
  TARGET of their true neighbours in the lists that the graph gives them.
  Results come from the lists at every size of the table.
* Scan: neighbouring lists make a group of about BLOCK vectors. A query goes once
  to each group it has lists in, a vector once to each group it is listed in, and
  there only the chosen lists are scored. A group or a query set of any size is
  split in blocks; each block keeps the best of each query. The group of the
  nearest list comes first: its k + 1 best set a bound, and of the other groups
  only what reaches it is kept. The best overall are ranked on the original
  vectors in double precision.

Equal vectors are one class: its k + 1 smallest ids are all that can be in a
result of k, as ties go to the smaller id; and equal queries are searched once.
So a vector repeated in a third of all rows costs no more than any other. A
query that finds fewer than k candidates in its lists is searched exactly, in
blocks, against all classes.

Edge cases: vectors that are null, empty, zero or hold null or non-finite
components take no part, nor those whose length is not the most common one; a
null id takes no part; of rows that repeat an id, each is a candidate, and none
is a candidate of a query of that id; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmix.llm.common import written

SAMPLE = 32_768
SAMPLE_BYTES = 64 << 20
LIST_SIZE = 64
MAX_CENTROIDS = 16_384
SAMPLE_CELL = 8        # at least so many sampled vectors make a centroid
REPLICAS = 4
REPLICA_RATIO = 0.05
BOUNDARY = 0.3         # at most about this share of the vectors is replicated,
JUDGED = 2048          # as judged by so many
LIST_RATIO = 0.10      # the least one, see calibrated()
PROBES = 256
TARGET = 0.93          # recall of the probes; 0.9 is required of all queries
GRAPH_DEGREE = 24
ENTRIES = 16           # centroids the search starts from
BEAM = 64              # steps without progress that end the search
WAVE = 32              # centroids that a query steps on at once
AT_ONCE = 128          # queries that search together
BLOCK = 8192           # classes of a group of lists, or queries, in one block


# --- centroids and their graph ------------------------------------------------

def balanced_centroids(sample: np.ndarray, cell: int, seed: int = 7) -> np.ndarray:
    """Means of cells of at most ``cell`` vectors, got by repeated halving."""
    rng = np.random.default_rng(seed)
    out, open_cells = [], [np.arange(len(sample))]
    while open_cells:
        members = open_cells.pop()
        points = sample[members]
        if len(members) <= max(1, cell):
            out.append(points.mean(axis=0))
            continue
        half = len(members) // 2
        a, b = points[rng.choice(len(points), 2, replace=False)]
        for _ in range(8):
            nearer = points @ (b - a) * 2 + a @ a - b @ b  # |p - a|^2 - |p - b|^2
            order = np.argsort(nearer, kind="stable")
            a, b = points[order[:half]].mean(axis=0), points[order[half:]].mean(axis=0)
        open_cells += [members[order[:half]], members[order[half:]]]
    return np.array(out)


class CentroidGraph:
    """Neighbour graph of the centroids; best-first search from a few entries."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        n = len(centroids)
        self.norms = (centroids ** 2).sum(axis=1)
        degree = min(GRAPH_DEGREE, n - 1)
        # a chain in the order of the halving, so that no centroid is out of reach
        tail, head = [np.arange(n - 1)], [np.arange(1, n)]
        for begin in range(0, n, 1024):
            part = centroids[begin:begin + 1024]
            far = self.norms[None, :] - 2 * part @ centroids.T
            far[np.arange(len(part)), begin + np.arange(len(part))] = np.inf
            if degree:
                best = np.argpartition(far, degree - 1, axis=1)[:, :degree]
                tail.append(np.repeat(np.arange(begin, begin + len(part)), degree))
                head.append(best.ravel())
        a, b = np.concatenate(tail), np.concatenate(head)
        edges = np.unique(np.concatenate([a * n + b, b * n + a]))  # either way
        self.near = edges % n
        self.ends = np.searchsorted(edges, np.arange(n + 1) * n)  # near[ends[c]:ends[c + 1]]
        self.entries = np.unique(np.linspace(0, n - 1, min(n, ENTRIES)).astype(np.int64))

    def distances(self, q: np.ndarray, which: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.norms[which] - 2 * self.centroids[which] @ q + q @ q, 0))

    def within(self, q: np.ndarray, ratio: float) -> tuple[np.ndarray, np.ndarray]:
        """Centroids found at most (1 + ratio) times as far as the nearest, nearest first."""
        return next(self.search(q[None, :], ratio))

    def search(self, queries: np.ndarray, ratio: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``within`` of each query."""
        for begin in range(0, len(queries), AT_ONCE):
            found = self._found(queries[begin:begin + AT_ONCE], ratio)
            for d in found:
                c = np.flatnonzero(d <= (1 + ratio) * d.min())
                c = c[np.argsort(d[c], kind="stable")]
                yield c, d[c]

    def _found(self, queries: np.ndarray, ratio: float) -> np.ndarray:
        """Distances (query, centroid) of the centroids that the steps find; others are infinite."""
        m, n = len(queries), len(self.centroids)
        found, ahead = np.full((m, n), np.inf), np.full((m, n), np.inf)  # ahead: not stepped on yet
        nearest, idle = np.full(m, np.inf), np.zeros(m, np.int64)
        squares = (queries ** 2).sum(axis=1)

        def see(at: np.ndarray) -> None:
            q, c = np.divmod(at, n)
            d = self.norms[c] - 2 * np.einsum("ij,ij->i", self.centroids[c], queries[q]) + squares[q]
            d = np.sqrt(np.maximum(d, 0))
            found.ravel()[at] = d
            ahead.ravel()[at] = d
            np.minimum.at(nearest, q, d)

        see((np.arange(m)[:, None] * n + self.entries[None, :]).ravel())
        alive = np.arange(m)
        while len(alive):
            rest = ahead[alive]
            wave = min(WAVE, n)
            step = np.argpartition(rest, wave - 1, axis=1)[:, :wave]
            d = np.take_along_axis(rest, step, axis=1)
            real = np.isfinite(d)
            close = real & (d <= (1 + ratio) * nearest[alive][:, None])
            # beyond the ratio only a few more steps are tried
            idle[alive] = np.where(close.any(axis=1), 0, idle[alive] + real.sum(axis=1))
            ahead[alive[:, None], step] = np.inf
            row, nth = np.nonzero(real)
            c = step[row, nth]
            many = self.ends[c + 1] - self.ends[c]
            skip = np.repeat(self.ends[c] - np.cumsum(many) + many, many)
            at = np.repeat(alive[row] * n, many) + self.near[skip + np.arange(many.sum())]
            see(np.unique(at[~np.isfinite(found.ravel()[at])]))
            alive = alive[real.any(axis=1) & (idle[alive] <= BEAM)]
        return found


def nearest_of(far: np.ndarray, copies: int) -> tuple[np.ndarray, np.ndarray]:
    """(centroids, distances): the ``copies`` nearest of each row, nearest first."""
    best = np.sort(np.argpartition(far, copies - 1, axis=1)[:, :copies], axis=1)
    d = np.take_along_axis(far, best, axis=1)
    order = np.argsort(d, axis=1, kind="stable")
    return np.take_along_axis(best, order, axis=1), np.take_along_axis(d, order, axis=1)


def boundary_ratio(sample: np.ndarray, centroids: np.ndarray) -> float:
    """REPLICA_RATIO, or less if more than BOUNDARY of the vectors would be replicated by it."""
    if len(centroids) < 2:
        return REPLICA_RATIO
    gaps = []
    norms = (centroids ** 2).sum(axis=1)
    for begin in range(0, len(sample), 1024):
        x = sample[begin:begin + 1024]
        far = np.sqrt(np.maximum((x ** 2).sum(axis=1)[:, None] - 2 * x @ centroids.T + norms[None, :], 0))
        _, d = nearest_of(far, 2)
        gaps.append(d[:, 1] / np.maximum(d[:, 0], 1e-300) - 1)
    return min(REPLICA_RATIO, float(np.quantile(np.concatenate(gaps), BOUNDARY)))


def _matrix(arrays: pd.Series) -> np.ndarray:
    return np.stack(arrays.to_numpy()).astype(np.float64)


def _mapped(vectors: np.ndarray, largest: float) -> np.ndarray:
    """One more component, so that all norms equal ``largest``."""
    rest = np.sqrt(np.maximum(largest ** 2 - (vectors ** 2).sum(axis=1), 0))
    return np.concatenate([vectors, rest[:, None]], axis=1)


def _as_query(vectors: np.ndarray, largest: float) -> np.ndarray:
    scaled = vectors * (largest / np.linalg.norm(vectors, axis=1))[:, None]
    return np.concatenate([scaled, np.zeros((len(vectors), 1))], axis=1)


# --- Spark jobs ---------------------------------------------------------------

def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _rows(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, embedding) that take part."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"),
                          F.col(embedding).cast("array<double>").alias("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    lengths = rows.groupBy(F.size("embedding").alias("dims")).count()
    common = lengths.orderBy(F.desc("count"), "dims").limit(1).select("dims")
    return rows.join(F.broadcast(common), F.size("embedding") == F.col("dims"), "left_semi")  # one row


def _classes(rows: DataFrame, k: int) -> DataFrame:
    """(cid, embedding, members): distinct vectors and their k + 1 smallest ids."""
    nth = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    small = rows.withColumn("nth", nth).where(F.col("nth") <= k + 1)  # cut in every task first
    return written(small.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("members"))
                   .withColumn("cid", F.monotonically_increasing_id()), "ann-classes")


def _scan(queries: np.ndarray, qids: np.ndarray, chosen: list, vectors: np.ndarray, cids: np.ndarray,
          homes: list, bounds: np.ndarray, k: int) -> pd.DataFrame:
    """Scores of each query's k best in its chosen lists, from its bound on; ties at the border stay.

    ``chosen``: lists of each query, ``homes``: lists of each vector. A vector in
    several chosen lists is one candidate.
    """
    out = []
    row = np.repeat(np.arange(len(homes)), [len(h) for h in homes])
    names, listed = np.unique(np.concatenate(homes), return_inverse=True)
    members = [row[listed == j] for j in range(len(names))]
    for begin in range(0, len(queries), 256):
        some = queries[begin:begin + 256]
        picks = np.array([np.isin(names, c) for c in chosen[begin:begin + 256]])
        rough, scored = np.full((len(some), len(vectors)), -np.inf), np.zeros((len(some), len(vectors)), bool)
        for j, here in enumerate(members):
            asking = np.flatnonzero(picks[:, j])
            if len(asking):
                cell = np.ix_(asking, here)
                rough[cell] = some[asking] @ vectors[here].T
                scored[cell] = True
        border = (np.partition(rough, -k, axis=1)[:, -k] if rough.shape[1] > k
                  else np.full(len(some), -np.inf))
        border = np.maximum(border, bounds[begin:begin + 256])
        # a little below, as the order of sums differs between blocks
        slack = 1e-9 * np.maximum(np.abs(border), 1e-300)
        q, v = np.nonzero(scored & (rough >= np.where(np.isfinite(border), border - slack, border)[:, None]))
        # the score proper: the same sum for a pair in whatever block
        score = (some[q] * vectors[v]).sum(axis=1)
        out.append(pd.DataFrame({"qid": qids[begin + q], "cid": cids[v], "score": score}))
    return pd.concat(out, ignore_index=True)


def _in_blocks(queries: DataFrame, lists: DataFrame, k: int) -> DataFrame:
    """(qid, cid, score): candidates of queries (qid, vector, part, lists) in vectors (cid, embedding, part, lists).

    Queries may have a ``bound`` that scores must reach. ``part``: a group of lists. Both sides of a part are cut in blocks of about
    BLOCK rows; every pair of blocks is one task's work.
    """
    if "bound" not in queries.columns:
        queries = queries.withColumn("bound", F.lit(float("-inf")))
    spread = {}
    for name, side in (("v", lists), ("q", queries)):
        sizes = side.groupBy("part").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(f"n_{name}"))
        spread[name] = sizes
    counts = spread["v"].join(spread["q"], "part")
    number = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    left = (queries.join(counts, "part").withColumn("qb", number("qid", "n_q"))
            .withColumn("vb", F.explode(F.sequence(F.lit(0), F.col("n_v") - 1)))
            .select("part", "qb", "vb", "qid", "vector", "lists", "bound"))
    right = (lists.join(counts, "part").withColumn("vb", number("cid", "n_v"))
             .withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("n_q") - 1)))
             .select("part", "qb", "vb", "cid", "embedding", "lists"))

    def scan(_, q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(v):
            return pd.DataFrame({"qid": [], "cid": [], "score": []})
        return _scan(_matrix(q["vector"]), q["qid"].to_numpy(), list(q["lists"]),
                     _matrix(v["embedding"]), v["cid"].to_numpy(), list(v["lists"]),
                     q["bound"].to_numpy(np.float64), k)

    keys = ["part", "qb", "vb"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        scan, "qid long, cid long, score double")


def _everywhere(side: DataFrame) -> DataFrame:
    """All rows in one part and list: every query meets every vector."""
    return side.withColumn("part", F.lit(0)).withColumn("lists", F.array(F.lit(0)))


def parts_of(sizes: np.ndarray) -> np.ndarray:
    """Part of each list: neighbouring lists together, up to about BLOCK vectors."""
    return ((np.cumsum(sizes) - sizes) // BLOCK).astype(np.int64)


def _by_part(key: np.ndarray, vectors: np.ndarray, lists: list, parts: np.ndarray,
             names: tuple[str, str]) -> Iterator[pd.DataFrame]:
    """A row for each part that a row's lists lie in, with its lists there; home: the first list's part."""
    home = parts[np.array([x[0] for x in lists], np.int64)]
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    some = np.concatenate(lists).astype(np.int64)
    order = np.lexsort((some, parts[some], row))
    row, some = row[order], some[order]
    first = np.flatnonzero(np.diff(row * (parts.max() + 1) + parts[some], prepend=-1))
    ends = np.append(first[1:], len(some))
    for begin in range(0, len(first), 4096):
        a, b = first[begin:begin + 4096], ends[begin:begin + 4096]
        yield pd.DataFrame({names[0]: key[row[a]], names[1]: vectors[row[a]], "part": parts[some[a]],
                            "home": parts[some[a]] == home[row[a]],
                            "lists": [some[i:j] for i, j in zip(a, b)]})


def calibrated(graph: CentroidGraph, lists: DataFrame, classes: DataFrame, distinct: DataFrame,
               sizes: np.ndarray, largest: float, k: int, least: float) -> tuple[float, float, float]:
    """(ratio, recall, rows read): what the probes need, and reach, in the lists.

    Rows read are a mean over the probes and count replicas. ``distinct``: (qid,
    vector), ``lists``: (cid, embedding, lists), ``sizes``: vectors of each list.
    """
    # not in the order of the sample: its vectors lie nearer to the centroids made of them
    probes = written(distinct.orderBy(F.xxhash64("qid", F.lit("probe")), "qid").limit(PROBES), "ann-probes")
    nth = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "cid"))
    truth = (_in_blocks(_everywhere(probes), _everywhere(classes.select("cid", "embedding")), k + 1)
             .where("cid <> qid").withColumn("nth", nth).where(F.col("nth") <= k).select("qid", "cid"))
    wanted: dict[int, list[np.ndarray]] = {}
    for r in truth.join(lists.select("cid", "lists"), "cid").collect():  # PROBES * k rows
        wanted.setdefault(r.qid, []).append(np.array(r.lists))
    rows = [r for r in probes.collect() if r.qid in wanted]
    if not rows:
        return least, 1.0, 0.0
    points = _as_query(np.array([r.vector for r in rows]), largest)
    needed = []  # of each neighbour, the ratio that reaches the nearest of its lists
    every = np.arange(len(graph.centroids))
    for q, r in zip(points, rows):
        d = graph.distances(q, every)
        needed += [d[some].min() / max(d.min(), 1e-300) - 1 for some in wanted[r.qid]]
    ratio = max(least, float(np.quantile(needed, TARGET, method="higher")))
    while True:
        hits, read, closed = 0, [], False
        for r, (c, _) in zip(rows, graph.search(points, ratio)):
            open_lists = np.zeros(len(sizes), bool)
            open_lists[c] = True
            hits += sum(open_lists[some].any() for some in wanted[r.qid])
            read.append(sizes[open_lists].sum())
            closed = closed or len(c) < len(sizes)
        recall = hits / len(needed)
        if recall >= TARGET or not closed or not math.isfinite(ratio):
            return ratio, recall, float(np.mean(read))
        ratio = ratio * 1.1 + 1e-3  # the graph lost some


def search(vectors: DataFrame, queries: Column | str, k: int = 20, vec_id: str = "vec_id",
           embedding: str = "embedding", list_ratio: float = LIST_RATIO) -> DataFrame:
    """The k nearest others of every row for which ``queries`` (a condition on vec_id) holds.

    ``list_ratio``: the least ratio of the lists read. Returns query_id, rank, vec_id, score.
    """
    spark = vectors.sparkSession
    wanted = F.expr(queries) if isinstance(queries, str) else queries
    rows = _rows(vectors, vec_id, embedding)
    classes = _classes(rows, k)
    size, largest, dims = classes.agg(
        F.count("*"), F.max(F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x))),
        F.max(F.size("embedding"))).first()
    empty = "query_id long, rank int, vec_id long, score double"
    if not size:
        return spark.createDataFrame([], empty)

    # bounded: SAMPLE vectors, or fewer long ones
    n_sample = min(SAMPLE, max(1, SAMPLE_BYTES // (8 * dims)))
    sample = _mapped(np.array([r.embedding for r in classes.select("cid", "embedding")
                               .orderBy(F.xxhash64("cid"), "cid").limit(n_sample).select("embedding").collect()]),
                     largest)
    n_lists = max(1, min(MAX_CENTROIDS, size // LIST_SIZE, len(sample) // SAMPLE_CELL))
    centroids = balanced_centroids(sample, -(-len(sample) // n_lists))
    graph = spark.sparkContext.broadcast(CentroidGraph(centroids))
    others = _mapped(np.array([r.embedding for r in classes.select("cid", "embedding")
                               .orderBy(F.xxhash64("cid", F.lit("boundary")), "cid").limit(min(JUDGED, n_sample))
                               .select("embedding").collect()]), largest)
    replica_ratio = boundary_ratio(others, centroids)

    def post(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c, norms = graph.value.centroids, graph.value.norms
        copies = min(REPLICAS, len(c))
        for frame in frames:
            x = _mapped(_matrix(frame["embedding"]), largest)
            far = np.sqrt(np.maximum((x ** 2).sum(axis=1)[:, None] - 2 * x @ c.T + norms[None, :], 0))
            best, d = nearest_of(far, copies)
            listed = d <= (1 + replica_ratio) * d[:, :1]
            yield frame.assign(lists=[some[on] for some, on in zip(best, listed)])

    lists = written(classes.select("cid", "embedding").mapInPandas(
        post, "cid long, embedding array<double>, lists array<int>"), "ann-lists")
    sizes = np.zeros(len(centroids), np.int64)
    for r in lists.select(F.explode("lists").alias("list")).groupBy("list").count().collect():  # MAX_CENTROIDS rows
        sizes[r["list"]] = r["count"]
    parts = parts_of(sizes)
    asked = rows.where(wanted).select("vec_id", "embedding")
    asked = written(asked.join(classes.select("cid", "embedding"), "embedding").select("vec_id", "cid"), "ann-asked")
    distinct = (classes.join(asked.select("cid").distinct(), "cid", "left_semi")
                .select(F.col("cid").alias("qid"), F.col("embedding").alias("vector")))
    ratio, _, _ = calibrated(graph.value, lists, classes, distinct, sizes, largest, k, list_ratio)

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield from _by_part(frame["cid"].to_numpy(), frame["embedding"].to_numpy(), list(frame["lists"]),
                                parts, ("cid", "embedding"))

    def choose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for begin in range(0, len(frame), AT_ONCE):
                some = frame.iloc[begin:begin + AT_ONCE]
                x = _as_query(_matrix(some["vector"]), largest)
                chosen = [c for c, _ in graph.value.search(x, ratio)]
                yield from _by_part(some["qid"].to_numpy(), some["vector"].to_numpy(), chosen,
                                    parts, ("qid", "vector"))

    asking = written(distinct.mapInPandas(choose, "qid long, vector array<double>, part long, home boolean, lists array<int>"),
                     "ann-chosen")
    listed = written(lists.mapInPandas(place, "cid long, embedding array<double>, part long, home boolean, lists array<int>"),
                     "ann-parts")
    nearby = written(_in_blocks(asking.where("home"), listed, k + 1), "ann-nearby")
    last = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score")))
    bounds = nearby.withColumn("nth", last).where(F.col("nth") == k + 1).select("qid", F.col("score").alias("bound"))
    others = asking.where("not home").join(bounds, "qid", "left").fillna(float("-inf"), ["bound"])
    pairs = nearby.unionByName(_in_blocks(others, listed, k + 1))
    found = written(_ranked(pairs, classes, k), "ann-found")

    # fewer found than there are: search these queries exactly
    all_rows = classes.select(F.explode("members")).limit(k + 1).count()
    counts = found.groupBy("qid").agg(F.count("*").alias("n"))
    short = written(distinct.join(counts, "qid", "left").where(F.coalesce("n", F.lit(0)) < min(k + 1, all_rows))
                    .select("qid", "vector"), "ann-short")
    if not short.isEmpty():
        everything = _everywhere(classes.select("cid", "embedding"))
        exact = _ranked(_in_blocks(_everywhere(short), everything, k + 1), classes, k)
        found = found.join(short.select("qid"), "qid", "left_anti").unionByName(exact)

    nth = F.row_number().over(Window.partitionBy("query_id", "row").orderBy("at"))
    # a row of its own for every query: ids may repeat
    each = asked.withColumnRenamed("vec_id", "query_id").withColumn("row", F.monotonically_increasing_id())
    return (each.join(found, F.col("cid") == F.col("qid")).where("vec_id <> query_id")
            .withColumn("rank", nth).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _ranked(candidates: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """(qid, at, vec_id, score): the k + 1 best ids of each query class, nearest first."""
    # a class found in several lists is one candidate
    best = candidates.groupBy("qid", "cid").agg(F.max("score").alias("score"))
    by_score = Window.partitionBy("qid").orderBy(F.desc("score"))
    # rank, not row_number: ties at the border stay, as ids decide among them
    few = best.withColumn("place", F.rank().over(by_score)).where(F.col("place") <= k + 1)
    ids = few.join(classes.select("cid", "members"), "cid").select("qid", "score", F.explode("members").alias("vec_id"))
    nth = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id"))
    return ids.withColumn("at", nth).where(F.col("at") <= k + 1).select("qid", "at", "vec_id", "score")
