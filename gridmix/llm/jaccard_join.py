"""Exact n-gram Jaccard self-join with adaptive multi-match prefixes.

A document's set holds its distinct word n-grams (64-bit hashes). Two sets
link when their Jaccard similarity is at least ``percent`` / 100.

1. Loads: one pass counts n-grams into LOAD_BUCKETS hash buckets over all
   documents. (load of its bucket, hash) is one global order of n-grams, in
   which frequent ones come last. The table has a fixed size, so it may be sent
   to every task; buckets that n-grams share make it less sharp, never wrong.
2. Classes: documents with one set (digest of the sorted hashes) are one node.
3. Prefixes: if two sets of sizes a and b link, they share at least
   ceil(percent/100 * max(a, b)) n-grams, so for every l >= 1 their prefixes of
   n - ceil(percent/100 * n) + l n-grams in global order share at least l. Each
   document picks its own l: a longer prefix costs the estimated postings of
   its added n-grams, and leaves at most postings / l candidates to verify. A
   pair is a candidate if the l-prefixes for the smaller l of the two share at
   least that many n-grams.
4. Links: candidates are verified on the whole sets. Only components matter, so
   first every posting list offers the pairs of one class with the rest (the
   class in which the n-gram comes earliest, which has the fewest rare n-grams
   of its own; then the one of the smallest number), and components of those
   links are formed; then all candidate pairs of different components are taken,
   without a cap. Pairs inside a component need no test: a group of n near
   copies costs about n tests, not n * n.
5. Pairs of different components: two sets of sizes a and b that link share
   ceil(percent / (100 + percent) * (a + b)) n-grams, so their prefixes may be
   shorter than those of 3, which fit any partner. Postings are dealt out by the
   sizes (in steps of about 1 %) and the l of both sides, each with the prefix
   that fits such partners, and a class with fewer than l postings that meet
   another component is dropped before pairs are formed. So near copies that
   differ a little too much from all others of a large group form no pairs.

A posting list holds a class at most once, and a class has many postings, so no
n-gram can hold more than 1 / prefix length of the rows that are dealt out.

Edge cases: a text of fewer than n words is one n-gram of all its words; a null
text, or one without words, has an empty set and links with nothing; rows with
a null id take part in links, but an id is never null unless a whole component
has none; repeated rows are one class; other columns are ignored. Two n-grams
of one 64-bit hash count as one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmix.llm.common import slices, words, written
from gridmix.llm.components import components

LOAD_BUCKETS = 1 << 18
LOAD_BLOCK = 1 << 12  # buckets in a row of the table of loads
MAX_MATCHES = 8       # largest l
SIZE_STEPS = 128      # steps of set size for a factor of two
VERIFY_COST = 16.0    # verifying a candidate, in postings read

MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                        0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)


# --- inside tasks ------------------------------------------------------------

def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def ngram_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the word n-grams of each text (A-Z lower-cased)."""
    offsets, codes, vocabulary = words(texts, lower=True)
    of_word = np.fromiter((xxhash.xxh64_intdigest(w) for w in
                           vocabulary.to_numpy(zero_copy_only=False).tolist()),
                          np.uint64, len(vocabulary))
    hashed = of_word[codes]
    sets = []
    for begin, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        w = hashed[begin:end]
        if not len(w):
            sets.append(w)
            continue
        size = min(n, len(w))
        total = np.full(len(w) - size + 1, size, np.uint64)
        for k in range(size):  # order matters: mix after each word
            total = _mix(total * MULTIPLIERS[k % len(MULTIPLIERS)] + w[k:len(w) - size + 1 + k])
        sets.append(np.unique(total))
    return sets


def digest(one: np.ndarray) -> bytes | None:
    return hashlib.blake2b(one.astype("<u8").tobytes(), digest_size=16).digest() if len(one) else None


def least_overlap(n, percent: int):
    """Fewest n-grams that a set of n shares with any set it links with."""
    return -(-percent * n // 100)


def prefix(one: np.ndarray, loads: np.ndarray, floor: float, percent: int) -> tuple[int, np.ndarray]:
    """(l, the l-prefix of a set in global order)."""
    load = loads[(one % np.uint64(LOAD_BUCKETS)).astype(np.int64)]
    order = np.lexsort((one, load))
    n = len(one)
    need = least_overlap(n, percent)
    base = n - need  # the l-prefix has base + l n-grams
    most = max(1, min(MAX_MATCHES, need))
    estimate = np.maximum(load[order[:base + most]] - floor, 1.0)
    matches = np.arange(1, most + 1)
    postings = np.cumsum(estimate)[base:base + most]
    best = int(np.argmin(postings * (1 + VERIFY_COST / matches))) + 1
    return best, one[order[:base + best]]


# --- Spark jobs --------------------------------------------------------------

def _summaries(docs: DataFrame, n: int) -> DataFrame:
    """One pass: a row per document (size and digest) and rows of the task's bucket loads."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loads = np.zeros(LOAD_BUCKETS, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                sets = ngram_sets(part.column("text"), n)
                if sets:
                    loads += np.bincount(
                        (np.concatenate(sets) % np.uint64(LOAD_BUCKETS)).astype(np.int64),
                        minlength=LOAD_BUCKETS)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([digest(s) for s in sets], pa.binary()),
                    pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())], names)
        for block in range(LOAD_BUCKETS // LOAD_BLOCK):
            some = loads[block * LOAD_BLOCK:(block + 1) * LOAD_BLOCK]
            if some.any():
                yield pa.RecordBatch.from_arrays([
                    pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
                    pa.array([block], pa.int32()), pa.array([some.astype("<i8").tobytes()])], names)

    names = ["doc_id", "n_ngrams", "digest", "block", "loads"]
    return docs.mapInArrow(
        run, "doc_id long, n_ngrams long, digest binary, block int, loads binary")


def _loads(summaries: DataFrame) -> np.ndarray:
    """The table of loads: always LOAD_BUCKETS numbers."""
    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for frame in frames:
            for block, some in zip(frame["block"], frame["loads"]):
                counts = np.frombuffer(some, "<i8")
                total[block] = total[block] + counts if block in total else counts
        if total:
            yield pd.DataFrame({"block": list(total), "loads": [t.tobytes() for t in total.values()]})

    rows = summaries.where("block is not null").select("block", "loads")
    # summed within each task first: then a row per block and task is dealt out
    summed = rows.mapInPandas(add, rows.schema).repartition("block").mapInPandas(add, rows.schema)
    loads = np.zeros(LOAD_BUCKETS)
    for row in summed.collect():  # LOAD_BUCKETS numbers in all
        loads[row.block * LOAD_BLOCK:(row.block + 1) * LOAD_BLOCK] += np.frombuffer(row.loads, "<i8")
    return loads


def _prefixes(docs: DataFrame, n: int, percent: int, loads: np.ndarray) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(loads.astype(np.float32))
    floor = float(np.median(loads))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                sets = [s for s in ngram_sets(part.column("text"), n) if len(s)]
                found = [prefix(s, table, floor, percent) for s in sets]
                yield pa.RecordBatch.from_arrays([
                    pa.array([digest(s) for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.array([l for l, _ in found], pa.int32()),
                    pa.array([p.view(np.int64) for _, p in found], pa.list_(pa.int64()))],
                    ["digest", "n", "l", "prefix"])

    return docs.select("text").mapInArrow(run, "digest binary, n int, l int, prefix array<long>")


def _sets(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(vid, grams) of the wanted classes (vid, digest, doc_id), from their documents' texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = [s for s in ngram_sets(part.column("text"), n) if len(s)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([digest(s) for s in sets], pa.binary()),
                    pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())],
                    ["digest", "grams"])

    ids = wanted.select(F.col("doc_id").alias("wanted_id")).distinct()
    texts = docs.join(ids, docs.doc_id.eqNullSafe(ids.wanted_id), "left_semi")
    sets = texts.select("text").mapInArrow(run, "digest binary, grams binary")
    return (sets.join(wanted.select("vid", "digest"), "digest")
            .dropDuplicates(["vid"]).select("vid", "grams"))


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (u, v) whose whole sets link."""
    pairs = written(pairs.select("u", "v"), "jaccard-candidates")
    nodes = pairs.select("u").union(pairs.select("v")).distinct().withColumnRenamed("u", "vid")
    wanted = classes.join(nodes, "vid", "left_semi").select("vid", "digest", "doc_id")
    sets = written(_sets(docs, wanted, n), "jaccard-sets")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("a"), batch.column("b")
            link = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(c[i].as_buffer(), "<u8") for c in (a, b))
                both = len(np.intersect1d(x, y, assume_unique=True))
                link[i] = 100 * both >= percent * (len(x) + len(y) - both)
            yield batch.select(["u", "v"]).filter(pa.array(link))

    first = sets.select(F.col("vid").alias("u"), F.col("grams").alias("a"))
    second = sets.select(F.col("vid").alias("v"), F.col("grams").alias("b"))
    links = pairs.join(second, "v").join(first, "u").select("u", "v", "a", "b")
    return written(links.mapInArrow(run, "u long, v long"), "jaccard-links")


def classes_and_links(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with digest, classes with vid, components of linked classes)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    summaries = written(_summaries(docs, n), "jaccard-summaries")
    loads = _loads(summaries)
    rows = summaries.where("block is null").select("doc_id", "n_ngrams", "digest")
    ids = rows.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    prefixes = (_prefixes(docs, n, percent, loads).groupBy("digest")
                .agg(F.first("n").alias("n"), F.first("l").alias("l"), F.first("prefix").alias("prefix")))
    # numbered once written: the numbers never change on a recomputation
    classes = written(prefixes.join(ids, "digest")
                      .withColumn("vid", F.monotonically_increasing_id()), "jaccard-classes")

    postings = (classes.select("vid", "n", "l", F.posexplode("prefix").alias("pos", "gram"))
                .select("gram", "vid", "n", "l", "pos"))
    same = Window.partitionBy("gram")
    shared = written(postings.withColumn("alike", F.count("*").over(same))
                     .where("alike > 1").drop("alike"), "jaccard-postings")

    found = None  # links so far
    tried = None  # candidates so far
    for centre in (["pos", "vid", "n", "l"], ["vid", "n", "l", "pos"]):
        lists = shared if found is None else _mixed(shared, components(found))
        star = (lists.withColumn("c", F.min(F.struct(*centre)).over(same))
                .select("vid", "n", "l", "pos", *(F.col(f"c.{x}").alias(f"c_{x}") for x in ("vid", "n", "l", "pos")))
                .where((F.col("vid") != F.col("c_vid")) & _fits(percent)))
        pairs = _counted(star.select(F.least("vid", "c_vid").alias("u"), F.greatest("vid", "c_vid").alias("v"),
                                     F.least("l", "c_l").alias("l")))
        found, tried = _extended(found, tried, pairs, docs, classes, n, percent)
    pairs = _counted(_across(_measured(_mixed(shared, components(found)), percent), percent))
    found, _ = _extended(found, tried, pairs, docs, classes, n, percent)
    return rows, classes, components(found)


def _needed(size: Column, percent: int) -> Column:
    """ceil(percent * size / 100)."""
    return F.ceil(F.lit(percent) * size / 100).cast("int")


def _fits(percent: int) -> Column:
    """A posting and its list's centre: sizes can link, both within the prefix of the smaller l."""
    small, large = F.least("n", "c_n"), F.greatest("n", "c_n")
    l = F.least("l", "c_l")
    within = [F.col(f"{c}pos") < F.col(f"{c}n") - _needed(F.col(f"{c}n"), percent) + l for c in ("", "c_")]
    return (F.lit(100) * small >= F.lit(percent) * large) & within[0] & within[1]


def _shared_by(n: Column, m: Column, percent: int) -> Column:
    """Fewest n-grams that linked sets of n and m share."""
    return F.ceil(F.lit(percent) * (n + m) / (100 + percent))


def _measured(lists: DataFrame, percent: int) -> DataFrame:
    """Lists with the l, up to the present one, at which a class costs least with partners of its size:
    a row for each posting that shares a list with it, and a candidate for every l of them."""
    one = Window.partitionBy("vid")
    spare = F.col("n") - F.greatest(_shared_by(F.col("n"), F.col("n"), percent), _needed(F.col("n"), percent))
    others = F.count("*").over(Window.partitionBy("gram")) - 1
    costs = [F.struct((F.coalesce(F.sum(F.when(F.col("pos") < spare + l, F.col("others"))).over(one), F.lit(0))
                       * (1 + VERIFY_COST / l)).alias("cost"), F.lit(l).alias("l")) for l in range(1, MAX_MATCHES + 1)]
    return (lists.withColumn("others", others).withColumn("costs", F.array(*costs))
            .withColumn("l", F.array_min(F.slice("costs", F.lit(1), F.col("l")))["l"]).drop("costs", "others"))


def _across(lists: DataFrame, percent: int) -> DataFrame:
    """(u, v, l) for every n-gram that classes of different components have in common in their
    prefixes for each other's size.

    ``lists``: gram, vid, n, l, pos, root. A side is the size step and l of a class, in one number.
    """
    step = F.greatest(F.lit(1), F.floor(F.pow(F.lit(2.0), F.floor(F.log2("n"))) / SIZE_STEPS).cast("int"))
    side = lists.withColumn("side", (F.col("n") - F.col("n") % step).cast("long") * 16 + F.col("l"))
    # the sides in a list are few: size steps times l
    present = side.groupBy("gram").agg(F.collect_set("side").alias("sides"), F.min("l").alias("least_l"))
    rows = side.join(present, "gram")
    # a class needs l of its n-grams to be in lists of other components
    enough = Window.partitionBy("vid")
    rows = (rows.withColumn("met", F.count("*").over(enough)).withColumn("least_l", F.min("least_l").over(enough))
            .where(F.col("met") >= F.least("l", "least_l")))

    def size(side: Column) -> Column:
        return F.floor(side / 16)

    def fits(other: Column) -> Column:
        own = size(F.col("side"))
        both = F.ceil(F.lit(percent) * (own + size(other)) / (100 + percent))
        l = F.least(F.col("l"), (other % 16).cast("int"))
        # sizes of a step are below twice its least one
        reach = ((F.lit(100) * size(other) * (1 + 2 / SIZE_STEPS) >= F.lit(percent) * F.col("n"))
                 & (F.lit(100) * F.col("n") >= F.lit(percent) * size(other)))
        return reach & (F.col("pos") < F.col("n") - F.greatest(both, _needed(F.col("n"), percent)) + l)

    dealt = (rows.select("gram", "vid", "n", "pos", "root", "side",
                         F.explode(F.filter("sides", fits)).alias("other"))
             .withColumn("low", F.least("side", "other")).withColumn("high", F.greatest("side", "other"))
             .withColumn("l", F.least(F.col("low") % 16, F.col("high") % 16).cast("int")))
    for _ in range(2):  # what is dropped may leave others with too few
        met = Window.partitionBy("gram", "low", "high")
        one = Window.partitionBy("vid", "low", "high")
        dealt = (dealt.withColumn("r0", F.min("root").over(met)).withColumn("r1", F.max("root").over(met))
                 .withColumn("s0", F.min("side").over(met)).withColumn("s1", F.max("side").over(met))
                 .where("r0 < r1 and s0 = low and s1 = high")
                 .withColumn("met", F.count("*").over(one)).where("met >= l"))
    dealt = written(dealt.select("gram", "low", "high", "l", "vid", "n", "pos", "root", "side"), "jaccard-dealt")
    a, b = (dealt.select("gram", "low", "high", *(F.col(c).alias(f"{x}_{c}") for c in ("l", "vid", "n", "pos", "root", "side")))
            for x in ("a", "b"))
    small, large = F.least("a_n", "b_n"), F.greatest("a_n", "b_n")
    both = F.ceil(F.lit(percent) * (F.col("a_n") + F.col("b_n")) / (100 + percent))
    within = [F.col(f"{x}_pos") < F.col(f"{x}_n") - F.greatest(both, _needed(F.col(f"{x}_n"), percent)) + F.col("a_l")
              for x in ("a", "b")]
    return (a.join(b, ["gram", "low", "high"])
            .where((F.col("a_side") == F.col("low")) & (F.col("b_side") == F.col("high"))
                   & ((F.col("low") < F.col("high")) | (F.col("a_vid") < F.col("b_vid")))
                   & (F.col("a_root") != F.col("b_root")) & within[0] & within[1]
                   & (F.lit(100) * small >= F.lit(percent) * large))
            .select(F.least("a_vid", "b_vid").alias("u"), F.greatest("a_vid", "b_vid").alias("v"),
                    F.col("a_l").alias("l")))


def _counted(pairs: DataFrame) -> DataFrame:
    """Pairs with at least l common n-grams within their l-prefixes; a row per common n-gram comes in."""
    return (pairs.groupBy("u", "v").agg(F.count("*").alias("common"), F.first("l").alias("l"))
            .where("common >= l").select("u", "v"))


def _mixed(shared: DataFrame, comps: DataFrame) -> DataFrame:
    """Postings, with their component, of n-grams found in more than one component."""
    same = Window.partitionBy("gram")
    rooted = (shared.join(comps.withColumnRenamed("node", "vid"), "vid", "left")
              .withColumn("root", F.coalesce("root", "vid")))
    return (rooted.withColumn("low", F.min("root").over(same)).withColumn("high", F.max("root").over(same))
            .where("low < high").drop("low", "high"))


def _extended(found, tried, pairs, docs, classes, n, percent):
    new = pairs if tried is None else pairs.join(tried, ["u", "v"], "left_anti")
    new = written(new, "jaccard-new")
    links = _verified(new, docs, classes, n, percent)
    return (links if found is None else found.union(links),
            new if tried is None else tried.union(new))


def _judged(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, digest and root (a component's own number)."""
    rows, classes, comps = classes_and_links(docs, n, percent)
    rooted = (classes.select("vid", "digest", "doc_id")
              .join(comps.withColumnRenamed("node", "vid"), "vid", "left")
              .withColumn("root", F.coalesce("root", "vid")))
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = rooted.join(least, "root").select("digest", "component_id", "root")
    return (rows.join(named, "digest", "left")
            .select("doc_id", F.col("n_ngrams").alias("n_shingles"),
                    F.when(F.col("digest").isNull(), F.col("doc_id"))
                    .otherwise(F.col("component_id")).alias("component_id"), "digest", "root"))


def join(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    component_id: smallest doc_id reachable by links, itself included.
    """
    return _judged(docs, n, percent).drop("digest", "root")


def _with_digests(docs: DataFrame, n: int) -> DataFrame:
    """(row, id, text, own): every row whole, as a struct, beside the digest of its set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = ngram_sets(part.column("text"), n)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([digest(s) for s in sets], pa.binary())], [*part.schema.names, "own"])

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("own", T.BinaryType())]))


def representatives(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the rows of whose component another one stays.

    One row of a component stays: that of the smallest doc_id, and of rows that
    repeat this id within the component the one of the smallest text. Rows that
    repeat an id with other texts are judged each by its own component. Rows with
    an empty set, and rows with a null id, all stay.
    """
    result = written(_judged(docs, n, percent), "jaccard-result")
    repeated = (result.where("doc_id is not null").groupBy("doc_id").count().where("count > 1")
                .select("doc_id"))
    gone = (result.where("component_id < doc_id").select("doc_id").distinct()
            .join(repeated, "doc_id", "left_anti"))
    kept = docs.join(gone, "doc_id", "left_anti")
    if repeated.isEmpty():
        return kept
    # rows of a repeated id: told apart by their sets
    own = _with_digests(kept.join(repeated, "doc_id", "left_semi"), n)
    known = (result.join(repeated, "doc_id", "left_semi").where("digest is not null")
             .select(F.col("doc_id").alias("id"), F.col("digest").alias("own"), "component_id", "root").distinct())
    first = F.row_number().over(Window.partitionBy("root").orderBy(F.asc_nulls_first("text")))
    least = own.join(known.where("component_id = id"), ["id", "own"]).withColumn("nth", first).where("nth = 1")
    empty = own.where("own is null")
    return (kept.join(repeated, "doc_id", "left_anti")
            .unionByName(least.select("row.*")).unionByName(empty.select("row.*")))
