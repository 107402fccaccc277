"""Quality classifier: ordinal cumulative-link regression on hashed text.

P(grade <= g) = sigmoid(threshold[g] - score), with one weight vector for all
grades and ordered thresholds; the score is the sum of the weights of a text's
hashed features: its words, their first 4 and 5 letters, their shapes (case and
punctuation), each once, and how often words repeat. Slots that occur in fewer
than MIN_SLOT_DOCS documents of the sample have no weight.

Fit: on at most SAMPLE rated documents, chosen by a hash of the id. Their
features are a written table; every step of L-BFGS is a Spark job that returns a
gradient per task (its length is bounded by the sample). Scoring covers every
document: expected grade and the probability of the top grade, which selects.

Edge cases: ratings of null id or grade are left out, of several ratings of a
document the lowest counts; with ratings of fewer than two grades there is no
model: grades are null and all documents are kept; a text without words (null,
empty, blank) has grade and probability 0 and is not kept; repeated rows are
scored each; other columns are ignored; long texts are scored whole.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmix.llm.common import slices, words, written

SAMPLE = 16_384        # rated documents to fit on, at most
SLOTS = 1 << 22
MIN_SLOT_DOCS = 20
PENALTY = 2e-4         # of half the squared weights, beside the mean loss
STEPS = 40
TASKS = 8              # of the fit
KEEP = 0.5             # least probability of the top grade

PUNCTUATION = ".,;:!?\"'()[]{}-|"


# --- features ----------------------------------------------------------------

# first values of the hash for words, their first 4 and 5 letters, shapes, shares
WORD, FOUR, FIVE, SHAPE, SHARE = 1, 4, 5, 7, 9


def _slot(feature: str, kind: int) -> int:
    return crc32(feature.encode(), kind) % SLOTS


def word_slots(word: str) -> tuple[int, int, int, int]:
    bare = word.strip(PUNCTUATION)
    low = bare.lower()
    if bare == low:
        case = "a" if bare.isalpha() else "x"
    elif bare.isupper():
        case = "A" if len(bare) > 1 else "T"
    else:
        case = "T" if bare[1:] == low[1:] else "x"
    tail = word[len(word.rstrip(PUNCTUATION)):]
    return (crc32(low.encode(), WORD) % SLOTS, crc32(low[:4].encode(), FOUR) % SLOTS,
            crc32(low[:5].encode(), FIVE) % SLOTS, crc32((case + tail).encode(), SHAPE) % SLOTS)


def features(texts: pa.Array, active: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, number) of every feature of the texts, each once a row, rows ascending; words of each row.

    A number is a slot, or the place of the slot in ``active`` (sorted slots);
    features of other slots are left out then.
    """
    offsets, codes, vocabulary = words(texts)
    n = len(offsets) - 1
    counts = np.diff(offsets)
    size = max(1, len(vocabulary))
    pairs = np.unique(np.repeat(np.arange(n), counts) * size + codes)
    row, code = pairs // size, pairs % size
    found = map(word_slots, vocabulary.to_numpy(zero_copy_only=False).tolist())
    slots = np.fromiter(itertools.chain.from_iterable(found), np.int64, 4 * len(vocabulary)).reshape(-1, 4)
    distinct = np.bincount(row, minlength=n)
    share = np.array([_slot(str(s), SHARE) for s in range(21)])[20 * distinct // np.maximum(counts, 1)]
    number, real = _numbers(slots, active)
    share, real_share = _numbers(share, active)
    chosen = real[code]
    row_of = np.concatenate([np.repeat(row, 4)[chosen.ravel()], np.flatnonzero(real_share)])
    both = np.unique(row_of * SLOTS + np.concatenate([number[code][chosen], share[real_share]]))
    return both // SLOTS, both % SLOTS, counts


def _numbers(slots: np.ndarray, active: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of slots, and which have one."""
    if active is None:
        return slots, np.ones(slots.shape, bool)
    if not len(active):
        return slots, np.zeros(slots.shape, bool)
    at = np.minimum(np.searchsorted(active, slots), len(active) - 1)
    return at, active[at] == slots


# --- the model ----------------------------------------------------------------

@dataclass
class Model:
    active: np.ndarray      # sorted slots
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one fewer than grades

    def grades(self, scores: np.ndarray) -> np.ndarray:
        """Probability of each grade, a row per score."""
        below = _sigmoid(self.thresholds[None, :] - scores[:, None])
        edges = np.concatenate([np.zeros((len(scores), 1)), below, np.ones((len(scores), 1))], axis=1)
        return np.diff(edges, axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def loss_and_gradient(weights: np.ndarray, thresholds: np.ndarray, row: np.ndarray, number: np.ndarray,
                      grade: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Sum over documents of -ln P(grade) and its gradients."""
    n = len(grade)
    score = np.bincount(row, weights[number], minlength=n)
    edges = np.concatenate([[-np.inf], thresholds, [np.inf]])
    high, low = _sigmoid(edges[grade + 1] - score), _sigmoid(edges[grade] - score)
    p = np.maximum(high - low, 1e-300)
    by_score = 1 - high - low
    gradient = np.bincount(number, by_score[row], minlength=len(weights))
    up, down = -high * (1 - high) / p, low * (1 - low) / p
    by_edge = np.bincount(grade + 1, up, minlength=len(edges)) + np.bincount(grade, down, minlength=len(edges))
    return float(-np.log(p).sum()), gradient, by_edge[1:-1]


def minimise(function: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, steps: int,
             memory: int = 8) -> np.ndarray:
    """L-BFGS with a halving line search."""
    value, gradient = function(x)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        direction, alphas = -gradient, []
        for s, y in reversed(moves):
            alphas.append(s @ direction / (y @ s))
            direction = direction - alphas[-1] * y
        if moves:
            s, y = moves[-1]
            direction = direction * (s @ y / (y @ y))
        else:
            direction = direction / max(1.0, float(np.abs(gradient).sum()))
        for (s, y), alpha in zip(moves, reversed(alphas)):
            direction = direction + (alpha - y @ direction / (y @ s)) * s
        slope, rate = float(gradient @ direction), 1.0
        for _ in range(12):
            new_value, new_gradient = function(x + rate * direction)
            if new_value <= value + 1e-4 * rate * slope:
                break
            rate /= 2
        else:
            break
        s, y = rate * direction, new_gradient - gradient
        if y @ s > 1e-12:
            moves = [*moves, (s, y)][-memory:]
        done = value - new_value < 1e-6 * abs(value)
        x, value, gradient = x + s, new_value, new_gradient
        if done:
            break
    return x


# --- Spark jobs ----------------------------------------------------------------

def _sample_features(docs: DataFrame, ratings: DataFrame, sample: int) -> DataFrame:
    """(grade, slots) of the rated documents of the sample."""
    chosen = (ratings.where("doc_id is not null and grade is not null")
              .groupBy("doc_id").agg(F.min("grade").alias("grade"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    # at most ``sample`` rows of two numbers are broadcast
    rated = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
             .select(F.col("grade").cast("int").alias("grade"), "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                row, number, _ = features(part.column("text"))
                ends = np.searchsorted(row, np.arange(part.num_rows + 1))
                slots = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(number.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column("grade"), slots], ["grade", "slots"])

    table = rated.mapInArrow(run, "grade int, slots array<int>")
    return written(table.repartition(TASKS), "rated-features")


def fit(docs: DataFrame, ratings: DataFrame, grades: int, sample: int = SAMPLE, steps: int = STEPS) -> Model | None:
    """Model of ``ratings`` (doc_id, grade from 0 to grades - 1); None with fewer than two grades.

    At most ``steps`` steps: STEPS of them stop short of the least loss, where scores hardly move.
    """
    sc = docs.sparkSession.sparkContext
    table = _sample_features(docs, ratings, sample)
    counts = {r.grade: r["count"] for r in table.groupBy("grade").count().collect()}
    total = sum(counts.values())
    if len(counts) < 2:
        return None
    # bounded: slots of the sample that are in MIN_SLOT_DOCS of its documents
    active = np.array(sorted(r.slot for r in table.select(F.explode("slots").alias("slot")).groupBy("slot")
                             .count().where(F.col("count") >= MIN_SLOT_DOCS).collect()), np.int64)
    kept = sc.broadcast(active)

    def compact(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = (_numbers(slots.astype(np.int64), kept.value) for slots in frame["slots"])
            yield pd.DataFrame({"grade": frame["grade"], "numbers": [n[real].astype(np.int32) for n, real in found]})

    rated = written(table.mapInPandas(compact, "grade int, numbers array<int>"), "rated-numbers")
    # thresholds begin where the grades' shares put them
    shares = np.cumsum([counts.get(g, 0) + 0.5 for g in range(grades)][:-1]) / (total + 0.5 * grades)
    start = np.concatenate([np.zeros(len(active)), np.log(shares / (1 - shares))])

    def evaluate(x: np.ndarray) -> tuple[float, np.ndarray]:
        weights, thresholds = x[:len(active)], x[len(active):]
        if np.any(np.diff(thresholds) <= 0):
            return np.inf, np.zeros_like(x)
        shared = sc.broadcast((weights, thresholds))

        def part(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            w, t = shared.value
            value, gradient = 0.0, np.zeros(len(w) + len(t))
            for frame in frames:
                row = np.repeat(np.arange(len(frame)), frame["numbers"].map(len).to_numpy())
                number = np.concatenate(frame["numbers"].tolist()).astype(np.int64)
                v, g, b = loss_and_gradient(w, t, row, number, frame["grade"].to_numpy())
                value += v
                gradient += np.concatenate([g, b])
            yield pd.DataFrame({"value": [value], "gradient": [gradient.tobytes()]})

        rows = rated.mapInPandas(part, "value double, gradient binary").collect()  # a row per task
        shared.unpersist()
        gradient = sum(np.frombuffer(r.gradient) for r in rows) / total
        gradient[:len(active)] += PENALTY * weights
        return sum(r.value for r in rows) / total + PENALTY / 2 * float(weights @ weights), gradient

    x = minimise(evaluate, start, steps)
    return Model(active, x[:len(active)], x[len(active):])


def score(docs: DataFrame, model: Model | None, keep: float = KEEP) -> DataFrame:
    """Per row: doc_id, expected_grade, tail_prob (of the top grade), kept."""
    if model is None:
        none = F.lit(None).cast("double")
        return docs.select("doc_id", none.alias("expected_grade"), none.alias("tail_prob"),
                           F.lit(True).alias("kept"))
    # its size is bounded by the sample
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                row, number, counts = features(part.column("text"), m.active)
                p = m.grades(np.bincount(row, m.weights[number], minlength=part.num_rows))
                p[counts == 0] = np.eye(p.shape[1])[0]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(p @ np.arange(p.shape[1])), pa.array(p[:, -1]),
                     pa.array((p[:, -1] >= keep) & (counts > 0))],
                    ["doc_id", "expected_grade", "tail_prob", "kept"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, expected_grade double, tail_prob double, kept boolean")


def grades_of_labels(labels: DataFrame) -> DataFrame:
    """Grade 0: poor quality; 1: good but toxic; 2: good and not toxic."""
    return labels.select("doc_id", F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1)
                         .when(F.col("quality") == 1, 2).alias("grade"))
