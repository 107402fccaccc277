"""Quality rules: minimum thresholds, then robust multivariate outliers.

Statistics of every text are counted in one pass. Documents that fail the base
rules (too few words, too many repeated words) are rejected. The others have a
vector of transformed statistics:

    ln(word_chars / n_words)              mean word length
    ln(1 + 100 * n_symbols / n_words)     symbols
    ln(1 + 100 * n_dup_lines / (n_lines + 10))      repeated lines
    ln(1 + 100 * n_repeat_words / (n_words + 100))  repeated words

The shares of repeats are taken as if PRIOR more lines or words without a repeat
stood in the text: a heading said again in a short text stays small, and a long
text's share is about its own.

For every (lang, source) the minimum covariance determinant is estimated over
all its documents: from two deterministic starts (median and MAD; spatial sign
covariance), concentration steps take the share COVERAGE of documents of least
Mahalanobis distance and estimate mean and covariance from them, until the
subsets no longer change (or MAX_STEPS times); the start of the smaller
determinant wins and one reweighting follows. Documents farther than the chi-square quantile CUTOFF are
rejected.

A step is one aggregate: distances are cut into fine bins (64 a factor of two),
rows are counted and summed by group, start and bin (partially in every task),
and a group's few bins give the subset's bound and its moments. So no group is
gathered anywhere, however large. Vectors are fixed-point integers, so that
sums are exact and results do not depend on the order of rows.

A variance gets the square of SCALE_FLOORS added: the resolution below which a
statistic's spread is not evidence. Groups of fewer than MIN_GROUP documents
that pass the base rules are pooled by language; a pool that is still smaller
rejects nothing beyond the base rules.

Edge cases: a null, empty or blank text has no words and fails the base rules;
null lang or source are groups of their own; repeated rows count as rows; other
columns are ignored, or kept by ``filter_documents``, where input columns that
begin with ``__q_`` are not allowed.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmix.llm.common import slices, words, written

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"

COVERAGE = 0.75
MIN_GROUP = 100
MAX_STEPS = 20
TAIL = 1e-9          # share of clean Gaussian vectors beyond the cutoff
REWEIGHT_TAIL = 0.025
SCALE_FLOORS = (0.1, 0.5, 0.5, 0.5)
PRIOR = {"n_lines": 10, "n_words": 100}  # lines and words without a repeat, added to a text's
ONE = 1024           # fixed-point unit of the vectors
BINS = 64            # bins of the squared distance for a factor of two

STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]
DIMS = len(SCALE_FLOORS)
PAIRS = [(i, j) for i in range(DIMS) for j in range(i, DIMS)]
STARTS = ("mad", "sign")


# --- statistics of a text ----------------------------------------------------

def _repeat_words(codes: np.ndarray) -> int:
    """Words within 3-word windows that occur twice or more, the first one included."""
    n = len(codes) - 2
    if n < 2:
        return 0
    _, part = np.unique(codes[:-1].astype(np.int64) << 32 | codes[1:], return_inverse=True)
    _, window, count = np.unique(part[:-1].astype(np.int64) << 32 | codes[2:],
                                 return_inverse=True, return_counts=True)
    twice = count[window] > 1
    inside = np.zeros(n + 2, bool)
    for k in range(3):
        inside[k:n + k] |= twice
    return int(inside.sum())


def _dup_lines(text: str) -> tuple[int, int]:
    """(lines with a word that equal an earlier line, lines with a word)."""
    lines = Counter(text.split("\n"))
    worded = [c for line, c in lines.items() if line.strip(" \t\n\v\f\r")]
    return sum(worded) - len(worded), sum(worded)


def _statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    texts = pc.fill_null(texts, "")
    offsets, codes, vocabulary = words(texts)
    chars = pc.utf8_length(vocabulary).to_numpy(zero_copy_only=False).astype(np.int64)
    sums = np.concatenate(([0], np.cumsum(chars[codes])))
    n = len(texts)
    symbols = np.zeros(n, np.int64)
    for s in SYMBOLS:
        symbols += pc.count_substring(texts, s).to_numpy()
    lines = np.array([_dup_lines(t) for t in texts.to_numpy(zero_copy_only=False).tolist()],
                     np.int64).reshape(n, 2)
    repeats = [_repeat_words(codes[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    return {"n_words": np.diff(offsets), "word_chars": sums[offsets[1:]] - sums[offsets[:-1]],
            "n_symbols": symbols, "n_dup_lines": lines[:, 0], "n_repeat_words": np.array(repeats, np.int64),
            "n_lines": lines[:, 1]}


def statistics(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``docs`` with the STATS of each whole text (long)."""
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    rows = docs.select(*keep, F.col(text).cast("string").alias("__q_text"))
    schema = T.StructType([*(rows.schema[c] for c in keep),
                           *(T.StructField(s, T.LongType()) for s in STATS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "__q_text"):
                found = _statistics(part.column("__q_text"))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), *(pa.array(found[s], pa.int64()) for s in STATS)],
                    [*keep, *STATS])

    return rows.mapInArrow(run, schema)


def base_failed() -> Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def _vector() -> list[Column]:
    """The transformed statistics as fixed-point integers."""
    def share(part: str, whole: str) -> Column:
        return F.log1p(100 * F.col(part) / F.greatest(F.col(whole), F.lit(1)))

    def repeats(part: str, whole: str) -> Column:
        return F.log1p(100 * F.col(part) / (F.col(whole) + PRIOR[whole]))

    values = [F.log(F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1))),
              share("n_symbols", "n_words"), repeats("n_dup_lines", "n_lines"),
              repeats("n_repeat_words", "n_words")]
    return [F.round(v * ONE).cast("long").alias(f"z{i}") for i, v in enumerate(values)]


# --- chi-square with an even number of degrees of freedom ---------------------

def chi2_cdf(x: float, df: int) -> float:
    half, term, total = x / 2, 1.0, 0.0
    for k in range(df // 2):
        total += term
        term *= half / (k + 1)
    return 1 - math.exp(-half) * total


def chi2_quantile(tail: float, df: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if 1 - chi2_cdf(mid, df) > tail else (low, mid)
    return high


def _consistency(share: float) -> float:
    """Factor that makes the covariance of the central ``share`` of a Gaussian consistent."""
    return share / chi2_cdf(chi2_quantile(1 - share, DIMS), DIMS + 2)


# --- minimum covariance determinant ------------------------------------------

GROUP = ["g_lang", "g_source"]
POOL = "pool"  # no name of a source, see _name


def _name(column: str) -> Column:
    """A lang or source as a name that is never null."""
    return F.coalesce(F.concat(F.lit("="), F.col(column)), F.lit("null"))


def _groups(stats: DataFrame) -> DataFrame:
    """Rows that pass the base rules, with their vector and group: (lang, source) or the pool."""
    passed = stats.where(~base_failed()).select(
        _name("lang").alias("g_lang"), _name("source").alias("own"), *_vector())
    sizes = written(passed.groupBy("g_lang", "own").agg(F.count("*").alias("size")), "mcd-sizes")
    small = sizes.where(F.col("size") < MIN_GROUP).select("g_lang", "own", F.lit(POOL).alias("pool"))
    return (passed.join(small, ["g_lang", "own"], "left")
            .select("g_lang", F.coalesce("pool", "own").alias("g_source"),
                    *(f"z{i}" for i in range(DIMS))))


def _joined(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    # plain joins: the estimates are a row or two per group, and AQE sees how large they are
    return rows.join(estimates, GROUP)


def _distance(mean: Column, precision: Column) -> Column:
    """Squared Mahalanobis distance of the fixed-point vector."""
    centred = [F.col(f"z{i}") / F.lit(float(ONE)) - mean[i] for i in range(DIMS)]
    terms = [precision[k] * centred[i] * centred[j] * (1.0 if i == j else 2.0)
             for k, (i, j) in enumerate(PAIRS)]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return F.greatest(total, F.lit(0.0))


def _bin(distance: Column) -> Column:
    return F.floor(F.log2(distance + 2.0 ** -20) * BINS).cast("long")


def _sums() -> list[Column]:
    """Exact moments; decimals, so that no number of rows overflows."""
    first = [F.sum(F.col(f"z{i}").cast("decimal(12,0)")).alias(f"s{i}") for i in range(DIMS)]
    second = [F.sum((F.col(f"z{i}") * F.col(f"z{j}")).cast("decimal(18,0)")).alias(f"s{i}{j}")
              for i, j in PAIRS]
    return [F.count("*").alias("n"), *first, *second]


MOMENTS = ["n", *(f"s{i}" for i in range(DIMS)), *(f"s{i}{j}" for i, j in PAIRS)]


def _moments(sums: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    n = int(sums["n"])
    mean = np.array([float(sums[f"s{i}"]) for i in range(DIMS)]) / n
    cov = np.empty((DIMS, DIMS))
    for i, j in PAIRS:
        # exact integers before the division
        top = n * int(sums[f"s{i}{j}"]) - int(sums[f"s{i}"]) * int(sums[f"s{j}"])
        cov[i, j] = cov[j, i] = top / (n * n)
    return mean / ONE, cov / (ONE * ONE)


def _estimate(mean: np.ndarray, cov: np.ndarray) -> dict:
    cov = cov + np.diag(np.square(SCALE_FLOORS))
    inverse = np.linalg.inv(cov)
    return {"mean": mean.tolist(), "precision": [float(inverse[i, j]) for i, j in PAIRS],
            "log_det": float(np.linalg.slogdet(cov)[1])}


def _starts(rows: DataFrame) -> DataFrame:
    """Estimates of every group from both starts."""
    z = [f"z{i}" for i in range(DIMS)]
    # a row per group, written: the joins know its size and leave the rows where they are
    middle = written(rows.groupBy(*GROUP).agg(*(F.percentile(c, F.lit(0.5)).alias(f"m_{c}") for c in z)),
                     "mcd-medians")
    near = _joined(rows, middle)
    spread = written(near.groupBy(*GROUP).agg(*(F.first(f"m_{c}").alias(f"m_{c}") for c in z), *(
        F.percentile(F.abs(F.col(c) - F.col(f"m_{c}")), F.lit(0.5)).alias(f"d_{c}") for c in z)), "mcd-spreads")

    def scale(i: int) -> Column:
        mad = 1.4826 * F.col(f"d_z{i}")
        return F.sqrt(mad * mad + (SCALE_FLOORS[i] * ONE) ** 2)

    scaled = [(F.col(c) - F.col(f"m_{c}")) / scale(i) for i, c in enumerate(z)]
    norm = F.sqrt(sum((c * c for c in scaled[1:]), scaled[0] * scaled[0]))
    signed = (_joined(rows, spread)
              .select(*GROUP, *(f"m_{c}" for c in z), *(scale(i).alias(f"c{i}") for i in range(DIMS)),
                      *(F.when(norm > 0, F.round(c / norm * ONE)).otherwise(0).cast("long").alias(f"z{i}")
                        for i, c in enumerate(scaled)))
              .groupBy(*GROUP).agg(*_sums(), *(F.first(f"m_{c}").alias(f"m_{c}") for c in z),
                                   *(F.first(f"c{i}").alias(f"c{i}") for i in range(DIMS))))

    def estimate(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, row in frame.iterrows():
            mean = np.array([float(row[f"m_{c}"]) for c in z]) / ONE
            scales = np.array([float(row[f"c{i}"]) for i in range(DIMS)]) / ONE
            # eigenvectors of the sign covariance, in units of the scales
            sign = np.empty((DIMS, DIMS))
            for i, j in PAIRS:
                sign[i, j] = sign[j, i] = float(row[f"s{i}{j}"]) / ONE ** 2 / int(row["n"])
            shape = sign * DIMS / max(np.trace(sign), 1e-9)
            for start, cov in (("mad", np.diag(scales ** 2)), ("sign", shape * np.outer(scales, scales))):
                out.append({"g_lang": row["g_lang"], "g_source": row["g_source"], "start": start,
                            "size": int(row["n"]), **_estimate(mean, cov), "subset": ""})
        return pd.DataFrame(out, columns=COLUMNS)

    return _each(signed, estimate)


ESTIMATES = ("g_lang string, g_source string, start string, size long, mean array<double>, "
             "precision array<double>, log_det double, subset string")
COLUMNS = [field.split()[0] for field in ESTIMATES.split(", ")]


def _each(small: DataFrame, function) -> DataFrame:
    """Apply ``function`` to the few rows of each group and cut the lineage."""
    return written(small.groupBy(*GROUP).applyInPandas(lambda frame: function(frame), ESTIMATES),
                   "mcd-estimates")


def _step(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """One concentration step of every group and start."""
    near = _joined(rows, estimates)
    bins = (near.withColumn("bin", _bin(_distance(F.col("mean"), F.col("precision"))))
            .groupBy(*GROUP, "start", "size", "bin").agg(*_sums()))

    def concentrate(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for start, part in frame.groupby("start", sort=True):
            part = part.sort_values("bin")
            size = int(part["size"].iloc[0])
            upto = int(np.searchsorted(part["n"].cumsum().to_numpy(), math.ceil(COVERAGE * size))) + 1
            inside = part.iloc[:upto]
            sums = inside[MOMENTS].sum()
            mean, cov = _moments(sums)
            cov = cov * _consistency(min(1 - 1e-9, int(sums["n"]) / size))
            out.append({"g_lang": part["g_lang"].iloc[0], "g_source": part["g_source"].iloc[0],
                        "start": start, "size": size, **_estimate(mean, cov),
                        "subset": " ".join(str(int(sums[m])) for m in MOMENTS)})
        return pd.DataFrame(out, columns=COLUMNS)

    return _each(bins, concentrate)


def mcd(stats: DataFrame) -> DataFrame:
    """(g_lang, g_source, mean, precision) of every group or pool of MIN_GROUP documents or more.

    ``stats``: lang, source and STATS.
    """
    rows = written(_groups(stats), "mcd-vectors")
    estimates = _starts(rows).where(F.col("size") >= MIN_GROUP)
    state = None
    for _ in range(MAX_STEPS):
        estimates = _step(rows, estimates)
        now = estimates.agg(F.count("*"), F.sum(F.hash("g_lang", "g_source", "start", "subset").cast("long"))).first()
        if now == state:  # every subset is as it was
            break
        state = now
    best = Window.partitionBy(*GROUP).orderBy("log_det", "start")
    raw = estimates.withColumn("nth", F.row_number().over(best)).where("nth = 1").drop("nth")
    within = chi2_quantile(REWEIGHT_TAIL, DIMS)
    near = _joined(rows, raw)
    central = (near.where(_distance(F.col("mean"), F.col("precision")) <= within)
               .groupBy(*GROUP, "start", "size").agg(*_sums()))

    def reweight(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, row in frame.iterrows():
            mean, cov = _moments(row)
            out.append({"g_lang": row["g_lang"], "g_source": row["g_source"], "start": row["start"],
                        "size": int(row["size"]),
                        **_estimate(mean, cov * _consistency(1 - REWEIGHT_TAIL)), "subset": ""})
        return pd.DataFrame(out, columns=COLUMNS)

    return _each(central, reweight).select(*GROUP, "mean", "precision")


def _verdict(stats: DataFrame, estimates: DataFrame) -> DataFrame:
    """``stats`` with base_failed, distance (null: none) and kept."""
    own = estimates.where(F.col("g_source") != POOL).select(
        "g_lang", "g_source", F.col("mean").alias("__own_mean"), F.col("precision").alias("__own_precision"))
    pool = estimates.where(F.col("g_source") == POOL).select(
        "g_lang", F.col("mean").alias("__pool_mean"), F.col("precision").alias("__pool_precision"))
    z = dict(zip((f"z{i}" for i in range(DIMS)), _vector()))
    mean = F.coalesce("__own_mean", "__pool_mean")
    precision = F.coalesce("__own_precision", "__pool_precision")
    found = (stats.withColumn("g_lang", _name("lang")).withColumn("g_source", _name("source"))
             .join(own, GROUP, "left").join(pool, "g_lang", "left")
             .withColumn("base_failed", base_failed()).withColumns(z)
             .withColumn("distance", F.when(~F.col("base_failed"), _distance(mean, precision))))
    far = chi2_quantile(TAIL, DIMS)
    return (found.withColumn("kept", ~F.col("base_failed")
                             & F.coalesce(F.col("distance") <= far, F.lit(True)))
            .select(*stats.columns, "base_failed", "distance", "kept"))


def verdicts(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, lang, source, STATS, base_failed, distance, kept."""
    stats = written(statistics(docs, keep=["doc_id", "lang", "source"]), "quality-statistics")
    return _verdict(stats, mcd(stats))


def filter_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns."""
    stats = written(statistics(docs, keep=["lang", "source"]), "quality-statistics")
    estimates = mcd(stats)
    # texts stay where they are: their statistics are counted again beside them
    packed = docs.select(F.struct(*docs.columns).alias("__q_row"), "lang", "source",
                         F.col("text").alias("__q_body"))
    judged = _verdict(statistics(packed, text="__q_body"), estimates)
    return judged.where("kept").select("__q_row.*")
