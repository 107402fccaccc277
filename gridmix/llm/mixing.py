"""Mixing sources to target weights by Poisson replication.

A source of n_s documents whose target share of the mixture is w_s is to be
repeated w_s * N / n_s times on average (N: documents of the mixture, by default
as many as come in). Every document draws a uniform number from the hash of its
id and a seed, and the Poisson distribution of that mean is inverted at it: the
number of copies, which may be 0. The copies are put in one global random order
by a hash of id, copy and seed.

Only sources are grouped (a count each, summed in every task first); the
documents meet the short table of cumulative probabilities by a join, and the
order is a range partition by a hash, which no source can skew. A draw depends
on id, seed and rate alone, so a lost task is repeated with the same result.

Edge cases: a null source is a source; a null id draws like the empty string;
rows of one id and source have the same number of copies and lie in any order
among themselves; sources without a given target have weight 0 and vanish; a
source named in the targets without documents is left out and the remaining
targets are rescaled; null or empty texts are documents like others; input
columns named like the outputs are replaced, those named like a helper column are
kept, as the helper takes another name.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmix.llm.common import unused, written

SEED = 20240229
TEMPERATURE = 0.5  # default targets: share proportional to documents ** TEMPERATURE
DRAW_BITS = 52


def _draw(*parts: Column) -> Column:
    """Hash of the parts as hexadecimal digits."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.md5(text)


def uniform(doc_id: Column, seed: int) -> Column:
    """Uniform on [0, 1), a multiple of 2 ** -52."""
    digits = F.substring(_draw(doc_id, F.lit(seed)), 1, DRAW_BITS // 4)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(1 << DRAW_BITS))


def rates(docs: DataFrame, source: str = "source", targets: dict[str, float] | None = None,
          total: int | None = None, temperature: float = TEMPERATURE) -> DataFrame:
    """(__source, __rate, __cdf) per source; __cdf: P(copies <= k) for k = 0, 1, ..."""
    counts = docs.groupBy(F.col(source).alias("__source")).agg(F.count("*").alias("n"))
    if targets is None:
        weighted = counts.withColumn("w", F.pow(F.col("n").cast("double"), F.lit(temperature)))
    else:
        given = F.create_map(*[F.lit(x) for pair in targets.items() for x in pair]) if targets else None
        weight = F.element_at(given, F.coalesce("__source", F.lit(""))) if targets else F.lit(None)
        weighted = counts.withColumn("w", F.coalesce(weight.cast("double"), F.lit(0.0)))
    size = F.lit(float(total)) if total is not None else F.col("all_n").cast("double")
    everything = Window.partitionBy()  # a row per source
    rated = (weighted.withColumn("all_w", F.sum("w").over(everything))
             .withColumn("all_n", F.sum("n").over(everything)).where("w > 0")
             .select("__source", (F.col("w") / F.col("all_w") * size / F.col("n")).alias("__rate")))
    # beyond this many copies the probability is below 2 ** -52
    most = F.ceil(F.col("__rate") + 12 * F.sqrt("__rate") + 40).cast("int")
    start = F.struct((-F.col("__rate")).alias("log_p"), F.exp(-F.col("__rate")).alias("sum"),
                     F.array(F.exp(-F.col("__rate"))).alias("cdf"))

    def step(acc: Column, k: Column) -> Column:
        log_p = acc["log_p"] + F.log("__rate") - F.log(k.cast("double"))
        total_p = acc["sum"] + F.exp(log_p)
        return F.struct(log_p.alias("log_p"), total_p.alias("sum"),
                        F.concat(acc["cdf"], F.array(total_p)).alias("cdf"))

    return rated.withColumn("__cdf", F.aggregate(F.sequence(F.lit(1), most), start, step)["cdf"])


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source",
        targets: dict[str, float] | None = None, total: int | None = None,
        temperature: float = TEMPERATURE, seed: int = SEED) -> DataFrame:
    """Copies of ``docs`` in global random order; adds copy (long, from 1) and shuffle_key."""
    columns = [c for c in docs.columns if c not in ("copy", "shuffle_key")]
    of, rate, cdf, u, n = (unused(docs.columns, name) for name in ("__source", "__rate", "__cdf", "__u", "__n"))
    # written first: its size is then known, and a small table never makes the texts move
    table = (written(rates(docs, source, targets, total, temperature), "mixing-rates")
             .withColumnsRenamed({"__source": of, "__rate": rate, "__cdf": cdf}))
    kept = [F.col(f"`{c}`") for c in columns]
    drawn = (docs.select(*kept).join(table, F.col(source).eqNullSafe(F.col(of)))
             .withColumn(u, uniform(F.col(doc_id), seed))
             .withColumn(n, F.size(F.filter(cdf, lambda c: c <= F.col(u))).cast("long"))
             .where(F.col(n) > 0))
    copies = drawn.select(*kept, F.explode(F.sequence(F.lit(1).cast("long"), F.col(n))).alias("copy"))
    key = _draw(F.col(doc_id), F.col("copy"), F.lit(seed))
    return copies.withColumn("shuffle_key", key).orderBy("shuffle_key")


SQL = f"""
WITH counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
weights AS (SELECT source, n, pow(n::DOUBLE, {TEMPERATURE}) AS w FROM counts),
rates AS (
  SELECT source, w / (SELECT sum(w) FROM weights) * (SELECT sum(n) FROM weights)::DOUBLE / n AS rate
  FROM weights),
steps AS (
  SELECT source, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 40)::BIGINT + 1)) AS k FROM rates),
cdf AS (
  SELECT source, k, sum(exp(-rate + k * ln(rate) - lgamma(k + 1)))
                      OVER (PARTITION BY source ORDER BY k) AS c
  FROM steps),
drawn AS (
  SELECT doc_id, source, text,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':{SEED}'), 1, 13))::BIGINT
           / {1 << DRAW_BITS}::DOUBLE AS u
  FROM documents),
counted AS (
  SELECT doc_id, drawn.source, text, count(*) FILTER (c <= u) AS n
  FROM drawn JOIN cdf ON cdf.source IS NOT DISTINCT FROM drawn.source
  GROUP BY ALL),
copies AS (SELECT doc_id, source, text, unnest(range(1, n + 1)) AS copy FROM counted)
SELECT doc_id, source, text, copy,
       md5(coalesce(doc_id::VARCHAR, '') || ':' || copy || ':{SEED}') AS shuffle_key
FROM copies
"""
