"""Site-relative line frequency: drop lines that too many pages of one host share.

For every host the number of pages holding a line (once per page) is divided by
the host's pages; a line is boilerplate of that host when the share exceeds
``max_ratio`` and at least ``min_pages`` pages hold it. Lines are split at \\n and
compared without leading and trailing blanks. Boilerplate lines are dropped and
the rest joined again.

A host's pages hold at most (mean distinct lines per page) / max_ratio lines of
a share above max_ratio, so the array of a host's boilerplate is short whatever
the host's size; texts are never shuffled by line. Lines are counted by two
independent hashes (96 bits) after a partial count in each task.

Edge cases: a null text stays null and has no lines but counts as a page; blank
lines are never boilerplate; pages of a null host are one host; repeated rows
count as pages each; a page of which every line goes has an empty text; columns
named like a helper column are kept, as the helper takes another name.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmix.llm.common import unused, written

MAX_RATIO = 0.1
MIN_PAGES = 5

BLANKS = " \t\r"


def _key(line: Column) -> Column:
    """Blank lines have none."""
    bare = F.trim(line, F.lit(BLANKS))
    return F.when(bare != "", F.struct(F.xxhash64(bare).alias("a"), F.hash(bare).alias("b")))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def boilerplate(pages: DataFrame, host: str, text: str,
                max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(__host, __drop) of each host with boilerplate: the keys of its lines, as an array."""
    rows = pages.select(F.col(host).alias("__host"), F.col(text).alias("__text"))
    totals = rows.groupBy("__host").agg(F.count("*").alias("__pages"))
    keys = F.array_distinct(F.transform(_lines(F.col("__text")), _key))
    counts = (rows.select("__host", F.explode(keys).alias("__key")).where("__key is not null")
              .groupBy("__host", "__key").agg(F.count("*").alias("__with")))
    totals = totals.withColumnRenamed("__host", "__of")
    common = (counts.where(F.col("__with") >= min_pages)
              .join(totals, F.col("__host").eqNullSafe(F.col("__of")))
              .where(F.col("__with") > max_ratio * F.col("__pages")))
    return common.groupBy("__host").agg(F.collect_list("__key").alias("__drop"))


def clean(pages: DataFrame, host: str = "source", text: str = "text",
          max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``pages`` with boilerplate lines dropped from ``text``; adds n_lines, n_dropped (long)."""
    columns = [c for c in pages.columns if c not in ("n_lines", "n_dropped")]
    of, drop, lines, kept = (unused(pages.columns, name) for name in ("__of", "__drop", "__lines", "__kept"))
    # written first: its size is then known, and a small table never makes the texts move
    dropped = (written(boilerplate(pages, host, text, max_ratio, min_pages), "boilerplate")
               .withColumnsRenamed({"__host": of, "__drop": drop}))
    joined = (pages.select(*[F.col(f"`{c}`") for c in columns])
              .join(dropped, F.col(host).eqNullSafe(F.col(of)), "left")
              .withColumn(lines, _lines(F.col(text))))
    rest = F.when(F.col(drop).isNull(), F.col(lines)).otherwise(F.filter(
        F.col(lines),
        lambda line: F.coalesce(~F.array_contains(F.col(drop), _key(line)), F.lit(True))))
    out = joined.withColumn(kept, rest)
    n, left = (F.coalesce(F.size(c), F.lit(0)).cast("long") for c in (lines, kept))
    return (out.withColumn("n_lines", F.when(F.col(text).isNull(), 0).otherwise(n).cast("long"))
            .withColumn("n_dropped", F.when(F.col(text).isNull(), 0).otherwise(n - left).cast("long"))
            .withColumn(text, F.array_join(kept, "\n"))
            .select(*[F.col(f"`{c}`") for c in columns], "n_lines", "n_dropped"))


SQL = f"""
WITH pages AS (
  SELECT doc_id, source, text, row_number() OVER () AS k FROM documents),
lines AS (
  SELECT k, source, i, l, trim(l, ' ' || chr(9) || chr(13)) AS bare
  FROM (SELECT k, source, unnest(string_split(text, chr(10))) AS l,
               generate_subscripts(string_split(text, chr(10)), 1) AS i FROM pages)),
totals AS (SELECT source, count(*) AS n FROM pages GROUP BY source),
common AS (
  SELECT c.source, c.bare
  FROM (SELECT source, bare, count(DISTINCT k) AS n FROM lines WHERE bare <> '' GROUP BY ALL) c
  JOIN totals t ON t.source IS NOT DISTINCT FROM c.source
  WHERE c.n >= {MIN_PAGES} AND c.n > {MAX_RATIO} * t.n),
marked AS (
  SELECT lines.k, i, l, common.bare IS NOT NULL AS gone
  FROM lines LEFT JOIN common
    ON common.source IS NOT DISTINCT FROM lines.source AND common.bare = lines.bare),
texts AS (
  SELECT k, coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text,
         count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped
  FROM marked GROUP BY k)
SELECT p.doc_id, p.source, t.text, coalesce(n_lines, 0)::BIGINT AS n_lines,
       coalesce(n_dropped, 0)::BIGINT AS n_dropped
FROM pages p LEFT JOIN texts t USING (k)
"""
