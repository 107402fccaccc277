"""Licence scans by canonical digests.

A text is brought to a canonical form: A-Z in lower case, typographic quotes and
dashes and all ASCII punctuation to blanks, copyright lines dropped, equivalent
spellings to one, runs of white space to one blank. The SHA-256 of the whole
canonical text is hash-joined with the digests of known licences.

Known are TEXTS and the full texts of the folder known_licenses, each also up to
"END OF TERMS AND CONDITIONS" and without its heading. For the look-up, lines
that say no more than "all rights reserved" are dropped; the digest returned
keeps them.

A document is scanned as a whole, and each of its lines that holds a mark (one of
a few strings, so chosen that every known text holds one) is scanned as a text of
its own. The known digests are a short fixed table, so the join never moves a text.

Edge cases: a null text has no digest and no licence; an empty or blank text, or
one of copyright lines alone, has the empty canonical form, which is no licence;
repeated rows are scanned each; other columns are ignored by ``scan``; texts are
never cut.

DataFrame functions only.
"""

from __future__ import annotations

import re
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmix.llm.license_texts import TEXTS

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TYPOGRAPHIC = "‘’‚‛“”„«»‐‑‒–—―•· "
# a line that begins, after punctuation, with a copyright mark; newline-delimited
COPYRIGHT_LINE = r"\n[^0-9a-z\n]*(copyright|\(c\)|©)[^\n]*"
PUNCTUATION = r"[\x01-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+"

# variants and the spelling that stands for them (fixed values)
SPELLINGS = [
    ("licence", "license"), ("sub license", "sublicense"), ("acknowledgement", "acknowledgment"),
    ("judgement", "judgment"), ("organis", "organiz"), ("authoris", "authoriz"),
    ("recognis", "recogniz"), ("initialis", "initializ"), ("centre", "center"), ("favour", "favor"),
    ("honour", "honor"), ("programme", "program"), ("whilst", "while"), ("wilful", "willful"),
    ("fulfilment", "fulfillment"), ("non commercial", "noncommercial"), ("per cent", "percent"),
    ("copyright owner", "copyright holder"), ("https ", "http "),
]


def canonical(text: Column) -> Column:
    c = F.translate(text, UPPER + TYPOGRAPHIC, LOWER + " " * len(TYPOGRAPHIC))
    c = F.regexp_replace(F.concat(F.lit("\n"), c), COPYRIGHT_LINE, "\n")
    c = F.trim(F.regexp_replace(c, PUNCTUATION, " "))
    for variant, standard in SPELLINGS:
        c = F.replace(c, F.lit(variant), F.lit(standard))
    return c


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


RESERVED = r"(?im)^[^0-9a-z\n]*all rights reserved[^0-9a-z\n]*$"
END = re.compile(r"END OF TERMS AND CONDITIONS")


def looked_up(text: Column) -> Column:
    """Digest without lines of rights reserved, by which licences are found."""
    return digest(F.regexp_replace(text, RESERVED, ""))


def full_texts() -> dict[str, list[str]]:
    """The folder's licences: whole, up to the end of the terms, each also without its heading."""
    out = {}
    for file in sorted(resources.files("gridmix.llm").joinpath("known_licenses").iterdir(), key=lambda f: f.name):
        whole = file.read_text(encoding="utf-8").strip()
        ends = [whole[:m.end()] for m in END.finditer(whole)][:1]
        parts = [whole, *ends, *(e[:-len("END OF TERMS AND CONDITIONS")] for e in ends)]
        out[file.name.removesuffix(".txt")] = parts + [
            t.partition("\n\n")[2] for t in parts if len(t.partition("\n\n")[0]) < 100 < len(t.partition("\n\n")[2])]
    return out


def all_texts() -> dict[str, list[str]]:
    full = full_texts()
    return {name: TEXTS.get(name, []) + full.get(name, []) for name in {**TEXTS, **full}}


def marks(texts: dict[str, list[str]]) -> list[str]:
    """Strings of which every known text holds one: "licen", or the longest word of a text without it."""
    found = ["licen"]
    for text in (t.translate(str.maketrans(UPPER, LOWER)) for some in texts.values() for t in some):
        # a word that has a spelling variant would not be in every form of the text
        words = [w for w in re.findall("[a-z]+", text) if not any(w in a or a in w or b in w for a, b in SPELLINGS)]
        if not any(m in text for m in found):
            found.append(max(words, key=len) if words else "")
    return found


def known(spark: SparkSession, texts: dict[str, list[str]] | None = None) -> DataFrame:
    """(license_id, digest) of known texts; one id a digest."""
    rows = [(name, text) for name, some in (texts or all_texts()).items() for text in some]
    return (spark.createDataFrame(rows, "license_id string, text string")
            .select("license_id", looked_up(F.col("text")).alias("digest"))
            .groupBy("digest").agg(F.min("license_id").alias("license_id")))


def scan(docs: DataFrame, texts: dict[str, list[str]] | None = None) -> DataFrame:
    """Per row: doc_id, digest, license_id (whole text; null: none), notices.

    notices: the licences of its lines, sorted, each once, joined by commas
    (null: none).
    """
    licences = known(docs.sparkSession, texts)
    some = "|".join(marks(texts or all_texts()))
    hints = F.filter(F.split("text", "\n", -1), lambda line: F.translate(line, UPPER, LOWER).rlike(some))
    text = F.col("text")
    rows = docs.select("doc_id", digest(text).alias("digest"),
                       F.when(text.rlike(RESERVED), looked_up(text)).otherwise(digest(text)).alias("sought"),
                       F.transform(hints, digest).alias("lines"))
    # few digests of lines are left: look them up in one array of the known ones
    names = F.broadcast(licences.groupBy().agg(  # the fixed table of known texts, one row
        F.map_from_entries(F.collect_list(F.struct("digest", "license_id"))).alias("names"))
        .withColumn("one", F.lit(1)))
    found = rows.withColumn("one", F.lit(1)).join(names, "one", "left")
    notices = F.array_sort(F.array_distinct(F.array_compact(
        F.transform("lines", lambda d: F.col("names")[d]))))
    whole = licences.withColumnRenamed("digest", "whole")
    return (found.join(F.broadcast(whole), found.sought == whole.whole, "left")  # the fixed table
            .select("doc_id", "digest", "license_id",
                    F.when(F.size(notices) > 0, F.array_join(notices, ",")).alias("notices")))


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sql_canonical(text: str) -> str:
    c = f"translate({text}, {_sql_text(UPPER + TYPOGRAPHIC)}, {_sql_text(LOWER + ' ' * len(TYPOGRAPHIC))})"
    c = f"regexp_replace(chr(10) || {c}, {_sql_text(COPYRIGHT_LINE)}, chr(10), 'g')"
    c = f"trim(regexp_replace({c}, {_sql_text(PUNCTUATION)}, ' ', 'g'))"
    for variant, standard in SPELLINGS:
        c = f"replace({c}, {_sql_text(variant)}, {_sql_text(standard)})"
    return f"sha256({c})"


def _sql_reserved(text: str) -> str:
    return f"regexp_replace({text}, {_sql_text(RESERVED)}, '', 'g')"


def _sql_rows(texts: dict[str, list[str]]) -> str:
    return ",\n  ".join(f"({_sql_text(name)}, {_sql_text(text)})" for name, some in texts.items() for text in some)


def sql() -> str:
    """The scan of ``documents``; the folder's texts are stated whole and cut in SQL."""
    whole = {name: some[:1] for name, some in full_texts().items()}
    end = "END OF TERMS AND CONDITIONS"
    return f"""
WITH stated(license_id, text) AS (VALUES
  {_sql_rows(TEXTS)}),
folder(license_id, text) AS (VALUES
  {_sql_rows(whole)}),
cut AS (SELECT license_id, text, strpos(text, '{end}') AS until FROM folder),
parts AS (
  SELECT license_id, text FROM cut
  UNION ALL SELECT license_id, substr(text, 1, until + {len(end) - 1}) FROM cut WHERE until > 0
  UNION ALL SELECT license_id, substr(text, 1, until - 1) FROM cut WHERE until > 0),
headed AS (SELECT license_id, text, strpos(text, chr(10) || chr(10)) AS h FROM parts),
bare AS (
  SELECT license_id, substr(text, h + 2) AS text FROM headed
  WHERE h BETWEEN 1 AND 100 AND length(text) - h - 1 > 100),
texts AS (SELECT * FROM stated UNION ALL SELECT * FROM parts UNION ALL SELECT * FROM bare),
known AS (SELECT {_sql_canonical(_sql_reserved('text'))} AS digest, min(license_id) AS license_id
          FROM texts GROUP BY 1),
docs AS (SELECT row_number() OVER () AS k, doc_id, text, {_sql_canonical('text')} AS digest,
                {_sql_canonical(_sql_reserved('text'))} AS sought FROM documents),
lines AS (SELECT k, unnest(string_split(text, chr(10))) AS line FROM docs),
hits AS (
  SELECT k, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notices
  FROM (SELECT k, {_sql_canonical('line')} AS digest FROM lines
        WHERE regexp_matches(translate(line, '{UPPER}', '{LOWER}'), {_sql_text('|'.join(marks(all_texts())))})) l
  JOIN known USING (digest) GROUP BY k)
SELECT doc_id, docs.digest, license_id, notices
FROM docs LEFT JOIN known ON known.digest = docs.sought LEFT JOIN hits USING (k)
"""


SQL = sql()
