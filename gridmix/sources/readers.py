"""Landed-file readers (yearly exports, feed envelopes) and source queries."""

from __future__ import annotations

import csv
import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gridmix.functions.cleaning import instant, normalize_name
from gridmix.sources.schemas import all_string

# Export file format and the offset used in slice bounds.
CSV_SEPARATOR = ";"
SLICE_OFFSET = "+01:00"
# Missing-value spellings of the export parser.
MISSING_TEXT = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
                "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def _listed(spark: SparkSession, paths: str | list[str]) -> list:
    """States of the files of the given paths (files, folders or globs)."""
    jvm = spark.sparkContext._jvm
    found = []
    for path in [paths] if isinstance(paths, str) else paths:
        pattern = jvm.org.apache.hadoop.fs.Path(path)
        fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        matches = fs.globStatus(pattern) or []
        for status in matches:
            some = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
            found += [s for s in some if s.isFile() and not s.getPath().getName().startswith((".", "_"))]
        if not matches:
            raise FileNotFoundError(path)
    return found


def export_files(spark: SparkSession, paths: str | list[str]) -> list[str]:
    """The files of the given paths; a yearly export is a file."""
    return sorted(s.getPath().toString() for s in _listed(spark, paths))


# Columns of a scanned export beside its own: why a row is rejected, its text, its file.
REASON, RECORD, FILE = "_reason", "_record", "_file"
_QUOTED = '"[^"]*"'     # a quoted part; a doubled quote is two parts side by side
# a field that begins with a quote and does not end on its line
_OPEN = f'(^|{CSV_SEPARATOR})"'


def export_profile(spark: SparkSession, files: list[str]) -> dict[str, tuple[tuple[str, ...], bool, bool]]:
    """Header, whether quoted fields run over lines, and whether a quote stays open, by file.

    One pass over the lines of all files; a file without lines has no entry. A
    row a file comes to the driver, which listed the files.
    """
    lines = spark.read.text(files).select(
        F.col("_metadata.file_path").alias("file"), "value",
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("place"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counted = lines.where(F.trim("value") != "").groupBy("file").agg(
        F.min_by("value", "place").alias("header"), F.sum(quotes).alias("quotes"),
        F.max(F.regexp_like(F.regexp_replace("value", _QUOTED, ""), F.lit(_OPEN))).alias("spans"))
    out = {}
    for row in counted.collect():
        header = next(csv.reader([row["header"].lstrip("\ufeff")], delimiter=CSV_SEPARATOR), [])
        out[row["file"]] = (tuple(header), row["spans"], row["spans"] and row["quotes"] % 2 == 1)
    return out


def _field_count(record: str) -> Column:
    bare = F.regexp_replace(record, _QUOTED, "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(CSV_SEPARATOR), F.lit(""))) + 1


def scan_export(spark: SparkSession, paths: str | list[str], needed: list[str]) -> DataFrame:
    """Rows of yearly ``;``-separated exports by their header names, every column as text.

    Adds ``_reason`` (NULL: a good row), ``_record`` (the text of a row whose
    width differs) and ``_file``. A row with more fields than the header is
    rejected with its text; one with fewer is padded with NULL; a file whose
    last quote stays open is rejected whole, as one row. Doubled quotes and line
    breaks inside quotes are read; only files that have such breaks are scanned
    whole, the others in splits. Files of one header are one parallel scan;
    scans are united by normalised name, so columns may differ in order and
    number between years. A needed column that no header names is an error, as
    are two columns of one normalised name. Missing-value spellings become NULL.
    """
    files = export_files(spark, paths)
    profile = export_profile(spark, files) if files else {}
    groups: dict[tuple[tuple[str, ...], bool], list[str]] = {}
    broken = []
    for file in sorted(profile):
        header, spans, is_open = profile[file]
        if is_open:
            broken.append(file)
        elif header:
            groups.setdefault((header, spans), []).append(file)
    frames = []
    for (header, spans), some in groups.items():
        names = [normalize_name(h.strip()) for h in header]
        lacking = [c for c in needed if c not in names]
        twice = sorted({n for n in names if names.count(n) > 1})
        if lacking or twice:
            raise ValueError(f"{some[0]}: " + (f"no column {', '.join(lacking)}" if lacking
                                               else f"two columns {', '.join(twice)}"))
        scan = (spark.read.option("header", True).option("sep", CSV_SEPARATOR).option("quote", '"')
                .option("escape", '"').option("multiLine", spans).option("mode", "PERMISSIVE")
                .option("columnPruning", False)     # the width of a row shows in all its fields only
                .option("columnNameOfCorruptRecord", RECORD).schema(all_string([*names, RECORD])).csv(some))
        # the length is never negative: the test makes every query read a field beside the record
        wide = (_field_count(RECORD) > len(names)) | (F.length(f"`{names[0]}`") < 0)
        frames.append(scan.withColumns({
            REASON: F.when(F.col(RECORD).isNotNull() & wide,
                           F.concat(F.lit(f"more than {len(names)} fields: "), _field_count(RECORD).cast("string"))),
            FILE: F.col("_metadata.file_path")}))
    if broken:
        rows = [(f, "open quote") for f in broken]      # a row a file
        frames.append(spark.createDataFrame(rows, f"{FILE} string, {REASON} string"))
    if not groups:
        frames.insert(0, spark.createDataFrame([], all_string([*needed, RECORD, REASON, FILE])))
    united = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    own = [c for c in united.columns if c not in (REASON, RECORD, FILE)]
    return united.select(*[F.when(~F.col(f"`{c}`").isin(MISSING_TEXT), F.col(f"`{c}`")).alias(c) for c in own],
                         REASON, RECORD, FILE)


def read_export(spark: SparkSession, paths: str | list[str], needed: list[str]) -> DataFrame:
    """The columns of :func:`scan_export`; an action on it fails at a rejected row."""
    rows = scan_export(spark, paths, needed)
    told = F.concat_ws(": ", FILE, REASON, F.substring(RECORD, 1, 200))
    good = F.when(F.col(REASON).isNull(), True).otherwise(F.raise_error(told).cast("boolean"))
    return rows.where(good).drop(REASON, RECORD, FILE)


def responses(bodies: DataFrame, envelope: StructType) -> DataFrame:
    """``value`` (a whole response) -> ``records`` or a ``reason`` why it has none.

    Rejected, like by a parser that raises: text that is no JSON object (cut
    short, an error page, a list), one without a list ``results``, and one with
    a value that its field can't hold. Other columns are kept.
    """
    schema = StructType([*envelope.fields, StructField(RECORD, StringType())])
    parsed = bodies.withColumn("_parsed", F.from_json("value", schema, {"columnNameOfCorruptRecord": RECORD}))
    body = F.trim(F.regexp_replace("value", "^\ufeff|[\\t\\r\\n]+", " "))
    keys, found = F.json_object_keys("value"), F.col("_parsed.results")
    reason = (F.when(F.col("value").isNull() | (body == ""), "empty")
              .when(keys.isNull() | ~body.endswith("}"), "no JSON object")
              .when(~F.array_contains(keys, "results"), "no results")
              .when(F.col(f"_parsed.{RECORD}").isNotNull() | F.exists(found, lambda r: r.isNull()),
                    "a value that does not fit")
              .when(found.isNull(), "results is no list"))
    return parsed.withColumns({"reason": reason, "records": F.when(reason.isNull(), found)}).drop("_parsed")


def empty_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Landed files without a byte, which Spark's file scans leave out."""
    none = [(None, s.getPath().toString(), s.getModificationTime()) for s in _listed(spark, paths)
            if s.getLen() == 0]
    return spark.createDataFrame(none, "value string, file string, ms long").select(
        "value", "file", F.timestamp_millis("ms").alias("file_time"))


def response_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Landed responses, a row a file: value, file, file_time."""
    return with_origin(spark.read.option("wholetext", True).text(paths)).unionByName(empty_files(spark, paths))


def with_origin(texts: DataFrame) -> DataFrame:
    return texts.select("value", F.col("_metadata.file_path").alias("file"),
                        F.col("_metadata.file_modification_time").alias("file_time"))


def read_feed(spark: SparkSession, paths: str | list[str], envelope: StructType) -> DataFrame:
    """Feed responses ``{"results": [...]}`` -> one row per record; an action on
    it fails at a response that has to be rejected."""
    read = responses(response_files(spark, paths), envelope)
    good = F.when(F.col("reason").isNull(), True).otherwise(
        F.raise_error(F.concat_ws(": ", "file", "reason")).cast("boolean"))
    return read.where(good).select(F.explode("records").alias("r")).select("r.*")


def latest_n(df: DataFrame, n: int, ts: str = "date_heure",
             tie_break: str | None = "_row_key") -> DataFrame:
    """Most recent ``n`` rows (TakeOrderedAndProject: per-task top-n, then merge)."""
    order = [F.col(ts).desc_nulls_last()]
    if tie_break and tie_break in df.columns:
        order.append(F.col(tie_break).desc_nulls_last())
    return df.orderBy(*order).limit(n)


def year_bounds(year: int) -> tuple[str, str]:
    return (f"{year}-01-01T00:00:00{SLICE_OFFSET}", f"{year + 1}-01-01T00:00:00{SLICE_OFFSET}")


def year_slice(df: DataFrame, year: int, ts: str = "date_heure") -> DataFrame:
    """Rows whose instant falls in ``[year, year+1)`` at the source offset."""
    lo, hi = year_bounds(year)
    t = instant(ts)
    return df.filter((t >= F.lit(lo).cast("timestamp")) & (t < F.lit(hi).cast("timestamp")))
