"""Real-time feed ingestion with Structured Streaming.

The hourly "fetch the latest 100 records and MERGE" job becomes a file
stream over landed API responses (``{"results": [...]}``), processed with
``trigger(availableNow=True)`` on the same cadence. The checkpoint records
which files were processed, replacing the overlapping re-read; each
micro-batch is merged into the raw table by key. Every batch is merged, also
one that was merged before a failure or comes again under a renewed checkpoint:
a keyed row is merged to the same result, and one without a key is inserted
again, as the source's MERGE does when a run is retried.

A response that can't be read goes to the quarantine table with its file and the
reason, and the run reports failure (:func:`run_feed`). The next run tries the
files in quarantine again, so one that was mended is loaded.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from gridmix.functions.cleaning import instant, ntz_of
from gridmix.operators.upsert import NATIONAL_FEED, REGIONAL_FEED, MergeSpec
from gridmix.sources import readers, sinks
from gridmix.sources.schemas import (NATIONAL_RT_MEASURES, REGIONAL_RT_MEASURES, feed_envelope,
                                     national_realtime_table, regional_realtime_table)
from gridmix.streaming.windows import STEP, half_hour_stats

# Fixed value: how late a reading may arrive and still update its window.
WATERMARK = "2 hours"
# Real-time tables are partitioned by day: an hourly merge rewrites only the
# one or two days its batch touches.
FEED_GRAIN = "day"
# Files of one micro-batch: a long backlog is merged in several.
MAX_FILES = 1000
# Which of two deliveries of a key came last: the later file, then the later
# name among files of one time, then the later position in the response. A
# replayed micro-batch orders them alike.
ARRIVAL = ("_file_time", "_file", "_position")

# Quarantine: what became of a file, by the last row of it.
REJECTED, LOADED, WITHDRAWN = "rejected", "loaded", "withdrawn"
QUARANTINE = "file string, file_time timestamp, reason string, body string, status string, at timestamp_ntz"


class RejectedResponses(RuntimeError):
    """Some landed responses could not be read; the others were merged."""


def feed_schema(regional: bool) -> StructType:
    """Schema of a raw real-time table; times are instants."""
    return regional_realtime_table(True) if regional else national_realtime_table(True)


def envelope_of(regional: bool) -> StructType:
    return feed_envelope(REGIONAL_RT_MEASURES if regional else NATIONAL_RT_MEASURES, regional)


def landed(spark: SparkSession, landing_dir: str, max_files: int = MAX_FILES) -> DataFrame:
    """Streaming DataFrame of landed responses, a row a file."""
    return readers.with_origin(spark.readStream.format("text").option("wholetext", True)
                               .option("maxFilesPerTrigger", max_files).load(landing_dir))


def feed_records(read: DataFrame) -> DataFrame:
    """Records of the responses that could be read, with what orders their arrival.

    The ISO time with offset is kept as an instant, so the two readings of a
    repeated autumn hour stay distinct keys (staging turns instants into Paris
    wall clock)."""
    recs = read.where("reason IS NULL").select(
        F.posexplode("records").alias("_position", "r"), F.col("file_time").alias("_file_time"),
        F.col("file").alias("_file"))
    return recs.select("r.*", *ARRIVAL).withColumn("date_heure", instant("date_heure"))


def _utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _note(rows: DataFrame, table: str, status: str) -> None:
    """Append rows (file, file_time, reason, value) to the quarantine table."""
    (rows.select("file", "file_time", "reason", F.col("value").alias("body"), F.lit(status).alias("status"),
                 ntz_of(_utc_now()).alias("at"))
     .write.mode("append").saveAsTable(quarantine_of(table), format="parquet"))


def quarantine_of(table: str) -> str:
    return f"{table}_quarantine"


def open_rejections(spark: SparkSession, table: str) -> DataFrame:
    """Files in quarantine whose last state is ``rejected``."""
    if not sinks.exists(spark, quarantine_of(table)):
        return spark.createDataFrame([], QUARANTINE)
    last = Window.partitionBy("file").orderBy(F.col("at").desc(), F.col("file_time").desc(), "status")
    return (spark.table(quarantine_of(table)).withColumn("_n", F.row_number().over(last))
            .where(F.col("_n") == 1).drop("_n").where(F.col("status") == REJECTED))


def merge_responses(spark: SparkSession, table: str, files: DataFrame, spec: MergeSpec,
                    regional: bool) -> None:
    """Merge what can be read of ``files`` (value, file, file_time); note the rest."""
    # read several times (touched partitions, merge, rejections): kept for this batch, then released
    read = readers.responses(files, envelope_of(regional)).persist()
    try:
        records = feed_records(read)
        if not records.isEmpty():
            sinks.merge_into(spark, table, records, replace(spec, arrival=ARRIVAL), _utc_now(),
                             feed_schema(regional), grain=FEED_GRAIN)
        bad = read.where("reason IS NOT NULL")
        if not bad.isEmpty():
            _note(bad, table, REJECTED)
    finally:
        read.unpersist()


def ingest_feed(spark: SparkSession, landing_dir: str, table: str, checkpoint: str,
                regional: bool = False, available_now: bool = True,
                max_files: int = MAX_FILES) -> StreamingQuery:
    """Start the feed ingestion; with ``available_now`` it stops when the
    landed files are processed (the hourly run)."""
    spec = REGIONAL_FEED if regional else NATIONAL_FEED

    def run(batch: DataFrame, _: int) -> None:
        merge_responses(spark, table, batch, spec, regional)

    w = landed(spark, landing_dir, max_files).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 hour")
    return w.start()


def retry_rejected(spark: SparkSession, table: str, regional: bool = False, max_files: int = MAX_FILES) -> None:
    """Read the files in quarantine again: a mended one is merged and noted as
    loaded, one that is gone as withdrawn; the others stay as they are."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    spec = REGIONAL_FEED if regional else NATIONAL_FEED
    # the stream listed these names on the driver too; a block of them at a time is worked on
    names = [r["file"] for r in open_rejections(spark, table).select("file").orderBy("file").collect()]
    for begin in range(0, len(names), max_files):
        some = names[begin:begin + max_files]
        paths = {n: jvm.org.apache.hadoop.fs.Path(n) for n in some}
        there = [n for n, p in paths.items() if p.getFileSystem(conf).exists(p)]
        gone = open_rejections(spark, table).where(F.col("file").isin([n for n in some if n not in there]))
        if len(there) < len(some):
            _note(gone.withColumn("value", F.col("body")), table, WITHDRAWN)
        if there:
            files = readers.response_files(spark, there)
            mended = readers.responses(files, envelope_of(regional)).where("reason IS NULL").persist()
            try:
                if not mended.isEmpty():
                    merge_responses(spark, table, mended.select("value", "file", "file_time"), spec, regional)
                    _note(mended.withColumn("value", F.lit(None).cast("string")), table, LOADED)
            finally:
                mended.unpersist()


def run_feed(spark: SparkSession, landing_dir: str, table: str, checkpoint: str, regional: bool = False,
             max_files: int = MAX_FILES) -> None:
    """One hourly run: files in quarantine again, then all new ones. Raises
    :class:`RejectedResponses` at its end while any file stays rejected."""
    retry_rejected(spark, table, regional, max_files)
    ingest_feed(spark, landing_dir, table, checkpoint, regional, max_files=max_files).awaitTermination()
    # the stream ticks files without a byte off unseen
    known = open_rejections(spark, table).select("file")
    empty = readers.empty_files(spark, landing_dir).join(known, "file", "left_anti")
    if not empty.isEmpty():
        _note(readers.responses(empty, envelope_of(regional)), table, REJECTED)
    rejected = open_rejections(spark, table)
    n = rejected.count()
    if n:
        told = "; ".join(f"{r['file']}: {r['reason']}" for r in rejected.orderBy("file").limit(10).collect())
        raise RejectedResponses(f"{n} responses rejected: {told}")


def half_hour_stream(stream: DataFrame, ts: str, value: str) -> DataFrame:
    """Streaming half-hour statistics, finalised once the watermark passes.

    Watermarks need an instant type, so the zone-less time is cast to an
    instant in the session zone for the event-time logic and cast back on
    output (an identity for every wall-clock time that exists in that zone;
    the library session runs in UTC).
    """
    ev = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    out = half_hour_stats(ev.withWatermark(ts, WATERMARK), ts, value)
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")) \
        .withColumn("window_end", F.col("window_end").cast("timestamp_ntz"))


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A file stream over one table file. File stream sources list a folder
    or a glob, so the single file is addressed by a one-file glob."""
    import os
    path = os.path.join(sf_dir, f"{name}.parquet")
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).parquet(path[:-1] + "[" + path[-1] + "]")


def source_state(spark: SparkSession, path: str) -> str:
    """Path, sizes and times of a source's files: another text once it is replaced."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = sorted(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}" for f in fs.listStatus(hpath))
    return "\n".join([path, *files])


def run_available_now(result: DataFrame, name: str, source_key: str) -> DataFrame:
    """Run a streaming result to completion (``availableNow``) into a Parquet
    folder under the shared checkpoint directory, with its checkpoint next to
    it, and return the written rows as a batch DataFrame.

    The folder is fixed per (``name``, ``source_key``) and application: a
    repeated call finds its files already processed, so calls do not pile up
    folders. A source whose key has changed (see :func:`source_state`) is read
    anew.
    """
    import hashlib
    import os
    from gridmix.session import checkpoint_dir
    spark = result.sparkSession
    tag = hashlib.sha1(source_key.encode()).hexdigest()[:12]
    base = os.path.join(checkpoint_dir(spark), f"{name}-{tag}")
    q = (result.writeStream.outputMode("append").format("parquet")
         .option("path", os.path.join(base, "out"))
         .option("checkpointLocation", os.path.join(base, "checkpoint"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(result.schema).parquet(os.path.join(base, "out"))


__all__ = ["feed_records", "ingest_feed", "merge_responses", "run_feed", "retry_rejected", "half_hour_stream", "table_stream",
           "run_available_now", "source_state", "STEP", "WATERMARK"]
