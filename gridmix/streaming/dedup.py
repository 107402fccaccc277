"""Overlapping deliveries, each row once: keyed streaming state with a watermark.

The hourly poll asks for the latest records and so delivers most of them several
times. :func:`once` lets the first delivery of a key pass and drops the others
for as long as the watermark keeps the key; state survives a restart by the
checkpoint. A row that is older than the watermark when it first comes would be
dropped as late, so the delay has to cover a whole delivery: then rows of one
delivery may come in any order and in any number of micro-batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WEEK = 7 * 86400
DAY = 86400


def once(stream: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """Rows of ``stream`` without those whose ``keys`` came before within ``delay`` of event time.

    ``ts`` is a zone-less time; watermarks need an instant, so it is one in the
    session's zone in between (the library's sessions run in UTC).
    """
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    return timed.dropDuplicatesWithinWatermark(keys).withColumn(ts, F.col(ts).cast("timestamp_ntz"))


def deliver(rows: DataFrame, folder: str, ts: str, step: int = WEEK, overlap: int = DAY) -> list[int]:
    """Land ``rows`` as polls would: a delivery per ``step`` seconds, which begins ``overlap`` seconds early.

    Deliveries are written one after the other, so their files' times keep their
    order; one that is there already is left. Returns their numbers.
    """
    at = F.unix_seconds(F.col(ts).cast("timestamp"))
    number = F.floor(at / step)
    again = at >= (number + 1) * step - overlap
    polled = rows.where(F.col(ts).isNotNull()).withColumn(
        "_delivery", F.explode(F.when(again, F.array(number, number + 1)).otherwise(F.array(number))))
    numbers = sorted(r[0] for r in polled.select("_delivery").distinct().collect())    # one per step of time
    for n in numbers:
        (polled.where(F.col("_delivery") == n).drop("_delivery")
         .write.mode("ignore").parquet(f"{folder}/poll={n}"))
    return numbers
