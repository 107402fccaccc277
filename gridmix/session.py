"""Spark session and shared-storage helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. AQE re-plans joins and coalesces shuffle
# partitions at run time; skew-join splitting covers hot keys in the
# upsert join; the session time zone only affects instant <-> text
# conversions, which the library keeps explicit anyway.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # merges checkpoint their rows to the shared folder; drop those files once
    # the checkpointed data is no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(app: str = "gridmix", master: str | None = None,
              shuffle_partitions: int | None = None,
              extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    ``master`` and ``shuffle_partitions`` are for local runs and tests; on a
    cluster leave them unset so the submit-time settings win.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and staged writes.

    Uses the cluster's ``spark.checkpoint.dir`` (or a directory already set
    on the context). When neither is set, a local session gets a fresh scratch
    folder; on a cluster, where executors share no local folder, that is an
    error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="gridmix-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared folder and read back: several
    consumers read the table instead of repeating its plan."""
    path = f"{checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
