"""Sinks and table maintenance: partitioned Parquet tables of the session catalog.

* append (K1): a load adds to what is there; staging removes duplicates. Only
  :func:`overwrite_partitions` replaces, for a caller that knows its batch to
  be whole partitions.
* create-if-missing (K2), namespaces (K9), layer naming (K10).
* full refresh (K6): the model is saved as a table of its own and the view that
  bears the model's name is pointed at it, so a failure leaves the old one.
* merge (K3/K4): the partitions that the batch touches are read, merged and
  overwritten dynamically. Spark puts their files in place when the job commits:
  a failure before leaves the table as it was, a replay merges into it again.

Partitions are named by the column ``_part`` (a year, month or day; ``none``
for readings without a usable time). Tables outlive the application where the
catalog does (a metastore); partitioned ones also without, as they are external:
:func:`ensure_table` finds the files of its folder again.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from gridmix.functions.cleaning import ntz_of
from gridmix.operators.upsert import MergeSpec, changed_keys, upsert, upsert_changes

PART = "_part"
NO_VALUE = "none"      # readings without a usable time
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


# ---- names ---------------------------------------------------------------------

def layer_name(custom: str | None, default: str) -> str:
    """Schema naming rule: no custom name -> the default; else the trimmed,
    upper-cased custom name."""
    return default if custom is None else custom.strip().upper()


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a database if there is none; one that lies elsewhere is an error."""
    where = f" LOCATION '{_quoted(location)}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")
    if location:
        fs, path = _folder(spark, location)
        wanted = fs.makeQualified(path).toString()
        found = spark.catalog.getDatabase(name).locationUri
        if found.rstrip("/") != wanted.rstrip("/"):
            raise ValueError(f"database {name} lies in {found}, not in {wanted}")


def _folder(spark: SparkSession, location: str):
    """File system and path of a location."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


# ---- partition values: independent of the session time zone --------------------

def _day(t: Column, instant: bool) -> Column:
    if instant:   # the UTC day of the instant
        return F.date_add(F.lit("1970-01-01").cast("date"),
                          F.floor(F.unix_seconds(t) / 86400).cast("int")).cast("string")
    return F.to_date(t).cast("string")


def partition_value(df: DataFrame, grain: str, ts: str = "date_heure") -> Column:
    """Text naming the partition of a row: a year, a month or a day."""
    kind = dict(df.dtypes)[ts]
    t = F.col(ts).try_cast("timestamp_ntz") if kind == "string" else F.col(ts)
    day = _day(t, instant=kind == "timestamp")
    value = {"day": day, "month": F.substring(day, 1, 7), "year": F.substring(day, 1, 4)}[grain]
    return F.coalesce(value, F.lit(NO_VALUE))


# ---- partitioned tables --------------------------------------------------------

def ensure_table(spark: SparkSession, table: str, schema: StructType, grain: str = "year") -> None:
    """Create an empty table if there is none; an existing one must have this
    grain and these columns. Files that its folder holds already are taken in."""
    if exists(spark, table):
        _fit(spark, table, schema, grain, evolve=False)
        return
    database, name = table.split(".")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    folder = f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{name}"
    spark.sql(f"CREATE TABLE {table} ({columns}, {PART} STRING) USING parquet PARTITIONED BY ({PART}) "
              f"LOCATION '{_quoted(folder)}' TBLPROPERTIES ('grain' = '{grain}')")
    fs, path = _folder(spark, folder)
    if fs.exists(path):
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")


def schema_of(spark: SparkSession, table: str) -> StructType | None:
    """Columns of the table without the partition's; None when there is no table."""
    if not exists(spark, table):
        return None
    return StructType([f for f in spark.table(table).schema if f.name != PART])


def _fit(spark: SparkSession, table: str, schema: StructType, grain: str, evolve: bool) -> list[str]:
    """Columns of the table in order, after adding new ones; raises when layout or types clash."""
    kept_by = spark.sql(f"SHOW TBLPROPERTIES {table} ('grain')").first()["value"]   # one property
    if kept_by != grain:
        raise ValueError(f"{table} is kept by {kept_by}, not by {grain}")
    kept = schema_of(spark, table)
    types = {f.name: f.dataType for f in kept}
    clash = [f.name for f in schema if f.name in types and types[f.name] != f.dataType]
    new = [f for f in schema if f.name not in types]
    if clash or (new and not evolve):
        raise ValueError(f"{table}: columns {clash or [f.name for f in new]} do not fit its schema")
    if new:
        added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({added})")
    return [*types, *[f.name for f in new]]


@contextmanager
def _dynamic(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


def _insert(df: DataFrame, table: str, ts: str, grain: str, mode: str, evolve: bool) -> None:
    spark = df.sparkSession
    ensure = [StructField(f.name, f.dataType, True) for f in df.schema]
    if not exists(spark, table):
        ensure_table(spark, table, StructType(ensure), grain)
    columns = _fit(spark, table, df.schema, grain, evolve)
    rows = df.select(*[F.col(f"`{c}`") if c in df.columns else
                       F.lit(None).cast(schema_of(spark, table)[c].dataType).alias(c) for c in columns],
                     partition_value(df, grain, ts).alias(PART))
    # rows of a partition come together, hot ones are split by size
    with _dynamic(spark):
        rows.hint("rebalance", PART).write.mode(mode).insertInto(table)


def append(df: DataFrame, table: str, ts: str = "date_heure", grain: str = "year") -> None:
    """Append a batch; columns the table lacks are added to it."""
    _insert(df, table, ts, grain, "append", evolve=True)


def overwrite_partitions(df: DataFrame, table: str, ts: str = "date_heure", grain: str = "year",
                         evolve: bool = True) -> None:
    """Replace exactly the partitions present in ``df``: for batches known to
    hold the whole of every partition they touch."""
    _insert(df, table, ts, grain, "overwrite", evolve)


def rewrite(df: DataFrame, table: str, ts: str = "date_heure", grain: str = "year") -> None:
    """Replace the whole table, layout and columns included.

    The rows, which may come from the table itself, are written to a new table
    that then takes the old one's name.
    """
    spark = df.sparkSession
    if not exists(spark, table):
        _insert(df, table, ts, grain, "append", evolve=False)
        return
    new = f"{table}__r{uuid.uuid4().hex[:12]}"
    _insert(df, new, ts, grain, "append", evolve=False)
    old = _location(spark, table)
    spark.sql(f"DROP TABLE {table}")
    spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
    fs, path = _folder(spark, old)
    fs.delete(path, True)


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def read_table(spark: SparkSession, table: str, values: list[str] | None = None) -> DataFrame:
    """The table, or the partitions ``values`` of it, without the partition column."""
    df = spark.table(table)
    if values is not None:
        df = df.where(F.col(PART).isin(values))
    return df.drop(PART) if PART in df.columns else df


def partitions(spark: SparkSession, table: str) -> set[str]:
    return {r["partition"].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}


# ---- full refresh: a table of its own, then the view -----------------------------

KEEP_VERSIONS = 2


def _versions(spark: SparkSession, table: str) -> list[str]:
    """Tables behind the view, oldest first."""
    database, name = table.split(".")
    found = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {database} LIKE '{name}__v*'").collect()]
    return [f"{database}.{n}" for n in sorted(found)]


def full_refresh(df: DataFrame, table: str, keep: int = KEEP_VERSIONS) -> None:
    """Replace the whole model, whatever its columns were.

    Of the tables behind the view the newest ``keep`` stay: readers that began
    on the one before still find their files.
    """
    spark = df.sparkSession
    old = _versions(spark, table)
    number = int(old[-1].rsplit("__v", 1)[1].split("_")[0]) + 1 if old else 1
    new = f"{table}__v{number:09d}_{uuid.uuid4().hex[:8]}"
    try:
        df.write.saveAsTable(new, format="parquet")
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {new}")
        raise
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM {new}")
    for name in [*old, new][:-keep]:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


# ---- merge -----------------------------------------------------------------------

def changes_of(table: str) -> str:
    return f"{table}_changes"


def touched(batch: DataFrame, grain: str, ts: str = "date_heure") -> list[str]:
    """Values of the partitions that hold a row of the batch (one per year or day)."""
    value = partition_value(batch, grain, ts).alias("value")
    return [r["value"] for r in batch.select(value).distinct().collect()]


def merge_into(spark: SparkSession, table: str, batch: DataFrame, spec: MergeSpec,
               loaded_at: datetime, schema: StructType, ts: str = "date_heure",
               grain: str = "year") -> None:
    """Upsert ``batch`` into the table.

    Only partitions holding a batch key are read and rewritten. The list of
    partition values is the only thing brought to the driver. The keys of what
    changes are appended to the table's change log first: a merge that is lost
    after that is replayed and logs them once more, which does no harm.
    """
    ensure_table(spark, table, schema, grain)
    values = touched(batch, grain, ts)
    if not values:
        return
    target = read_table(spark, table, values).select(*schema.fieldNames())
    keys = changed_keys(upsert_changes(target, batch, spec, loaded_at)).withColumn("at", ntz_of(loaded_at))
    keys.write.mode("append").saveAsTable(changes_of(table), format="parquet")
    overwrite_partitions(upsert(target, batch, spec, loaded_at), table, ts, grain, evolve=False)


def rows_without_time(df: DataFrame, ts: str = "date_heure"):
    """Rows whose text time can't be parsed, as a column of a load report."""
    return F.count_if(F.col(ts).try_cast("timestamp_ntz").isNull())
