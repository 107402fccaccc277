"""Column hygiene: name normalisation, 'nan' handling, casts, rounding.

All helpers return Spark ``Column`` expressions (or rename metadata only),
so they stay inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Landing-step name normalisation. Lower-case first, then
# each character of NAME_FROM maps to the character at the same position
# of NAME_TO; the trailing '(' and ')' have no partner and are deleted.
NAME_FROM = " -éèêàô()"
NAME_TO = "__eeeao"

# Fixed value: the only spelling turned into NULL after text coercion.
NAN_TEXT = "nan"

# Wall-clock zone of the source data.
SOURCE_TZ = "Europe/Paris"


def normalize_name(name: str) -> str:
    """Python twin of :func:`normalize_text` for column names (metadata only)."""
    table = {ord(a): b for a, b in zip(NAME_FROM, NAME_TO)}
    table.update({ord(a): None for a in NAME_FROM[len(NAME_TO):]})
    return name.lower().translate(table)


def normalize_text(col: Column | str) -> Column:
    """Same normalisation as a column expression."""
    return F.translate(F.lower(F.col(col) if isinstance(col, str) else col),
                       NAME_FROM, NAME_TO)


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename every column with :func:`normalize_name` (no data touched)."""
    return df.toDF(*[normalize_name(c) for c in df.columns])


def nan_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Replace the exact text ``'nan'`` by NULL in string columns.

    Must run before any numeric cast: ``try_cast('nan' AS DOUBLE)`` is NaN,
    which would survive NOT NULL filters.
    """
    targets = cols or [f.name for f in df.schema.fields
                       if isinstance(f.dataType, StringType)]
    return df.withColumns({c: F.nullif(F.col(c), F.lit(NAN_TEXT)) for c in targets})


def strict_double(col: Column | str) -> Column:
    """Strict cast: under ANSI mode bad text fails the query."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("double")


def lenient_double(col: Column | str) -> Column:
    """Lenient cast: bad text becomes NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast("double")


def lenient_timestamp(col: Column | str) -> Column:
    """Lenient parse to a zone-less timestamp, keeping the text's wall clock."""
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast("timestamp_ntz")


def instant(col: Column | str) -> Column:
    """Parse ISO text with offset to an absolute instant (TIMESTAMP)."""
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast("timestamp")


def wall_clock(instant_col: Column, tz: str = SOURCE_TZ) -> Column:
    """Instant -> zone-less wall clock in ``tz`` (independent of session zone)."""
    return F.convert_timezone(None, F.lit(tz), instant_col.cast("timestamp_ntz"))


def instant_of(wall: Column, tz: str = SOURCE_TZ) -> Column:
    """Zone-less wall clock in ``tz`` -> instant (independent of the session zone).
    A time that a spring change skips is moved on by the change."""
    utc = F.convert_timezone(F.lit(tz), F.lit("UTC"), wall)
    return F.concat(utc.cast("string"), F.lit("Z")).cast("timestamp")


def null_double() -> Column:
    """Typed NULL used to pad columns a source does not have."""
    return F.lit(None).cast("double")


def ntz(text: str) -> Column:
    """Zone-less timestamp literal."""
    return F.lit(text).cast("timestamp_ntz")


def ntz_of(value) -> Column:
    """Zone-less timestamp literal from a Python datetime, independent of the
    session and process time zones (aware values are taken in UTC)."""
    from datetime import timezone
    if value.tzinfo is not None:
        value = value.astimezone(timezone.utc).replace(tzinfo=None)
    return ntz(value.isoformat(sep=" "))


def rnd(col: Column | str, scale: int) -> Column:
    """Round half away from zero, reproducibly across engines.

    Going through ``decimal(20,6)`` removes binary noise before rounding,
    so every engine rounds the same decimal value.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c.cast("decimal(20,6)"), scale).cast("double")
