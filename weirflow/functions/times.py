"""Event-time columns: epoch conversion, window bounds as text, exact ordinals for sorting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the text form of window bounds.
BOUND_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"


def event_time(seconds: Column) -> Column:
    """Event time of a record that carries whole epoch seconds."""
    return F.timestamp_seconds(seconds)


def ntz_micros(ts: Column) -> Column:
    """Epoch microseconds of a zone-less timestamp, whatever the session time zone is."""
    since_epoch = ts - F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    seconds = since_epoch.cast("interval second").cast("decimal(20,6)")
    return (seconds * F.lit(1_000_000)).cast("bigint")


def to_utc_timestamp(ts: Column) -> Column:
    """The instant of a zone-less timestamp read as UTC (streams need this type for watermarks)."""
    return F.timestamp_micros(ntz_micros(ts))


def to_ntz(ts: Column) -> Column:
    """Back from an instant to a zone-less UTC timestamp."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), F.expr("timestamp_ntz'1970-01-01 00:00:00'"))


def ordinal(df: DataFrame, name: str) -> Column:
    """A long that sorts exactly as column ``name`` (timestamp, date or integer) does."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampNTZType):
        return ntz_micros(F.col(name))
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(F.col(name))
    if isinstance(kind, T.DateType):
        return F.unix_date(F.col(name)).cast("bigint")
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.col(name).cast("bigint")
    raise TypeError(f"{name}: {kind.simpleString()} has no exact ordinal")


def widened(df: DataFrame, name: str) -> Column:
    """A numeric column as a sum needs it: integers as bigint, decimals and floats as they are."""
    whole = isinstance(df.schema[name].dataType, (T.ByteType, T.ShortType, T.IntegerType))
    return F.col(name).cast("bigint") if whole else F.col(name)


def bound_text(ts: Column) -> Column:
    """A window bound as text with milliseconds."""
    return F.date_format(ts, BOUND_FORMAT)


def floor_to(value: Column, step: int) -> Column:
    """``value`` rounded down to a multiple of ``step`` (also below zero)."""
    return value - F.pmod(value, F.lit(step))
