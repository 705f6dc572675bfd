"""Time helpers as JVM-side column expressions.

The canonical ``timestamp`` column may be ``TIMESTAMP`` (CSV input, session
time zone) or ``TIMESTAMP_NTZ`` (Parquet written without a zone).  All ordering
and frame arithmetic is done on an integral epoch-microsecond key so the same
window / range frames work for both and are independent of the session zone
for NTZ input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICROS_PER_SECOND = 1_000_000
# Optional column: seconds east of UTC that a time was written with; NULL for a time without an offset.
OFFSET = "utc_offset"
LONG_MAX = 9_223_372_036_854_775_807
LONG_MIN = -9_223_372_036_854_775_808

def epoch_micros(df: DataFrame, col: str = "timestamp") -> Column:
    """Microseconds since the epoch.  NTZ values are read as UTC wall clock."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.TimestampNTZType):
        epoch = F.lit("1970-01-01 00:00:00").cast(T.TimestampNTZType())
        return F.timestamp_diff("MICROSECOND", epoch, F.col(col))
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(F.col(col))
    raise TypeError(f"column {col!r} must be a timestamp, got {dtype.simpleString()}")

def wall_clock_micros(df: DataFrame, col: str = "timestamp") -> Column:
    """Microseconds of the wall-clock reading (session zone for ``TIMESTAMP``), as if it were UTC.

    Naive datetimes compare by wall clock: across a daylight-saving change the
    wall-clock distance differs from the elapsed time.
    """
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.TimestampType):
        epoch = F.lit("1970-01-01 00:00:00").cast(T.TimestampNTZType())
        return F.timestamp_diff("MICROSECOND", epoch, F.col(col).cast(T.TimestampNTZType()))
    return epoch_micros(df, col)


def history_micros(df: DataFrame, col: str = "timestamp") -> Column:
    """Order key of the history dialect: the instant of a time with an offset, else the wall clock."""
    wall = wall_clock_micros(df, col)
    if OFFSET not in df.columns:
        return wall
    return F.when(F.col(OFFSET).isNull(), wall).otherwise(epoch_micros(df, col))


def local_time(df: DataFrame, col: str = "timestamp") -> Column:
    """The wall clock a time was written with: its own offset's where it has one, else as it stands."""
    if OFFSET not in df.columns:
        return F.col(col)
    epoch = F.lit("1970-01-01 00:00:00").cast(T.TimestampNTZType())
    own = F.timestamp_add("MICROSECOND", epoch_micros(df, col) + F.col(OFFSET).cast("long") * MICROS_PER_SECOND, epoch)
    return F.when(F.col(OFFSET).isNull(), F.col(col).cast(T.TimestampNTZType())).otherwise(own)


def offset_text(offset: Column) -> Column:
    """``+HH:MM`` of seconds east of UTC."""
    minutes = F.call_function("div", F.abs(offset), F.lit(60))
    return F.concat(F.when(offset < 0, F.lit("-")).otherwise(F.lit("+")),
                    F.lpad(F.call_function("div", minutes, F.lit(60)).cast("string"), 2, "0"), F.lit(":"),
                    F.lpad((minutes % 60).cast("string"), 2, "0"))


def iso_time(df: DataFrame, col: str = "timestamp") -> Column:
    """``datetime.isoformat()``, with the time's own offset where it has one."""
    text = iso_format(local_time(df, col))
    if OFFSET not in df.columns:
        return text
    return F.when(F.col(OFFSET).isNull(), text).otherwise(F.concat(text, offset_text(F.col(OFFSET))))


def from_epoch_micros(us: Column, dtype: T.DataType) -> Column:
    """Inverse of :func:`epoch_micros` for the given timestamp type."""
    if isinstance(dtype, T.TimestampNTZType):
        epoch = F.lit("1970-01-01 00:00:00").cast(T.TimestampNTZType())
        return F.timestamp_add("MICROSECOND", us, epoch)
    return F.timestamp_micros(us)


def floor_seconds(us_col: str) -> Column:
    """Whole epoch seconds, floored (equals ``CAST(ts AS BIGINT)``), exact in integers."""
    return F.expr(f"({us_col} - pmod({us_col}, {MICROS_PER_SECOND})) div {MICROS_PER_SECOND}")

def iso_format(ts: Column | str) -> Column:
    """``datetime.isoformat()`` of a naive value: seconds, plus 6-digit micros if non-zero."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    base = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(ts, "SSSSSS")
    return F.when(ts.isNull(), F.lit(None).cast("string")).otherwise(
        F.concat(base, F.when(frac == F.lit("000000"), F.lit("")).otherwise(F.concat(F.lit("."), frac)))
    )
