"""Time columns that behave the same for TIMESTAMP and TIMESTAMP_NTZ."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T


def moment(df: DataFrame, column: str, value) -> Column:
    """``value`` as a literal of the column's own type, so filters still push down."""
    if isinstance(value, Column):
        return value
    if isinstance(value, (date, datetime)):
        value = str(value)
    return F.lit(value).cast(df.schema[column].dataType)


def micros(df: DataFrame, column: str) -> Column:
    """Microseconds since 1970; for TIMESTAMP_NTZ without going through a time zone."""
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        since = f"(`{column}` - timestamp_ntz'1970-01-01 00:00:00')"
        return F.expr(f"{since} div interval '0.000001' second")
    return F.unix_micros(F.col(column).cast("timestamp"))


def from_micros(df: DataFrame, column: str, us: Column) -> Column:
    """Microseconds since 1970 as a time of the column's own type."""
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=(us / 1_000_000).cast("decimal(18,6)"))
    return F.timestamp_micros(us)


def whole_days(later: str, earlier: str) -> Column:
    """Whole days between two times."""
    return F.expr(f"cast(extract(day from (`{later}` - `{earlier}`)) as bigint)")
