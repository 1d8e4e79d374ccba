"""Date/time expressions used by the calendar, rollups and SCD intervals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(c) -> Column:
    """``yyyyMMdd`` as an int (the calendar's primary key)."""
    return F.date_format(_c(c), "yyyyMMdd").cast("int")


def truncate(unit: str, c, dtype: T.DataType | None = None) -> Column:
    """``date_trunc``; pass the input's type to keep ``timestamp_ntz`` inputs
    NTZ (the built-in returns a session-zone TIMESTAMP for them)."""
    out = F.date_trunc(unit, _c(c))
    return out.cast(dtype) if isinstance(dtype, T.TimestampNTZType) else out


def minus_millis(c, n: int = 1) -> Column:
    """``timestampadd(MILLISECOND, -n, c)`` -- preserves the input type."""
    return F.timestamp_add("MILLISECOND", F.lit(-n), _c(c))


def to_event_time(c) -> Column:
    """NTZ -> TIMESTAMP for watermarks (session zone is UTC)."""
    return _c(c).cast(T.TimestampType())


def order_number(c, dtype: T.DataType) -> Column:
    """Monotone numeric image of an ordering column (for bucketing by order)."""
    col = _c(c)
    if isinstance(dtype, T.TimestampNTZType):
        return F.unix_micros(col.cast(T.TimestampType())).cast("double")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(col).cast("double")
    if isinstance(dtype, T.DateType):
        return F.unix_date(col).cast("double")
    return col.cast("double")
