"""Scalar helpers for readings and time: rounding, day truncation, interval
arithmetic, timestamp <-> microsecond conversion.  All built-in Columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_reading(c, scale: int = 2) -> Column:
    """``ROUND(value, 2)``, half up on the decimal digits of the reading.

    Spark rounds a double through its shortest decimal form, once, whatever its
    size: 0.0049999996 gives 0.00, 0.285 gives 0.29, 2e12 stays 2e12, and
    infinities and NaN pass unchanged.
    """
    return F.round(_c(c).cast(T.DoubleType()), scale)


def day(c) -> Column:
    """``DATE(ts)``."""
    return F.to_date(_c(c))


_DAY_US = 86_400_000_000


def to_micros_sql(name: str, data_type: T.DataType) -> str:
    """Microseconds since the epoch as SQL text, independent of the session
    time zone.  TIMESTAMP_NTZ uses wall-clock fields only (day number, hour,
    minute, second), so readings inside a DST gap keep their order."""
    c = f"`{name}`" if not name.startswith("`") else name
    if isinstance(data_type, T.TimestampNTZType):
        return (f"(CAST(unix_date(to_date({c})) AS BIGINT) * {_DAY_US}L + hour({c}) * 3600000000L"
                f" + minute({c}) * 60000000L"
                f" + CAST(date_part('SECOND', {c}) * 1000000L AS BIGINT))")
    return f"unix_micros(CAST({c} AS TIMESTAMP))"


def from_micros_sql(expr: str, data_type: T.DataType) -> str:
    """Inverse of :func:`to_micros_sql`.  For NTZ: the epoch plus an exact
    decimal-seconds interval (NTZ + interval is wall-clock arithmetic); one
    small expression, so thousands of such columns stay cheap."""
    if isinstance(data_type, T.TimestampNTZType):
        return (f"(TIMESTAMP_NTZ '1970-01-01 00:00:00' + make_dt_interval(0, 0, 0,"
                f" CAST(CAST({expr} AS DECIMAL(20, 0)) / 1000000 AS DECIMAL(18, 6))))")
    return f"CAST(timestamp_micros({expr}) AS {data_type.simpleString()})"


def to_micros(c, data_type: T.DataType | None = None) -> Column:
    """Column form of :func:`to_micros_sql` (``c`` is a column name)."""
    return F.expr(to_micros_sql(c, data_type or T.TimestampType()))


def from_micros(c, data_type: T.DataType) -> Column:
    """Column form of :func:`from_micros_sql` for a column or expression."""
    if isinstance(c, str):
        return F.expr(from_micros_sql(f"`{c}`", data_type))
    if isinstance(data_type, T.TimestampNTZType):
        secs = (c.cast(T.DecimalType(20, 0)) / F.lit(1_000_000)).cast(T.DecimalType(18, 6))
        return (F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
                + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs))
    return F.timestamp_micros(c).cast(data_type)


def midnight(d: dt.date) -> dt.datetime:
    return dt.datetime.combine(d, dt.time.min)


def lookback_start(as_of: dt.date, days: int) -> dt.datetime:
    """Midnight of ``as_of - days`` (first-run lower bound, strict)."""
    return midnight(as_of - dt.timedelta(days=days))


def run_end(as_of: dt.date) -> dt.datetime:
    """Midnight after the run day (exclusive upper bound)."""
    return midnight(as_of + dt.timedelta(days=1))


def retention_cutoff(as_of: dt.date, days: int) -> dt.datetime:
    """Rows strictly before this instant are purged."""
    return midnight(as_of - dt.timedelta(days=days))


def ts_literal(value: dt.datetime, data_type: T.DataType) -> Column:
    """A typed timestamp literal of the column's flavour (ntz or session-zone)."""
    return F.lit(value.isoformat(sep=" ")).cast(data_type)


def plus_seconds(c, seconds: float) -> Column:
    """``ts + INTERVAL seconds`` (microsecond precision)."""
    return _c(c) + F.make_dt_interval(secs=F.lit(f"{seconds:.6f}").cast(T.DecimalType(18, 6)))
