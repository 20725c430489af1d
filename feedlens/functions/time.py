"""Calendar helpers.  Every operator gets its dates as parameters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_date(d: dt.date | str) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(d)


def as_datetime(t: dt.datetime | str) -> dt.datetime:
    return t if isinstance(t, dt.datetime) else dt.datetime.fromisoformat(t)


def ts_lit(value: dt.datetime | dt.date, dtype: T.DataType = T.TimestampNTZType()) -> Column:
    """A timestamp literal of the column's own type, so the comparison needs no cast
    on the column and the predicate reaches the parquet scan."""
    if not isinstance(value, dt.datetime):
        value = dt.datetime.combine(value, dt.time())
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast(dtype)


def time_type(df: DataFrame, col: str = "time") -> T.DataType:
    return df.schema[col].dataType


def day_range(df: DataFrame, first: dt.date, last: dt.date, col: str = "time") -> Column:
    """``first <= to_date(col) <= last`` written as a half-open range on ``col``."""
    dtype = time_type(df, col)
    return (F.col(col) >= ts_lit(as_date(first), dtype)) & (
        F.col(col) < ts_lit(as_date(last) + dt.timedelta(days=1), dtype)
    )


def time_range(df: DataFrame, start: dt.datetime, end: dt.datetime, col: str = "time") -> Column:
    """``start <= col < end``."""
    dtype = time_type(df, col)
    return (F.col(col) >= ts_lit(start, dtype)) & (F.col(col) < ts_lit(end, dtype))


def floor_15min(col: str | Column) -> Column:
    """Start of the 15-minute bucket (keeps the column's timestamp type)."""
    return F.window(col, "15 minutes").start


def floor_15min_py(t: dt.datetime) -> dt.datetime:
    return t.replace(minute=t.minute - t.minute % 15, second=0, microsecond=0)


def hhmm(col: str | Column) -> Column:
    return F.date_format(col, "HH:mm")


def to_monday(col: str | Column) -> Column:
    """Monday of the ISO week containing the date."""
    return F.to_date(F.date_trunc("week", F.to_date(col)))


def monday_py(d: dt.date) -> dt.date:
    return d - dt.timedelta(days=d.weekday())
