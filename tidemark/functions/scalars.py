"""Scalar expressions of the measure job. Each is a built-in Spark expression."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The start time that asks for a full load, and what it becomes.
FULL_LOAD_REQUEST = dt.datetime(1900, 1, 1)
FULL_LOAD_START = dt.datetime(1700, 1, 1)


def as_datetime(value: dt.datetime | dt.date | str) -> dt.datetime:
    """A datetime from a datetime, a date or ISO text."""
    if isinstance(value, str):
        return dt.datetime.fromisoformat(value)
    if isinstance(value, dt.datetime):
        return value
    return dt.datetime(value.year, value.month, value.day)


def effective_start(start):
    """The start time to use: exactly 1900-01-01 00:00 means everything since 1700.

    Takes a datetime, date or ISO text, or a timestamp column.
    """
    if isinstance(start, Column):
        # The sentinel as text takes the type of the column it is compared with.
        return F.when(start == F.lit(FULL_LOAD_REQUEST.isoformat(" ")),
                      F.lit(FULL_LOAD_START.isoformat(" ")).cast("timestamp_ntz")).otherwise(start)
    start = as_datetime(start)
    return FULL_LOAD_START if start.replace(tzinfo=None) == FULL_LOAD_REQUEST else start


def check_range(start, end) -> None:
    """Reject a job window that ends before it begins."""
    if end is not None and as_datetime(start) > as_datetime(end):
        raise ValueError(f"start {start} lies after end {end}")


def time_literal(value, dtype: T.DataType) -> Column:
    """A literal of the column's own time type, so that comparing needs no cast
    on the column and the filter reaches the parquet scan."""
    value = as_datetime(value)
    if isinstance(dtype, T.TimestampNTZType):
        if value.tzinfo is not None:
            value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return F.lit(value.isoformat(" ")).cast("timestamp_ntz")
    if isinstance(dtype, T.DateType):
        return F.lit(value.date())
    if value.tzinfo is not None:
        return F.lit(value)
    return F.lit(value.isoformat(" ")).cast("timestamp")


def composite_id(*columns: str | Column, sep: str = "~") -> Column:
    """Business id from several columns; NULL parts are skipped, not blanked."""
    return F.concat_ws(sep, *[_column(c).cast("string") for c in columns])


def concat_blank(*columns: str | Column) -> Column:
    """Joined text in which NULL counts as empty text."""
    return F.concat(*[F.coalesce(_column(c).cast("string"), F.lit("")) for c in columns])


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace NULL by a default in the named columns, order and types kept."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({
        name: F.coalesce(F.col(name), F.lit(value).cast(types[name]))
        for name, value in defaults.items()
    })


def safe_key(column: str | Column, dtype: str = "bigint") -> Column:
    """A key in another type; text that is no such value becomes NULL, not an error."""
    return _column(column).try_cast(dtype)


def parse_time(column: str | Column, fmt: str | None = None, strict: bool = True) -> Column:
    """Time from text. Bad text fails the query, or gives NULL if not strict."""
    column = _column(column)
    if strict:
        return F.to_timestamp(column, fmt) if fmt else F.to_timestamp(column)
    return F.try_to_timestamp(column, F.lit(fmt)) if fmt else F.try_to_timestamp(column)


def elapsed_seconds(start: str | Column, end: str | Column) -> Column:
    """Whole seconds from start to end."""
    return F.timestamp_diff("SECOND", _column(start), _column(end))


def run_id(prefix: str = "run") -> str:
    """A name for one run, unique without any shared counter."""
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


def _column(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column
