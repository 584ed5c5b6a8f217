"""Which rows changed since a start time, on the fact or on its dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import (
    FULL_LOAD_REQUEST,
    FULL_LOAD_START,
    as_datetime,
    effective_start,
    time_literal,
)
from tidemark.operators.latest import dedupe

_KEY, _TIME, _ZERO = "_dim_key", "_dim_time", "_zero"


def changed_since(fact: DataFrame, dim: DataFrame, on: str | tuple[str, str], fact_ts: str,
                  dim_ts: str, start, strategy: str = "auto", dim_unique: bool = False,
                  assume_unique: bool = False, fact_grain: str | None = None,
                  dim_grain: str | None = None) -> DataFrame:
    """Distinct fact rows whose own time, or whose dimension row's time, is at or
    after ``start``. Facts without a dimension row are dropped; there is no upper
    bound; a NULL time on one side does not hide the other.

    strategy="or" tests both times after one join, which reads and shuffles both
    tables whole. strategy="union" makes two disjoint branches, each with a
    filter that reaches its scan: changed facts that have a dimension row, and
    the other facts whose dimension row changed. "auto" takes "or" for a full
    load, where no filter would remove anything, and "union" otherwise.

    Both are semi-joins, so nothing fans out. ``dim_unique`` says the dimension
    holds each key once; otherwise its keys are pre-aggregated.

    ``fact_grain`` and ``dim_grain`` (year, month or day) say that a table was written by
    ``write_partitioned`` with this grain of its time. The branches that ask for new times then list
    only the folders that can hold some. Facts changed by their dimension alone may be of any age: that
    branch reads all folders.
    """
    start = effective_start(start)
    if strategy == "auto":
        full = as_datetime(start).replace(tzinfo=None) <= FULL_LOAD_START
        strategy = "or" if full else "union"
    fact_key, dim_key = (on, on) if isinstance(on, str) else on
    fact_new = F.col(fact_ts) >= time_literal(start, fact.schema[fact_ts].dataType)
    dim_new = F.col(dim_ts) >= time_literal(start, dim.schema[dim_ts].dataType)

    fact_folders = _folders_since(fact_grain, start) if fact_grain else F.lit(True)
    dim_folders = _folders_since(dim_grain, start) if dim_grain else F.lit(True)

    def having(rows: DataFrame, members: DataFrame, condition=None) -> DataFrame:
        left = rows
        match = F.col(fact_key) == F.col(_KEY)
        if not dim_unique:
            # A key that is 0 on both sides. It gives the join a shuffle of its own
            # behind the pre-aggregation, which adaptive execution can split when
            # one fact key is hot.
            left = rows.withColumn(_ZERO, F.pmod(F.hash(fact_key), F.lit(1)))
            members = members.withColumn(_ZERO + "_dim", F.pmod(F.hash(_KEY), F.lit(1)))
            match = match & (F.col(_ZERO) == F.col(_ZERO + "_dim"))
        if condition is not None:
            match = match & condition
        return left.join(members, match, "left_semi").select(*fact.columns)

    if strategy == "or":
        members = dim.select(F.col(dim_key).alias(_KEY), F.col(dim_ts).alias(_TIME))
        if not dim_unique:
            members = members.groupBy(_KEY).agg(F.max(_TIME).alias(_TIME))
        member_new = F.col(_TIME) >= time_literal(start, dim.schema[dim_ts].dataType)
        return dedupe(having(fact, members, fact_new | member_new), assume_unique)
    if strategy != "union":
        raise ValueError(f"unknown strategy {strategy!r}")

    def member_keys(rows: DataFrame) -> DataFrame:
        found = rows.select(F.col(dim_key).alias(_KEY))
        return found if dim_unique else found.distinct()

    own = having(fact.where(fact_folders & fact_new), member_keys(dim))
    others = fact.where(~fact_new | F.col(fact_ts).isNull())
    by_dim = having(others, member_keys(dim.where(dim_folders & dim_new)))
    return dedupe(own.unionByName(by_dim), assume_unique)


def _folders_since(grain: str, start) -> Column:
    """Whether a folder of ``write_partitioned`` can hold times at or after ``start``. Two days are
    allowed for a writer in another time zone."""
    day = as_datetime(start).replace(tzinfo=None).date()
    day = day - dt.timedelta(days=2) if day.year > 1 else day
    if grain == "year":
        return F.col("year") >= day.year
    if grain == "month":
        return F.make_date("year", "month", F.lit(1)) >= F.lit(day.replace(day=1))
    if grain == "day":
        return F.col("load_date") >= F.lit(day)
    raise ValueError(f"unknown grain {grain!r}")


def high_water_mark(log: DataFrame, ts_col: str, default=FULL_LOAD_REQUEST):
    """Latest time in a run log, or the default for an empty one. One driver scalar."""
    found = log.agg(F.max(ts_col)).first()[0]
    return as_datetime(default) if found is None else found


def since_last_run(source: DataFrame, log: DataFrame, ts_col: str, log_ts_col: str | None = None,
                   default=FULL_LOAD_REQUEST) -> DataFrame:
    """Source rows at or after the last run. The mark is fetched first, so that it
    stands in the filter as a literal and reaches the scan."""
    mark = high_water_mark(log, log_ts_col or ts_col, default)
    return source.where(F.col(ts_col) >= time_literal(mark, source.schema[ts_col].dataType))
