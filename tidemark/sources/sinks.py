"""Writing tables: plain, by date partition, and clustered by key."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import remove, rename

# The partition columns of each grain, outermost first.
GRAINS = {"year": ("year",), "month": ("year", "month"), "day": ("load_date",)}


def write_overwrite(df: DataFrame, path: str) -> None:
    """Replace the table at ``path``, also when ``df`` reads from there: the new data is
    written beside it first and takes its place only when it is whole. Plans made on the
    old files cannot be run afterwards."""
    spark, target = df.sparkSession, path.rstrip("/")
    fresh = f"{target}.new-{uuid.uuid4().hex}"
    df.write.parquet(fresh)
    remove(spark, target)
    rename(spark, fresh, target)


def with_partition_columns(df: DataFrame, date_col: str, grain: str) -> DataFrame:
    """Adds the partition columns of a grain: year; year and month; or load_date. A
    column of that name which is there already would be lost: an error."""
    taken = {c.lower() for c in df.columns} & set(GRAINS[grain])
    if taken:
        raise ValueError(f"the data has columns named like its partitions: {', '.join(sorted(taken))}")
    made = {"year": F.year(date_col), "month": F.month(date_col), "load_date": F.to_date(date_col)}
    return df.withColumns({name: made[name] for name in GRAINS[grain]})


def write_partitioned(df: DataFrame, path: str, date_col: str, grain: str = "month",
                      mode: str = "overwrite") -> None:
    """One folder per year, month or day.

    Rows are rebalanced by folder first: small folders get one file, and a folder
    with a large share of the rows is split over several tasks at run time.
    """
    columns = GRAINS[grain]
    rows = with_partition_columns(df, date_col, grain).hint("rebalance", *columns)
    rows.write.mode(mode).partitionBy(*columns).parquet(path)


def clustered(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Rows range-partitioned and sorted by key, so that files hold narrow key ranges.
    Without a number of partitions the session's shuffle setting decides.

    A hash of the whole row is the last range column: rows of one hot key then
    span several ranges instead of one.
    """
    tail = F.xxhash64(*df.columns)
    ranges = [*([partitions] if partitions else []), *keys, "_tail"]
    return (df.withColumn("_tail", tail).repartitionByRange(*ranges)
              .sortWithinPartitions(*keys).drop("_tail"))


def write_clustered(df: DataFrame, path: str, keys: Sequence[str],
                    partitions: int | None = None) -> None:
    """Write a table laid out for later pruning by key."""
    clustered(df, keys, partitions).write.mode("overwrite").parquet(path)


def _by_range(column: str, bounds: list, values: list[int]) -> Column:
    """The value of the range that a row is in, by a search tree over ascending bounds; NULL is in the first."""
    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(values[low]).cast("long")
        middle = (low + high) // 2
        return F.when(F.col(column) >= F.lit(bounds[middle]), search(middle + 1, high)).otherwise(search(low, middle))

    return search(0, len(bounds))


def zordered(df: DataFrame, columns: Sequence[str], partitions: int | None = None, bits: int = 6) -> DataFrame:
    """Rows range-partitioned and sorted along a Z curve over numeric, date or time columns.

    Files then hold narrow ranges of *every* column, where ``clustered`` narrows the first one only. Each
    column is cut at 2**bits - 1 quantiles, so that outliers and uneven values fill the curve evenly; the
    interleaved bits of the range ranks give the place. One aggregation finds the quantiles: the driver
    gets that many numbers a column. Equal places (a hot value) are spread by a hash of the row.
    """
    if not columns or len(columns) * bits > 62:
        raise ValueError("the bits of all columns must fit a long")
    shares = [i / 2**bits for i in range(1, 2**bits)]
    found = df.agg(*[F.percentile_approx(c, shares, 10_000).alias(f"_{i}") for i, c in enumerate(columns)]).first()
    place = F.lit(0).cast("long")
    for i, c in enumerate(columns):
        # Bits spread out per bound, once, in place of shifting the rank of every row.
        bounds = sorted(set(found[i] or []))
        spread = [sum((rank >> bit & 1) << (bit * len(columns) + len(columns) - 1 - i) for bit in range(bits))
                  for rank in range(len(bounds) + 1)]
        place = place + _by_range(c, bounds, spread)
    dealt = df.withColumns({"_z": place, "_tail": F.xxhash64(*df.columns)})
    return (dealt.repartitionByRange(*([partitions] if partitions else []), "_z", "_tail")
                 .sortWithinPartitions("_z").drop("_z", "_tail"))


def write_zordered(df: DataFrame, path: str, columns: Sequence[str], partitions: int | None = None,
                   bits: int = 6) -> None:
    """Write a table laid out for later pruning by any of several columns."""
    zordered(df, columns, partitions, bits).write.mode("overwrite").parquet(path)
