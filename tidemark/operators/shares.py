"""Shares of a large result by its keys: written one after the other, they bound the shuffle files there are at a time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import own_shuffles

#: Bytes of the files that a plan reads for each share, and the most shares: each reads the files again.
_SHARE_BYTES, _MOST_SHARES = 64 << 20, 16


def shares_of(df: DataFrame, most: int | None = None) -> int:
    """Into how many shares a result is cut, by the size of the files its plan reads; one that is read twice counts twice."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    found = [leaves.apply(i) for i in range(leaves.size())]
    read = sum(int(str(x.stats().sizeInBytes())) for x in found if x.getClass().getSimpleName() == "LogicalRelation")
    return min(most or _MOST_SHARES, 1 + read // _SHARE_BYTES)


def share(keys: Sequence[str], shares: int, number: int) -> Column:
    """Whether a row belongs to a share. As a filter on keys it goes below joins, rankings and groupings by them."""
    return F.pmod(F.xxhash64(*keys), F.lit(shares)) == number


def bucket_share(keys: Sequence[str], buckets: int, shares: int, number: int) -> Column:
    """The same with whole buckets in a share, by the hash that Spark deals rows to buckets and shuffle partitions."""
    return F.pmod(F.pmod(F.hash(*keys), F.lit(buckets)), F.lit(shares)) == number


def write_shares(df: DataFrame, path: str, keys: Sequence[str] = (), most: int | None = None) -> None:
    """Write a parquet table. With ``keys``, one made from large files in shares, the shuffle files of each gone before the next."""
    spark, shares = df.sparkSession, shares_of(df, most) if keys else 1
    for part in [df.where(share(keys, shares, i)) for i in range(shares)] if shares > 1 else [df]:
        with own_shuffles(spark):
            part.write.option("compression", "zstd").mode("append").parquet(path)


def table_ddl(name: str, schema: T.StructType, path: str, keys: Sequence[str], buckets: int, parted: str | None = None) -> str:
    """The statement that makes a bucketed table at a path, in folders by the integer ``parted`` if that is given."""
    columns = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields] + [f"{parted} INT"] * bool(parted))
    by = ", ".join(f"`{k}`" for k in keys)
    folders = f"PARTITIONED BY ({parted}) " if parted else ""
    return (f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS (compression 'zstd') {folders}"
            f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'")
