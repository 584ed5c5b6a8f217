"""Data-quality profiles, gates and key checks, each in one pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """A named condition whose rows are counted."""

    name: str
    predicate: str | Column

    def column(self) -> Column:
        return F.expr(self.predicate) if isinstance(self.predicate, str) else self.predicate


def standard_checks(keys: Sequence[str], hash_col: str | None, amount: str) -> list[Check]:
    """NULL keys, NULL hashes, zero and negative amounts."""
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    checks = [Check("null_keys", null_key)]
    if hash_col:
        checks.append(Check("null_hashes", F.col(hash_col).isNull()))
    return checks + [Check("zero_amounts", F.col(amount) == 0),
                     Check("negative_amounts", F.col(amount) < 0)]


def profile(df: DataFrame, checks: Sequence[Check], amount: str | None = None,
            ts: str | None = None, since: str | Column | None = None) -> DataFrame:
    """One row: total_records, one count per check, avg_amount, min_date, max_date."""
    if since is not None:
        df = df.where(since)
    parts = [F.count("*").alias("total_records")]
    parts += [F.count_if(c.column()).alias(c.name) for c in checks]
    if amount:
        parts.append(F.avg(amount).alias("avg_amount"))
    if ts:
        parts += [F.min(ts).alias("min_date"), F.max(ts).alias("max_date")]
    return df.agg(*parts)


def fail_if(profiled: DataFrame, predicate: str | Column) -> DataFrame:
    """The profile row if the predicate holds, else no row."""
    return profiled.where(predicate)


def gate(profiled: DataFrame, max_negative_share: str = "0.1") -> DataFrame:
    """A row if any key is NULL or too large a share of the amounts is negative."""
    return fail_if(profiled, "null_keys > 0 OR negative_amounts > "
                             f"total_records * CAST({max_negative_share} AS DECIMAL(9,6))")


def status(profiled: DataFrame) -> DataFrame:
    """The profile with quality_status; the first finding that applies is named."""
    half = F.col("total_records") * F.lit("0.5").cast("decimal(2,1)")
    return profiled.withColumn(
        "quality_status",
        F.when(F.col("null_keys") > 0, "FAIL: Null keys detected")
         .when(F.col("null_hashes") > 0, "FAIL: Null hashes detected")
         .when(F.col("zero_amounts") > half, "WARN: High zero amounts")
         .otherwise("PASS"))


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key, pre-aggregated in the map tasks."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return key_counts(df, keys).where(F.col("rows") > 1)


def check_keys(df: DataFrame, keys: Sequence[str], not_null: Sequence[str] = (),
               approximate: bool = False) -> DataFrame:
    """One row: totals, distinct keys, NULLs per column, and the verdicts.

    The exact form counts per key first, so the distinct count needs no row to
    travel twice. ``approximate`` estimates the distinct keys without a shuffle.
    """
    watched = [*keys, *not_null]
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in watched]
    if approximate:
        one_row = df.agg(F.count("*").alias("total_records"),
                         F.approx_count_distinct(F.struct(*keys)).alias("distinct_keys"), *nulls)
    else:
        per_key = df.groupBy(*keys).agg(
            F.count("*").alias("_rows"),
            *[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in watched])
        one_row = per_key.agg(
            F.coalesce(F.sum("_rows"), F.lit(0)).alias("total_records"),
            F.count("*").alias("distinct_keys"),
            *[F.coalesce(F.sum(f"_null_{c}"), F.lit(0)).alias(f"null_{c}") for c in watched])
    no_null = reduce(lambda a, b: a & b, [F.col(f"null_{c}") == 0 for c in watched])
    return one_row.withColumns({
        "keys_unique": F.col("total_records") == F.col("distinct_keys"),
        "all_present": no_null,
    })
