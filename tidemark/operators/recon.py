"""Reconciliation of two datasets: totals, row by row, hashes, expectations.

Both sides are stacked with a mark and aggregated by key, instead of being
joined: one shuffle with partial sums, so that neither a hot key nor repeated
keys multiply, and no side is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.staging import stage

_LEFT = "_is_left"
_LEAF = "_leaf"


def _stack(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    return (left.select(*columns, F.lit(True).alias(_LEFT))
                .unionByName(right.select(*columns, F.lit(False).alias(_LEFT))))


def reconcile_totals(left: DataFrame, right: DataFrame, amount: str, tolerance: str = "0.01",
                     ts: str | None = None, since=None) -> DataFrame:
    """One row: counts, sums, their differences, and PASS if the counts are equal
    and the sums closer than the tolerance. A side without rows has no sum: FAIL."""
    if ts is not None:
        left, right = left.where(F.col(ts) >= since), right.where(F.col(ts) >= since)
    mine, theirs = F.col(_LEFT), ~F.col(_LEFT)
    totals = _stack(left, right, [amount]).agg(
        F.count_if(mine).alias("left_count"), F.count_if(theirs).alias("right_count"),
        F.sum(F.when(mine, F.col(amount))).alias("left_sum"),
        F.sum(F.when(theirs, F.col(amount))).alias("right_sum"))
    same = ((F.col("left_count") == F.col("right_count"))
            & (F.abs(F.col("left_sum") - F.col("right_sum"))
               < F.lit(tolerance).cast("decimal(18,6)")))
    return totals.select(
        "left_count", "right_count", (F.col("left_count") - F.col("right_count")).alias("count_diff"),
        "left_sum", "right_sum", (F.col("left_sum") - F.col("right_sum")).alias("sum_diff"),
        F.when(same, "PASS").otherwise("FAIL").alias("validation_status"))


def reconcile_rows(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   compare: Sequence[str]) -> DataFrame:
    """One row per key: left_rows, right_rows, status, differing.

    status is matched, differs, left_only or right_only; NULL equals NULL. A key
    with several rows matches if both sides hold the same rows equally often.
    differing names the unequal columns, comma-separated; NULL where a key
    repeats, as no row there has a partner.
    """
    # Copies of a row collapse first, so a hot key is spread by its values.
    variants = _stack(left, right, [*keys, *compare]).groupBy(*keys, *compare).agg(
        F.count_if(F.col(_LEFT)).alias("_l"), F.count_if(~F.col(_LEFT)).alias("_r"))
    mine, theirs = F.col("_l") > 0, F.col("_r") > 0
    sides = []
    for i, name in enumerate(compare):
        sides += [F.max(F.when(mine, F.col(name))).alias(f"_l{i}"),
                  F.max(F.when(theirs, F.col(name))).alias(f"_r{i}")]
    per_key = variants.groupBy(*keys).agg(
        F.sum("_l").alias("left_rows"), F.sum("_r").alias("right_rows"),
        F.bool_and(F.col("_l") == F.col("_r")).alias("_same"), *sides)
    status = (F.when(F.col("right_rows") == 0, "left_only")
               .when(F.col("left_rows") == 0, "right_only")
               .when(F.col("_same"), "matched").otherwise("differs"))
    single = (F.col("left_rows") == 1) & (F.col("right_rows") == 1)
    names = [F.when(~F.col(f"_l{i}").eqNullSafe(F.col(f"_r{i}")), name)
             for i, name in enumerate(compare)]
    return per_key.select(*keys, "left_rows", "right_rows", status.alias("status"),
                          F.when(single, F.concat_ws(",", *names)).alias("differing"))


def match_rate(recon: DataFrame, target: str = "99.99") -> DataFrame:
    """One row: keys, matched keys, rate in percent, and whether the target is met."""
    counted = recon.agg(F.count("*").alias("total_keys"),
                        F.count_if(F.col("status") == "matched").alias("matched_keys"))
    rate = (F.col("matched_keys").cast("decimal(20,0)") * 100
            / F.col("total_keys").cast("decimal(20,0)")).cast("decimal(9,4)")
    return (counted.withColumn("match_rate", F.when(F.col("total_keys") > 0, rate))
                   .withColumn("target_met",
                               F.coalesce(F.col("match_rate") >= F.lit(target).cast("decimal(9,4)"),
                                          F.lit(False))))


def reconcile_hash(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   hash_col: str = "HashValue") -> DataFrame:
    """Number of keys per status when only the row hashes are compared."""
    return (reconcile_rows(left, right, keys, [hash_col])
            .groupBy("status").agg(F.count("*").alias("keys")))


def _with_leaf(rows: DataFrame, keys: Sequence[str], leaves: int) -> DataFrame:
    return rows.withColumn(_LEAF, F.pmod(F.xxhash64(*_marked(keys)), F.lit(leaves)).cast("int"))


def _marked(columns: Sequence[str]) -> list:
    """Columns with a mark for NULL each: a hash skips NULLs, so that they would not keep their place."""
    return [c for name in columns for c in (F.col(name), F.col(name).isNull())]


def checksums(rows: DataFrame, keys: Sequence[str], compare: Sequence[str], leaves: int = 65_536) -> DataFrame:
    """Order-free checksums of a table: leaf, n, sum_a, sum_b, one row per leaf that has rows.

    A key belongs to one leaf by its hash. The sums are those of two 64-bit hashes of each row, so copies
    count. At most ``leaves`` rows come out, whatever the table's size: a system can keep them or send
    them. Both sides must hold the columns in the same types, as hashes depend on them.
    """
    hashes = [F.xxhash64(F.lit(salt), *_marked([*keys, *compare])).cast("decimal(20,0)") for salt in ("a", "b")]
    return _with_leaf(rows, keys, leaves).groupBy(F.col(_LEAF).alias("leaf")).agg(
        F.count("*").alias("n"), F.sum(hashes[0]).alias("sum_a"), F.sum(hashes[1]).alias("sum_b"))


def differing_leaves(left: DataFrame, right: DataFrame, branches: int = 256) -> DataFrame:
    """The leaves of two tables of ``checksums`` that differ, found from ``branches`` coarse sums down."""
    names = ("n", "sum_a", "sum_b")
    signed = left.select("leaf", *names).unionByName(right.select("leaf", *[(-F.col(c)).alias(c) for c in names]))
    signed = signed.withColumn("branch", F.pmod("leaf", F.lit(branches)))

    def unequal(*by: str) -> DataFrame:
        # Differences: a leaf on one side only has the other's sums missing, not NULL.
        return signed.groupBy(*by).agg(*[F.sum(c).alias(c) for c in names]).where("n <> 0 or sum_a <> 0 or sum_b <> 0")

    coarse = [r[0] for r in unequal("branch").select("branch").collect()]
    signed = signed.where(F.col("branch").isin(coarse))
    return unequal("leaf").select("leaf")


def reconcile_tree(left: DataFrame, right: DataFrame, keys: Sequence[str], compare: Sequence[str],
                   leaves: int = 65_536, branches: int = 256, left_sums: DataFrame | None = None,
                   right_sums: DataFrame | None = None) -> DataFrame:
    """The rows of ``reconcile_rows`` that are not matched, comparing rows only where checksums differ.

    Each side is read for its ``checksums`` (or stored ones with the same keys, columns, types and
    ``leaves`` are given), which leaves at most ``leaves`` rows to shuffle. Only rows of leaves that
    differ are shuffled and compared; those leaves are broadcast, as their number is bounded. Two tables
    with equal rows in another order shuffle nothing else. Rows pass unseen only if the sums of both hashes agree.
    """
    columns = [*keys, *compare]
    kinds = _stack(left, right, columns).schema
    sides = [df.select(*[F.col(c).cast(kinds[c].dataType).alias(c) for c in columns]) for df in (left, right)]
    sums = [checksums(side, keys, compare, leaves) if known is None else known
            for side, known in zip(sides, (left_sums, right_sums), strict=True)]
    stages = [stage(s, mode="table") for s in sums]  # read for the branches, then for the leaves
    try:
        numbers = sorted(r[0] for r in differing_leaves(*[s.df for s in stages], branches=branches).collect())
    finally:
        for kept in stages:
            kept.release()
    spark = left.sparkSession
    wanted = F.broadcast(spark.createDataFrame([(n,) for n in numbers], f"{_LEAF} int"))
    parts = [_with_leaf(side, keys, leaves).join(wanted, _LEAF, "left_semi").select(*columns) for side in sides]
    return reconcile_rows(*parts, keys, compare).where("status <> 'matched'")


def expect(actual: DataFrame, expected: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Expected against actual value per key, PASS or FAIL; NULL equals NULL.

    A key on one side only is a FAIL. Expectation tables hold each key once.
    """
    columns = [*keys, value]
    mine, theirs = F.col(_LEFT), ~F.col(_LEFT)
    per_key = _stack(actual, expected, columns).groupBy(*keys).agg(
        F.max(F.when(theirs, F.col(value))).alias("expected"),
        F.max(F.when(mine, F.col(value))).alias("actual"),
        F.count_if(mine).alias("_a"), F.count_if(theirs).alias("_e"))
    good = ((F.col("_a") == 1) & (F.col("_e") == 1)
            & F.col("expected").eqNullSafe(F.col("actual")))
    return per_key.select(*keys, "expected", "actual",
                          F.when(good, "PASS").otherwise("FAIL").alias("test_result"))


def stack_rows(first: DataFrame, *others: DataFrame) -> DataFrame:
    """UNION ALL by column name, e.g. of literal expectation rows."""
    return reduce(lambda a, b: a.unionByName(b), others, first)


def comparable(df: DataFrame) -> DataFrame:
    """Floating-point columns as decimals, so that totals do not depend on order."""
    return df.select(*[
        F.col(f.name).cast("decimal(28,6)").alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields])
