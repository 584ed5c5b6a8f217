"""Latest row per key, and row de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

_RANK = "_rank"


def sort_key(spec: str | Column) -> Column:
    """A sort column from ``"name"``, ``"name asc"`` or ``"name desc"``.

    NULL counts as the lowest value: first when ascending, last when descending.
    """
    if isinstance(spec, Column):
        return spec
    name, _, direction = spec.strip().partition(" ")
    direction = direction.strip().lower() or "asc"
    if direction == "asc":
        return F.col(name).asc_nulls_first()
    if direction == "desc":
        return F.col(name).desc_nulls_last()
    raise ValueError(f"unknown sort direction in {spec!r}")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                   where: str | Column | None = None) -> DataFrame:
    """The first row per key in the given order, e.g. ``["ts desc", "id desc"]``.

    The last order column should be unique within a key, or the winner among ties
    is arbitrary. The rank filter lets Spark cut each key to one row *per map
    task* before the shuffle, so a key with a third of all rows sends only a
    handful of rows to its reducer.
    """
    if not keys or not order:
        raise ValueError("latest_per_key needs keys and an order with a tie-break")
    if where is not None:
        df = df.where(where)
    window = Window.partitionBy(*keys).orderBy(*[sort_key(o) for o in order])
    return (df.withColumn(_RANK, F.row_number().over(window))
              .where(F.col(_RANK) == 1).drop(_RANK))


def dedupe(df: DataFrame, assume_unique: bool = False) -> DataFrame:
    """Distinct rows. Copies collapse in the map tasks, before the shuffle.

    ``assume_unique`` skips the step where the caller knows there are no copies.
    """
    return df if assume_unique else df.distinct()
