"""Star and snowflake lookups that keep their aliases, and size-checked broadcast."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPREAD = "_spread"
# Rows whose lookup key is NULL match nothing; they are dealt over this many shares.
_NULL_SHARES = 4096


@dataclass(frozen=True)
class Lookup:
    """One lookup table of a star join.

    on: key names shared with the fact, or one SQL condition over the aliases.
    take / defaults: columns to return and what stands for an unknown member.
    broadcast_rows: hint a broadcast if the table has at most this many rows;
        0 leaves the choice to Spark.
    spread: (fact column, lookup column) of an equality in ``on``. It deals rows
        with a NULL key over many tasks and gives the join a shuffle of its own,
        which adaptive execution can split. For lookups that were windowed or
        grouped by the same keys: their shuffle would be reused, and a reused
        shuffle cannot be split.
    """

    name: str
    df: DataFrame
    on: Sequence[str] | str
    how: str = "left"
    take: Sequence[str] = ()
    defaults: Mapping[str, object] = field(default_factory=dict)
    broadcast_rows: int = 0
    spread: tuple[str, str] | None = None


def star_join(fact: DataFrame, lookups: Sequence[Lookup], alias: str = "fact") -> DataFrame:
    """Join the lookups in the given order. All columns stay reachable as
    ``alias.column``, which rule text relies on. Put inner joins first."""
    joined = fact.alias(alias)
    for look in lookups:
        if look.how not in ("inner", "left"):
            raise ValueError(f"lookup {look.name}: how must be inner or left")
        table = look.df
        if look.broadcast_rows and fits(table, look.broadcast_rows):
            table = F.broadcast(table)
        condition = _condition(look, alias)
        if look.spread:
            left_key, right_key = F.col(look.spread[0]), F.col(look.spread[1].split(".")[-1])
            mine, theirs = f"{_SPREAD}_{look.name}", f"{_SPREAD}_of_{look.name}"
            # 0 on both sides for a key that can match.
            joined = joined.withColumn(
                mine, F.pmod(F.hash(left_key), F.lit(1)) + _share_of_null(left_key, fact, alias))
            table = table.withColumn(theirs, F.pmod(F.hash(right_key), F.lit(1)))
            condition = condition & (F.col(mine) == F.col(theirs))
        joined = joined.join(table.alias(look.name), condition, look.how)
    return joined


def lookup_columns(lookups: Sequence[Lookup]) -> list[Column]:
    """The taken columns of all lookups, unknown members replaced by their default."""
    columns = []
    for look in lookups:
        types = {f.name: f.dataType for f in look.df.schema.fields}
        for name in look.take:
            value = F.col(f"{look.name}.{name}")
            if name in look.defaults:
                value = F.coalesce(value, F.lit(look.defaults[name]).cast(types[name]))
            columns.append(value.alias(name))
    return columns


def enrich(fact: DataFrame, lookups: Sequence[Lookup], alias: str = "fact") -> DataFrame:
    """Fact columns followed by the taken lookup columns."""
    kept = [F.col(f"{alias}.{c}") for c in fact.columns]
    return star_join(fact, lookups, alias).select(*kept, *lookup_columns(lookups))


def used_lookups(lookups: Sequence[Lookup], texts: Iterable[str]) -> list[Lookup]:
    """Leave out left lookups nothing refers to: no expression in ``texts`` and no
    condition of a lookup that stays names their alias or one of their columns.

    Only for results that are made distinct afterwards: a left join with an
    unread table can repeat rows but neither change nor drop any.
    """
    spoken = _words(texts)
    kept: list[Lookup] = []
    for look in reversed(lookups):
        names = {look.name.lower(), *(c.lower() for c in look.df.columns)}
        if look.how == "left" and not names & spoken:
            continue
        kept.append(look)
        # A condition always names its own table; what counts is the others.
        condition = look.on if isinstance(look.on, str) else ""
        spoken |= _words([condition]) - {look.name.lower()}
    return kept[::-1]


def fits(df: DataFrame, max_rows: int) -> bool:
    """Whether the table has at most ``max_rows`` rows. A full count on purpose: it
    adds up per task and reads no column, where a limit would send its rows to one."""
    return df.count() <= max_rows


def broadcast_if_fits(df: DataFrame, max_rows: int) -> DataFrame:
    """The table, hinted for broadcast only when its checked size allows it."""
    return F.broadcast(df) if fits(df, max_rows) else df


def _condition(look: Lookup, alias: str) -> Column:
    if isinstance(look.on, str):
        return F.expr(look.on)
    pairs = [F.col(f"{alias}.{k}") == F.col(f"{look.name}.{k}") for k in look.on]
    return reduce(lambda a, b: a & b, pairs)


def _share_of_null(key: Column, fact: DataFrame, alias: str) -> Column:
    # Hash of the row, not rand(): a retried task must deal its rows the same way.
    row = F.xxhash64(*[F.col(f"{alias}.{c}") for c in fact.columns])
    return F.when(key.isNull(), F.pmod(row, F.lit(_NULL_SHARES))).otherwise(F.lit(0))


def _words(texts: Iterable[str]) -> set[str]:
    """Aliases, and names that stand without one; ``b`` of ``a.b`` belongs to ``a``."""
    return {w.lower() for text in texts
            for w in re.findall(r"(?<![\w.])([A-Za-z_]\w*)", re.sub(r"\s*\.\s*", ".", text))}
