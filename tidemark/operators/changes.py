"""Change detection: compare row hashes with a prior snapshot, and apply the delta."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import time_literal
from tidemark.operators.lookup import fits

INSERTED, UPDATED, UNCHANGED = 1, 0, 3
HASH, CREATED, UPDATED_AT = "HashValue", "LoadCreateDate", "LoadUpdateDate"
CLASS, LABEL = "InsertUpdates", "AuditOperations"
_STORED = "_stored_"


def prior_snapshot(df: DataFrame, keys: Sequence[str], hash_col: str = HASH,
                   created_col: str = CREATED) -> DataFrame:
    """The columns of a stored table that change detection reads, and no others."""
    return df.select(*keys, hash_col, created_col)


def prune_prior(prior: DataFrame, current: DataFrame, keys: Sequence[str],
                max_keys: int = 1_000_000) -> DataFrame:
    """Prior rows of the current keys only, when these are few enough to broadcast.

    That saves shuffling the snapshot. With more keys the snapshot is returned as
    it is, since a shuffled semi-join would cost as much as the join it prepares.
    ``current`` is counted, so pass a stored or persisted stage.
    """
    wanted = current.select(*keys)
    if not fits(wanted, max_keys):
        return prior
    return prior.join(F.broadcast(wanted.distinct()), list(keys), "left_semi").select(*prior.columns)


def classify(current: DataFrame, prior: DataFrame, keys: Sequence[str], hash_col: str = HASH,
             created_col: str = CREATED, null_hash: str = "ignore") -> DataFrame:
    """Label each current row against the prior snapshot.

    InsertUpdates / AuditOperations: 1 / Inserted for an unknown key, 0 / Updated
    for another hash, 3 / NULL otherwise. A stored NULL hash counts as unchanged
    (null_hash="ignore"), or as changed (null_hash="update"). Several prior rows
    of one key give one result row each. The prior create time rides along for
    ``stamp``.
    """
    if null_hash not in ("ignore", "update"):
        raise ValueError(f"unknown option null_hash={null_hash!r}")
    stored = prior.select(*[F.col(k).alias(_STORED + k) for k in keys],
                          F.col(hash_col).alias(_STORED + "hash"),
                          F.col(created_col).alias(_STORED + "created"))
    match = reduce(lambda a, b: a & b, [F.col(k) == F.col(_STORED + k) for k in keys])
    absent = F.col(_STORED + keys[0]).isNull()
    if null_hash == "update":
        changed = ~F.col(hash_col).eqNullSafe(F.col(_STORED + "hash"))
    else:
        changed = F.col(hash_col) != F.col(_STORED + "hash")
    return current.join(stored, match, "left").select(
        *current.columns,
        F.when(absent, INSERTED).when(changed, UPDATED).otherwise(UNCHANGED).alias(CLASS),
        F.when(absent, "Inserted").when(changed, "Updated").alias(LABEL),
        F.col(_STORED + "created"))


def only_changes(df: DataFrame) -> DataFrame:
    """Inserted and updated rows."""
    return df.where(F.col(CLASS) != UNCHANGED)


def only_inserts(current: DataFrame, prior: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Current rows of unknown keys, as an anti-join that reads the prior keys only."""
    return current.join(prior.select(*keys), list(keys), "left_anti").select(*current.columns)


def stamp(df: DataFrame, batch_ts, updated_col: str = UPDATED_AT,
          created_col: str = CREATED) -> DataFrame:
    """Set the update time to the batch time; keep a stored create time, else take
    the batch time too. One literal per run, so that two actions agree."""
    stored = _STORED + "created"
    now = time_literal(batch_ts, df.schema[stored].dataType)
    kept = [c for c in df.columns if c not in (stored, updated_col, created_col)]
    return df.select(*kept, now.alias(updated_col), F.coalesce(stored, now).alias(created_col))


def apply_delta(snapshot: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The snapshot after the upsert: rows of other keys, and the delta. Rows that
    the delta does not mention stay, as nothing is ever deleted.

    Columns of either side stay, too: those of a new rule are NULL in rows the delta
    does not have, and dropped rules are NULL in rows it has. One name with two types is an error.
    """
    stored = {name.lower(): kind for name, kind in snapshot.dtypes}
    other = [f"{name}: {stored[name.lower()]} and {kind}" for name, kind in delta.dtypes
             if stored.get(name.lower(), kind) != kind]
    if other:
        raise TypeError(f"columns change their type: {'; '.join(other)}")
    kept = snapshot.join(delta.select(*keys), list(keys), "left_anti")
    return kept.select(*snapshot.columns).unionByName(delta, allowMissingColumns=True)


def empty_prior(current: DataFrame, keys: Sequence[str], hash_col: str = HASH,
                created_col: str = CREATED, time_type: T.DataType | None = None) -> DataFrame:
    """A prior snapshot without rows, for the first load."""
    fields = [T.StructField(k, current.schema[k].dataType) for k in keys]
    fields += [T.StructField(hash_col, T.StringType()),
               T.StructField(created_col, time_type or T.TimestampType())]
    return current.sparkSession.createDataFrame([], T.StructType(fields))
