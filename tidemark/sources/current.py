"""The current version of every key, kept up from the versions that are new."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.latest import latest_per_key, sort_key
from tidemark.operators.staging import stage
from tidemark.sources.keyed import KeyedSnapshots

_FRESH = "_fresh"


class CurrentState:
    """``latest_per_key`` of all versions given so far, stored by slices of the key.

    A merge ranks the new versions and the stored winners of *their* keys; nothing else is read or
    written. That is the same as ranking the whole history as long as versions are only added: a version
    that arrives late loses against a newer one, and one with the sort columns of the stored winner
    replaces it (a repeated delivery, a correction). A version that is taken back, or that fails
    ``where`` after it passed, is not seen: ``reset`` with the history then. Rows with a NULL in a key
    are left out, as no lookup can find them. ``keys`` and ``order`` are names of columns; all other
    columns ride along.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], order: Sequence[str | Column],
                 where: str | Column | None = None, slices: int = 16, buckets: int = 16):
        self.keys, self.order, self.where = list(keys), list(order), where
        self.store = KeyedSnapshots(spark, root, keys, slices, buckets)

    def _winners(self, versions: DataFrame) -> DataFrame:
        return latest_per_key(versions.dropna(subset=self.keys), self.keys, self.order, self.where)

    def merge(self, versions: DataFrame, run: str | None = None) -> int | None:
        """The store's version after these rows: a new one only if a winner changed. With a
        ``run`` a second call with the same name changes nothing. Returns None while there is no version. Another
        writer's version in between is a ``CommitConflict``: merge again."""
        if (done := self.store.replayed(run)) is not None:
            return done
        with stage(self._winners(versions), mode="table") as fresh:
            base = self.store.version()
            if base is None:
                return None if fresh.isEmpty() else self.store.upsert(fresh, run, base=None)
            kept = self.store.read(base, self.store.touched(fresh))
            rivals = kept.join(fresh.select(*self.keys), self.keys, "left_semi").withColumn(_FRESH, F.lit(0))
            both = rivals.unionByName(fresh.withColumn(_FRESH, F.lit(1)), allowMissingColumns=True)
            best = latest_per_key(both, self.keys, [*map(sort_key, self.order), F.col(_FRESH).desc()])
            # What is stored already, word for word, is no change.
            same = rivals.select(*fresh.columns) if set(fresh.columns) <= set(kept.columns) else None
            won = best.where(F.col(_FRESH) == 1).select(*fresh.columns)
            with stage(won if same is None else won.exceptAll(same), mode="table") as changed:
                return base if changed.isEmpty() else self.store.upsert(changed, run, base=base)

    def reset(self, history: DataFrame, run: str | None = None) -> int:
        """Rank a whole history anew; what was stored before is replaced."""
        return self.store.overwrite(self._winners(history), run)

    def read(self, version: int | None = None) -> DataFrame | None:
        """The current versions, or None before the first merge."""
        return self.store.read(version)
