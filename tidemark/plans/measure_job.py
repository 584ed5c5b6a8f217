"""The whole job as one lazy plan: window, lookups, measures, hash, classify, stamp."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.hashing import row_hash
from tidemark.operators.changes import HASH, classify, only_changes, stamp
from tidemark.operators.latest import dedupe
from tidemark.operators.lookup import Lookup, star_join, used_lookups
from tidemark.operators.rules import Rule, apply_measures


@dataclass(frozen=True)
class MeasureJob:
    """What one job computes, apart from its rules.

    attributes: (name, SQL over the aliases) of the columns that are no measures.
    hash_columns: hashed columns in order; measures not listed follow by name.
    """

    fact_alias: str
    keys: tuple[str, ...]
    attributes: tuple[tuple[str, str], ...]
    hash_columns: tuple[str, ...]
    hash_bits: int = 512
    hash_nulls: str = "skip"
    hash_style: str = "hex"

    def hashed_columns(self, rules: Sequence[Rule]) -> list[str]:
        known = {c.lower() for c in self.hash_columns}
        return [*self.hash_columns, *[r.name for r in rules if r.name.lower() not in known]]


def measured_rows(facts: DataFrame, lookups: Sequence[Lookup], rules: Sequence[Rule],
                  job: MeasureJob, strict_names: Sequence[str] | None = None) -> DataFrame:
    """Attributes, measures and row hash of the given facts.

    No DISTINCT here: everything after it works row by row, so the one at the end
    of ``measure_delta`` gives the same set of rows, on the few that changed.
    """
    texts = [sql for _, sql in job.attributes] + [r.logic for r in rules]
    joined = star_join(facts, used_lookups(lookups, texts), job.fact_alias)
    attributes = [F.expr(sql).alias(name) for name, sql in job.attributes]
    rows = apply_measures(joined, rules, keep=attributes, strict_names=strict_names)
    digest = row_hash(rows, job.hashed_columns(rules), bits=job.hash_bits, nulls=job.hash_nulls,
                      style=job.hash_style)
    return rows.withColumn(HASH, digest)


def measure_delta(facts: DataFrame, lookups: Sequence[Lookup], rules: Sequence[Rule],
                  prior: DataFrame, job: MeasureJob, batch_ts,
                  strict_names: Sequence[str] | None = None, null_hash: str = "ignore",
                  assume_unique: bool = False) -> DataFrame:
    """New and changed rows against the prior snapshot, stamped with the batch time."""
    rows = measured_rows(facts, lookups, rules, job, strict_names)
    return delta_of(rows, prior, job.keys, batch_ts, null_hash, assume_unique)


def delta_of(rows: DataFrame, prior: DataFrame, keys: Sequence[str], batch_ts,
             null_hash: str = "ignore", assume_unique: bool = False) -> DataFrame:
    """The delta of hashed rows. When the join with the prior snapshot shuffles by
    key, the final DISTINCT reuses that partitioning and shuffles nothing."""
    changed = only_changes(classify(rows, prior, keys, null_hash=null_hash))
    return dedupe(stamp(changed, batch_ts), assume_unique)
