"""Snapshots of a table as numbered versions of plain parquet.

A version is a folder of its own with a name nobody else takes, never the one being read. It
counts only once its commit file is there, which only one writer can create and which comes after
the data: a run that dies half-way leaves the last version in force.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.changes import apply_delta
from tidemark.operators.shares import write_shares
from tidemark.session import remove
from tidemark.sources.commits import CommitConflict, CommitLog
from tidemark.sources.sinks import clustered


class Snapshots:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.commits = CommitLog(spark, f"{self.root}/commits")

    def path(self, version: int) -> str:
        record = self.commits.record(version) if version in self.commits.numbers() else None
        if record is None:
            raise ValueError(f"no version {version} below {self.root}")
        return f"{self.root}/data/{record['folder']}"

    def version(self, below: int | None = None) -> int | None:
        """The latest complete version, optionally among those below a number."""
        found = self.commits.latest(below)
        return None if found is None else found[0]

    def read(self, version: int | None = None) -> DataFrame | None:
        """A version, by default the latest; None before the first commit."""
        version = self.version() if version is None else version
        return None if version is None else self.spark.read.parquet(self.path(version))

    def commit(self, df: DataFrame, version: int | None = None, keys: Sequence[str] = (),
               partitions: int = 0, run: str | None = None, base: int | None = None) -> int:
        """Write a version and put it in force. With ``partitions``, laid out by key; else with ``keys`` a large one is
        written in shares of the keys' hashes, so that the shuffle files of one share at a time are there.

        A number that is not above the latest one is an error, unless ``run`` is the
        name under which that number was committed: a replay, which changes nothing. So is
        losing a race with another writer for a number; the loser's rows do not count. ``base`` is
        the version the rows were made from: an error if another one has come since.
        """
        free = self.commits.settled()
        latest = self.version()
        if version is None:
            version = free if base is None else base + 1
        if version < free:
            before = self.commits.record(version) if version in self.commits.numbers() else None
            if run is not None and before is not None and before["run"] == run:
                return version
            if base is not None and latest != base:
                raise CommitConflict(f"version {latest} of {self.root} came after {base}, which the rows were made from")
            raise ValueError(f"version {version} is not above the stored {latest} in {self.root}")
        if base is not None and latest != base:
            raise CommitConflict(f"version {latest} of {self.root} came after {base}, which the rows were made from")
        folder = f"v{version:012d}-{uuid.uuid4().hex}"
        if partitions:
            df = clustered(df, keys, partitions)
        write_shares(df, f"{self.root}/data/{folder}", () if partitions else keys)
        try:
            if base is not None and self.version() != base:
                raise CommitConflict(f"another version of {self.root} came after {base}, which the rows were made from")
            self.commits.add(version, {"folder": folder, "run": run, "base": latest})
        except CommitConflict:
            remove(self.spark, f"{self.root}/data/{folder}")
            raise
        return version

    def retire(self, keep: int = 7) -> list[int]:
        """Delete the data of all but the last ``keep`` versions; their numbers stay taken."""
        numbers = [n for n in self.commits.numbers() if self.commits.record(n) is not None]
        for number in numbers[keep:]:
            remove(self.spark, self.path(number))
        return numbers[keep:]


def upsert(store: Snapshots, delta: DataFrame, keys: Sequence[str], version: int | None = None,
           partitions: int = 0, run: str | None = None) -> int:
    """Apply a delta as the next version: rows of its keys are replaced or added.

    The next version is numbered from the one that was read, so another writer in between is an
    error (``CommitConflict``), and the rows of neither are lost. The caller may try again.
    """
    base = store.version()
    if base is None:
        return store.commit(delta, 0 if version is None else version, keys, partitions, run)
    rows = apply_delta(store.read(base), delta, keys)
    return store.commit(rows, version, keys, partitions, run, base=base)
