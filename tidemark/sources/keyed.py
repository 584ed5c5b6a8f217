"""A keyed snapshot cut into slices: an upsert rewrites the slices of its delta, a join reads them only.

Rows are dealt to slices by one hash of the key and, inside a slice, to buckets by Spark's own
bucketing hash. A version is a record that names the folder of every slice; a new version names new
folders for the slices it changed and the old ones for the others (copy on write).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.changes import CREATED, HASH, apply_delta
from tidemark.operators.shares import shares_of, table_ddl
from tidemark.session import own_shuffles, remove
from tidemark.sources.commits import CommitConflict, CommitLog

_SLICE = "_slice"
_ANY = object()


class KeyedSnapshots:
    """``keys`` with their types are fixed by the first version, as are ``slices`` and ``buckets``.

    slices: unit of rewriting and pruning. buckets: tasks of a join with the snapshot; a slice is that many
    files. The record of a version holds one folder name per slice.
    """

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], slices: int = 16, buckets: int = 16):
        self.spark, self.root, self.keys = spark, root.rstrip("/"), list(keys)
        self.commits = CommitLog(spark, f"{self.root}/commits")
        known = self.commits.latest()
        self.slices, self.buckets = (known[1]["slices"], known[1]["buckets"]) if known else (slices, buckets)
        if known and known[1]["keys"] != self.keys:
            raise ValueError(f"{self.root} is keyed by {known[1]['keys']}")
        self._tables: dict[int, str] = {}

    # --- reading ------------------------------------------------------------------------------

    def version(self, below: int | None = None) -> int | None:
        found = self.commits.latest(below)
        return None if found is None else found[0]

    def record(self, version: int | None = None) -> dict | None:
        """The record of a version, by default the latest."""
        if version is None:
            found = self.commits.latest()
            return None if found is None else found[1]
        record = self.commits.record(version) if version in self.commits.numbers() else None
        if record is None:
            raise ValueError(f"no version {version} below {self.root}")
        return record

    def folders(self, version: int | None = None) -> dict[int, str]:
        """The folder of every slice that has rows."""
        record = self.record(version)
        return {} if record is None else {int(s): f"{self.root}/data/{f}/{_SLICE}={s}" for s, f in record["folders"].items()}

    def schema(self, version: int | None = None) -> T.StructType | None:
        record = self.record(version)
        return None if record is None else T.StructType.fromJson(json.loads(record["schema"]))

    def read(self, version: int | None = None, slices: Sequence[int] | None = None) -> DataFrame | None:
        """The rows of a version, or of some of its slices; None before the first commit. Columns that
        came later are NULL in older files."""
        schema = self.schema(version)
        if schema is None:
            return None
        wanted = [f for s, f in sorted(self.folders(version).items()) if slices is None or s in slices]
        if not wanted:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*wanted)

    def slice_of(self, schema: T.StructType) -> Column:
        """The slice of a row by its key, in the key's stored types."""
        return F.pmod(F.xxhash64(*[F.col(k).cast(schema[k].dataType) for k in self.keys]), F.lit(self.slices)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """The slices that hold keys of some rows: at most as many numbers as there are slices."""
        schema = self.schema() or rows.schema
        return sorted(r[0] for r in rows.select(self.slice_of(schema)).distinct().collect())

    def bucketed(self, version: int | None = None) -> DataFrame | None:
        """A version as a bucketed table: a join or grouping by the keys needs no shuffle of it. The
        table lives in the session's catalog until ``release``."""
        number = self.version() if version is None else version
        if number is None:
            return None
        if number not in self._tables:
            schema, name = self.schema(number), f"tidemark_{uuid.uuid4().hex}"
            self.spark.sql(table_ddl(name, schema, f"{self.root}/data", self.keys, self.buckets, _SLICE))
            for s, folder in sorted(self.folders(number).items()):
                self.spark.sql(f"ALTER TABLE {name} ADD PARTITION ({_SLICE} = {s}) LOCATION '{folder}'")
            self._tables[number] = name
        return self.spark.table(self._tables[number])

    def prior_of(self, rows: DataFrame, columns: Sequence[str] = (HASH, CREATED)) -> DataFrame | None:
        """Keys and ``columns`` of the stored rows that can match ``rows``, for ``classify``.

        Only slices with keys of ``rows`` are read, and the buckets let the join shuffle ``rows``
        alone. ``rows`` is read once more for that: pass a stored stage.
        """
        stored = self.bucketed()
        if stored is None:
            return None
        return stored.where(F.col(_SLICE).isin(self.touched(rows))).select(*self.keys, *columns)

    def release(self) -> None:
        """Drop the catalog's entries; the files stay."""
        for name in self._tables.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self._tables.clear()

    # --- writing ------------------------------------------------------------------------------

    def _write(self, rows: Callable[[list[int]], DataFrame], schema: T.StructType, slices: Sequence[int]) -> tuple[str, list[int], T.StructType]:
        """Rows of the slices as bucketed files by slice in a new folder: its name, the slices it has and the rows' schema.
        Those of large tables are written some slices at a time, so that only the shuffle files of these are there."""
        folder, name = f"f-{uuid.uuid4().hex}", f"tidemark_{uuid.uuid4().hex}"
        every = rows(list(slices))
        shares = max(1, min(len(slices), shares_of(every)))
        path = f"{self.root}/data/{folder}"
        self.spark.sql(table_ddl(name, every.schema, path, self.keys, self.buckets, _SLICE))
        try:
            for i in range(shares):
                # Spark deals a repartition and its buckets by one hash: every task has whole buckets.
                dealt = rows(list(slices[i::shares])).withColumn(_SLICE, self.slice_of(schema)).repartition(self.buckets, *self.keys)
                with own_shuffles(self.spark):
                    dealt.write.insertInto(name)
        finally:
            self.spark.sql(f"DROP TABLE {name}")
        found = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        store = found.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in store.listStatus(found)] if store.exists(found) else []
        return folder, sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{_SLICE}=")), every.schema

    def _slices_of(self, rows: DataFrame, schema: T.StructType, slices: Sequence[int]) -> DataFrame:
        """The rows of some slices."""
        return rows if len(slices) == self.slices else rows.where(self.slice_of(schema).isin(list(slices)))

    def _commit(self, number: int, base: int | None, folders: dict[int, str], fresh: str, schema: T.StructType, run: str | None) -> int:
        try:
            if self.version() != base:
                raise CommitConflict(f"a version of {self.root} came after {base}, which the rows were made from")
            self.commits.add(number, {
                "keys": self.keys, "slices": self.slices, "buckets": self.buckets, "run": run, "base": base,
                "schema": schema.json(), "folders": {str(s): f for s, f in folders.items()}})
        except CommitConflict:
            remove(self.spark, f"{self.root}/data/{fresh}")
            raise
        return number

    def replayed(self, run: str | None) -> int | None:
        """The version that a run of this name has committed before, looked for among the latest."""
        if run is not None:
            for number in self.commits.numbers()[:1000]:
                record = self.commits.record(number)
                if record is not None and record["run"] == run:
                    return number
        return None

    def overwrite(self, rows: DataFrame, run: str | None = None) -> int:
        """A version that holds these rows and nothing else. The table is never without a version."""
        if (done := self.replayed(run)) is not None:
            return done
        number, base = self.commits.settled(), self.version()
        folder, found, schema = self._write(lambda some: self._slices_of(rows, rows.schema, some), rows.schema, range(self.slices))
        return self._commit(number, base, dict.fromkeys(found, folder), folder, schema, run)

    def upsert(self, delta: DataFrame, run: str | None = None, attempts: int = 1, base: object = _ANY) -> int:
        """Apply a delta as the next version: rows of its keys are replaced or added.

        Only the slices of the delta's keys are read and written; files of the others are those of the version
        before. Another writer's version in between is a ``CommitConflict``; with ``attempts`` the delta is
        applied again to the new version. A delta made from what a version holds names it as ``base`` (None: there
        was none), and any other latest version is a conflict. A ``run`` that was committed before changes nothing. The delta is
        read several times: pass a stored stage.
        """
        if (done := self.replayed(run)) is not None:
            return done
        while True:
            attempts -= 1
            try:
                return self._upsert(delta, run, base)
            except CommitConflict:
                if attempts < 1:
                    raise

    def _upsert(self, delta: DataFrame, run: str | None, expected: object) -> int:
        number, latest = self.commits.settled(), self.commits.latest()
        if expected is not _ANY and expected != (latest and latest[0]):
            raise CommitConflict(f"{self.root} has version {latest and latest[0]}, the delta was made from {expected}")
        if latest is None:
            folder, found, schema = self._write(lambda some: self._slices_of(delta, delta.schema, some), delta.schema, range(self.slices))
            return self._commit(number, None, dict.fromkeys(found, folder), folder, schema, run)
        base, record = latest
        schema = T.StructType.fromJson(json.loads(record["schema"]))
        slices = self.touched(delta)
        folder, found, grown = self._write(lambda some: apply_delta(
            self.read(base, some), self._slices_of(delta, schema, some), self.keys), schema, slices)
        folders = {int(s): f for s, f in record["folders"].items()} | dict.fromkeys(found, folder)
        return self._commit(number, base, folders, folder, grown, run)

    def retire(self, keep: int = 7) -> list[str]:
        """Delete the folders of slices that none of the last ``keep`` versions names; returns them."""
        records = [(n, self.commits.record(n)) for n in self.commits.numbers()]
        live = [r for _, r in records if r is not None]

        def named(some: list[dict]) -> set[str]:
            return {f"{f}/{_SLICE}={s}" for r in some for s, f in r["folders"].items()}

        gone = sorted(named(live[keep:]) - named(live[:keep]))
        for place in gone:
            remove(self.spark, f"{self.root}/data/{place}")
        return gone
