"""Stage results: lazy, persisted, or cut off from their lineage."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from tidemark.session import own_shuffles, remove, scratch, shared_dir
from tidemark.operators.shares import bucket_share, shares_of, table_ddl, write_shares


class Stage:
    """A stage result and its release. Usable as a context manager."""

    def __init__(self, df: DataFrame, view: str | None = None, persisted: bool = False,
                 path: str | None = None, table: str | None = None):
        self.df, self._view, self._persisted, self._path, self._table = df, view, persisted, path, table

    def release(self) -> None:
        """Free the cache, drop the view and delete the written table; harmless when
        called again. Nothing may read the stage afterwards."""
        if self._persisted:
            self.df.unpersist()
            self._persisted = False
        if self._view:
            self.df.sparkSession.catalog.dropTempView(self._view)
            self._view = None
        if self._table:
            self.df.sparkSession.sql(f"DROP TABLE IF EXISTS {self._table}")
            self._table = None
        if self._path:
            remove(self.df.sparkSession, self._path)
            self._path = None

    def __enter__(self) -> DataFrame:
        return self.df

    def __exit__(self, *_: object) -> None:
        self.release()


def stage(df: DataFrame, name: str | None = None, mode: str = "lazy", keys: Sequence[str] = (),
          most: int | None = None, dealt: bool = False) -> Stage:
    """Keep a stage result, as a temporary view too if a name is given.

    lazy: nothing is stored. persist: memory and disk of the executors; lost
    parts are computed again. checkpoint: written to the shared checkpoint
    folder, so that an executor's loss costs nothing upstream. table: the same as
    a parquet table, of which later steps read only the columns they need.

    The shuffle files of a table's write go when it ends. With ``keys``, a table made from large
    files is written in shares of the keys' hashes, one after the other, so that only the shuffle files of one
    share are there at a time. Every share is a run of the plan on its own that reads the files again, ``most`` bounds
    their number where rows are wide; rows must not depend on chance. ``dealt`` says that the rows come from a shuffle by the keys, as those of ``latest_per_key`` do:
    such a table of shares has buckets, and a join or grouping by the keys shuffles nothing. One hot key would
    be one task there; leave it out where keys repeat much.
    """
    path = table = None
    if mode == "persist":
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
    elif mode == "checkpoint":
        context = df.sparkSession.sparkContext
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(shared_dir(df.sparkSession))
        df = df.checkpoint(eager=True)
    elif mode == "table":
        spark, path = df.sparkSession, scratch(df.sparkSession, name or "stage")
        shares = shares_of(df, most) if dealt else 1
        if shares > 1:
            table, buckets = f"tidemark_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
            spark.sql(table_ddl(table, df.schema, path, keys, buckets))
            for i in range(shares):
                with own_shuffles(spark):
                    df.where(bucket_share(keys, buckets, shares, i)).write.insertInto(table)
            df = spark.table(table)
        else:
            write_shares(df, path, keys, most)
            df = spark.read.schema(df.schema).parquet(path)
    elif mode != "lazy":
        raise ValueError(f"unknown mode {mode!r}")
    if name:
        df.createOrReplaceTempView(name)
    return Stage(df, name, mode == "persist", path, table)
