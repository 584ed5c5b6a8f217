"""Change detection over a file stream, in micro-batches.

State on disk below ``root``:
  changes/batch=N   rows batch N inserted or updated
  base/             a snapshot of everything up to some batch, made now and then
  stream/           the id of the stream, so that no other one writes here
A batch reads the stored rows of its own keys only and writes its own changes
only. Its id names its folder, so a replay overwrites what the first try wrote.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.hashing import row_hash
from tidemark.operators.changes import (
    CREATED,
    HASH,
    classify,
    empty_prior,
    only_changes,
    prune_prior,
    stamp,
)
from tidemark.operators.latest import latest_per_key
from tidemark.operators.staging import stage
from tidemark.sources.snapshots import Snapshots
from tidemark.sources.tables import read_if_there

_BATCH = "batch"


class ChangeLog:
    """The stored result of a stream: a base snapshot and the changes after it."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str]):
        self.spark, self.root, self.keys = spark, root.rstrip("/"), list(keys)
        self.base = Snapshots(spark, f"{self.root}/base")

    def log(self, below: int | None = None) -> DataFrame | None:
        """Stored rows, possibly several per key, with the batch that wrote them."""
        upto = self.base.version(below)
        changes = read_if_there(self.spark, f"{self.root}/changes")
        if changes is not None:
            changes = changes.withColumn(_BATCH, F.col(_BATCH).cast("long"))
            if upto is not None:
                changes = changes.where(F.col(_BATCH) > upto)
            if below is not None:
                changes = changes.where(F.col(_BATCH) < below)
        if upto is None:
            return changes
        base = self.base.read(upto).withColumn(_BATCH, F.lit(upto).cast("long"))
        return base if changes is None else base.unionByName(changes)

    def current(self, below: int | None = None) -> DataFrame | None:
        """One row per key: the one the last batch wrote."""
        log = self.log(below)
        if log is None:
            return None
        return latest_per_key(log, self.keys, [f"{_BATCH} desc"]).drop(_BATCH)

    def compact(self, batch_id: int) -> None:
        """Fold the changes up to a batch into a new base."""
        rows = self.current(below=batch_id + 1)
        if rows is not None:
            self.base.commit(rows, batch_id, run=f"batch {batch_id}")

    def claim(self, checkpoint: str) -> None:
        """Tie the root to the stream of a checkpoint. Another stream would count its
        batches from 0 again and write over this one's: it is refused."""
        mine = self.spark.read.json(f"{checkpoint}/metadata").first()["id"]
        owner = read_if_there(self.spark, f"{self.root}/stream")
        if owner is not None:
            known = owner.first()["id"]
            if known != mine:
                raise RuntimeError(f"{self.root} belongs to stream {known}; start {mine} on a root of its own")
        elif self.log() is not None:
            raise RuntimeError(f"{self.root} holds rows of a stream that is not known")
        else:
            self.spark.createDataFrame([(mine,)], "id string").coalesce(1).write.parquet(f"{self.root}/stream")


def stream_cdc(stream: DataFrame, root: str, keys: Sequence[str], order: Sequence[str],
               hash_columns: Sequence[str], checkpoint: str | None = None,
               late: str = "latest", compact_every: int = 50, max_keys: int = 1_000_000,
               batch_time: Callable[[int], dt.datetime] | None = None,
               time_type: str = "timestamp", dedupe_within: tuple[str, str] | None = None,
               available_now: bool = True) -> StreamingQuery:
    """Start the change detection of a stream; read the result with ``ChangeLog``.

    order: the columns that make a row newer, highest first, as plain names.
    late="latest" drops rows older than the stored one, so the result does not
    depend on how the input is cut into batches; late="readmit" takes whatever
    differs from the stored hash, as a batch run over a changed source would.
    dedupe_within: (event time column, delay) drops repeated rows inside the delay
    before they reach a batch, with bounded state.
    """
    if late not in ("latest", "readmit"):
        raise ValueError(f"unknown option late={late!r}")
    if dedupe_within:
        stream = (stream.withWatermark(*dedupe_within)
                        .dropDuplicatesWithinWatermark([*keys, *order]))

    place = (checkpoint or f"{root.rstrip('/')}/checkpoint").rstrip("/")
    claimed: list[bool] = []

    def process(batch: DataFrame, batch_id: int) -> None:
        now = (batch_time(batch_id) if batch_time else
               dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
        store = ChangeLog(batch.sparkSession, root, keys)
        if not claimed:
            store.claim(place)
            claimed.append(True)
        newest = latest_per_key(batch, keys, [f"{c} desc" for c in order])
        hashed = newest.withColumn(HASH, row_hash(newest, hash_columns))
        with stage(hashed, mode="persist") as rows:
            stored = store.log(below=batch_id)
            if stored is None:
                fields = empty_prior(rows, keys).schema
                stored = rows.sparkSession.createDataFrame([], fields).select(
                    *keys, HASH, F.col(CREATED).cast(time_type).alias(CREATED),
                    *[F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in order
                      if c not in keys])
            else:
                columns = [*keys, HASH, CREATED, *[c for c in order if c not in keys]]
                pruned = prune_prior(stored.select(*columns, _BATCH), rows, keys, max_keys)
                stored = latest_per_key(pruned, keys, [f"{_BATCH} desc"]).drop(_BATCH)
            fresh = _not_older(rows, stored, keys, order) if late == "latest" else rows
            delta = stamp(only_changes(classify(fresh, stored, keys)), now)
            delta.write.mode("overwrite").parquet(f"{store.root}/changes/{_BATCH}={batch_id}")
        if compact_every and batch_id % compact_every == compact_every - 1:
            store.compact(batch_id)

    writer = stream.writeStream.foreachBatch(process).option(
        "checkpointLocation", place)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def _not_older(rows: DataFrame, stored: DataFrame, keys: Sequence[str],
               order: Sequence[str]) -> DataFrame:
    """Rows whose stored counterpart, if any, does not come later in the order."""
    later = stored.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                          F.struct(*order).alias("_order"))
    match = F.lit(True)
    for i, k in enumerate(keys):
        match = match & (F.col(k) == F.col(f"_k{i}"))
    newer_stored = F.col("_order") > F.struct(*order)
    return rows.join(later, match & newer_stored, "left_anti")
