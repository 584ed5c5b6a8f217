"""Counts of 64-bit hashes by their leading bits, in an array of fixed size."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidemark.llm.common import batches_of, scope, written

#: 2**22 counters: 16 MB on the driver at any number of rows.
BITS = 22
_CHUNK = 1 << 16
_SCHEMA = pa.schema([("chunk", pa.int32()), ("salt", pa.int32()), ("counts", pa.binary())])


def _packed(counts: np.ndarray, salt: int) -> Iterator[tuple]:
    for chunk in range(-(-len(counts) // _CHUNK)):
        part = counts[chunk * _CHUNK:(chunk + 1) * _CHUNK]
        if part.any():
            yield chunk, salt, zlib.compress(part.astype("<u8").tobytes(), 1)


def bucket_counts(df: DataFrame, hashes: Callable[[pa.RecordBatch], Iterator[np.ndarray]], bits: int = BITS,
                  salts: int = 16) -> np.ndarray:
    """How many of the hashes fall into each of 2**bits ranges, over all rows.

    Tasks count for themselves; the arrays are added in two steps, so no task
    adds up more than a ``salts``-th of them.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, np.int64)
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for h in hashes(batch):
                held.append((h >> np.uint64(64 - bits)).astype(np.int64))
                size += len(h)
            if size > 1 << 22:
                total += np.bincount(np.concatenate(held), minlength=1 << bits)
                held, size = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=1 << bits)
        yield from batches_of(_packed(total, TaskContext.get().partitionId() % salts), _SCHEMA)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, data in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                part = np.frombuffer(zlib.decompress(data), "<u8")
                sums[chunk] = sums[chunk] + part if chunk in sums else part
        yield from batches_of(((k, 0, zlib.compress(v.tobytes(), 1)) for k, v in sorted(sums.items())), _SCHEMA)

    shape = "chunk int, salt int, counts binary"
    parts = df.mapInArrow(count, shape)
    parts = parts.repartition("chunk", "salt").mapInArrow(add, shape).repartition("chunk").mapInArrow(add, shape)
    total = np.zeros(1 << bits, np.int64)
    with scope():
        for row in written(parts.select("chunk", "counts"), "range-counts").collect():
            part = np.frombuffer(zlib.decompress(row["counts"]), "<u8")
            total[row["chunk"] * _CHUNK:row["chunk"] * _CHUNK + len(part)] = part
    return total


def levels(counts: np.ndarray) -> np.ndarray:
    """Counts on a logarithmic scale of 256 steps, a byte each."""
    return np.minimum(255, np.round(8 * np.log2(1 + counts))).astype(np.uint8)
