"""Positions of rows within their group, in a global order, whatever the size of a group."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import ship_package, written


def _count_runs(group: str, part: str, at: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            key = batch.column(group)
            fresh = np.ones(n, bool)
            fresh[1:] = pc.not_equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)
            fresh[0] = last is None or key[0].as_py() != last
            index = np.arange(n)
            start = np.maximum.accumulate(np.where(fresh, index, 0))
            local = index - start
            if not fresh[0]:
                first = int(np.argmax(fresh)) if fresh.any() else n
                local[:first] += seen
            last, seen = key[n - 1].as_py(), int(local[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, here, np.int64)), pa.array(local.astype(np.int64))],
                names=[*batch.schema.names, part, at])

    return run


def numbered(df: DataFrame, group: str, order: Sequence[str], pos: str = "pos", size: str = "size") -> DataFrame:
    """The rows with their position from 0 in their group, by ``order``, and the group's size.

    ``group`` is a string column without nulls; ``order`` ascends, nulls first. Rows that agree in all of
    it take neighbouring positions, in the order of the input's partitions. Column names starting with
    ``_`` belong to this function.

    The rows are dealt by ranges of (group, order) and count their runs in their own task. So a group
    with a third of all rows spans as many tasks as its share, and what is added up per group
    is one number a task. ``df`` should be a written table: it is read twice, once for the ranges.
    """
    ship_package(df.sparkSession)
    columns = df.columns
    by = [group, *order, "_from"]
    dealt = df.withColumn("_from", F.spark_partition_id()).repartitionByRange(*by).sortWithinPartitions(*by)
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    counted = written(dealt.select(*columns).mapInArrow(
        _count_runs(group, "_part", "_at"), f"{shape}, _part long, _at long"), "numbered-rows")
    pieces = counted.groupBy(group, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(group)
    offsets = written(pieces.select(
        F.col(group).alias("_g"), F.col("_part").alias("_p"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(whole).alias("_all")),
        "numbered-offsets")
    return counted.join(offsets, (F.col(group) == F.col("_g")) & (F.col("_part") == F.col("_p"))).select(
        *columns, (F.col("_before") + F.col("_at")).alias(pos), F.col("_all").alias(size))
