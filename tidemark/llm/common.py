"""Helpers the operators of this package share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.session import remove, scratch

#: White space between words: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACE = "\\x20\\x09-\\x0D"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Give the workers this package, once per context: tasks written in Python import
    it, and it need not be installed on the executors."""
    context = spark.sparkContext
    if getattr(context, "_tidemark_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="tidemark-package-"), "tidemark_package.zip")
    with zipfile.ZipFile(archive, "w") as packed:
        for source in sorted(root.rglob("*.py")):
            packed.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._tidemark_shipped = True


_open: list[scope] = []


class scope:
    """Removes, on leaving, the folders of the tables that ``written`` made inside, but for
    those handed over with ``keep``: they belong to the enclosing scope, if there is one.
    Every table made inside must have been read for the last time by then."""

    def __enter__(self) -> scope:
        self.folders: dict[str, SparkSession] = {}
        _open.append(self)
        return self

    def keep(self, table: DataFrame) -> DataFrame:
        spark = self.folders.pop(table._folder)
        outer = _open[_open.index(self) - 1] if _open.index(self) else None
        if outer is not None:
            outer.folders[table._folder] = spark
        return table

    def detach(self) -> dict[str, SparkSession]:
        """The folders that are left, which the caller removes later in place of this scope."""
        left, self.folders = self.folders, {}
        return left

    def __exit__(self, *_: object) -> None:
        _open.remove(self)
        for folder, spark in self.folders.items():
            remove(spark, folder)


def drop(*tables: DataFrame) -> None:
    """Remove tables made by ``written`` before their scope ends. Nothing may read them afterwards."""
    for each in tables:
        remove(each.sparkSession, each._folder)
        for outer in _open:
            outer.folders.pop(each._folder, None)


def written(df: DataFrame, label: str, batch_rows: int | None = None) -> DataFrame:
    """The rows as a parquet table below ``spark.checkpoint.dir``: computed once,
    and read again from the shared folder when an executor is lost. ``batch_rows``
    bounds the Arrow batches of plans that hand whole texts to Python. The innermost open
    ``scope`` removes the table. The write's own shuffle files go as soon as it ends, not when the driver
    happens to collect its garbage."""
    spark = df.sparkSession
    path = scratch(spark, label)
    if _open:
        _open[-1].folders[path] = spark
    settings = {_CLEANUP: "true"} | ({_BATCH: str(batch_rows)} if batch_rows else {})
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        df.write.option("compression", "zstd").parquet(path)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    found = spark.read.schema(df.schema).parquet(path)
    found._folder = path
    return found


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` computed once. Without it, the optimizer may copy the
    expression into every lambda that reads it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def unit(*parts: Column) -> Column:
    """A number in (0, 1) that the parts decide: the leading 52 bits of their MD5."""
    digits = F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10)
    return (digits.cast("double") + 0.5) / F.lit(float(2**52))


def running(df: DataFrame, keys: Sequence[str], chunk: Column, order: Sequence[str | Column],
            sums: dict[str, Column], kind: str = "long") -> DataFrame:
    """Exclusive running sums within ``keys``, in the order of (``chunk``, ``order``), as ``kind``.

    ``chunk`` must not fall as the order rises. Each (keys, chunk) is summed in a
    task of its own and only the totals of the chunks are run through per key, so a
    key with a third of all rows is spread over as many tasks as it has chunks.
    """
    part = df.withColumn("_chunk", chunk)
    inner = Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1)
    outer = Window.partitionBy(*keys).orderBy(F.col("_chunk").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, -1)
    totals = part.groupBy(*keys, "_chunk").agg(
        *[F.sum(value).alias(f"_t_{name}") for name, value in sums.items()])
    totals = totals.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_chunk").alias("_k_chunk"),
        *[F.coalesce(F.sum(f"_t_{name}").over(outer), F.lit(0)).alias(f"_o_{name}")
          for name in sums])
    own = part.withColumns(
        {f"_i_{name}": F.coalesce(F.sum(value).over(inner), F.lit(0))
         for name, value in sums.items()})
    same = F.col("_chunk").eqNullSafe(F.col("_k_chunk"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return own.join(totals, same, "left").select(
        *df.columns, *[(F.col(f"_o_{n}") + F.col(f"_i_{n}")).cast(kind).alias(n) for n in sums])


def rows_of(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """The rows of Arrow batches as tuples of Python values."""
    for batch in batches:
        yield from zip(*[batch.column(n).to_pylist() for n in names], strict=True)


def batches_of(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096,
               most_bytes: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches, closed by number of rows or by bytes of text."""
    held: list[tuple] = []
    weight = 0
    for row in rows:
        held.append(row)
        weight += sum(len(v) for v in row if isinstance(v, (bytes, str)))
        if len(held) >= size or weight >= most_bytes:
            yield _batch(held, schema)
            held, weight = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, field.type) for column, field in zip(zip(*rows), schema, strict=True)],
        schema=schema)
