"""Exact dedup by Grace hashing: partition, probe a bounded table, recurse on what is left."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, UPPER, batches_of, rows_of, scope, ship_package, written

_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())
#: Content one table may hold, and the mean content of one partition; the second is
#: well below the first, so that a partition is seldom passed on to another level.
TABLE_BYTES = 48 << 20
BUCKET_BYTES = 12 << 20


class ContentTable:
    """An open-addressing table (Python's dict) from whole content to the row that
    stands for it. Once full it takes nothing new, so each content is either in it
    with all its later copies or not at all."""

    def __init__(self, most_bytes: int):
        self._rows: dict[bytes, int] = {}
        self._room = most_bytes

    def find(self, content: bytes, row: int) -> int | None:
        """The row that stands for the content, ``row`` if it is new, None if there
        is no room. The first content always has room."""
        known = self._rows.get(content)
        if known is None and (self._room > 0 or not self._rows):
            self._rows[content] = known = row
            self._room -= len(content)
        return known


def _local(most_bytes: int, given: bool):
    schema = pa.schema([("row", pa.int64()), ("id", pa.int64()), ("rep", pa.int64()),
                        ("size", pa.int64()), ("content", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 40
        seen = ContentTable(most_bytes)

        def rows():
            for n, (key, text, row) in enumerate(rows_of(batches, "id", "text", "row")):
                row = row if given else first + n
                content = (text or "").encode().translate(_FOLD)
                rep = seen.find(content, row)
                new = rep is None or rep == row
                yield row, key, row if new else rep, len(content), content if new else None

        yield from batches_of(rows(), schema)

    return run


def _probe(most_bytes: int):
    schema = pa.schema([("rep", pa.int64()), ("class", pa.int64()), ("sha", pa.string()),
                        ("content", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ContentTable(most_bytes)

        def rows():
            for rep, content in rows_of(batches, "rep", "content"):
                found = table.find(content, rep)
                if found is None:
                    yield rep, None, None, content
                else:
                    yield rep, found, hashlib.sha256(content).hexdigest(), None

        yield from batches_of(rows(), schema)

    return run


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", row: str | None = None,
                 table_bytes: int = TABLE_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Group of each row by its whole text, A-Z in lower case; null counts as empty.

    Returns row, doc_id, keep_id, group_size, kept, text_sha256, one row per input
    row. The largest key of a group stays; null keys are the smallest, and of rows that
    repeat key and text one stays. ``row`` names a unique long column; without it rows are
    numbered. Other columns are ignored.

    Copies within an input partition meet in a table there first, so a text that a
    third of all rows hold reaches its partition once per map task. The shuffle
    files are the spill files of the method: a partition streams through a table of bounded
    bytes, and content that finds no room goes to the next level under another hash.
    """
    ship_package(docs.sparkSession)
    given = F.col(row).cast("long") if row else F.lit(None).cast("long")
    local = written(docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"),
                                given.alias("row")).mapInArrow(
        _local(table_bytes, row is not None),
        "row long, id long, rep long, size long, content binary"), "grace-rows")
    todo = local.where("content is not null").select("rep", "size", "content")
    levels = []
    while True:
        total = todo.agg(F.sum("size")).first()[0] or 0
        parts = int(total // bucket_bytes) + 1
        level = written(todo.repartition(
            parts, F.xxhash64("content", F.lit(len(levels)))).select("rep", "content").mapInArrow(
            _probe(table_bytes), "rep long, class long, sha string, content binary"), "grace-level")
        levels.append(level.where("class is not null").select("rep", "class", "sha"))
        left = level.where("class is null")
        if left.isEmpty():
            break
        todo = left.select("rep", F.octet_length("content").cast("long").alias("size"), "content")
    classes = reduce(DataFrame.unionAll, levels)
    members = local.select("row", "id", "rep")
    tops = members.groupBy("rep").agg(F.max(F.struct("id", "row")).alias("top"), F.count("*").alias("n"))
    groups = classes.join(tops, "rep").groupBy("class").agg(
        F.max("top").alias("top"), F.sum("n").alias("group_size"))
    known = classes.join(groups, "class").select("rep", "top", "group_size", "sha")
    return members.join(known, "rep").select(
        "row", F.col("id").alias("doc_id"), F.col("top.id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("top.row")).alias("kept"), F.col("sha").alias("text_sha256"))


def keep_one_each(docs: DataFrame, key: str = "doc_id", text: str = "text", unique: bool = False) -> DataFrame:
    """The rows that stay, with all their columns as they are; see ``exact_groups`` for which.

    A column called ``_grace_row`` is an error. Two tables stay below the shared folder, as the result
    reads them: the input and the numbers of the rows that stay. ``unique`` says that the key is a long one that no two
    rows share and no row lacks: it numbers the rows then, and the input is not copied but read again."""
    if "_grace_row" in docs.columns:
        raise ValueError("the column _grace_row would be overwritten")
    with scope() as here:
        marked = docs.withColumn("_grace_row", F.col(key).cast("long") if unique else F.monotonically_increasing_id())
        if not unique:
            marked = here.keep(written(marked, "grace-input"))
        kept = here.keep(written(exact_groups(marked, key, text, "_grace_row").where("kept").select(
            F.col("row").alias("_grace_row")), "grace-kept"))
    return marked.join(kept, "_grace_row", "left_semi").drop("_grace_row")
