"""Merkle manifest of a table: one tree per source, one over the sources, proofs by recomputation.

Only every ``SPAN``-th level of a tree is stored. A proof needs all levels: the missing
interior nodes of an aligned subtree (``FAN ** SPAN`` nodes of a stored level at most) are
computed again from the stored nodes below it, their siblings handed out, and the nodes forgotten.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches_of, rows_of, scope, ship_package, written
from tidemark.llm.numbering import numbered

FAN = 3
#: Levels between two stored ones: subtrees of 243 nodes, of which 121 are computed again.
SPAN = 5
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_TOP = "sources"


def encoded(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(**replaced: Column) -> Column:
    """The leaf of a row: SHA-256 over its encoded columns, some of them replaced."""
    return F.sha2(F.concat(*[encoded(replaced.get(c, F.col(c))) for c in COLUMNS]), 256)


def combine(digests: list[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def regrown(nodes: list[str], steps: int) -> list[list[str]]:
    """The nodes and ``steps`` levels above them, each run of ``FAN`` nodes combined, the last of fewer."""
    levels = [nodes]
    for _ in range(steps):
        below = levels[-1]
        levels.append([combine(below[i:i + FAN]) for i in range(0, len(below), FAN)])
    return levels


def siblings(levels: list[list[str]], at: int) -> list[str]:
    """Of each level below the last: the siblings left of the node's ancestor, and those right of it."""
    found = []
    for level in levels[:-1]:
        run = at - at % FAN
        found += ["".join(level[run:at]), "".join(level[at + 1:run + FAN])]
        at //= FAN
    return found


def folded(leaf: str, path: list[str]) -> str:
    """The root that a leaf and its siblings make."""
    for left, right in zip(path[::2], path[1::2], strict=True):
        leaf = combine([left, leaf, right])
    return leaf


def height(size: Column) -> Column:
    """Levels above ``size`` leaves: the least d with FAN ** d >= size."""
    powers = F.array(*[F.lit(FAN**i).cast("long") for i in range(40)])
    return F.size(F.filter(powers, lambda p: p < size))


@dataclass(frozen=True)
class Manifest:
    """Stored levels of the source trees and of the tree over them, lowest first (tree, pos, digest,
    height; the lowest of the sources also doc_id and claim), and the root; None without rows."""

    levels: list[DataFrame]
    top_levels: list[DataFrame]
    subroots: DataFrame
    root: str | None


def _up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("digest", pa.string()), ("height", pa.int32())])

    def rows():
        given = rows_of(batches, "tree", "block", "digest", "height", "steps")
        for (tree, block, high, steps), run in groupby(given, lambda r: (r[0], r[1], r[3], r[4])):
            yield tree, block, regrown([r[2] for r in run], steps)[-1][0], high

    yield from batches_of(rows(), schema)


def _blocks(level: DataFrame, done: int) -> DataFrame:
    """A stored level cut into aligned subtrees, with the number of levels each has up to its top."""
    return level.withColumns({"block": F.expr(f"pos div {FAN**SPAN}"),
                              "steps": F.least(F.lit(SPAN), F.col("height") - done)})


def _grow(leaves: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The stored levels above ``leaves`` and the top node of every tree."""
    levels, tops, done = [leaves], [], 0
    while True:
        by = ["tree", "block"]
        above = written(_blocks(levels[-1], done).select(*by, "pos", "digest", "height", "steps").repartition(
            *by).sortWithinPartitions(*by, "pos").mapInArrow(
            _up, "tree string, pos long, digest string, height int"), "merkle-level")
        done += SPAN
        tops.append(above.where(F.col("height") <= done).select("tree", "digest"))
        rest = above.where(F.col("height") > done)
        if rest.isEmpty():
            return levels, reduce(DataFrame.unionAll, tops)
        levels.append(rest)


def build(docs: DataFrame, claim: Column | None = None) -> Manifest:
    """The manifest of all rows of ``docs`` (doc_id, source, lang, n_chars, text).

    Leaves of a source ascend by doc_id, nulls first; rows of one doc_id by their leaf. Repeated
    rows are leaves of their own. Null is a source like others, the first. No rows: no root.
    Other columns, whatever their names, are not read. ``claim`` is carried along for
    ``verify``: the leaf of a row as somebody else holds it, null for the same.

    Text is read and hashed once; all further steps move digests only. Every step
    deals subtrees, never a source, so a source with a third of all rows is as
    many tasks' work as others. Call inside a ``scope``, which removes the stored levels.
    """
    ship_package(docs.sparkSession)
    # Non-null names of sources, in the order of the sources: "-" comes before "=".
    tree = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("-"))
    given = F.lit(None).cast("string") if claim is None else claim
    leaves = written(docs.select(tree.alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
                                 leaf_digest().alias("digest"), given.alias("claim")), "merkle-leaves")
    placed = written(numbered(leaves, "tree", ["doc_id", "digest"]).withColumn("height", height(F.col("size"))).drop(
        "size"), "merkle-placed")
    levels, tops = _grow(placed)
    subroots = written(tops, "merkle-subroots")
    over = written(numbered(subroots.select(F.lit(_TOP).alias("tree"), F.col("tree").alias("name"), "digest"),
                            "tree", ["name"]).withColumn("height", height(F.col("size"))).drop("size"), "merkle-top")
    top_levels, top = _grow(over)
    root = top.first()
    return Manifest(levels, top_levels, subroots, root["digest"] if root else None)


def _down(emit: Callable, fields: list[str], schema: pa.Schema):
    """Runs over aligned subtrees, each led by the path of its top, and emits rows per node."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            given = rows_of(batches, "tree", "block", "pos", "digest", "steps", "subroot", "path", *fields)
            for _, members in groupby(given, lambda r: (r[0], r[1])):
                head = next(members)
                nodes = list(members)
                if not nodes:
                    continue
                levels = regrown([r[3] for r in nodes], nodes[0][4])
                for i, row in enumerate(nodes):
                    yield emit(row, head[5], siblings(levels, i) + head[6])

        yield from batches_of(rows(), schema)

    return run


def _with_paths(level: DataFrame, heads: DataFrame, done: int, emit: Callable, shape: str, schema: pa.Schema,
                fields: tuple[str, ...] = ()) -> DataFrame:
    """``emit`` for every node of a stored level; ``heads``: tree, block, subroot, path of the subtrees' tops.

    A head travels once per subtree, as the row before its nodes, and not with each of them.
    """
    nodes = _blocks(level, done).select("tree", "block", "pos", "digest", "steps", *fields)
    led = nodes.unionByName(heads.withColumn("pos", F.lit(-1).cast("long")), allowMissingColumns=True)
    by = ["tree", "block"]
    return led.repartition(*by).sortWithinPartitions(*by, "pos").mapInArrow(
        _down(emit, list(fields), schema), shape)


def _node_path(row: tuple, subroot: str, path: list[str]) -> tuple:
    return row[0], row[2], subroot, path


_HEADS = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("subroot", pa.string()), ("path", pa.list_(pa.string()))])
_HEADS_SHAPE = "tree string, block long, subroot string, path array<string>"


def _descend(levels: list[DataFrame], tops: DataFrame, emit: Callable, shape: str, schema: pa.Schema,
             fields: tuple[str, ...]) -> DataFrame:
    """From the tops (tree, height, subroot, path) down to the lowest level, subtree by subtree."""
    above = None
    for k in range(len(levels) - 1, -1, -1):
        # Trees whose top is the root of one subtree of this level.
        mine = F.col("height") <= (k + 1) * SPAN if k == 0 else F.col("height").between(k * SPAN + 1, (k + 1) * SPAN)
        heads = tops.where(mine).select("tree", F.lit(0).cast("long").alias("block"), "subroot", "path")
        if above is not None:
            heads = heads.unionByName(above)
        if k == 0:
            return _with_paths(levels[0], heads, 0, emit, shape, schema, fields)
        above = written(_with_paths(levels[k], heads, k * SPAN, _node_path, _HEADS_SHAPE, _HEADS), "merkle-paths")


def _source_tops(manifest: Manifest) -> DataFrame:
    """tree, height, subroot and path to the root of every source."""
    top_height = manifest.top_levels[0].select("height").first()["height"]
    spark = manifest.subroots.sparkSession
    start = spark.createDataFrame([(_TOP, top_height, manifest.root, [])],
                                  "tree string, height int, subroot string, path array<string>")
    schema = pa.schema([("tree", pa.string()), ("subroot", pa.string()), ("path", pa.list_(pa.string()))])
    paths = _descend(manifest.top_levels, start, lambda row, _, path: (row[7], row[3], path),
                     "tree string, subroot string, path array<string>", schema, ("name",))
    heights = manifest.levels[0].groupBy("tree").agg(F.max("height").alias("height"))
    return written(paths.join(heights, "tree"), "merkle-source-paths")


def prove(manifest: Manifest) -> DataFrame:
    """doc_id, leaf, subroot, root and path of every row: per level from the leaf to the
    root the siblings left of the node, joined, and those right of it. ``folded`` checks it."""
    schema = pa.schema([("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()),
                        ("path", pa.list_(pa.string()))])
    shape = "doc_id long, leaf string, subroot string, root string, path array<string>"
    root = manifest.root
    return _proofs(manifest, lambda row, subroot, path: (row[7], row[3], subroot, root, path), shape, schema)


def verify(manifest: Manifest) -> DataFrame:
    """The proofs as digests, and whether the claimed leaves fold to the root.

    doc_id, leaf, subroot, root, proof_sha256 (over the siblings in their order), folded_root
    and verified of every row; a row without a claim is folded from its own leaf.
    """
    schema = pa.schema([(n, pa.int64() if n == "doc_id" else pa.bool_() if n == "verified" else pa.string()) for n in (
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")])
    shape = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    root = manifest.root

    def emit(row: tuple, subroot: str, path: list[str]) -> tuple:
        found = folded(row[3] if row[8] is None else row[8], path)
        return row[7], row[3], subroot, root, combine(path), found, found == root

    return _proofs(manifest, emit, shape, schema)


def _proofs(manifest: Manifest, emit: Callable, shape: str, schema: pa.Schema) -> DataFrame:
    if manifest.root is None:
        return manifest.subroots.sparkSession.createDataFrame([], shape)
    return _descend(manifest.levels, _source_tops(manifest), emit, shape, schema, ("doc_id", "claim"))


def without_line_feeds() -> Column:
    """The leaf of a row whose text lost its line feeds, where 2 divides the CRC-32 of the doc_id; else null."""
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    bare = F.translate("text", "\n", "")
    return F.when(chosen & F.contains(F.col("text"), F.lit("\n")), leaf_digest(text=bare))


def manifest_report(docs: DataFrame) -> DataFrame:
    """Manifest of all rows, their proofs, and what becomes of rows whose text loses its line feeds.

    A row without a doc_id is a leaf as others and never tampered with. See ``build`` for nulls, ties, repeats.
    """
    with scope() as here:
        return here.keep(written(verify(build(docs, without_line_feeds())), "merkle-report"))
