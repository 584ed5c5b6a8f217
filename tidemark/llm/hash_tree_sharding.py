"""Sharding by a hierarchical weighted hash tree: region, rack, shard."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import unit, written


@dataclass(frozen=True)
class Node:
    """A named subtree; a leaf carries the shard number. Weights are those of its leaves."""

    name: str
    children: tuple[Node, ...] = field(default=())
    shard: int | None = None
    own_weight: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own_weight

    @property
    def depth(self) -> int:
        return 1 + max(c.depth for c in self.children) if self.children else 0


def _leaf(shard: int) -> Node:
    return Node(f"shard{shard}", shard=shard)


#: Two regions of two racks of two shards.
TREE = Node("", tuple(
    Node(f"region{r}", tuple(
        Node(f"rack{k}", (_leaf(4 * r + 2 * k), _leaf(4 * r + 2 * k + 1))) for k in (0, 1)))
    for r in (0, 1)))


def grown(tree: Node, shard: int) -> Node:
    """The tree with one more shard, in a rack and region of its own: the weights of
    all other subtrees stay, so rows move nowhere but into the new shard."""
    return Node(tree.name, (*tree.children, Node(
        f"region{len(tree.children)}", (Node("rack0", (_leaf(shard),)),))))


def _draw(key: Column, path: str, node: Node) -> Column:
    """The path of the child that wins: the least -ln(u) / weight, u drawn from the
    key and the child's path. A child wins in proportion to its weight, and a change
    of one weight moves rows only to or from that child."""
    scores = [F.struct((-F.log(unit(key, F.lit(f"{path}/{c.name}"))) / F.lit(float(c.weight))).alias("score"),
                       F.lit(f"{path}/{c.name}").alias("path")) for c in node.children]
    return F.array_min(F.array(*scores))["path"]


def _inner(node: Node, path: str, depth: int) -> list[tuple[str, Node]]:
    if depth == 0:
        return [(path, node)] if node.children else []
    return [x for c in node.children for x in _inner(c, f"{path}/{c.name}", depth - 1)]


def _leaves(node: Node, path: str = "") -> list[tuple[str, int]]:
    if not node.children:
        return [(path, node.shard)]
    return [x for c in node.children for x in _leaves(c, f"{path}/{c.name}")]


def descend(df: DataFrame, key: Column, tree: Node, to: str) -> DataFrame:
    """Adds the shard of each row, level by level from the root."""
    path = f"_{to}_path"
    df = df.withColumn(path, F.lit(""))
    for depth in range(tree.depth):
        cases = [(F.col(path) == at, _draw(key, at, node)) for at, node in _inner(tree, "", depth)]
        df = df.withColumn(path, reduce(lambda c, x: c.when(*x), cases[1:], F.when(*cases[0]))
                           .otherwise(F.col(path)))
    leaves = _leaves(tree)
    shard = reduce(lambda c, x: c.when(F.col(path) == x[0], F.lit(x[1])), leaves[1:],
                   F.when(F.col(path) == leaves[0][0], F.lit(leaves[0][1])))
    return df.withColumn(to, shard.cast("int")).drop(path)


def shard_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", tree: Node = TREE,
               chunk_rows: int = 20_000) -> DataFrame:
    """Shard, slot and, with one more shard, the next shard of every row.

    Size is the bytes of the text plus 1; a null text has none. The key alone
    decides, so repeated keys share a shard; a null key counts as the word "null". Slots run
    from 0 in each shard, by chunk of the key's hash, then key. Chunks hold about
    ``chunk_rows`` rows each, so no task numbers a whole shard. Other columns are ignored.
    """
    spread = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    rows = docs.select(
        F.col(key).alias("doc_id"),
        (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"))
    shards = len(_leaves(tree))
    rows = descend(rows, spread, tree, "shard")
    rows = written(descend(rows, spread, grown(tree, shards), "grown_shard"), "shards")
    # Copies of a row are dealt over the chunks by their content as well.
    chunks = rows.count() // (chunk_rows * shards) + 1
    rows = rows.withColumn("_chunk", F.floor(unit(
        F.lit("slot"), spread, F.col("text_crc32").cast("string")) * chunks).cast("long"))
    totals = rows.groupBy("shard", "_chunk").agg(F.count("*").alias("_n")).select(
        F.col("shard").alias("_s"), F.col("_chunk").alias("_c"),
        F.coalesce(F.sum("_n").over(Window.partitionBy("shard").orderBy("_chunk").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("shard", "_chunk").orderBy(
        F.col("doc_id").asc_nulls_first(), "text_crc32", "size")) - 1
    numbered = rows.withColumn("_place", place).join(
        totals, (F.col("shard") == F.col("_s")) & (F.col("_chunk") == F.col("_c")))
    return numbered.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                           (F.col("_before") + F.col("_place")).cast("long").alias("slot"), "grown_shard")
