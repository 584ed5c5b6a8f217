"""Linking of items that share keys: candidates, verification, connected components."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import drop, scope, written

#: Keys of more components are wide; so many of them an item names, for a pair to be returned at the first that it shares.
WIDE, _NAMED = 8, 32


def components(edges: DataFrame) -> DataFrame:
    """(item, component) of every item on an edge (a, b); the component is its least item.

    Alternates large-star and small-star steps: each hangs the neighbours of a node on
    its least neighbour. Minima aggregate before they are shuffled, joins are plain ones whose hot
    keys adaptive execution splits, and each step is a table in the shared folder. Only small-star drops
    repeated edges: large-star makes one edge of one edge. It ends as soon as all edges form stars.
    """
    both = edges.where("a <> b")
    now = written(both.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "star-links")
    while True:
        sides = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = sides.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = sides.join(least, F.col("u") == F.col("w")).where("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large, "large-star")
        drop(now)
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), "m")
        small = large.join(least, F.col("u") == F.col("w")).select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        now = written(small.where("u <> v").unionAll(least.select(F.col("w").alias("u"), F.col("m").alias("v"))).distinct(),
                      "small-star")
        drop(large)
        if _stars(now):
            break
    return now.select(F.col("u").alias("item"), F.col("v").alias("component")).unionAll(
        now.select(F.col("v").alias("item"), F.col("v").alias("component")).distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether the distinct edges (u, v), u > v, hang every node on one node that hangs on none."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionAll(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
    found = ends.groupBy("x").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return found.where("hangs > 1 or hangs > 0 and holds > 0").agg(F.count("*")).first()[0] == 0


def link_items(members: DataFrame, attributes: list[str], pairs_of: Callable[[DataFrame], DataFrame],
               verify: Callable[[DataFrame], DataFrame], pivots: tuple[int, ...] = (4,), slices: int = 8,
               details: DataFrame | None = None, likely: Callable[[str, str], Column] | None = None,
               order: str | None = None) -> DataFrame:
    """Components of the graph of all verified pairs of items that share a key.

    ``members``: key, item (longs) and attributes; made by ``written``, the table goes once its open keys are stored. ``pairs_of`` turns raw pairs (a, b
    and the attributes with suffixes _a and _b, once per shared key) into distinct
    candidates (a, b); ``verify`` keeps the true ones. Exact, but never all
    pairs of a group: first, in a round for each of ``pivots``, the members of a key are
    compared with a pivot, of so many choices that the keys of one group of near copies
    name the same few. What the links join needs no further check. Then every pair of members in
    *different* components that shares a key is compared: the largest component of a
    key against the rest, and the rest among themselves. One of ``slices`` shares of the members
    comes first: what it links to a component is not compared with all others of that. Then
    all members that are still of use do, but for the pairs checked before: a key whose members are all of one component has
    nothing left to compare. ``details``: one row per item, with
    all that ``likely`` reads. That gives a condition that every linked pair meets, from the prefixes of the columns of
    either side. It keeps other pairs from being verified, and in the last rounds out of what the join returns.

    Near copies share many keys. With ``order`` a pair is returned in the last rounds at the first of its keys only, as far as
    these are among the first wide ones of both items. It names the key or an attribute whose values put the keys that two items
    share in the same order, and at the first of which ``pairs_of`` passes every linked pair.
    """
    joined, checked, links = None, [], []

    def placed(rows: DataFrame) -> DataFrame:
        if joined is None:
            return rows.withColumn("_c", F.col("item"))
        return rows.join(joined, "item", "left").withColumn("_c", F.coalesce("component", "item")).drop("component")

    def check(raw: DataFrame, label: str, sift: bool = False) -> bool:
        """Verifies the pairs not seen before, with ``sift`` the likely ones of them; whether any are linked."""
        pairs = pairs_of(_ordered(raw, attributes))
        for old in checked:
            pairs = pairs.join(old, ["a", "b"], "left_anti")
        if sift:
            for side in ("a", "b"):
                pairs = pairs.join(details.select(F.col("item").alias(side), *[
                    F.col(c).alias(f"{side}_{c}") for c in details.columns if c != "item"]), side)
            pairs = pairs.where(likely("a_", "b_")).select("a", "b")
        pairs = written(pairs, f"{label}-pairs")
        if pairs.isEmpty():
            return False
        checked.append(pairs)
        links.append(written(verify(pairs), f"{label}-links"))
        return not links[-1].isEmpty()

    def renewed() -> DataFrame:
        with scope() as here:
            return here.keep(written(components(reduce(DataFrame.unionAll, links)), "components"))

    for choices in pivots:
        ranked = placed(members).withColumn("_o", F.xxhash64("item", F.pmod("key", F.lit(choices))))
        first = ranked.groupBy("key").agg(F.min("_o").alias("_o"))
        pivot = ranked.join(first, ["key", "_o"]).select("key", F.col("item").alias("_x"), F.col("_c").alias("_xc"), *[
            F.col(c).alias(f"_x_{c}") for c in attributes])
        if check(ranked.join(pivot, "key").where("_c <> _xc"), "star", likely is not None):
            joined = renewed()
    part = F.pmod(F.xxhash64("item", F.lit("slice")), F.lit(slices))
    # The last round leaves no member out: the links of the first may have changed which side of a pair leads.
    rows, last = members, []
    for share in (part == 0, F.lit(True)):
        open_keys = _open_keys(placed(rows), None if details is None else details.drop(*attributes), order)
        drop(*(last if last else [members] if hasattr(members, "_folder") else []))
        rows, last = open_keys.select("key", "item", *attributes), [open_keys]
        if check(_across(open_keys, share, likely), "cross"):
            joined = renewed()
    drop(*last)
    if joined is None:
        return members.sparkSession.createDataFrame([], "item long, component long")
    return joined


def _open_keys(placed: DataFrame, details: DataFrame | None, order: str | None = None) -> DataFrame:
    """The members of the keys with several components, with the largest of these as _big, with their details and, given an
    ``order``, as _before with the first wide keys of the item that come before the row's own."""
    sizes = written(placed.groupBy("key", "_c").agg(F.count("*").alias("_n")), "key-components")
    counted = sizes.groupBy("key").agg(F.max("_n").alias("_n"), F.count("*").alias("_k"))
    largest = counted.where("_k > 1").drop("_k")
    largest = sizes.join(largest, ["key", "_n"]).groupBy("key").agg(F.min("_c").alias("_big"))
    found = placed.join(largest, "key")
    if details is not None:
        found = found.join(details, "item")
    wide = [written(counted.where(F.col("_k") > WIDE).select("key"), "wide-keys")] if order else []
    if wide and not wide[0].isEmpty():
        named = placed.join(wide[0], "key").groupBy("item").agg(F.slice(F.sort_array(
            F.collect_set(F.struct(F.col(order).alias("at"), "key"))), 1, _NAMED).alias("_named"))
        earlier = F.filter("_named", lambda x: x["at"] < F.col(order))
        found = found.join(named, "item", "left").withColumn(
            "_before", F.coalesce(F.transform(earlier, lambda x: x["key"]), F.array().cast("array<long>"))).drop("_named")
    found = written(found, "open-keys")
    drop(sizes, *wide)
    return found


def _across(open_keys: DataFrame, share: Column, likely: Callable[[str, str], Column] | None) -> DataFrame:
    """Raw pairs of different components, the first side from a share of the members."""
    columns = [c for c in open_keys.columns if c not in ("key", "item", "_c", "_big")]
    rest = open_keys.where("_c <> _big").select("key", F.col("item").alias("_x"), F.col("_c").alias("_xc"), *[
        F.col(c).alias(f"_x_{c}") for c in columns])
    pairs = open_keys.where(share).join(rest, "key").where("_c <> _xc and (_c = _big or item < _x)")
    if likely is not None:
        pairs = pairs.where(likely("", "_x_"))
    return pairs.where("not arrays_overlap(_before, _x__before)") if "_before" in columns else pairs


def _ordered(pairs: DataFrame, attributes: list[str]) -> DataFrame:
    """Pairs of item and _x with the smaller one as a."""
    swap = F.col("item") > F.col("_x")

    def pick(name: str, other: str, to: str) -> list[Column]:
        return [F.when(swap, F.col(other)).otherwise(F.col(name)).alias(f"{to}a" if to == "" else f"{to}_a"),
                F.when(swap, F.col(name)).otherwise(F.col(other)).alias(f"{to}b" if to == "" else f"{to}_b")]

    return pairs.select(*pick("item", "_x", ""), *[x for c in attributes for x in pick(c, f"_x_{c}", c)])
