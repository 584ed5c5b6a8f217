"""Prefix trie of conversations as a z-fast trie: handles by two-fattest depth, fat binary search, batch inserts.

Vocabulary. A *string* is a distinct sequence of turns, known by the smallest conversation that has it. Its
prefix of depth d has a *key* of 128 bits. The trie is a set of *paths*: a string inserted
into it owns the depths below the point where it left the trie. Branching points and ends cut a path
into *edges* (p, e], the compacted nodes. An edge is stored under the key of its *handle*, the prefix whose
depth is the two-fattest number in (p, e]: the one that the highest power of two divides.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import batches_of, drop, rows_of, running, scope, ship_package, written
from tidemark.llm.numbering import numbered

#: A conversation c first takes so many turns, below this number, of conversation c - c % FAMILY.
HEAD, FAMILY = 6, 100
#: Keys of the first turns that a string carries along; deeper ones are looked up.
INLINE = 64
#: Turns of a conversation whose running sums one task makes, and ids hashed as one piece.
CHUNK = 4096
NO_ENDS = hashlib.sha256(b"").hexdigest()


def fattest(low: Column, high: Column) -> Column:
    """The number in (low, high] with the most trailing zero bits; low < high."""
    bits = F.length(F.bin(low.bitwiseXOR(high))) - 1
    return high.bitwiseAND(F.call_function("shiftleft", F.lit(-1).cast("long"), bits))


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv, depth, mark, chars) of the rebuilt conversations, and (conv, length) of each, even turnless ones.

    Original turns are ordered by turn, nulls first, and by their content's hash where turns tie. Only the
    hash and the length of a text travel. The heads that many conversations take are at
    most ``HEAD`` - 1 rows of at most 2 * ``FAMILY`` - 1 conversations each.
    """
    def framed(c: str) -> Column:
        text = F.coalesce(F.col(c), F.lit(""))
        return F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)

    given = written(conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("conv_id").cast("long").cast("string").alias("name"), "turn",
        F.substring(F.sha2(F.concat(framed("role"), framed("text")), 256), 1, 32).alias("mark"),
        F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("chars")), "trie-turns")
    head = (F.crc32(F.col("name").cast("binary")) % HEAD).alias("head")
    placed = written(numbered(given, "name", ["turn", "mark"]).select(
        "conv", "pos", "mark", "chars", "size", head, (F.col("conv") - F.col("conv") % FAMILY).alias("base")), "trie-placed")
    first = placed.where("pos = 0").select("conv", "size", "head", "base")
    bases = first.where("conv = base").select(F.col("conv").alias("base"), F.col("size").alias("base_size"))
    taken = F.least("head", F.coalesce("base_size", F.lit(0)))
    convs = first.join(bases, "base", "left").select(
        "conv", "head", "base", taken.alias("taken"), (taken + F.greatest(F.col("size") - F.col("head"), F.lit(0))).alias("length"))
    convs = written(convs, "trie-conversations")
    heads = placed.where(f"conv = base and pos < {HEAD - 1}").select("base", "pos", "mark", "chars")
    theirs = convs.where("taken > 0").join(heads, "base").where("pos < taken").select(
        "conv", (F.col("pos") + 1).alias("depth"), "mark", "chars")
    own = placed.where("pos >= head").join(bases, "base", "left").select(
        "conv", (F.col("pos") - F.col("head") + taken + 1).alias("depth"), "mark", "chars")
    return theirs.unionAll(own), convs.select("conv", "length")


def prefix_keys(turns: DataFrame) -> DataFrame:
    """conv, depth, k1, k2 (the key of the prefix), total (code points down to here) and chars of every turn.

    A prefix is known by two sums of 64-bit hashes of its turns with their depths. Sums need no order, so a conversation
    with a third of all turns is summed up in chunks.
    """
    def hashed(salt: int) -> Column:
        return F.xxhash64(F.lit(salt), "depth", "mark").cast("decimal(38,0)")

    sums = running(turns, ["conv"], F.expr(f"depth div {CHUNK}"), ["depth"],
                   {"s1": hashed(1), "s2": hashed(2), "before": F.col("chars").cast("decimal(38,0)")}, "decimal(38,0)")
    s1, s2 = F.col("s1") + hashed(1), F.col("s2") + hashed(2)
    return sums.select("conv", "depth", F.xxhash64(s1, s2).alias("k1"), F.xxhash64(s2, F.lit(7), s1).alias("k2"),
                       (F.col("before") + F.col("chars")).cast("long").alias("total"), "chars")


class Trie:
    """The trie of a set of strings: ``keys`` (conv, depth, k1, k2, total, chars) and ``strings`` (conv, length)."""

    def __init__(self, keys: DataFrame, strings: DataFrame):
        self.keys, self.strings = keys, strings
        self.paths: list[DataFrame] = []   # path, lo, hi, parent; one table per batch
        self.ends: list[DataFrame] = []    # conv, path, depth: where strings end
        self._spent: list[DataFrame] = []  # tables that nothing reads once the strings are located
        self._inline = written(keys.where(F.col("depth") <= INLINE).groupBy("conv").agg(F.transform(
            F.sort_array(F.collect_list(F.struct("depth", "k1", "k2"))), lambda k: F.struct(k["k1"], k["k2"])).alias("inline")), "trie-inline")

    def _key(self, rows: DataFrame, conv: str, depth: Column, far: bool) -> DataFrame:
        """k1 and k2 of the prefix of ``depth``; for depths above 0 within the string."""
        if not far:
            at = F.get("inline", depth.cast("int") - 1)
            return rows.withColumns({"k1": at["k1"], "k2": at["k2"]})
        known = self.keys.select(F.col("conv").alias("_c"), F.col("depth").alias("_d"), "k1", "k2")
        return rows.withColumn("_at", depth).join(known, (F.col(conv) == F.col("_c")) & (F.col("_at") == F.col("_d")), "left").drop(
            "_c", "_d", "_at")

    def edges(self) -> DataFrame:
        """path, p, e of every edge, from the depths at which paths branch or strings end.

        A path has no more cuts than depths, and each cut stands for a string at least so long: no path can
        have more of them than about the root of twice the number of turns.
        """
        paths = reduce(DataFrame.unionAll, self.paths)
        cuts = paths.select("path", F.col("hi").alias("e")).unionAll(
            paths.where("parent is not null").select(F.col("parent").alias("path"), F.col("lo").alias("e"))).unionAll(
            reduce(DataFrame.unionAll, self.ends).where("depth > 0").select("path", F.col("depth").alias("e"))).distinct()
        before = F.lag("e").over(Window.partitionBy("path").orderBy("e"))
        return cuts.join(paths.select("path", "lo"), "path").select("path", F.coalesce(before, F.col("lo")).alias("p"), "e")

    def _handles(self) -> DataFrame:
        """path, e and the depth and key of the handle and of the first turn of every edge."""
        asked = self.edges().select("path", "e", F.explode(F.array(
            F.struct(F.lit("handle").alias("kind"), fattest(F.col("p"), F.col("e")).alias("depth")),
            F.struct(F.lit("first").alias("kind"), (F.col("p") + 1).alias("depth")))).alias("q")).select("path", "e", "q.*")
        known = self.keys.select(F.col("conv").alias("path"), "depth", "k1", "k2")
        return written(asked.join(known, ["path", "depth"]), "trie-handles")

    def _find(self, rows: DataFrame, handles: DataFrame, kind: str, depth: Column, want: Column, far: bool) -> DataFrame:
        """Adds found_path and found_e of the edge of ``kind`` that has the row's prefix of ``depth``, where wanted."""
        rows = self._key(rows.withColumns({"_want": want, "ask": depth}), "conv", F.when(want, depth), far)
        # Rows that ask for nothing are dealt by their own id, not heaped up under one null.
        rows = rows.withColumns({"ask": F.when(F.col("_want"), F.col("ask")).otherwise(-1),
                                 "k1": F.when(F.col("_want"), F.col("k1")).otherwise(F.col("conv")),
                                 "k2": F.coalesce("k2", F.lit(0))})
        known = handles.where(F.col("kind") == kind).select(
            F.col("depth").alias("ask"), "k1", "k2", F.col("path").alias("found_path"), F.col("e").alias("found_e"))
        return rows.join(known, ["ask", "k1", "k2"], "left").drop("ask", "k1", "k2", "_want")

    def _locate(self, waiting: DataFrame, handles: DataFrame, longest: int, far: bool) -> DataFrame:
        """Adds lcp, the depth down to which the trie has the string, and path, where it leaves.

        Fat binary search: the edges on the way down are found by handles alone. A string that leaves an edge
        below its handle finds no deeper one. Then its next turn tells whether it goes on into a child, and
        the keys along that last edge tell the depth.

        Every probe is a table of its own: the plans of all probes stay small and alike, which the driver keeps.
        """
        rows, last = waiting.withColumns({"a": F.col("lcp"), "b": F.col("length")}), None
        for _ in range(longest.bit_length()):
            probe = fattest(F.col("a"), F.col("b"))
            rows = self._find(rows, handles, "handle", probe, F.col("a") < F.col("b"), far)
            hit, asked = F.col("found_path").isNotNull(), F.col("a") < F.col("b")
            rows = rows.select(
                "conv", "length", *([] if far else ["inline"]), F.coalesce("found_path", "path").alias("path"),
                F.when(hit, probe).otherwise(F.col("lcp")).alias("lcp"), F.when(hit, F.col("found_e")).otherwise(F.col("a")).alias("a"),
                F.when(asked & ~hit, probe - 1).otherwise(F.col("b")).alias("b"))
            rows = written(rows, "trie-probe")
            if last is not None:
                drop(last)
            last = rows
        if last is not None:
            self._spent.append(last)
        rows = self._find(rows, handles, "first", F.col("a") + 1, F.col("a") < F.col("length"), far)
        into = F.col("found_path").isNotNull()
        rows = rows.select("conv", "length", *([] if far else ["inline"]), F.coalesce("found_path", "path").alias("path"),
                           F.when(into, F.col("a") + 1).otherwise(F.col("lcp")).alias("lcp"),
                           F.least("length", F.when(into, F.col("found_e")).otherwise(F.col("a"))).alias("most"))
        if not far:
            theirs = self._inline.select(F.col("conv").alias("path"), F.col("inline").alias("other"))
            both = F.zip_with(F.slice("inline", F.col("lcp").cast("int") + 1, (F.col("most") - F.col("lcp")).cast("int")),
                              F.slice("other", F.col("lcp").cast("int") + 1, (F.col("most") - F.col("lcp")).cast("int")), lambda x, y: x == y)
            same = F.size(F.filter(both, lambda x: F.coalesce(x, F.lit(False)))).cast("long")
            return rows.join(theirs, "path").select("conv", "length", "inline", "path", (F.col("lcp") + same).alias("lcp"))
        rows = written(rows, "trie-exits")
        self._spent.append(rows)
        steps = rows.where("lcp < most").select("conv", "path", F.explode(F.sequence(F.col("lcp") + 1, F.col("most"))).alias("depth"))
        steps = steps.join(self.keys.select("conv", "depth", "k1", "k2"), ["conv", "depth"]).join(
            self.keys.select(F.col("conv").alias("path"), "depth", F.col("k1").alias("o1"), F.col("k2").alias("o2")), ["path", "depth"])
        agree = steps.where("k1 = o1 and k2 = o2").groupBy("conv").agg(F.max("depth").alias("same"))
        return rows.join(agree, "conv", "left").select("conv", "length", "path", F.coalesce("same", "lcp").alias("lcp"))

    def insert_all(self) -> None:
        """Insert the strings in batches: of those that leave the trie at one point by the same turn, one
        drawn at random becomes a path; the others follow it in the next batch. A string's group is
        halved about each time, so the number of batches grows with the logarithm of the group."""
        start = self.strings.where("length > 0").select("conv", "length", F.lit(None).cast("long").alias("path"), F.lit(0).cast("long").alias("lcp"))
        self.ends.append(self.strings.where("length = 0").select(
            "conv", F.lit(None).cast("long").alias("path"), F.lit(0).cast("long").alias("depth")))
        waiting = [(far, rows) for far, rows in (
            (False, start.where(F.col("length") <= INLINE).join(self._inline, "conv")),
            (True, start.where(F.col("length") > INLINE))) if not rows.isEmpty()]
        handles, batch = None, 0
        while waiting:
            batch += 1
            located = []
            for far, rows in waiting:
                if handles is not None:
                    rows = self._locate(rows, handles, rows.agg(F.max("length")).first()[0], far)
                rows = self._key(rows, "conv", F.when(F.col("lcp") < F.col("length"), F.col("lcp") + 1), far)
                located.append((far, written(rows, "trie-located")))
                drop(*self._spent)
                self._spent.clear()
            if handles is not None:
                drop(handles)
            every = reduce(DataFrame.unionAll, [t.select("conv", "length", "path", "lcp", "k1", "k2") for _, t in located])
            leaders = every.where("lcp < length").groupBy("lcp", "k1", "k2").agg(
                F.min(F.struct(F.xxhash64("conv", F.lit(batch)), "conv", "length", "path")).alias("one"))
            paths = written(leaders.select(F.col("one.conv").alias("path"), "lcp", F.col("one.length").alias("hi"),
                                           F.col("one.path").alias("parent")).withColumnRenamed("lcp", "lo"), "trie-paths")
            self.paths.append(paths)
            self.ends.append(every.where("lcp = length").select("conv", "path", F.col("length").alias("depth")))
            self.ends.append(paths.select(F.col("path").alias("conv"), "path", F.col("hi").alias("depth")))
            rest = [(far, t.where("lcp < length").join(paths.select(F.col("path").alias("conv")), "conv", "left_anti").drop("k1", "k2"))
                    for far, t in located]
            waiting = [(far, rows) for far, rows in rest if not rows.isEmpty()]
            if waiting:
                handles = self._handles()

    def totals(self, weights: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Of every edge, what its lower end and all below it hold; and the same of whole paths, as their parents see them.

        ``weights``: conv, members per string. Paths hang on paths of earlier batches, so the batches are
        summed up from the last to the first, and along each path from its end.
        """
        at = self.keys.select(F.col("conv").alias("path"), F.col("depth").alias("_d"), "total")
        edges = self.edges()
        edges = edges.join(at.select("path", F.col("_d").alias("e"), F.col("total").alias("total_e")), ["path", "e"]).join(
            at.select("path", F.col("_d").alias("p"), F.col("total").alias("total_p")), ["path", "p"], "left")
        ending = reduce(DataFrame.unionAll, self.ends).join(weights, "conv").groupBy("path", F.col("depth").alias("e")).agg(
            F.sum("members").alias("own"), F.min("conv").alias("least"), F.min("conv").alias("ending"))
        edges = written(edges.join(ending, ["path", "e"], "left").withColumn("total_p", F.coalesce("total_p", F.lit(0))), "trie-edges")
        nodes, hanging = [], None
        for paths in reversed(self.paths):
            mine = edges.join(paths.select("path", "lo", "hi", "parent"), "path")
            none = {c: F.lit(None).cast("long") for c in ("h_n", "h_least", "h_leaves", "h_saved", "h_count")}
            if hanging is None:
                mine = mine.withColumns(none)
            else:
                mine = mine.join(hanging.where("parent is not null").groupBy(F.col("parent").alias("path"), F.col("lo").alias("e")).agg(
                    F.sum("n").alias("h_n"), F.min("least").alias("h_least"), F.sum("leaves").alias("h_leaves"),
                    F.sum("saved").alias("h_saved"), F.count("*").alias("h_count")), ["path", "e"], "left")
            down = Window.partitionBy("path").orderBy(F.desc("e")).rowsBetween(Window.unboundedPreceding, 0)
            below = Window.partitionBy("path").orderBy(F.desc("e")).rowsBetween(Window.unboundedPreceding, -1)

            def of(c: str) -> Column:
                return F.coalesce(F.col(c), F.lit(0))

            last = F.col("e") == F.col("hi")
            mine = mine.withColumns({
                "n": F.sum(of("own") + of("h_n")).over(down), "least": F.min(F.least("least", "h_least")).over(down),
                "leaves": F.sum(of("h_leaves") + F.when(last & F.col("h_count").isNull(), 1).otherwise(0)).over(down),
                "children": of("h_count") + F.when(last, 0).otherwise(1)})
            mine = mine.withColumn("along", (F.col("n") - 1) * (F.col("total_e") - F.col("total_p")))
            mine = mine.withColumn("below", F.sum(of("h_saved")).over(down) + F.coalesce(F.sum("along").over(below), F.lit(0)))
            mine = written(mine.select("path", "p", "e", "lo", "parent", "n", "least", "leaves", "children", "along", "below", "total_e", "ending"),
                           "trie-totals")
            nodes.append(mine)
            whole = mine.where("p = lo").select("path", "parent", "lo", "n", "least", "leaves", (F.col("along") + F.col("below")).alias("saved"))
            hanging = whole if hanging is None else hanging.unionAll(whole)
        return reduce(DataFrame.unionAll, nodes), hanging


def _end_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for string, pieces in groupby(rows_of(batches, "string", "ids"), lambda r: r[0]):
            digest, joint = hashlib.sha256(), b""
            for _, ids in pieces:
                digest.update(joint + ids.encode())
                joint = b","
            yield string, digest.hexdigest()

    yield from batches_of(rows(), pa.schema([("ending", pa.int64()), ("ends_sha256", pa.string())]))


def _ends(members: DataFrame) -> DataFrame:
    """ending (a string) and the SHA-256 of the ids (conv) of its conversations, ascending, joined by commas.

    Ids are joined in pieces of a ``CHUNK``; one task runs a string's pieces through the hash, which knows no other
    order, holding one piece at a time.
    """
    pieces = members.groupBy("string", F.expr("shiftright(conv, 12)").alias("piece")).agg(F.array_join(F.transform(
        F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))
    return pieces.repartition("string").sortWithinPartitions("string", "piece").select("string", "ids").mapInArrow(
        _end_hashes, "ending long, ends_sha256 string")


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of all rebuilt conversations, with the root.

    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 as the README
    states them. Null role or text counts as empty; null turns come first; turns that tie are ordered by a hash of
    their content; repeated rows are turns of their own. Rows without a conv_id belong to no conversation and are not
    read. No conversations: no nodes, not even the root. Other columns are not read.
    """
    ship_package(conversations.sparkSession)
    with scope() as here:
        turns, lengths = rebuilt_turns(conversations)
        keys = written(prefix_keys(turns), "trie-keys")
        full = keys.select("conv", F.col("depth").alias("length"), "k1", "k2")
        ends = lengths.join(full, ["conv", "length"], "left")
        # Turnless conversations are one string of their own; copies meet in the map tasks.
        strings = written(ends.groupBy("length", "k1", "k2").agg(F.min("conv").alias("string"), F.count("*").alias("members")), "trie-strings")
        none = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("k1", "k2")]
        members = written(ends.select("conv", "length", *none).join(strings.select("string", "length", *none), ["length", "k1", "k2"]).select(
            "conv", "string"), "trie-members")
        names = strings.select(F.col("string").alias("conv"), "length")
        trie = Trie(written(keys.join(names.select("conv"), "conv", "left_semi"), "trie-string-keys"), names)
        drop(keys)
        trie.insert_all()
        weights = strings.select(F.col("string").alias("conv"), "members")
        hashes = written(_ends(members), "trie-ends")
        return here.keep(written(_expanded(trie, weights, hashes), "trie-nodes"))


def _expanded(trie: Trie, weights: DataFrame, hashes: DataFrame) -> DataFrame:
    """Every depth of every edge as a row of its own, and the root."""
    root = weights.agg(F.min("conv").alias("conv_id"), F.sum("members").alias("n_convs")).where("n_convs > 0")
    empty = trie.strings.where("length = 0").select(F.col("conv").alias("ending")).join(hashes, "ending")
    if not trie.paths:
        below = root.select(F.lit(0).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"))
    else:
        nodes, whole = trie.totals(weights)
        below = whole.where("parent is null").agg(F.count("*").alias("n_children"), F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    # The root's own counts, what hangs on it, and its turnless conversations, stacked and put into one row.
    top = root.unionByName(below, allowMissingColumns=True).unionByName(
        empty.select("ends_sha256"), allowMissingColumns=True).agg(
        F.max("conv_id").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
        *[F.max(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.coalesce(F.max("ends_sha256"), F.lit(NO_ENDS)).alias("ends_sha256")).where("n_convs > 0")
    if not trie.paths:
        return top
    least = root.first()["conv_id"]
    above = nodes.select(F.col("path").alias("up_path"), F.col("e").alias("up_e"), F.col("least").alias("up_least"))
    edges = nodes.withColumn("up", F.when(F.col("p") == F.col("lo"), F.col("parent")).otherwise(F.col("path")))
    edges = edges.join(above, (F.col("up") == F.col("up_path")) & (F.col("p") == F.col("up_e")), "left").join(hashes, "ending", "left")
    rows = edges.withColumn("depth", F.explode(F.sequence(F.col("p") + 1, F.col("e"))))
    at = trie.keys.select(F.col("conv").alias("path"), "depth", F.col("total"), F.col("chars"))
    rows = rows.join(at, ["path", "depth"])
    end = F.col("depth") == F.col("e")
    return rows.select(
        F.col("least").alias("conv_id"), "depth",
        F.when(F.col("depth") == F.col("p") + 1, F.coalesce("up_least", F.lit(least))).otherwise(F.col("least")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.when(end, F.col("children")).otherwise(1).cast("long").alias("n_children"), F.col("leaves").alias("n_leaves"),
        ((F.col("n") - 1) * (F.col("total_e") - F.col("total") + F.col("chars")) + F.col("below")).alias("saved_tokens"),
        F.coalesce(F.when(end, F.col("ends_sha256")), F.lit(NO_ENDS)).alias("ends_sha256")).unionAll(top)
