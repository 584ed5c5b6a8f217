"""N-gram Jaccard join: rare-first prefix filtering, each pair verified once."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, UPPER, batches_of, drop, scope, ship_package, written
from tidemark.llm.components import link_items
from tidemark.llm.sketches import BITS, bucket_counts, levels

WORDS, PERCENT = 5, 75
#: Prefix n-grams that one task matches, and texts turned into n-grams at a time.
BUCKET_POSTINGS = 400_000
_CHUNK_BYTES = 1 << 20
_BATCH_ROWS = 256
#: Prefix n-grams a task holds while it deals them out or matches them.
_HELD = 1 << 19
#: Words of the bitmap of a set, of 64 bits each.
_BITMAP = [f"b{i}" for i in range(8)]

_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())
_WORD = np.ones(256, np.int8)
_WORD[[9, 10, 11, 12, 13, 32]] = 0
_RANDOM = np.random.Generator(np.random.PCG64(20240601))
_BYTES = _RANDOM.integers(1, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = _RANDOM.integers(1, 2**63, 64, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C17 | 3
#: Words of more bytes are hashed one by one: the sums of powers that serve for short ones are the same for long
#: words of two letters in certain orders.
_LONG = 32
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _mixed(h: np.ndarray) -> np.ndarray:
    """Spreads every bit over the word."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if len(_powers["up"]) < n:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def ngram_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """The distinct n-grams of each text as sorted 64-bit hashes.

    A-Z in lower case; words end at blanks, tabs and line ends. Fewer words than n count
    as one n-gram; no words or no text give an empty set.
    """
    data = [(t or "").encode().translate(_FOLD) for t in texts]
    joined = np.frombuffer(b"\n".join(data) + b"\n", np.uint8)
    first = np.cumsum([0, *[len(d) + 1 for d in data]])
    inside = np.diff(_WORD[joined], prepend=np.int8(0))
    begin, end = np.flatnonzero(inside == 1), np.flatnonzero(inside == -1)
    up, down = _power(len(joined) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[joined] * up[:len(joined)])])
    hashes = _mixed((sums[end] - sums[begin]) * down[begin])
    for at in np.flatnonzero(end - begin > _LONG):
        word = joined[begin[at]:end[at]].tobytes()
        hashes[at] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    edges = np.searchsorted(begin, first)
    grams = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
    for i in range(words):
        grams += hashes[i:len(grams) + i] * _PLACES[i]
    grams = _mixed(grams)
    sets = []
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        n = int(high - low)
        if n >= words:
            sets.append(np.unique(grams[low:high - words + 1]))
        elif n:
            whole = (hashes[low:high] * _PLACES[words:words + n]).sum(dtype=np.uint64, keepdims=True)
            sets.append(_mixed(whole + np.array([n], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def _sets_of(batch: pa.RecordBatch, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, set) of each text of a batch, a few megabytes of text at a time."""
    texts, held, size, start = batch.column("text").to_pylist(), [], 0, 0
    for at, text in enumerate(texts):
        held.append(text)
        size += len(text or "")
        if size >= _CHUNK_BYTES or at == len(texts) - 1:
            yield from enumerate(ngram_sets(held, words), start)
            held, size, start = [], 0, at + 1


def signature(grams: np.ndarray) -> int:
    """Identity of a set: texts with the same set are one item."""
    total = _mixed(grams ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64, keepdims=True)
    return int(_mixed(total + np.array([len(grams)], np.uint64) * _PLACES[0]).view(np.int64)[0])


def needed(n: int, percent: int) -> int:
    """Common n-grams that a set of n needs with any set it is linked to."""
    return -(-percent * n // 100)


# --- the passes over the texts ----------------------------------------------------------------

def bitmap(grams: np.ndarray) -> list[int]:
    """Parities of the number of n-grams in each of 512 ranges. What two bitmaps differ in, the sets differ in."""
    places = (_mixed(grams) >> np.uint64(55)).astype(np.int64)
    odd = (np.bincount(places, minlength=64 * len(_BITMAP)) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64).tolist()


_PROFILE = "doc_id long, sig long, n long, prefix binary, " + ", ".join(f"{b} long" for b in _BITMAP)


def _profiles(words: int, percent: int, common):
    """Per row: set identity and size and, once per set and task, its bitmap and its prefix: the
    rarest n-grams, of which every linked set has one."""
    schema = pa.schema([("doc_id", pa.int64()), ("sig", pa.int64()), ("n", pa.int64()), ("prefix", pa.binary()),
                        *[(b, pa.int64()) for b in _BITMAP]])
    none = [None] * len(_BITMAP)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = np.frombuffer(common.value, np.uint8)
        shift = np.uint64(64 - int(np.log2(len(level))))
        seen: set[int] = set()

        def rows():
            for batch in batches:
                ids = batch.column("doc_id").to_pylist()
                for at, grams in _sets_of(batch, words):
                    n = len(grams)
                    if not n:
                        yield ids[at], None, 0, None, *none
                        continue
                    sig, prefix, bits = signature(grams), None, none
                    if sig not in seen:
                        seen.add(sig)
                        order = np.lexsort((grams, level[grams >> shift]))
                        prefix = grams[order[:n - needed(n, percent) + 1]].tobytes()
                        bits = bitmap(grams)
                    yield ids[at], sig, n, prefix, *bits

        yield from batches_of(rows(), schema)

    return run


def _place(value: Column, bits: int) -> Column:
    """The range of a 64-bit hash, by its leading bits."""
    return F.shiftrightunsigned(value, 64 - bits)


def _key_place(bits: int) -> Column:
    """The range of the hash of a row's key; null as 0."""
    return _place(F.xxhash64(F.coalesce("doc_id", F.lit(0).cast("long"))), bits)


def _hit(places: DataFrame, bits: int) -> list[bytes]:
    """For each column, a bit for every of 2**bits ranges: whether it occurs. Tasks make bitmaps of 4 KB."""
    parts = places.select(F.posexplode(F.array(*places.columns)).alias("column", "place")).groupBy(
        "column", F.shiftright("place", 15).alias("part")).agg(F.bitmap_construct_agg(F.col("place").bitwiseAND(32767)).alias("bits"))
    flags = np.zeros((len(places.columns), max(4096, 2**bits // 8)), np.uint8)
    with scope():
        for r in written(parts, "ngram-hits").collect():
            flags[r["column"], r["part"] * 4096:(r["part"] + 1) * 4096] = np.frombuffer(r["bits"], np.uint8)
    return [f.tobytes() for f in flags]


def _sets(words: int, bits: int, wanted, keys):
    """The whole sets of the items whose identity falls into a wanted range, from the rows whose key (as
    ``place``) does, too: an item of many copies is made from the one row that stands for it."""
    schema = pa.schema([("sig", pa.int64()), ("grams", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        want, rows_want = (np.unpackbits(np.frombuffer(f.value, np.uint8), bitorder="little").astype(bool) for f in (wanted, keys))
        seen: set[int] = set()

        def rows():
            for batch in batches:
                batch = batch.filter(pa.array(rows_want[batch.column("place").to_numpy(zero_copy_only=False)]))
                for _, grams in _sets_of(batch, words):
                    if len(grams):
                        sig = signature(grams)
                        if want[(sig % 2**64) >> (64 - bits)] and sig not in seen:
                            seen.add(sig)
                            yield sig, grams.tobytes()

        yield from batches_of(rows(), schema)

    return run


# --- matching of prefixes ---------------------------------------------------------------------

def _scatter(buckets: int):
    """Prefix n-grams by hash bucket, as arrays."""
    schema = pa.schema([("bucket", pa.int32()), ("key", pa.binary()), ("item", pa.binary()),
                        ("n", pa.binary()), ("pos", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held: list[tuple]) -> Iterator[tuple]:
            sizes = [len(g) for _, _, g in held]
            key = np.concatenate([g for _, _, g in held])
            item = np.repeat(np.array([s for s, _, _ in held], np.int64), sizes)
            n = np.repeat(np.array([n for _, n, _ in held], np.int32), sizes)
            pos = np.concatenate([np.arange(s, dtype=np.int32) for s in sizes])
            bucket = (key % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for b in range(buckets):
                at = order[cuts[b]:cuts[b + 1]]
                if len(at):
                    yield b, key[at].tobytes(), item[at].tobytes(), n[at].tobytes(), pos[at].tobytes()

        def rows():
            held, size = [], 0
            for batch in batches:
                for sig, n, data in zip(*[batch.column(c).to_pylist() for c in ("sig", "n", "prefix")], strict=True):
                    held.append((sig, n, np.frombuffer(data, np.uint64)))
                    size += len(held[-1][2])
                    if size >= _HELD:
                        yield from flush(held)
                        held, size = [], 0
            if held:
                yield from flush(held)

        yield from batches_of(rows(), schema, size=256)

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of the n-grams that two or more items have.

    Arrays stream through: an n-gram met once is held back until a second item comes;
    from then on its members pass at once. Memory follows the distinct n-grams
    of the bucket, however many items one of them has.
    """
    names = ("key", "item", "n", "pos")
    kinds = (np.uint64, np.int64, np.int32, np.int32)
    single = [np.zeros(0, k) for k in kinds]
    many = np.zeros(0, np.uint64)

    def settle(held: list[list[np.ndarray]]) -> pa.RecordBatch | None:
        nonlocal single, many
        key, item, n, pos = (np.concatenate(x) for x in zip(single, *held, strict=True))
        order = np.lexsort((item, key))
        key, item, n, pos = key[order], item[order], n[order], pos[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (item[1:] != item[:-1])
        key, item, n, pos = key[new], item[new], n[new], pos[new]
        heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        sizes = np.diff(np.append(heads, len(key)))
        known = np.isin(key[heads], many, assume_unique=False)
        passes = np.repeat(known | (sizes > 1), sizes)
        many = np.concatenate([many, key[heads][(sizes > 1) & ~known]])
        single = [x[~passes] for x in (key, item, n, pos)]
        if not passes.any():
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array(key[passes].view(np.int64)), pa.array(item[passes]),
             pa.array(n[passes].astype(np.int64)), pa.array(pos[passes].astype(np.int64))], names=list(names))

    held, size = [], 0
    for batch in batches:
        for row in zip(*[batch.column(c).to_pylist() for c in names], strict=True):
            held.append([np.frombuffer(x, k) for x, k in zip(row, kinds, strict=True)])
            size += len(held[-1][0])
            if size >= _HELD:
                if (out := settle(held)) is not None:
                    yield out
                held, size = [], 0
    if held and (out := settle(held)) is not None:
        yield out


def _candidates(percent: int):
    """Length and positional filter, then each pair of items once."""
    def run(raw: DataFrame) -> DataFrame:
        near = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
        # From the first common n-gram on, the sets share no more than the shorter rest. A linked
        # pair passes there; what its later common n-grams say does not matter, so they may
        # fail here, inside the join, before anything is shuffled.
        most = F.least(F.col("n_a") - F.col("pos_a"), F.col("n_b") - F.col("pos_b"))
        enough = most * (100 + percent) >= (F.col("n_a") + F.col("n_b")) * percent
        return raw.where(near & enough).select("a", "b").distinct()

    return run


def _likely(percent: int):
    """Suffix filter on whole sets: a pair shares no more than half of what is left of its sizes
    when the bits that differ are taken off. It stands inside the join, before any set is moved."""
    def run(a: str, b: str) -> Column:
        differ = reduce(Column.__add__, [F.bit_count(F.col(f"{a}{w}").bitwiseXOR(F.col(f"{b}{w}"))) for w in _BITMAP])
        total = F.col(f"{a}n") + F.col(f"{b}n")
        return (total - differ) * (100 + percent) >= total * (2 * percent)

    return run


def _similar(percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    marks = (np.arange(1, 32, dtype=np.uint64) << np.uint64(59))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for a, b, x, y in zip(*[batch.column(c).to_pylist() for c in ("a", "b", "grams_a", "grams_b")], strict=True):
                    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    need = percent * (len(x) + len(y))
                    # Suffix filter: ranges of the order can share no more than their smaller side.
                    parts = [np.diff(np.concatenate([[0], np.searchsorted(s, marks), [len(s)]])) for s in (x, y)]
                    if (100 + percent) * int(np.minimum(*parts).sum()) < need:
                        continue
                    if (100 + percent) * len(np.intersect1d(x, y, assume_unique=True)) >= need:
                        yield a, b

        yield from batches_of(rows(), schema)

    return run


def jaccard_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS,
                   percent: int = PERCENT, bits: int = BITS, bucket_postings: int = BUCKET_POSTINGS) -> DataFrame:
    """n_shingles and component_id of every row; linked texts share a component.

    Two texts link when 100 * common >= percent * all of their distinct n-grams. The
    component is the smallest key that links reach. Texts without words link with
    nothing, not even each other, and are their own component. A null key is passed over
    for the smallest; repeated rows are linked like other copies. Other columns are ignored.

    The order of n-grams is rare-first by counts over all texts in 2**bits ranges (fixed
    size, so frequent n-grams stand out at any corpus size); a range that also holds others
    only makes the order less sharp, never the result. N-grams are known by
    64-bit hashes, sets by a 64-bit hash of theirs.
    """
    with scope() as here:
        return here.keep(written(_groups(docs, key, text, words, percent, bits, bucket_postings), "ngram-groups"))


def _groups(docs: DataFrame, key: str, text: str, words: int, percent: int, bits: int, bucket_postings: int) -> DataFrame:
    spark = docs.sparkSession
    ship_package(spark)
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for _, grams in _sets_of(batch, words):
            yield grams

    common = spark.sparkContext.broadcast(levels(bucket_counts(texts.select("text"), hashes, bits)).tobytes())
    rows = written(texts.mapInArrow(_profiles(words, percent, common), _PROFILE), "ngram-profiles", _BATCH_ROWS)
    prefixes = rows.where("prefix is not null").select("sig", "n", "prefix")
    postings = prefixes.agg(F.sum(F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)).first()[0] or 0
    buckets = int(postings // bucket_postings) + 1
    shared = prefixes.mapInArrow(_scatter(buckets), "bucket int, key binary, item binary, n binary, pos binary")
    members = written(shared.repartition(buckets, "bucket").mapInArrow(
        _shared, "key long, item long, n long, pos long"), "ngram-members", 64)

    # One row of each distinct set: of the rows that have it, one holds its bitmap for each task.
    items = written(rows.where("sig is not null").groupBy("sig").agg(
        F.min(F.coalesce("doc_id", F.lit(0))).alias("doc_id"), F.min("doc_id").alias("least"), F.max("n").alias("n"),
        *[F.max(b).alias(b) for b in _BITMAP]), "ngram-items")
    profiles, rows = rows, written(rows.select("doc_id", "sig", "n"), "ngram-rows")
    drop(profiles)  # The prefixes take the most room.
    placed = texts.select("text", _key_place(bits).alias("place"))

    def verify(pairs: DataFrame) -> DataFrame:
        sides = pairs.select(F.explode(F.array("a", "b")).alias("sig")).distinct()
        used = sides.join(items.select("sig", "doc_id"), "sig").select(_place(F.col("sig"), bits).alias("sig"), _key_place(bits).alias("key"))
        wanted, keys = (spark.sparkContext.broadcast(f) for f in _hit(used, bits))
        stored = written(placed.mapInArrow(_sets(words, bits, wanted, keys), "sig long, grams binary"), "ngram-sets", _BATCH_ROWS)
        found = stored.dropDuplicates(["sig"])
        sets_a = found.select(F.col("sig").alias("a"), F.col("grams").alias("grams_a"))
        sets_b = found.select(F.col("sig").alias("b"), F.col("grams").alias("grams_b"))
        links = written(pairs.join(sets_a, "a").join(sets_b, "b").select("a", "b", "grams_a", "grams_b").mapInArrow(
            _similar(percent), "a long, b long"), "ngram-links", _BATCH_ROWS)
        drop(stored)
        return links

    bitmaps = items.select(F.col("sig").alias("item"), "n", *_BITMAP)
    linked = link_items(members, ["n", "pos"], _candidates(percent), verify, details=bitmaps, likely=_likely(percent),
                        order="pos")
    classes = items.select("sig", "least")
    classes = classes.join(linked, F.col("sig") == F.col("item"), "left").select(
        "sig", "least", F.coalesce("component", "sig").alias("component"))
    ids = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    named = classes.join(ids, "component").select(F.col("sig").alias("_sig"), "component_id")
    return rows.join(named, F.col("sig") == F.col("_sig"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one_per_group(docs: DataFrame, key: str = "doc_id", text: str = "text", unique: bool = False) -> DataFrame:
    """One row of each group of linked texts, the one with the smallest key, with all
    its columns as they are. Rows without words stay. Null keys come last; of rows with one key the first stays.

    A column called ``_ngram_row`` is an error. Two tables stay below the shared folder, as the result
    reads them: the input and the numbers of the rows that stay. ``unique`` says that the key is a long one that no two
    rows share and no row lacks: it numbers the rows then, and the input is not copied but read again."""
    if "_ngram_row" in docs.columns:
        raise ValueError("the column _ngram_row would be overwritten")
    with scope() as here:
        if unique:
            marked = docs.withColumn("_ngram_row", F.col(key).cast("long"))
            groups = jaccard_groups(marked, "_ngram_row", text)
            kept = here.keep(written(groups.where("doc_id = component_id").select(F.col("doc_id").alias("_ngram_row")), "ngram-kept"))
        else:
            marked, kept = (here.keep(t) for t in _kept(docs, key, text))
    return marked.join(kept, "_ngram_row", "left_semi").drop("_ngram_row")


def _kept(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The numbered rows, and the numbers of those that stay."""
    marked = written(docs.withColumn("_ngram_row", F.monotonically_increasing_id()), "ngram-input")
    groups = jaccard_groups(marked.select(F.col("_ngram_row"), F.col(text).alias("text")), "_ngram_row", "text")
    named = groups.join(marked.select("_ngram_row", F.col(key).alias("_key")), F.col("doc_id") == F.col("_ngram_row"))
    first = named.groupBy("component_id").agg(F.min(F.struct(F.col("_key").isNull().alias("none"), "_key", "_ngram_row")).alias("top"))
    return marked, written(first.select(F.col("top._ngram_row").alias("_ngram_row")), "ngram-kept")
