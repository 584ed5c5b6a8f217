"""Suffix-array dedup of repeated byte strings by prefix-free parsing.

A rolling hash over ``ANCHOR`` bytes sets triggers: of the hashes inside a string of ``length``
bytes the least is its trigger. Consecutive strings with the same trigger form a phrase; phrases
overlap by ``length - 1`` bytes, so each string lies in exactly one phrase, and equal strings
lie in phrases of equal trigger. The dictionary (distinct phrases) is dealt out by
trigger. In each part the suffix array of the dictionary brings equal strings together; the
parse gives the corpus order, (document, start), of each phrase's first occurrence,
and with it the first occurrence of each string. A string needs no more context than its phrase,
so the parse needs no suffix array of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches_of, ship_package, written
from tidemark.llm.ngram_join import _BYTES, _mixed, _power

LENGTH, ANCHOR = 100, 32
#: Phrases that a task of the parse sorts, bytes of dictionary in a suffix array, and suffix arrays that a task
#: makes one after the other.
BUCKET_PHRASES, BUCKET_BYTES, BUCKETS_A_TASK = 300_000, 512 << 10, 16
#: Distinct phrases of one trigger above which they are cut into single strings and dealt by content.
HOT_PHRASES = 5_000
_CHUNK_BYTES, _FLUSH, _BATCH_ROWS = 1 << 20, 1 << 18, 256
_SELF = 128  # mark in the count of a phrase: a string may occur in it twice


def parse(data: list[bytes], length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Phrases of some documents: trigger, content hash, document index, start, number of strings."""
    text = np.frombuffer(b"\0".join(data) + b"\0" * (length + 1), np.uint8)
    sizes = np.array([len(d) for d in data], np.int64)
    first = np.cumsum(np.concatenate([[0], sizes[:-1] + 1]))
    up, down = _power(len(text) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[text] * up[:len(text)])])
    hashes = _mixed((sums[anchor:] - sums[:-anchor]) * down[:len(sums) - anchor])
    reach, least = 1, hashes
    window = length - anchor + 1
    while 2 * reach <= window:
        least, reach = np.minimum(least[:-reach], least[reach:]), 2 * reach
    if window > reach:
        least = np.minimum(least[:reach - window], least[window - reach:])
    inside = np.zeros(len(least) + 1, np.int64)
    full = sizes >= length
    np.add.at(inside, first[full], 1)
    np.add.at(inside, first[full] + sizes[full] - length + 1, -1)
    inside = np.cumsum(inside)[:-1] > 0
    at = np.flatnonzero(inside)
    if not len(at):
        return tuple(np.zeros(0, k) for k in (np.uint64, np.uint64, np.int64, np.int64, np.uint8))
    value = least[at]
    new = np.ones(len(at), bool)
    new[1:] = (value[1:] != value[:-1]) | (at[1:] != at[:-1] + 1)
    # Runs longer than a window (periodic text) are cut; any cut is right, see the module text.
    run = np.flatnonzero(new)
    place = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
    new |= place % window == 0
    head = np.flatnonzero(new)
    count = np.diff(np.append(head, len(at)))
    # A trigger that starts before the last string of its phrase occurs in it again.
    again = hashes[at] == value
    again[np.append(head[1:], len(at)) - 1] = False
    twice = np.logical_or.reduceat(again, head)
    begin = at[head]
    end = begin + count - 1 + length
    content = _mixed((sums[end] - sums[begin]) * down[begin] + count.astype(np.uint64))
    doc = np.searchsorted(first, begin, side="right") - 1
    return value[head], content, doc, begin - first[doc], (count + _SELF * twice).astype(np.uint8)


_KINDS = {"trigger": np.uint64, "content": np.uint64, "doc": np.int64, "h": np.int64, "lo": np.int64, "n": np.uint8}
_RUNS = pa.schema([("kind", pa.int32()), ("doc", pa.int64()), ("h", pa.int64()), ("lo", pa.int64()),
                   ("n", pa.int64()), ("trigger", pa.int64())])
_RUNS_SQL = "kind int, doc long, h long, lo long, n long, trigger long"


def _runs(kind: int, doc, h, lo, n, trigger) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(doc), kind, np.int32)), *[
        pa.array(np.ascontiguousarray(x).astype(np.int64)) for x in (doc, h, lo, n)],
        pa.array(np.ascontiguousarray(trigger).view(np.int64))], schema=_RUNS)


def _sorted_first(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Phrases in dictionary, then corpus order; which are the first of their content, and
    which are later occurrences (an occurrence listed twice is neither)."""
    order = np.lexsort(columns[4:1:-1] + columns[1::-1])
    c = [x[order] for x in columns]
    first, same = np.ones(len(order), bool), np.zeros(len(order), bool)
    first[1:] = (c[0][1:] != c[0][:-1]) | (c[1][1:] != c[1][:-1])
    same[1:] = ~first[1:] & (c[2][1:] == c[2][:-1]) & (c[3][1:] == c[3][:-1]) & (c[4][1:] == c[4][:-1])
    return c, first, ~first & ~same


def _parse_task(length: int, anchor: int, buckets: int):
    schema = pa.schema([("bucket", pa.int32()), ("later", pa.int32()), *[(c, pa.binary()) for c in _KINDS]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def dealt(columns: list[np.ndarray], bucket: np.ndarray, later: int) -> Iterator[tuple]:
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for b in range(buckets):
                at = order[cuts[b]:cuts[b + 1]]
                if len(at):
                    yield b, later, *[x[at].tobytes() for x in columns]

        def flush(held: list[tuple]) -> Iterator[tuple]:
            columns = [np.concatenate(x) for x in zip(*held, strict=True)]
            # Later copies inside the task are settled here and go straight through.
            c, first, later = _sorted_first(columns)
            back = np.lexsort((c[4], c[3], c[2]))
            keep, past = back[first[back]], back[later[back]]
            yield from dealt([x[keep] for x in c], (c[0][keep] % np.uint64(buckets)).astype(np.int64), 0)
            spread = _mixed(c[2].view(np.uint64) ^ c[3].view(np.uint64))[past] % np.uint64(buckets)
            yield from dealt([x[past] for x in c], spread.astype(np.int64), 1)

        def rows():
            held, size = [], 0
            for batch in batches:
                ids = np.array(batch.column("doc").to_pylist(), np.int64)
                hs = np.array(batch.column("h").to_pylist(), np.int64)
                texts, some, weight, start = batch.column("text").to_pylist(), [], 0, 0
                for at, text in enumerate(texts):
                    some.append((text or "").encode())
                    weight += len(some[-1])
                    if weight >= _CHUNK_BYTES or at == len(texts) - 1:
                        trigger, content, doc, lo, n = parse(some, length, anchor)
                        held.append((trigger, content, ids[start + doc], hs[start + doc], lo, n))
                        size += len(trigger)
                        some, weight, start = [], 0, at + 1
                if size >= _FLUSH:
                    yield from flush(held)
                    held, size = [], 0
            if size:
                yield from flush(held)

        yield from batches_of(rows(), schema, size=64)

    return run


def _order_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First occurrences of the phrases of a bucket. Later ones are repeats as a whole
    (kind 0); phrases that share a trigger with another, or may repeat a string inside,
    go on to the suffix array (kind 1). Streams: holds one row per distinct phrase."""
    best = [np.zeros(0, k) for k in _KINDS.values()]
    held, size = [], 0

    def settle() -> pa.RecordBatch:
        nonlocal best
        c, first, later = _sorted_first([np.concatenate(x) for x in zip(best, *held, strict=True)])
        best = [x[first] for x in c]
        return _runs(0, c[2][later], c[3][later], c[4][later], c[5][later] & (_SELF - 1), c[0][later])

    for batch in batches:
        for later, *row in zip(*[batch.column(c).to_pylist() for c in ("later", *_KINDS)], strict=True):
            c = [np.frombuffer(x, k) for x, k in zip(row, _KINDS.values(), strict=True)]
            if later:
                yield _runs(0, c[2], c[3], c[4], c[5] & (_SELF - 1), c[0])
            else:
                held.append(c)
                size += len(c[0])
                if size >= _FLUSH:
                    yield settle()
                    held, size = [], 0
    if held:
        yield settle()
    trigger = best[0]
    if len(trigger):
        heads = np.flatnonzero(np.concatenate([[True], trigger[1:] != trigger[:-1]]))
        sizes = np.diff(np.append(heads, len(trigger)))
        go = np.repeat(sizes > 1, sizes) | (best[5] >= _SELF)
        yield _runs(1, *[best[i][go] for i in (2, 3, 4)], best[5][go] & (_SELF - 1), trigger[go])


def _dictionary_task(length: int, buckets: int):
    """Contents of the phrases asked for; hot ones cut into single strings."""
    schema = pa.schema([("bucket", pa.int32()), *[(c, pa.binary()) for c in ("doc", "h", "lo", "n", "bytes")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held: dict[int, list]) -> Iterator[tuple]:
            for bucket, items in held.items():
                doc, h, lo, n, parts = zip(*items, strict=True)
                yield (bucket, *[np.array(x, np.int64).tobytes() for x in (doc, h, lo, n)], b"".join(parts))

        def rows():
            held, size = {}, 0
            for batch in batches:
                for doc, h, text, asked in zip(*[batch.column(c).to_pylist() for c in ("doc", "h", "text", "asked")], strict=True):
                    data = (text or "").encode()
                    for item in asked:
                        lo, n = item["lo"], item["n"]
                        if item["hot"]:
                            for s in range(lo, lo + n):
                                part = data[s:s + length]
                                b = int.from_bytes(hashlib.blake2b(part, digest_size=8).digest(), "little") % buckets
                                held.setdefault(b, []).append((doc, h, s, 1, part))
                                size += length
                        else:
                            b = item["trigger"] % buckets
                            held.setdefault(b, []).append((doc, h, lo, n, data[lo:lo + n - 1 + length]))
                            size += n + length
                    if size >= 8 << 20:
                        yield from flush(held)
                        held, size = {}, 0
            yield from flush(held)

        yield from batches_of(rows(), schema, size=256)

    return run


def suffix_ranks(text: np.ndarray, length: int) -> np.ndarray:
    """Ranks, equal for equal strings, of the suffixes of a text by their first ``length``
    bytes: the suffix array to that depth, by prefix doubling. The text is taken as
    followed by zeros; only suffixes at least ``length`` long are compared rightly."""
    padded = np.concatenate([text, np.zeros(length + 8, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)[:len(text) + length]
    rank = np.unique(np.ascontiguousarray(words).view(">u8").astype(np.uint64).ravel(), return_inverse=True)[1]
    depth = 8
    while depth < length:
        step = min(depth, length - depth)
        pair = rank[:-step] * (rank.max() + 1) + rank[step:]
        rank = np.unique(pair, return_inverse=True)[1]
        depth += step
    return rank[:len(text)]


def _repeats(held: list[tuple[list[np.ndarray], np.ndarray]], length: int) -> pa.RecordBatch:
    """Runs of the strings in the phrases of one bucket that also start earlier."""
    doc, h, lo, n = (np.concatenate(x) for x in zip(*[x[0] for x in held], strict=True))
    rank = suffix_ranks(np.concatenate([x[1] for x in held]), length)
    sizes = n + length - 1
    first = np.cumsum(sizes) - sizes
    which = np.repeat(np.arange(len(n), dtype=np.int32), n)
    inner = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
    group, start = rank[first[which] + inner], lo[which] + inner
    del rank, inner
    order = np.lexsort((start, h[which], doc[which], group))
    g, d, k, s = (x[order] for x in (group, doc[which], h[which], start))
    head = np.concatenate([[True], g[1:] != g[:-1]])
    lead = np.flatnonzero(head)[np.cumsum(head) - 1]
    mark = np.zeros(len(order), bool)
    mark[order] = ~head & ~((d == d[lead]) & (k == k[lead]) & (s == s[lead]))
    del g, d, k, s, lead, order
    # Strings that follow each other in a phrase go out as one run.
    open_ = mark.copy()
    open_[1:] &= ~mark[:-1] | (which[1:] != which[:-1])
    head = np.flatnonzero(open_)
    many = np.add.reduceat(mark.astype(np.int64), head) if len(head) else head
    return _runs(0, doc[which[head]], h[which[head]], start[head], many, np.zeros(len(head), np.int64))


def _suffix_task(length: int):
    """One suffix array per bucket, in turn: the rows come sorted by bucket, so that a task holds one only."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in batches:
            for bucket, *numbers, data in zip(*[batch.column(c).to_pylist() for c in (
                    "bucket", "doc", "h", "lo", "n", "bytes")], strict=True):
                if held and bucket != now:
                    yield _repeats(held, length)
                    held = []
                now = bucket
                held.append(([np.frombuffer(x, np.int64) for x in numbers], np.frombuffer(data, np.uint8)))
        if held:
            yield _repeats(held, length)

    return run


def _cut_task(length: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                        ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for doc_id, text, runs in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "text", "runs")], strict=True):
                    data = (text or "").encode()
                    spans = removed_spans([(r["lo"], r["n"]) for r in runs or ()], length)
                    kept, at = hashlib.sha256(), 0
                    for low, high in spans:
                        kept.update(data[at:low])
                        at = high
                    kept.update(data[at:])
                    yield doc_id, len(data), sum(b - a for a, b in spans), len(spans), kept.hexdigest()

        yield from batches_of(rows(), schema)

    return run


def removed_spans(runs: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Bytes covered by strings that start in the runs, as separate spans."""
    spans: list[tuple[int, int]] = []
    for lo, n in sorted(runs):
        high = lo + n - 1 + length
        if spans and lo <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(high, spans[-1][1]))
        else:
            spans.append((lo, high))
    return spans


def repeated_bytes(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH,
                   anchor: int = ANCHOR, bucket_phrases: int = BUCKET_PHRASES,
                   bucket_bytes: int = BUCKET_BYTES, hot_phrases: int = HOT_PHRASES) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Removes each byte covered by a string of ``length`` bytes that also starts earlier: in a
    document with a smaller key, or earlier in the same one. Null text is empty; shorter
    texts lose nothing. A null key counts as the smallest long. Rows that repeat a key are told
    apart by a hash of their text, which also orders them; rows that repeat key and text are
    one document, reported once per row. Other columns are ignored.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).select(
        "doc_id", F.coalesce("doc_id", F.lit(-2**63)).alias("doc"), F.xxhash64("text").alias("h"), "text")
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = int(total / (length - anchor) * 2 // bucket_phrases) + 1
    shape = ", ".join(["bucket int", "later int", *[f"{c} binary" for c in _KINDS]])
    parsed = rows.select("doc", "h", "text").mapInArrow(_parse_task(length, anchor, buckets), shape)
    runs = written(parsed.repartition(buckets, "bucket").mapInArrow(_order_task, _RUNS_SQL), "phrase-runs", _BATCH_ROWS)
    asked = runs.where("kind = 1")
    volume = asked.agg(F.sum(F.col("n") + length)).first()[0] or 0
    parts = int(volume // bucket_bytes) + 1
    hot = asked.groupBy("trigger").count().where(F.col("count") > hot_phrases).select("trigger", F.lit(True).alias("hot"))
    wanted = asked.join(hot, "trigger", "left").groupBy("doc", "h").agg(F.collect_list(F.struct(
        "lo", "n", "trigger", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("asked"))
    contents = rows.select("doc", "h", "text").join(wanted, ["doc", "h"]).mapInArrow(
        _dictionary_task(length, parts), "bucket int, doc binary, h binary, lo binary, n binary, bytes binary")
    tasks = parts // BUCKETS_A_TASK + 1
    dealt = contents.repartition(tasks, "bucket").sortWithinPartitions("bucket")
    strings = written(dealt.mapInArrow(_suffix_task(length), _RUNS_SQL), "string-runs", _BATCH_ROWS)
    later = runs.where("kind = 0").unionAll(strings).select("doc", "h", "lo", "n").groupBy("doc", "h").agg(
        F.collect_list(F.struct("lo", "n")).alias("runs"))
    return rows.join(later, ["doc", "h"], "left").select("doc_id", "text", "runs").mapInArrow(
        _cut_task(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
