"""Best-fit packing of token sequences by bin completion."""

from __future__ import annotations

import base64
import json
import logging
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches_of, rows_of, running, ship_package, written

#: Effort of the search: alternatives tried per bin, and bins opened in all attempts.
#: Past either the best packing so far is taken; no piece is left out.
BRANCHES = 6
MOST_NODES = 6_000
#: Alternatives kept for later; a warning tells how many more were discarded.
MOST_STACK = 400
#: Pieces numbered in one task.
CHUNK_ROWS = 50_000
#: White space in a row from which tiktoken's splitting may overflow its stack (it does at 1,200,000).
LONG_RUN = 100_000


# --- tokens -----------------------------------------------------------------------------------

@lru_cache(maxsize=2)
def _encoder(ranks_path: str, pattern: str, vocabulary: str):
    """Ids of a text by the vocabulary as ``tokenizers`` reads it, once per worker process. Most texts take the
    byte-level BPE of its rank file, which gives the same ids at four times the speed; those with an
    added token, which has an id of its own, or a long run of white space go through ``tokenizers``."""
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(t): int(i) for t, i in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    added = [t["content"] for t in json.loads(Path(vocabulary).read_text(encoding="utf-8"))["added_tokens"]]
    long_run = re.compile(rf"(?<!\s)\s{{{LONG_RUN},}}")

    def encode(text: str) -> list[int]:
        if any(t in text for t in added) or len(text) >= LONG_RUN and long_run.search(text):
            return _reader(vocabulary).encode(text, add_special_tokens=False).ids
        return fast(text)

    return encode


@lru_cache(maxsize=2)
def _reader(vocabulary: str):
    """Loaded only by workers that meet a text which needs it."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary)


_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                     ("length", pa.int64()), ("ids_crc32", pa.int64())])


def cut(n_ids: int, size: int) -> list[tuple[int, int]]:
    """Starts and lengths of a document's pieces: of ``size`` each, the first one shorter."""
    first = n_ids % size or min(n_ids, size)
    return [(0, first), *[(s, size) for s in range(first, n_ids, size)]]


def _tokenize(ranks_path: str, pattern: str, vocabulary: str, size: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(ranks_path, pattern, vocabulary)

        def rows():
            for doc_id, text in rows_of(batches, "doc_id", "text"):
                ids = encode(text or "")
                ids.append(end_id)
                data = memoryview(np.array(ids, "<u4").tobytes())
                for piece, (start, length) in enumerate(cut(len(ids), size)):
                    yield doc_id, piece, start, length, zlib.crc32(data[4 * start:4 * (start + length)])

        yield from batches_of(rows(), _PIECES)

    return run


# --- search -----------------------------------------------------------------------------------

def lower_bound(counts: dict[int, int], size: int) -> int:
    """Bins that any packing needs: the larger of the total's bound and, for each k, that of the
    pieces above half a bin with the room they leave for pieces of k or more."""
    held = np.zeros(size + 1, np.int64)
    for length, n in counts.items():
        held[length] = n
    number, total = np.cumsum(held), np.cumsum(held * np.arange(size + 1))
    best = -(-int(total[-1]) // size)
    half = size // 2
    for k in range(half + 1):
        big = int(number[-1] - number[half])
        between = int(number[size - k] - number[half])
        room = between * size - int(total[size - k] - total[half])
        small = int(total[half] - (total[k - 1] if k else 0))
        best = max(best, big + max(0, -(-(small - room) // size)))
    return best


def fillings(lengths: list[int], counts: dict[int, int], room: int, most: int) -> list[tuple[int, ...]]:
    """Undominated ways to fill ``room``, least waste first, up to ``most``.

    A filling is dominated if pieces of it, one or two, can be replaced by one longer
    piece left outside that fits their place and the waste: any packing with the filling
    can be turned into one with the better filling.
    """
    found: list[tuple[int, ...]] = []
    visits = 0

    def dominated(chosen: list[int], waste: int) -> bool:
        for i, a in enumerate(chosen):
            for b in (0, *chosen[i + 1:i + 3]):
                at = bisect_right(lengths, a) if not b else bisect_left(lengths, a + b)
                while at < len(lengths) and lengths[at] <= a + b + waste:
                    if counts[lengths[at]] > chosen.count(lengths[at]):
                        return True
                    at += 1
        return False

    def extend(chosen: list[int], left: int, top: int) -> None:
        nonlocal visits
        visits += 1
        at = bisect_right(lengths, min(left, top)) - 1
        fits = False
        while at >= 0 and len(found) < most and visits < 60 * most:
            x = lengths[at]
            if counts[x] > chosen.count(x):
                fits = True
                chosen.append(x)
                extend(chosen, left - x, x)
                chosen.pop()
                if left == x:  # nothing beats a full bin with its largest piece
                    break
            at -= 1
        if not fits and (not lengths or not any(
                counts[x] > chosen.count(x) for x in lengths[:bisect_right(lengths, left)])):
            if not dominated(chosen, left):
                found.append(tuple(chosen))

    extend([], room, room)
    return sorted(found or [()], key=lambda f: (room - sum(f), len(f)))


def best_fit(counts: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Incumbent: the largest piece first, then always the largest that still fits;
    equal bins are made at once."""
    left, plan = dict(counts), []
    lengths = sorted(left)
    while lengths:
        chosen, room, at = [], size, len(lengths) - 1
        while at >= 0:
            x = lengths[at]
            take = min(room // x, left[x])
            chosen += [x] * take
            room -= take * x
            at = min(at - 1, bisect_right(lengths, room) - 1)
        plan.append((tuple(chosen), _take(left, lengths, chosen)))
    return plan


def _take(left: dict[int, int], lengths: list[int], chosen: list[int]) -> int:
    """Removes as many equal bins as the pieces last for; their number."""
    need = {x: chosen.count(x) for x in set(chosen)}
    times = min(left[x] // c for x, c in need.items())
    for x, c in need.items():
        left[x] -= times * c
        if not left[x]:
            lengths.pop(bisect_left(lengths, x))
    return times


def complete_bins(counts: dict[int, int], size: int, branches: int = BRANCHES,
                  most_nodes: int = MOST_NODES, most_stack: int = MOST_STACK) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in a bin, number of such bins), in as few bins as the search finds.

    Works on the number of pieces per length, so its effort does not depend on how
    many pieces there are.
    """
    best = best_fit(counts, size)
    fewest, bound = sum(n for _, n in best), lower_bound(counts, size)
    stack = [(dict(counts), [], 0, sum(x * n for x, n in counts.items()))]
    nodes = discarded = 0
    while stack and fewest > bound and nodes < most_nodes:
        left, plan, used, total = stack.pop()
        lengths = sorted(x for x, n in left.items() if n)
        while lengths:
            if used + -(-total // size) >= fewest or nodes >= most_nodes:
                break
            nodes += 1
            top = lengths[-1]
            left[top] -= 1
            if not left[top]:
                lengths.pop()
            options = fillings(lengths, left, size - top, branches)
            if left[top] == 0:
                lengths.append(top)
            left[top] += 1
            waste = size - top - sum(options[0])
            for other in reversed(options[1:]):
                # Each bin may waste what the incumbent's bins have to spare.
                spare = (fewest - 1 - used) * size - total
                if size - top - sum(other) <= max(spare, waste):
                    if len(stack) >= most_stack:
                        discarded += 1
                        continue
                    rest, names = dict(left), list(lengths)
                    n = _take(rest, names, [top, *other])
                    stack.append((rest, [*plan, ((top, *other), n)], used + n,
                                  total - n * (top + sum(other))))
            chosen = [top, *options[0]]
            n = _take(left, lengths, chosen)
            plan = [*plan, (tuple(chosen), n)]
            used, total = used + n, total - n * sum(chosen)
        if not lengths and used < fewest:
            best, fewest = plan, used
    if discarded:
        logging.getLogger(__name__).warning("packing search discarded %d alternatives", discarded)
    return best


# --- packing ----------------------------------------------------------------------------------

def _places(plan: list[tuple[tuple[int, ...], int]]) -> list[tuple]:
    """Per bin kind and length: the ranks it takes, and where they go."""
    rows, taken, sequence = [], {}, 0
    for chosen, times in plan:
        offset = 0
        for length in sorted(set(chosen), reverse=True):
            copies = chosen.count(length)
            low = taken.get(length, 0)
            taken[length] = low + times * copies
            rows.append((length, low, taken[length], sequence, copies, offset))
            offset += copies * length
        sequence += times
    return rows


def pack_documents(docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text",
                   size: int = 1024, end_id: int = 2, chunk_rows: int = CHUNK_ROWS,
                   vocabulary: str | None = None) -> DataFrame:
    """Pieces of all documents and their places in sequences of at most ``size`` tokens.

    Ids are those of ``tokenizers`` with the file ``vocabulary`` (the .json beside the ranks unless given)
    and add_special_tokens=False: an added token quoted in a text is that token.
    Documents end with ``end_id``; a null or empty text is that id alone. Longer
    ones are cut into pieces of ``size``, the first shorter. Repeated rows are packed
    once each. Other columns are ignored.

    Only the number of pieces per length, ``size`` numbers at most, reaches the driver.
    Bin completion turns it into kinds of bins; pieces are numbered within their
    length by distributed running counts and look up the kind that takes their number.
    """
    ship_package(docs.sparkSession)
    pieces = written(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        _tokenize(ranks_path, pattern, vocabulary or str(Path(ranks_path).with_suffix(".json")), size, end_id),
        "doc_id long, piece int, start long, length long, ids_crc32 long"), "pieces", 256)
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    chunks = sum(counts.values()) // chunk_rows + 1
    ranked = running(pieces, ["length"], F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(chunks)),
                     ["doc_id", "piece", "ids_crc32"], {"rank": F.lit(1)})
    places = docs.sparkSession.createDataFrame(
        _places(complete_bins(counts, size)),
        "_length long, low long, high long, first long, copies long, at long")
    # At most a few rows for each of ``size`` lengths, whatever the number of documents.
    found = ranked.join(F.broadcast(places), (F.col("length") == F.col("_length")) & (
        F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
    turn = F.col("rank") - F.col("low")
    return found.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("first") + F.floor(turn / F.col("copies"))).cast("long").alias("sequence_id"),
        (F.col("at") + F.pmod(turn, F.col("copies")) * F.col("length")).cast("long").alias("offset"))
