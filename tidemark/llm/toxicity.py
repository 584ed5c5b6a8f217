"""Toxicity scores by a linear classifier that is held to the same score when identity terms are swapped."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches_of, rows_of, scope, ship_package, written

#: 2**18 weights: one MB for every task, at any number of documents.
BITS = 18
#: Bounds of the training sample: labelled rows, half of them toxic where there are as many, and their features in all.
MOST_ROWS, MOST_FEATURES = 10_000, 6_000_000
_WORD = re.compile(r"[^\W_]+")
#: Initial letters that count as features beside the whole word, for stems that take many endings.
_STEMS = (4, 5, 6)
_CACHE = 1 << 17

#: Terms that name people by group. A term may stand for another of its line in a counterfactual.
IDENTITY_TERMS = """
women men girls boys woman man girl boy female male
christians muslims jews hindus buddhists atheists christian muslim jewish hindu buddhist atheist catholic protestant
gay lesbian bisexual transgender straight heterosexual homosexual queer
black white asian african latino hispanic european arab indigenous
immigrants refugees foreigners natives migrants
old young elderly teenage
blind deaf disabled
frauen männer mädchen jungen
christen muslime juden hindus atheisten
ausländer flüchtlinge einwanderer einheimische
femmes hommes filles garçons
chrétiens musulmans juifs hindous athées
immigrés réfugiés étrangers
mujeres hombres niñas niños
cristianos musulmanes judíos hindúes ateos
inmigrantes refugiados extranjeros
"""


def swaps_of(terms: str) -> dict[str, tuple[str, ...]]:
    """For each term the others of its line, the next one first."""
    lines = [line.split() for line in terms.lower().split("\n") if line.strip()]
    return {term: (*line[i + 1:], *line[:i]) for line in lines for i, term in enumerate(line)}


class Features:
    """The buckets of a set of words: each word and its initial letters."""

    def __init__(self, bits: int = BITS):
        self._mask, self._known = (1 << bits) - 1, {}

    def of_word(self, word: str) -> tuple[int, ...]:
        found = self._known.get(word)
        if found is None:
            if len(self._known) >= _CACHE:
                self._known.clear()
            names = [f"w {word}", *[f"{n} {word[:n]}" for n in _STEMS if len(word) > n]]
            found = self._known[word] = tuple(zlib.crc32(n.encode()) & self._mask for n in names)
        return found

    def of(self, words: set[str]) -> list[int]:
        found: set[int] = set()
        for word in words:
            found.update(self.of_word(word))
        return sorted(found)


def words_of(text: str | None) -> set[str]:
    """The distinct words of a whole text, in lower case."""
    return set(_WORD.findall((text or "").lower()))


def swapped(words: set[str], swaps: Mapping[str, Sequence[str]], turn: int) -> set[str]:
    """The words with every identity term replaced by another of its kind, a further one each turn."""
    return {swaps[w][turn % len(swaps[w])] if swaps.get(w) else w for w in words}


@dataclass
class Examples:
    """Sparse rows: ``ids`` of row i are those from start[i] to start[i + 1]. ``counter_*`` hold what
    a counterfactual adds (+1) and removes (-1), with the row it belongs to."""

    start: np.ndarray
    ids: np.ndarray
    label: np.ndarray
    counter_start: np.ndarray
    counter_ids: np.ndarray
    counter_sign: np.ndarray
    counter_row: np.ndarray

    @staticmethod
    def of(rows: Sequence[tuple[Sequence[int], int, Sequence[Sequence[int]]]]) -> Examples:
        """From (ids, label, counterfactuals); a counterfactual lists i for an added bucket, -i - 1 for a removed one."""
        shape = pa.list_(pa.int32())
        return Examples.of_arrow(*[pa.array([r[i] for r in rows], kind) for i, kind in enumerate((shape, pa.int64(), pa.list_(shape)))])

    @staticmethod
    def of_arrow(ids: pa.Array, labels: pa.Array, counters: pa.Array) -> Examples:
        """The same from Arrow lists, without a Python object per bucket."""
        def starts(sizes) -> np.ndarray:
            return np.concatenate([[0], np.cumsum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False))]).astype(np.int64)

        pairs = pc.list_flatten(counters)
        owners = np.repeat(np.arange(len(ids)), np.diff(starts(pc.list_value_length(counters))))
        signed = pc.list_flatten(pairs).to_numpy(zero_copy_only=False)
        return Examples(starts(pc.list_value_length(ids)), pc.list_flatten(ids).to_numpy(zero_copy_only=False),
                        labels.to_numpy(zero_copy_only=False).astype(np.float64), starts(pc.list_value_length(pairs)),
                        np.where(signed >= 0, signed, -signed - 1), np.where(signed >= 0, 1.0, -1.0), owners)


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    bits: int = BITS
    features: Features = field(init=False, repr=False)

    def __post_init__(self):
        self.features = Features(self.bits)

    def score(self, text: str | None) -> float:
        ids = self.features.of(words_of(text))
        z = self.bias + float(self.weights[ids].sum(dtype=np.float64))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _rows(start: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the entries of the chosen rows, and for each its place among them."""
    sizes = start[chosen + 1] - start[chosen]
    owner = np.repeat(np.arange(len(chosen)), sizes)
    shift = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return start[chosen][owner] + shift, owner


def scales(data: Examples, bits: int, full: float = 6.0, least: float = 0.1) -> np.ndarray:
    """How far a feature may be trusted, 0 to 1: the square of the number of standard deviations by which its
    toxic rows depart from its share, over that of ``full``. Rare words, which agree with either
    label by chance, come out small; below ``least`` of ``full``, or in one row only, they are left out."""
    owner = np.repeat(np.arange(len(data.label)), np.diff(data.start))
    rows = np.bincount(data.ids, minlength=1 << bits)
    toxic = np.bincount(data.ids, data.label[owner], minlength=1 << bits)
    share = data.label.mean()
    apart = np.abs(toxic - rows * share) / np.sqrt(np.maximum(rows * share * (1 - share), 1e-9)) / full
    return np.where((rows > 1) & (apart >= least), np.minimum(apart, 1) ** 2, 0.0)


def fit(data: Examples, priors: tuple[float, float] | None = None, swap_penalty: float = 10.0, toxic_cost: float = 3.0,
        l2: float = 1e-4, steps: int = 2500, rate: float = 2.0, batch: int = 64, bits: int = BITS) -> Model:
    """Weights by gradient steps on: log loss + swap_penalty * (change of the logit under a swap) ** 2 + l2.

    ``priors``: how often each label occurs where the sample was drawn; rows are weighted to it, toxic ones
    ``toxic_cost`` times. The order of the rows is that of the data, so the result is the same
    each time. Without rows of both labels there is nothing to tell apart: all weights are 0 and the bias
    follows the counts.
    """
    n = len(data.label)
    counts = np.array([n - data.label.sum(), data.label.sum()])
    seen = np.array(priors if priors is not None else counts, np.float64)
    weights = np.zeros(1 << bits)
    bias = float(np.log((seen[1] + 0.5) / (seen[0] + 0.5)))
    if not counts.all():
        return Model(weights.astype(np.float32), bias, bits)
    scale = scales(data, bits)
    share = (seen / seen.sum()) / (counts / n) * [1.0, toxic_cost]
    cost = share[data.label.astype(np.int64)]
    kept = scale[data.ids] > 0
    start = np.concatenate([[0], np.cumsum(kept)])[data.start]
    ids, size = data.ids[kept], scale[data.ids[kept]]
    first_pair = np.searchsorted(data.counter_row, np.arange(n + 1))
    turns = [np.arange(k, n, -(-n // batch)) for k in range(-(-n // batch))]
    for step in range(steps):
        rows = turns[step % len(turns)]
        now = rate * (1 - step / steps)
        at, owner = _rows(start, rows)
        z = bias + np.bincount(owner, weights[ids[at]] * size[at], len(rows))
        slope = cost[rows] * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - data.label[rows]) / len(rows)
        weights *= 1 - now * l2
        np.subtract.at(weights, ids[at], now * slope[owner] * size[at])
        bias -= now * float(slope.sum())
        pairs = np.concatenate([np.arange(first_pair[r], first_pair[r + 1]) for r in rows])
        if len(pairs) and swap_penalty:
            at, owner = _rows(data.counter_start, pairs)
            moved = data.counter_sign[at] * scale[data.counter_ids[at]]
            change = np.bincount(owner, weights[data.counter_ids[at]] * moved, len(pairs))
            # A step never goes beyond the point where the scores agree.
            room = np.maximum(np.bincount(owner, moved**2, len(pairs)), 1e-9)
            pull = np.minimum(2 * swap_penalty * now / len(rows), 0.5 / room / np.maximum(len(pairs) / 2, 1))
            np.subtract.at(weights, data.counter_ids[at], (pull * change)[owner] * moved)
    return Model((weights * scale).astype(np.float32), bias, bits)


def example(features: Features, words: set[str], swaps: Mapping[str, Sequence[str]], turns: int) -> tuple[list[int], list[list[int]]]:
    """Buckets of a labelled text, and what each of its counterfactuals adds and removes."""
    ids = features.of(words)
    mentioned = {w for w in words if swaps.get(w)}
    if not mentioned:
        return ids, []
    known, found = set(ids), []
    for turn in range(turns):
        other = set(features.of(swapped(words, swaps, turn)))
        found.append([*sorted(other - known), *sorted(-i - 1 for i in known - other)])
    return ids, found


def _examples(terms: str, turns: int, bits: int):
    schema = pa.schema([("place", pa.int64()), ("doc_id", pa.int64()), ("toxic", pa.int64()), ("n", pa.int64()),
                        ("ids", pa.list_(pa.int32())), ("counter", pa.list_(pa.list_(pa.int32())))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, swaps = Features(bits), swaps_of(terms)

        def rows():
            for doc, text, toxic, place in rows_of(batches, "doc_id", "text", "toxic", "place"):
                ids, counter = example(features, words_of(text), swaps, turns)
                yield place, doc, toxic, len(ids) + sum(map(len, counter)), ids, counter

        yield from batches_of(rows(), schema, size=256)

    return run


def learnable(doc_id: str = "doc_id"):
    """Whether labels of a row may be learned from: CRC-32 of the doc_id as text, modulo 5, is not 0."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 != 0


def train(docs: DataFrame, labels: DataFrame, terms: str = IDENTITY_TERMS, swap_penalty: float = 10.0, turns: int = 2,
          most_rows: int = MOST_ROWS, most_features: int = MOST_FEATURES, bits: int = BITS) -> Model:
    """A model from the labels (doc_id, toxic) of the rows that ``learnable`` leaves.

    Fitted on a bounded sample, on the driver: ``most_rows`` labelled rows by the order of a hash of
    their doc_id, half of either label where there are as many, and of these as many, in that order, as have
    ``most_features`` features together. Only buckets of features reach the driver, no text. A
    doc_id labelled several times counts as toxic if one label says so; labels that are null or of no
    document are left out. Several documents of one doc_id are one example each.
    """
    ship_package(docs.sparkSession)
    with scope():
        marks = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & learnable()).groupBy(
            F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("long")).alias("toxic"))
        marks = written(marks.where("toxic in (0, 1)").withColumn("place", F.xxhash64("doc_id")), "toxic-labels")
        found = {r["toxic"]: r["count"] for r in marks.groupBy("toxic").count().collect()}
        half = most_rows // 2
        take = {1: max(half, most_rows - found.get(0, 0)), 0: max(half, most_rows - found.get(1, 0))}
        chosen = written(marks.where("toxic = 1").orderBy("place").limit(take[1]).unionAll(
            marks.where("toxic = 0").orderBy("place").limit(take[0])), "toxic-sample")
        # The sample has at most most_rows rows: small enough for every task, and no text is shuffled.
        texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
        table = written(texts.select("doc_id", "text", "toxic", "place").mapInArrow(
            _examples(terms, turns, bits),
            "place long, doc_id long, toxic long, n long, ids array<int>, counter array<array<int>>"), "toxic-examples")
        order = ["place", "doc_id", "n", "toxic"]
        sizes = [r["n"] for r in table.select(*order).orderBy(*order).limit(most_rows).collect()]
        fitting = int(np.searchsorted(np.cumsum(sizes), most_features, "right")) if sizes else 0
        found_rows = table.orderBy(*order, "ids").limit(max(fitting, 1)).select("ids", "toxic", "counter").toArrow().combine_chunks()
    ids, toxic, counter = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in found_rows.columns)
    data = Examples.of_arrow(ids, toxic, counter)
    del found_rows, ids, counter
    return fit(data, (found.get(0, 0), found.get(1, 0)), swap_penalty, bits=bits)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every row, by its whole text and by nothing else.

    Null and empty texts have no features: their score is that of the bias. A null doc_id is not held out, and
    no label is learned for it. Repeated rows are scored each. Other columns are not read.
    """
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias, model.bits))
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Model(*shared.value)
        yield from batches_of(((doc, float(known.score(text))) for doc, text in rows_of(batches, "doc_id", "text")), schema)

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    return found.select("doc_id", F.coalesce(~learnable(), F.lit(False)).alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all rows by a model trained on the labels; see ``train`` and ``score``."""
    return score(docs, train(docs, labels))
