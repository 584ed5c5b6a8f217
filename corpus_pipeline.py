"""The text pipeline: quality rules, exact dedup, near-duplicate join, source mixing, packing."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bin_packing import pack_documents
from tidemark.llm.common import drop, scope, table, written
from tidemark.llm.grace_dedup import keep_one_each
from tidemark.llm.ngram_join import keep_one_per_group
from tidemark.llm.poisson_mixing import mix_sources
from tidemark.llm.quality_rules import keep_good
from tidemark.llm.queries import PATTERN, RANKS
from tidemark.session import remove


#: Folders of tables that the results of earlier stages read, until a later stage starts from a written copy.
_left: dict[str, SparkSession] = {}


def _release(docs: DataFrame) -> None:
    """Remove what earlier stages left, but for what ``docs`` itself is read from."""
    used = docs.inputFiles() if _left else []
    for folder in [f for f in _left if not any(f.rsplit("/", 1)[-1] in name for name in used)]:
        remove(_left.pop(folder), folder)


def _stage(work: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage that releases the tables of those before it. Their results must be written by then, as ``STAGES``
    are meant to be used; a result that ``docs`` still reads keeps its tables."""
    @wraps(work)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _release(docs)
        with scope() as here:
            found = work(docs)
            _left.update(here.detach())
        return found

    return stage


def _unique(docs: DataFrame) -> bool:
    """Whether every row has a doc_id of its own. The two dedups copy their input only where that is not so."""
    n, known = docs.agg(F.count("*"), F.count_distinct(F.col("doc_id").cast("long"))).first()
    return n == known


@_stage
def quality(docs: DataFrame) -> DataFrame:
    """Documents that the quality rules reject go."""
    return keep_good(docs)


@_stage
def exact_dedup(docs: DataFrame) -> DataFrame:
    """Of equal texts the largest doc_id stays."""
    return keep_one_each(docs, unique=_unique(docs))


@_stage
def near_dedup(docs: DataFrame) -> DataFrame:
    """Of texts linked by shared n-grams the smallest doc_id stays."""
    return keep_one_per_group(docs, unique=_unique(docs))


@_stage
def mixing(docs: DataFrame) -> DataFrame:
    """Every source gets an equal share of the characters; copies keep their doc_id."""
    return mix_sources(docs, marks=False)


@_stage
def packing(docs: DataFrame) -> DataFrame:
    """Pieces of the documents and their places in the sequences."""
    return pack_documents(docs, RANKS, PATTERN)


STAGES = [("quality rules", quality), ("exact dedup", exact_dedup), ("n-gram Jaccard join", near_dedup),
          ("source mixing", mixing), ("best-fit packing", packing)]

#: SQL has no tokenizer and no search for packings; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written and read again; what a stage has read goes with the next one's result."""
    docs = table(spark, sf_dir, "documents")
    before = None
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name.replace(' ', '-')}")
            if before is not None:
                drop(before)
            before = docs
    return docs
