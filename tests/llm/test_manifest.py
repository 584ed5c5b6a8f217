"""The Merkle manifest against trees built one node at a time."""

import hashlib
import os
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL, rows
from tidemark.llm.common import scope, written
from tidemark.llm.merkle_manifest import COLUMNS, build, folded, manifest_report, prove
from tidemark.llm.numbering import numbered
from tidemark.session import shared_dir

SHAPE = "doc_id long, text string, lang string, source string, n_chars long"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return digest(*["-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in COLUMNS])


def tree(leaves):
    """The top of a tree, and the (left, right) siblings of each leaf up to it."""
    paths, below, now = [[] for _ in leaves], [[i] for i in range(len(leaves))], list(leaves)
    while len(now) > 1:
        above, under = [], []
        for i in range(0, len(now), 3):
            run = now[i:i + 3]
            for j in range(len(run)):
                for member in below[i + j]:
                    paths[member].append(("".join(run[:j]), "".join(run[j + 1:])))
            above.append(digest(*run))
            under.append([m for part in below[i:i + 3] for m in part])
        now, below = above, under
    return now[0], paths


def brute(table):
    sources = {}
    for row in table:
        known, claimed = leaf(row), leaf(row)
        if row["doc_id"] is not None and row["text"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 2 == 0:
            claimed = leaf(row | {"text": row["text"].replace("\n", "")})
        order = (row["doc_id"] is not None, row["doc_id"] or 0)
        sources.setdefault(row["source"], []).append((order, known, claimed, row["doc_id"]))
    if not sources:
        return []
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    members = {s: sorted(sources[s], key=lambda m: m[:2]) for s in names}
    low = {s: tree([m[1] for m in members[s]]) for s in names}
    root, tops = tree([low[s][0] for s in names])
    found = []
    for name, top in zip(names, tops):
        for (_, known, claimed, doc_id), path in zip(members[name], low[name][1]):
            for left, right in (path := path + top):
                claimed = digest(left, claimed, right)
            found.append((doc_id, known, low[name][0], root, digest(*[x for pair in path for x in pair]), claimed, claimed == root))
    return sorted(found, key=repr)


def draw(seed, n, sources):
    rnd = random.Random(seed)
    return [(rnd.choice([None, 1, 2, 3, rnd.randrange(10_000)]), rnd.choice([None, "", "a\nb", "ß" * 10, f"{rnd.random()}\n"]),
             rnd.choice(["en", None]), rnd.choice(["hot", "hot", "hot", "é", "~", None, "", str(rnd.randrange(sources))]),
             rnd.choice([None, 4])) for _ in range(n)]


@pytest.mark.parametrize("n, sources", [(0, 1), (1, 1), (2, 1), (4, 3), (244, 2), (3000, 800)])
def test_nulls_ties_repeats_and_sizes(spark, n, sources):
    docs = spark.createDataFrame(draw(n, n, sources), SHAPE)
    assert rows(manifest_report(docs)) == brute([r.asDict() for r in docs.collect()])


def test_whole_table_and_columns_of_the_same_names(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = docs.withColumns({c: F.lit("x") for c in ("tree", "pos", "digest", "claim", "height", "block", "path", "_from", "leaf", "root")})
    assert rows(manifest_report(odd)) == brute([r.asDict() for r in docs.collect()])


def test_very_long_text(spark):
    docs = spark.createDataFrame([(2, "line\n" * 400_000, "en", "a", 1), (4, "x", "en", "a", 1)], SHAPE)
    assert rows(manifest_report(docs)) == brute([r.asDict() for r in docs.collect()])


def test_proofs_fold_to_the_root_and_only_from_their_own_leaf(spark):
    docs = spark.createDataFrame(draw(7, 1500, 5), SHAPE)
    with scope():
        made = build(docs)
        proofs = prove(made).collect()
    assert len(proofs) == 1500
    assert all(folded(p.leaf, p.path) == p.root == made.root for p in proofs)
    assert not any(folded(digest(p.leaf), p.path) == p.root for p in proofs)


def test_a_change_of_one_text_changes_one_subroot(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    changed = docs.withColumn("text", F.when(F.col("doc_id") == 7, "other").otherwise(F.col("text")))
    with scope():
        one, two = build(docs), build(changed)
        tops = [{r.tree: r.digest for r in m.subroots.collect()} for m in (one, two)]
    assert one.root != two.root
    source = docs.where("doc_id = 7").first()["source"]
    assert [t for t in tops[0] if tops[0][t] != tops[1][t]] == [f"={source}"]


def test_only_the_result_is_left_in_the_shared_folder(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    folder = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    found = manifest_report(docs)
    left = set(os.listdir(folder)) - before
    assert len(left) == 1 and next(iter(left)).startswith("merkle-report-")
    assert found.count() == docs.count()


def test_positions_of_a_group_that_spans_many_tasks(spark, conf):
    conf(spark_sql_shuffle_partitions=16, spark_sql_adaptive_coalescePartitions_enabled="false")
    values = [("hot" if i % 4 else f"g{i % 40}", (i * 7919) % 5000) for i in range(20_000)]
    with scope():
        got = numbered(written(spark.createDataFrame(values, "g string, v long"), "test-rows"), "g", ["v"]).collect()
    groups = {}
    for g, v in values:
        groups.setdefault(g, []).append(v)
    assert sorted((r.g, r.v, r.pos, r["size"]) for r in got) == sorted(
        (g, v, i, len(vs)) for g, vs in groups.items() for i, v in enumerate(sorted(vs)))
