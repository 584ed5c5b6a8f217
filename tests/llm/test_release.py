"""Tables that operators write go again, and long words of two letters are told apart."""

import os
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SMALL, rows
from tidemark.llm import ngram_join
from tidemark.llm.common import drop, scope, written
from tidemark.llm.components import link_items
from tidemark.llm.grace_dedup import keep_one_each
from tidemark.llm.ngram_join import _BITMAP, _likely, bitmap, jaccard_groups, keep_one_per_group, ngram_sets
from tidemark.session import shared_dir


def folders(spark):
    return set(os.listdir(shared_dir(spark).removeprefix("file:")))


def test_scopes_remove_what_is_not_kept(spark):
    before = folders(spark)
    with scope() as outer:
        a = written(spark.range(3), "a")
        with scope() as inner:
            b, c = written(spark.range(4), "b"), written(spark.range(5), "c")
            inner.keep(b)
            drop(c)
        assert b.count() == 4 and {n.split("-")[0] for n in folders(spark) - before} == {"a", "b"}
        outer.keep(a)
    left = folders(spark) - before
    assert {n.split("-")[0] for n in left} == {"a"} and a.count() == 3
    drop(a)


def test_near_duplicate_operators_leave_only_their_result(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g"), (2, "a b c d e f g"), (3, "other words stand here now")], "doc_id long, text string")
    before = folders(spark)
    assert jaccard_groups(docs).count() == 3
    assert {n.rsplit("-", 1)[0] for n in folders(spark) - before} == {"ngram-groups"}
    before = folders(spark)
    assert {r.doc_id for r in keep_one_per_group(docs).collect()} == {1, 3}
    assert {n.rsplit("-", 1)[0] for n in folders(spark) - before} == {"ngram-input", "ngram-kept"}
    before = folders(spark)
    assert {r.doc_id for r in keep_one_each(docs).collect()} == {2, 3}
    assert {n.rsplit("-", 1)[0] for n in folders(spark) - before} == {"grace-input", "grace-kept"}
    with pytest.raises(ValueError, match="overwritten"):
        keep_one_each(docs.withColumn("_grace_row", F.lit(1)))
    with pytest.raises(ValueError, match="overwritten"):
        keep_one_per_group(docs.withColumn("_ngram_row", F.lit(1)))


def test_dedups_copy_no_input_whose_keys_are_unique(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g"), (2, "a b c d e f g"), (3, "other words stand here now"), (4, None), (5, "")],
                                 "doc_id long, text string")
    for stage, operator, kept, label in ((corpus_pipeline.exact_dedup, keep_one_each, {2, 3, 5}, "grace"),
                                         (corpus_pipeline.near_dedup, keep_one_per_group, {1, 3, 4, 5}, "ngram")):
        before = folders(spark)
        assert {r.doc_id for r in operator(docs, unique=True).collect()} == {r.doc_id for r in operator(docs).collect()} == kept
        before = folders(spark)
        found = stage(spark, docs, SMALL)
        assert rows(found) == rows(docs.where(F.col("doc_id").isin(kept)))
        assert f"{label}-input" not in {n.rsplit("-", 1)[0] for n in folders(spark) - before}
        odd = docs.unionAll(docs.where("doc_id < 3")).unionAll(docs.select(F.lit(None).cast("long"), F.lit("a b c d e f g")).limit(1))
        before = folders(spark)
        found = stage(spark, odd, SMALL)
        assert rows(found) == rows(docs.where(F.col("doc_id").isin(kept)))
        assert f"{label}-input" in {n.rsplit("-", 1)[0] for n in folders(spark) - before}


def test_a_stage_releases_those_before_it(spark, tmp_path):
    docs, before = spark.read.parquet(f"{SMALL}/documents.parquet"), folders(spark)
    for at, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(f"{tmp_path}/{at}")
        docs = spark.read.parquet(f"{tmp_path}/{at}")
        kinds = {n.split("-")[0] for n in folders(spark) - before}
        assert not {"grace", "ngram"} & kinds or at in (1, 2) and len({"grace", "ngram"} & kinds) == 1
    corpus_pipeline._release(docs)
    before = folders(spark)
    found = corpus_pipeline.run(spark, SMALL)
    assert rows(found) == rows(docs)
    assert {n.rsplit("-", 1)[0] for n in folders(spark) - before if n.startswith("pipeline")} == {"pipeline-source-mixing"}


@pytest.mark.parametrize("letters", [32, 33, 64, 512, 1024, 2048])
def test_long_words_of_two_letters_in_an_order_and_its_mirror(spark, letters):
    order = [bin(i).count("1") % 2 for i in range(letters)]
    one, two = ("".join("ab"[x ^ flip] for x in order) for flip in (0, 1))
    texts = [f"the word {w} stands here" for w in (one, two)]
    sets = ngram_sets(texts, 5)
    assert not set(sets[0]) & set(sets[1])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    if letters >= 1024:
        assert {r.component_id for r in jaccard_groups(docs).collect()} == {0, 1}


def test_the_bitmap_filter_keeps_every_linked_pair(spark):
    """Pairs at and around the bound, sets of one n-gram to thousands; what it refuses is not linked."""
    pick, rows = random.Random(5), []
    for size in (1, 2, 5, 20, 140, 900, 5000):
        for share in (1.0, 0.9, 0.86, 0.85, 0.8, 0.6, 0.2, 0.0):
            common = round(size * share)
            ids = pick.sample(range(2**62), 2 * size - common)
            a, b = ids[:size], ids[:common] + ids[size:]
            linked = 100 * common >= 75 * (2 * size - common)
            rows.append((linked, share, size, *bitmap(np.array(a, np.uint64)), size, *bitmap(np.array(b, np.uint64))))
    names = ["linked", "share", "n", *_BITMAP, "_x_n", *[f"_x_{b}" for b in _BITMAP]]
    got = spark.createDataFrame(rows, names).withColumn("passes", _likely(75)("", "_x_")).collect()
    assert all(r.passes for r in got if r.linked) and any(r.linked for r in got)
    assert not [r for r in got if r.passes and r.share <= 0.6 and 5 <= r.n <= 140]


def test_shuffle_files_go_with_the_write(spark):
    def files():
        return {f for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
                if "/shuffle_" in f}

    before = files()
    with scope():
        found = written(spark.range(5000).groupBy((F.col("id") % 1000).alias("k")).count(), "shuffled")
        until = time.time() + 20
        while files() - before and time.time() < until:
            time.sleep(0.2)
        assert not files() - before and found.count() == 1000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_a_set_of_many_copies_is_stored_once(spark, monkeypatch):
    base = [f"w{i}" for i in range(40)]
    docs = [(i, " ".join(base if i % 2 else [*base[:-1], "other"])) for i in range(64)] + [(None, " ".join(base))]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(8)
    stored = []

    def counted(df, label, *rest):
        found = written(df, label, *rest)
        stored.extend([found.count()] if label == "ngram-sets" else [])
        return found

    monkeypatch.setattr(ngram_join, "written", counted)
    got = {r.doc_id: r.component_id for r in jaccard_groups(frame).collect()}
    assert set(got.values()) == {0} and len(got) == 65 and stored == [2]


def test_unlikely_pairs_are_not_verified(spark):
    members = spark.createDataFrame([(1, i, 1) for i in range(20)], "key long, item long, n long")
    details = spark.createDataFrame([(i, i % 2) for i in range(20)], "item long, side int")
    seen = []

    def verify(pairs):
        seen.extend(map(tuple, pairs.collect()))
        return pairs

    got = dict(rows(link_items(members, ["n"], lambda raw: raw.select("a", "b").distinct(), verify, details=details,
                               likely=lambda a, b: F.col(f"{a}side") == F.col(f"{b}side"))))
    assert got == {i: i % 2 for i in range(20)} and all(a % 2 == b % 2 for a, b in seen) and len(set(seen)) == len(seen)


def test_stars_and_ranges_take_few_steps(spark, monkeypatch):
    """A forest of stars ends in one step of either kind, and n-grams alone are counted by ranges."""
    from tidemark.llm import common
    from tidemark.llm.components import components

    labels, named = [], common.scratch
    monkeypatch.setattr(common, "scratch", lambda session, label: (labels.append(label), named(session, label))[1])
    edges = [(0, i) for i in range(1, 9)] + [(20, i) for i in range(10, 15)] + [(30, 31), (31, 30)]
    got = dict(rows(components(spark.createDataFrame(edges, "a long, b long"))))
    assert got == {i: 0 for i in range(9)} | {i: 10 for i in (10, 11, 12, 13, 14, 20)} | {30: 30, 31: 30}
    assert labels.count("small-star") <= 2
    chain = dict(rows(components(spark.createDataFrame([(i, i + 1) for i in range(50)], "a long, b long"))))
    assert chain == {i: 0 for i in range(51)}
    labels.clear()
    base = [f"w{i}" for i in range(80)]
    texts = [" ".join([*base[:i], "new", *base[i + 1:]]) for i in (5, 40, 70)]
    docs = spark.createDataFrame([*enumerate(texts), (None, texts[0])], "doc_id long, text string")
    assert {r.component_id for r in jaccard_groups(docs, bits=9).collect()} == {0}
    assert labels.count("range-counts") == 1
