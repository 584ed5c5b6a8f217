"""Kept-up current state, checksum tree, folder pruning of the change window, Z-order."""

import datetime as dt
import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of, rows
from tidemark.operators import changed_since, checksums, differing_leaves, latest_per_key, reconcile_rows, reconcile_tree
from tidemark.session import scratch
from tidemark.sources import CommitConflict, CurrentState, write_partitioned, write_zordered, zordered

# --- current state ----------------------------------------------------------------------------

VERSIONS = "k long, ts long, id long, active boolean, what string"


def versions(spark, some):
    return spark.createDataFrame(some, VERSIONS)


def test_merging_deliveries_equals_ranking_the_history(spark):
    draw = random.Random(5)
    history = [(draw.choice([None, *range(12)]), draw.choice([None, 1, 2, 3, 9]), i, draw.random() < .7, draw.choice([None, "", "x"]))
               for i in range(300)]
    state = CurrentState(spark, scratch(spark, "state"), ["k"], ["ts desc", "id desc"], where="active", slices=4, buckets=2)
    draw.shuffle(history)
    for low in (0, 90, 190):  # the deliveries overlap
        state.merge(versions(spark, history[low:low + 100]))
        seen = versions(spark, list({*history[:low + 100]}))
        full = latest_per_key(seen.where("k is not null"), ["k"], ["ts desc", "id desc"], "active")
        assert rows(state.read()) == rows(full)
    state.reset(versions(spark, history[:50]))
    assert rows(state.read()) == rows(latest_per_key(versions(spark, history[:50]).where("k is not null"), ["k"], ["ts desc", "id desc"], "active"))


def test_a_merge_without_news_makes_no_version(spark):
    state = CurrentState(spark, scratch(spark, "state"), ["k"], ["ts desc", "id desc"], slices=4, buckets=2)
    assert state.merge(versions(spark, [])) is None and state.read() is None
    first = [(1, 5, 1, True, "a"), (2, 5, 2, True, "b")]
    assert state.merge(versions(spark, first), run="one") == 0
    assert state.merge(versions(spark, first)) == 0
    assert state.merge(versions(spark, [(1, 4, 9, True, "late")])) == 0
    assert state.merge(versions(spark, [(1, 9, 9, True, "lost")]), run="one") == 0
    assert state.merge(versions(spark, [(2, 5, 2, True, "corrected")])) == 1
    assert rows(state.read()) == [(1, 5, 1, True, "a"), (2, 5, 2, True, "corrected")]


def test_a_merge_writes_the_slices_of_changed_winners_only(spark):
    state = CurrentState(spark, scratch(spark, "state"), ["k"], ["ts desc"], slices=8, buckets=1)
    state.merge(versions(spark, [(k, 1, k, True, "old") for k in range(100)]))
    before = state.store.folders()
    state.merge(versions(spark, [(7, 2, 7, True, "new"), *[(k, 0, k, True, "late") for k in range(100)]]))
    after = state.store.folders()
    assert len([s for s in after if after[s] != before[s]]) == 1
    assert {r.what for r in state.read().collect() if r.k == 7} == {"new"}


def test_another_merge_in_between_is_a_conflict(spark):
    root = scratch(spark, "state")
    state = CurrentState(spark, root, ["k"], ["ts desc"], slices=2, buckets=1)
    state.merge(versions(spark, [(1, 1, 1, True, "old")]))
    kept = state.store.upsert

    def late(delta, run, base):
        state.store.upsert = kept
        CurrentState(spark, root, ["k"], ["ts desc"]).merge(versions(spark, [(1, 9, 1, True, "newest")]))
        return kept(delta, run, base=base)

    state.store.upsert = late
    with pytest.raises(CommitConflict):
        state.merge(versions(spark, [(1, 5, 1, True, "newer")]))
    assert [r.what for r in state.read().collect()] == ["newest"]


def test_a_grown_version_row_keeps_its_new_column(spark):
    state = CurrentState(spark, scratch(spark, "state"), ["k"], ["ts desc"], slices=2, buckets=1)
    state.merge(versions(spark, [(1, 1, 1, True, "a"), (2, 1, 2, True, "b")]))
    state.merge(versions(spark, [(2, 2, 3, True, "c")]).withColumn("extra", F.lit("e")))
    assert sorted((r.k, r.what, r.extra) for r in state.read().collect()) == [(1, "a", None), (2, "c", "e")]


# --- checksum tree ----------------------------------------------------------------------------

PAIR = "k long, rev int, a string, b double"


def test_the_tree_finds_what_comparing_all_rows_finds(spark):
    draw = random.Random(9)
    some = [(draw.choice([None, *range(200)]), draw.choice([None, 1, 2]), draw.choice([None, "", "x"]), draw.choice([None, 0.0, 1.5]))
            for _ in range(600)]
    other = [r if draw.random() < .97 else (r[0], r[1], r[3] and str(r[3]), None) for r in some if draw.random() < .98] + some[:2]
    draw.shuffle(other)
    left, right = spark.createDataFrame(some, PAIR), spark.createDataFrame(other, PAIR)
    wanted = rows(reconcile_rows(left, right, ["k", "rev"], ["a", "b"]).where("status <> 'matched'"))
    assert wanted
    for leaves, branches in ((1, 1), (7, 3), (4096, 16)):
        assert rows(reconcile_tree(left, right, ["k", "rev"], ["a", "b"], leaves, branches)) == wanted


def test_null_keeps_its_place_and_copies_count(spark):
    left = spark.createDataFrame([(1, 1, None, 2.0), (2, 1, "x", 1.0)], PAIR)
    moved = spark.createDataFrame([(1, 1, None, 2.0), (2, 1, "x", 1.0), (2, 1, "x", 1.0)], PAIR)
    assert [r.k for r in reconcile_tree(left, moved, ["k", "rev"], ["a", "b"]).collect()] == [2]
    pair = "k long, a string, b string"
    left, right = spark.createDataFrame([(1, None, "x")], pair), spark.createDataFrame([(1, "x", None)], pair)
    assert [tuple(r)[3:] for r in reconcile_tree(left, right, ["k"], ["a", "b"]).collect()] == [("differs", "a,b")]


def test_equal_tables_have_no_differing_leaf_in_any_order_or_type(spark):
    left = spark.range(1000).selectExpr("id AS k", "CAST(id % 7 AS INT) AS a")
    right = left.orderBy(F.col("k").desc()).selectExpr("k", "CAST(a AS LONG) AS a", "'more' AS other")
    assert reconcile_tree(left, right, ["k"], ["a"]).isEmpty()
    sums = checksums(left, ["k"], ["a"], leaves=64)
    assert sums.count() == 64 and differing_leaves(sums, checksums(left.repartition(3), ["k"], ["a"], leaves=64)).isEmpty()
    empty = left.where("false")
    assert reconcile_tree(empty, empty, ["k"], ["a"]).isEmpty()
    assert {r.status for r in reconcile_tree(left, empty, ["k"], ["a"]).collect()} == {"left_only"}


def test_stored_checksums_spare_a_side(spark):
    left = spark.range(500).selectExpr("id AS k", "id % 7 AS a")
    right = left.withColumn("a", F.expr("CASE WHEN k = 77 THEN -1L ELSE a END"))
    kept = checksums(left, ["k"], ["a"], leaves=256)
    found = reconcile_tree(left, right, ["k"], ["a"], leaves=256, left_sums=kept)
    assert [(r.k, r.differing) for r in found.collect()] == [(77, "a")]


# --- change window ----------------------------------------------------------------------------

@pytest.mark.parametrize("grain", ["year", "month", "day"])
def test_new_rows_are_looked_for_in_new_folders_only(spark, grain):
    day = dt.datetime(2020, 1, 1)
    fact = spark.createDataFrame([(i, i % 9, None if i % 31 == 0 else day + dt.timedelta(days=11 * i)) for i in range(120)],
                                 "id long, k long, at timestamp_ntz")
    dim = spark.createDataFrame([(k, None if k == 4 else day + dt.timedelta(days=160 * k)) for k in range(8)],
                                "k long, seen timestamp_ntz")
    places = scratch(spark, "fact"), scratch(spark, "dim")
    write_partitioned(fact, places[0], "at", grain)
    write_partitioned(dim, places[1], "seen", grain)
    parts = [spark.read.parquet(p) for p in places]
    for start in ("2022-06-30 12:00:00", "2022-07-01", "1900-01-01", "2200-01-01"):
        plain = changed_since(fact, dim, "k", "at", "seen", start, "or")
        pruned = changed_since(*parts, "k", "at", "seen", start, "union", fact_grain=grain, dim_grain=grain)
        assert rows(pruned.select("id", "k", "at")) == rows(plain)
    pruned = changed_since(*parts, "k", "at", "seen", "2022-07-01", "union", fact_grain=grain, dim_grain=grain)
    name = {"year": "year#", "month": "make_date(year#", "day": "load_date#"}[grain]
    assert sum("PartitionFilters" in line and name in line.split("PartitionFilters")[1].split("PushedFilters")[0]
               for line in plan_of(pruned).splitlines()) >= 2


def test_an_unknown_grain_is_an_error(spark):
    df = spark.sql("SELECT 1 AS k, TIMESTAMP_NTZ'2020-01-01' AS at")
    with pytest.raises(ValueError, match="grain"):
        changed_since(df, df, "k", "at", "at", "2020-01-01", fact_grain="week")


# --- Z-order ----------------------------------------------------------------------------------

def share_of_files(path, column, value):
    """The share of files whose range of the column holds a value."""
    hits = []
    for name in glob.glob(f"{path.removeprefix('file:')}/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        at = meta.schema.names.index(column)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        hits.append(any(s.min <= value <= s.max for s in stats if s and s.has_min_max))
    return sum(hits) / len(hits)


def test_files_hold_narrow_ranges_of_every_column(spark):
    grid = spark.range(40_000).selectExpr("id", "pmod(xxhash64(id), 1000) AS a", "CAST(pmod(xxhash64(id, 1), 1000) AS INT) AS b")
    path = scratch(spark, "z")
    write_zordered(grid, path, ["a", "b"], partitions=64)
    for column in ("a", "b"):
        for value in (3, 500, 998):
            assert share_of_files(path, column, value) < .3
    assert spark.read.parquet(path).agg(F.count("*"), F.countDistinct("id")).first() == (40_000, 40_000)


def test_zorder_takes_nulls_ties_times_and_empty_tables(spark):
    some = [(i, None if i % 3 else i % 2, None) for i in range(300)]
    df = spark.createDataFrame(some, "id long, a int, b timestamp_ntz").withColumn(
        "b", F.when(F.col("id") > 5, F.lit(dt.datetime(2020, 1, 1)).cast("timestamp_ntz")))
    assert rows(zordered(df, ["a", "b"], 4)) == rows(df)
    assert zordered(df.where("false"), ["a", "b"]).isEmpty()
    hot = spark.range(8_000).selectExpr("id", "1 AS a", "1 AS b")
    counts = zordered(hot, ["a", "b"], 8).groupBy(F.spark_partition_id()).count().collect()
    assert len(counts) == 8
    with pytest.raises(ValueError, match="long"):
        zordered(df, ["a"] * 11)
