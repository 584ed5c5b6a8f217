"""Commits, lost updates and sliced snapshots."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of, rows
from tidemark.operators import logged_run, stage
from tidemark.operators.changes import classify
from tidemark.plans.incremental import run_once
from tidemark.session import scratch, shared_dir
from tidemark.sources import CommitConflict, CommitLog, KeyedSnapshots, Snapshots, upsert

KEYED = "k long, rev int, HashValue string, LoadCreateDate timestamp_ntz"


def hashed(spark, ids, text):
    return spark.createDataFrame([(i,) for i in ids], "k long").select(
        "k", (F.col("k") % 3).cast("int").alias("rev"), F.lit(text).alias("HashValue"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("LoadCreateDate"))


# --- commits ----------------------------------------------------------------------------------

def test_one_writer_gets_a_number(spark):
    log = CommitLog(spark, scratch(spark, "log"))
    won, lost = [], []

    def write(name):
        try:
            log.add(0, {"by": name})
            won.append(name)
        except CommitConflict:
            lost.append(name)

    threads = [threading.Thread(target=write, args=(n,)) for n in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(won) == 1 and len(lost) == 7 and log.record(0) == {"by": won[0]}


def test_an_unfinished_commit_stops_writers_not_readers(spark):
    root = scratch(spark, "store")
    store = Snapshots(spark, root)
    store.commits.patience = 0.2
    store.commit(spark.range(3).toDF("k"))
    folder = f"{root}/commits".removeprefix("file:")
    for content in (b"", b'{"fold'):
        with open(f"{folder}/000000000001", "wb") as f:
            f.write(content)
        assert store.version() == 0 and store.read().count() == 3
        with pytest.raises(CommitConflict, match="unfinished"):
            store.commit(spark.range(4).toDF("k"))
    store.commits.void(1)
    assert store.commit(spark.range(4).toDF("k")) == 2 and store.read().count() == 4
    with pytest.raises(ValueError, match="in force"):
        store.commits.void(2)


def test_two_writers_of_one_version_lose_no_row(spark):
    root = scratch(spark, "store")
    one, two = Snapshots(spark, root), Snapshots(spark, root)
    one.commit(spark.range(1).toDF("k"))
    before = two.commits.settled
    # The second writer looks before the first commits, and writes after it.
    two.commits.settled = lambda: 1
    one.commit(spark.range(5).toDF("k"))
    with pytest.raises((CommitConflict, ValueError)):
        two.commit(spark.range(9).toDF("k"), version=1)
    two.commits.settled = before
    assert one.read().count() == 5 and len(os.listdir(f"{root}/data".removeprefix("file:"))) == 2


def test_upsert_notices_a_version_in_between(spark, monkeypatch):
    store, other = (Snapshots(spark, root) for root in [scratch(spark, "store")] * 2)
    upsert(store, hashed(spark, [1], "a"), ["k", "rev"])
    inner = Snapshots.read

    def read_then_other(self, version=None):
        found = inner(self, version)
        if self is store:
            monkeypatch.setattr(Snapshots, "read", inner)
            upsert(other, hashed(spark, [2], "theirs"), ["k", "rev"])
        return found

    monkeypatch.setattr(Snapshots, "read", read_then_other)
    with pytest.raises(CommitConflict):
        upsert(store, hashed(spark, [3], "mine"), ["k", "rev"])
    assert {r.k for r in store.read().collect()} == {1, 2}
    upsert(store, hashed(spark, [3], "mine"), ["k", "rev"])
    assert {r.k for r in store.read().collect()} == {1, 2, 3}


# --- slices -----------------------------------------------------------------------------------

def test_upsert_rewrites_only_its_slices(spark):
    store = KeyedSnapshots(spark, scratch(spark, "keyed"), ["k", "rev"], slices=8, buckets=4)
    assert store.read() is None and store.prior_of(hashed(spark, [1], "a")) is None
    assert store.upsert(hashed(spark, range(400), "a")) == 0
    before = store.folders()

    def files(folder):
        return {n: os.stat(f"{folder.removeprefix('file:')}/{n}").st_mtime_ns for n in os.listdir(folder.removeprefix("file:"))}

    untouched = {s: files(f) for s, f in before.items()}
    delta = hashed(spark, [7, 8, 1000], "b")
    touched = store.touched(delta)
    assert store.upsert(delta) == 1 and len(touched) < 8
    after = store.folders()
    assert {s for s in after if after[s] != before.get(s)} == set(touched)
    assert all(files(after[s]) == untouched[s] for s in after if s not in touched)
    assert {(r.k, r.HashValue) for r in store.read().collect()} == {
        (i, "b" if i in (7, 8, 1000) else "a") for i in [*range(400), 1000]}
    assert store.read(0).count() == 400  # the old version is as it was


def test_join_with_a_sliced_snapshot_shuffles_the_delta_only(spark, conf):
    conf(spark_sql_autoBroadcastJoinThreshold="-1")
    store = KeyedSnapshots(spark, scratch(spark, "keyed"), ["k", "rev"], slices=8, buckets=4)
    store.upsert(hashed(spark, range(400), "a"))
    delta = hashed(spark, [7, 8, 1000], "b")
    found = classify(delta, store.prior_of(delta), ["k", "rev"])
    assert {(r.k, r.InsertUpdates) for r in found.collect()} == {(7, 0), (8, 0), (1000, 1)}
    plan = plan_of(found).split("== Physical Plan ==")[-1]
    scan = plan.index("FileScan")
    join = plan.rindex("SortMergeJoin", 0, scan)
    assert plan[join:scan].count("Exchange") == 1  # that of the delta, which stands first
    assert "Bucketed: true" in plan[scan:] and "_slice" in plan[scan:].split("PartitionFilters")[1][:80]
    store.release()


def test_two_upserts_of_slices_lose_no_row(spark):
    root = scratch(spark, "keyed")
    one, two = (KeyedSnapshots(spark, root, ["k", "rev"], slices=4, buckets=2) for _ in range(2))
    one.upsert(hashed(spark, range(20), "a"))
    ask = two.commits.latest
    calls = []

    def then_other(*args):
        found = ask(*args)
        if not calls:
            calls.append(1)
            one.upsert(hashed(spark, [100], "theirs"))
        return found

    two.commits.latest = then_other
    with pytest.raises(CommitConflict):
        two.upsert(hashed(spark, [200], "mine"))
    calls.clear()
    assert two.upsert(hashed(spark, [200], "mine"), attempts=2) == 3
    two.commits.latest = ask
    assert {r.k for r in two.read().collect()} == {*range(20), 100, 200}


def test_new_columns_types_runs_and_nulls(spark):
    store = KeyedSnapshots(spark, scratch(spark, "keyed"), ["k"], slices=4, buckets=2)
    store.upsert(spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k long, v string"), run="first")
    assert store.upsert(spark.createDataFrame([(1, "x")], "k long, v string"), run="first") == 0
    wider = spark.createDataFrame([(2, "c", 5)], "k long, v string, extra int")
    assert store.upsert(wider, run="second") == 1
    assert sorted(map(tuple, store.read().collect()), key=repr) == sorted([(1, "a", None), (2, "c", 5), (None, "n", None)], key=repr)
    with pytest.raises(TypeError, match="change their type"):
        store.upsert(spark.createDataFrame([(2, 5)], "k long, v int"))
    assert store.upsert(spark.createDataFrame([], "k long, v string")) == 2 and store.read().count() == 3
    with pytest.raises(ValueError, match="keyed by"):
        KeyedSnapshots(spark, store.root, ["v"])
    again = KeyedSnapshots(spark, store.root, ["k"], slices=99)
    assert again.slices == 4


def test_overwrite_and_retire_slices(spark):
    store = KeyedSnapshots(spark, scratch(spark, "keyed"), ["k", "rev"], slices=4, buckets=2)
    for text in ("a", "b", "c"):
        store.upsert(hashed(spark, range(10), text))
    store.overwrite(hashed(spark, [1, 2], "d"))
    assert {(r.k, r.HashValue) for r in store.read().collect()} == {(1, "d"), (2, "d")}
    assert store.retire(keep=2)
    assert store.read(2).count() == 10 and store.read().count() == 2
    assert store.retire(keep=2) == [] or all("=" in f for f in store.retire(keep=2))


# --- runs -------------------------------------------------------------------------------------

def test_runs_leave_no_stage_and_count_in_one_pass(spark):
    folder, log = shared_dir(spark).removeprefix("file:"), scratch(spark, "log")
    delta = hashed(spark, range(10), "a").withColumn("InsertUpdates", F.when(F.col("k") < 4, 1).otherwise(0))
    before = set(os.listdir(folder))
    assert logged_run(spark, log, "p", "1", lambda: delta, keep=False) is None
    with pytest.raises(ZeroDivisionError):
        logged_run(spark, log, "p", "2", lambda: delta, write=lambda _: 1 / 0)
    assert {n for n in set(os.listdir(folder)) - before if n.startswith("stage-")} == set()
    found = {r.ExecutionId: (r.RecordsProcessed, r.RecordsInserted, r.RecordsUpdated, r.ExecutionStatus) for r in spark.read.parquet(log).collect()}
    assert found == {"1": (10, 4, 6, "SUCCESS"), "2": (None, None, None, "FAILED")}


def test_run_once_over_slices(spark):
    root = scratch(spark, "job")
    store = KeyedSnapshots(spark, f"{root}/slices", ["k", "rev"], slices=4, buckets=2)
    priors = []

    def job(ids, text):
        def run(start, prior):
            priors.append(prior)
            rows = stage(hashed(spark, ids, text), mode="table").df
            if prior is None:
                return rows.withColumns({"InsertUpdates": F.lit(1), "AuditOperations": F.lit("Inserted")})
            found = classify(rows, prior.prior_of(rows), ["k", "rev"]).where("InsertUpdates <> 3")
            return found.drop("_stored_created")

        return run

    run_once(spark, root, "p", job(range(10), "a"), ["k", "rev"], "2024-01-01 00:00:00", store=store)
    run_once(spark, root, "p", job([3, 4, 50], "b"), ["k", "rev"], "2024-01-02 00:00:00", store=store)
    assert priors == [None, store]
    assert {r.k for r in store.read().where("HashValue = 'b'").collect()} == {3, 4, 50} and store.read().count() == 11
    log = spark.read.parquet(f"{root}/log").orderBy("StartTime").collect()
    assert [(r.RecordsInserted, r.RecordsUpdated) for r in log] == [(10, 0), (1, 2)]
    assert rows(store.read()) and not spark.catalog.listTables()
