"""Large results written in shares: the same rows, and no more shuffle files than a share makes."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL, plan_of, rows
from tidemark.operators import apply_delta, shares, stage
from tidemark.plans import claims, registered
from tidemark.session import scratch
from tidemark.sources import KeyedSnapshots, Snapshots, upsert


@pytest.fixture
def large(monkeypatch, conf):
    """Any table counts as large, and no join is a broadcast."""
    conf(spark_sql_autoBroadcastJoinThreshold="-1")
    monkeypatch.setattr(shares, "_SHARE_BYTES", 1)
    monkeypatch.setattr(shares, "_MOST_SHARES", 3)


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [found.apply(i).getName() for i in range(found.size())]
    return {n for n in names if n.startswith("shuffle_")}


def keyed(spark, ids, text):
    return spark.createDataFrame([(i,) for i in ids], "k long").select(
        F.when(F.col("k") != 5, F.col("k")).alias("k"), F.lit(text).alias("v")).repartition(3)


def test_a_stage_in_shares_has_every_row_and_leaves_no_shuffle_files(spark, large):
    made = scratch(spark, "made")
    keyed(spark, range(200), "a").write.parquet(made)
    read = spark.read.parquet(made)
    df = read.unionAll(read).groupBy("k").agg(F.count("*").alias("n"))
    before = shuffle_files(spark)
    for dealt in (False, True):
        kept = stage(df, mode="table", keys=["k"], dealt=dealt)
        assert shuffle_files(spark) <= before
        assert rows(kept.df) == rows(df) and kept.df.columns == df.columns
        assert "Exchange" not in plan_of(kept.df) and ("Bucketed: true" in plan_of(kept.df.groupBy("k").count())) == dealt
        before |= shuffle_files(spark)
        kept.release()
    assert not [t for t in spark.catalog.listTables() if t.name == kept._table]


@pytest.mark.parametrize("name", ["cdc_classify_512", "cdc_apply"])
def test_classes_and_delta_of_staged_lines_shuffle_nothing(spark, large, name):
    found = registered.QUERIES[name](spark, SMALL)
    assert "Exchange" not in plan_of(found)
    shares._SHARE_BYTES = 1 << 40
    assert rows(found) == rows(registered.QUERIES[name](spark, SMALL))
    [spark.sql(f"DROP TABLE {t.name}") for t in spark.catalog.listTables() if t.name.startswith("tidemark_")]


def test_an_upsert_in_shares(spark, large):
    store = Snapshots(spark, scratch(spark, "store"))
    store.commit(keyed(spark, range(50), "a"))
    delta = stage(keyed(spark, [3, 5, 70], "b"), mode="table").df
    wanted = rows(apply_delta(store.read(), delta, ["k"]))
    before = shuffle_files(spark)
    upsert(store, delta, ["k"])
    assert shuffle_files(spark) <= before
    assert rows(store.read()) == wanted and store.read().count() == 52  # a NULL key is never the same


def test_an_upsert_of_slices_in_shares(spark, large):
    store, plain = (KeyedSnapshots(spark, scratch(spark, "keyed"), ["k"], slices=8, buckets=2) for _ in range(2))
    deltas = [stage(keyed(spark, ids, text), mode="table").df for ids, text in ((range(50), "a"), ([3, 70], "b"), (range(60), "c"))]
    before = shuffle_files(spark)
    for delta in deltas:
        store.upsert(delta)
        # One shuffle names the slices of the delta and is no part of the write.
        assert len({n.split("_")[1] for n in shuffle_files(spark) - before}) <= 1
        before |= shuffle_files(spark)
    shares._SHARE_BYTES = 1 << 40
    [plain.upsert(delta) for delta in deltas]
    assert rows(store.read()) == rows(plain.read())
    assert len({f.split("/")[-2] for f in store.folders().values()}) == len({f.split("/")[-2] for f in plain.folders().values()})
    assert not [t for t in spark.catalog.listTables() if store.root in t.name]


@pytest.mark.parametrize("name", ["claim_measures_first_load", "claim_measures_pruned"])
def test_claims_in_shares(spark, large, name):
    before = shuffle_files(spark), {t.name for t in spark.catalog.listTables()}
    found = registered.QUERIES[name](spark, SMALL)
    assert "Exchange" not in plan_of(found) and {t.name for t in spark.catalog.listTables()} == before[1]
    shares._SHARE_BYTES = 1 << 40
    assert rows(found) == rows(registered.QUERIES[name](spark, SMALL))


def test_claim_rows_in_shares_read_the_shares_of_their_transaction(spark, large):
    tables = registered.claim_sources(spark, SMALL)
    rules = claims.sample_rules()
    job = claims.run_measures(tables, rules, None, "1900-01-01", registered.BATCH)
    plan = plan_of(job.where(shares.share(["ClaimTransactionWCKey"], 3, 1))).split("== Physical Plan ==")[-1]
    # Fact, transactions and descriptors; not the ranked states, which were written before.
    assert plan.count("pmod(xxhash64(") >= 3 and plan.count("WindowGroupLimit") == 2
    before = shuffle_files(spark)
    found = registered.claim_measures_delta(spark, SMALL)
    assert shuffle_files(spark) <= before
    shares._SHARE_BYTES = 1 << 40
    assert rows(found) == rows(registered.claim_measures_delta(spark, SMALL))
