import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from tests.conftest import SMALL, plan_of, rows
from tidemark.operators import RuleError, append_run, logged_run, rules_frame, stage
from tidemark.operators.rules import Rule
from tidemark.plans import claims
from tidemark.plans.incremental import QualityError, run_once
from tidemark.session import scratch, shared_dir
from tidemark.sources import (
    Snapshots,
    is_first_load,
    load_settings,
    read_merged,
    read_pair,
    read_tables,
    upsert,
    write_clustered,
    write_overwrite,
    write_partitioned,
)
from tidemark.streaming import ChangeLog, stream_cdc

BATCH = "2024-06-01 12:00:00"


# --- claims in 80 columns ---------------------------------------------------------------------

def frame(spark, values, schema):
    return spark.createDataFrame(values, schema)


@pytest.fixture
def warehouse(spark):
    day = dt.datetime
    new, old = day(2024, 3, 1), day(2019, 7, 1)
    fact = "FactClaimTransactionLineWCKey long, RevisionNumber int, PolicyWCKey long, ClaimWCKey long, " \
           "ClaimTransactionLineCategoryKey long, ClaimTransactionWCKey long, ClaimCheckKey long, " \
           "SourceTransactionLineItemCreateDate timestamp_ntz, SourceTransactionLineItemCreateDateKey int, " \
           "SourceSystem string, RecordEffectiveDate timestamp_ntz, TransactionAmount decimal(18,2), " \
           "LoadUpdateDate timestamp_ntz, RetiredInd int"
    from decimal import Decimal as D

    def line(key, rev, policy, claim, amount, loaded, retired=0):
        return (key, rev, policy, claim, key, key, None, old, 20190701, "SYS", old, D(amount), loaded, retired)

    return {
        "fact_line": frame(spark, [
            line(1, 0, 100, 200, "1000.00", new), line(2, None, 101, 201, "2500.50", new),
            line(3, 0, 102, 202, "-1500.75", old), line(4, 2, 103, 203, "3200.75", old),
            line(5, 0, None, 204, "999999999.99", new, 1), line(1, 0, 100, 200, "1000.00", new)], fact),
        "transaction_dim": frame(spark, [(1, old), (2, None), (3, new), (4, old), (5, old)],
                                 "ClaimTransactionWCKey long, LoadUpdateDate timestamp_ntz"),
        "transaction_descriptors": frame(spark, [
            (1, 1, 200, old, old, "Payment", "Indemnity"), (2, 2, 201, old, None, "Incurred", "Medical"),
            (3, 3, 202, old, old, "Recovery", "Subrogation"), (4, 4, 203, old, old, "Reserve", "Expense"),
            (5, 5, 204, old, old, "Payment", "Legal")],
            "ClaimTransactionLineCategoryKey long, ClaimTransactionWCKey long, ClaimWCKey long, "
            "SourceTransactionCreateDate timestamp_ntz, TransactionSubmitDate timestamp_ntz, "
            "TransactionType string, LineCategory string"),
        "claim_descriptors": frame(spark, [
            (200, "MI", "OH"), (201, None, "OH"), (202, None, None), (203, "MI", None), (204, "MI", "MI")],
            "ClaimWCKey long, EmploymentLocationState string, JurisdictionState string"),
        "policy_descriptors": frame(spark, [(100, 7, 1), (101, None, 2), (102, 9, 1)],
                                    "PolicyWCKey long, AgencyKey long, BrandKey long"),
        "brand": frame(spark, [(1, "First")], "BrandKey long, BrandName string"),
        "policy_risk_state": frame(spark, [
            (10, 100, "MI", 0, old, old, old), (11, 100, "MI", 0, new, old, old), (12, 100, "MI", 1, new, new, new),
            (13, 101, "OH", 0, old, old, old), (14, 102, None, 0, old, old, old)],
            "PolicyRiskStateWCKey long, PolicyWCKey long, RiskState string, RetiredInd int, "
            "RiskStateEffectiveDate timestamp_ntz, RecordEffectiveDate timestamp_ntz, LoadUpdateDate timestamp_ntz"),
    }


def run(tables, prior=None, start="2024-01-01", rules=None, **options):
    return claims.run_measures(tables, rules or claims.sample_rules(), prior, start, BATCH, **options)


def test_first_load_in_80_columns(warehouse):
    delta = run(warehouse)
    assert tuple(delta.columns) == claims.OUTPUT_COLUMNS and len(delta.columns) == 80
    got = {r.FactClaimTransactionLineWCKey: r for r in delta.collect()}
    assert set(got) == {1, 2, 3, 5} and delta.count() == 4  # 4 did not change; 1 came twice
    assert got[1].PolicyRiskStateWCKey == 11 and got[1].AgencyKey == 7
    assert got[2].RevisionNumber == 0 and got[2].SourceSystemIdentifier == "2"  # raw revision in the id
    assert got[2].PolicyRiskStateWCKey == 13 and got[2].AgencyKey == -1
    assert got[3].PolicyRiskStateWCKey == -1  # no state at all matches nothing
    assert str(got[1].NetPaidIndemnity) == "1000.00" and str(got[1].NetIncurredMedical) == "0.00"
    assert str(got[3].RecoverySubrogation) == "-1500.75" and str(got[5].NetPaidLegal) == "999999999.99"
    assert {r.AuditOperations for r in got.values()} == {"Inserted"} and got[5].RetiredInd == 1
    assert all(len(r.HashValue) == 130 and r.HashValue.startswith("0x") for r in got.values())


def test_runs_do_not_find_the_same_rows_twice(warehouse):
    with stage(run(warehouse), mode="persist") as stored:
        assert run(warehouse, stored).isEmpty()
        late = dict(warehouse)
        # A new effective date alone is not hashed; a retirement is a change.
        late["fact_line"] = warehouse["fact_line"].withColumn(
            "RecordEffectiveDate", F.lit("2030-01-01").cast("timestamp_ntz"))
        assert run(late, stored).isEmpty()
        late["fact_line"] = warehouse["fact_line"].withColumn(
            "RetiredInd", F.when(F.col("FactClaimTransactionLineWCKey") == 1, 1).otherwise(F.col("RetiredInd")))
        again = run(late, stored).collect()
        assert [(r.FactClaimTransactionLineWCKey, r.InsertUpdates) for r in again] == [(1, 0)]
        everything = run(warehouse, stored, start="1900-01-01").collect()
        assert [r.FactClaimTransactionLineWCKey for r in everything] == [4]


def test_both_window_strategies_agree(warehouse):
    assert rows(run(warehouse, strategy="or")) == rows(run(warehouse, strategy="union"))


def test_empty_input_keeps_the_shape(warehouse):
    empty = {**warehouse, "fact_line": warehouse["fact_line"].where("false")}
    assert run(empty).isEmpty() and len(run(empty).columns) == 80


def test_rules_may_use_the_brand_and_grow(spark, warehouse):
    assert "BrandName" not in plan_of(run(warehouse)).split("Optimized Logical Plan")[-1]
    grown = [*claims.sample_rules(), Rule("FirstBrand", "CASE WHEN BK.BrandName = 'First' THEN 1 ELSE 0 END")]
    with pytest.raises(RuleError, match="FirstBrand"):
        run(warehouse, rules=grown)
    delta = run(warehouse, rules=grown, strict=False)
    got = {r.FactClaimTransactionLineWCKey: r for r in delta.collect()}
    assert delta.columns[80:] == ["FirstBrand"] and got[1].FirstBrand == 1 and got[2].FirstBrand == 0
    plain = {r.FactClaimTransactionLineWCKey: r.HashValue for r in run(warehouse).collect()}
    assert got[1].HashValue != plain[1]  # the added measure is hashed, too
    with pytest.raises(RuleError, match="NetPaidLoss"):
        run(warehouse, rules=[r for r in claims.sample_rules() if r.name != "NetPaidLoss"])


def test_rules_from_a_table_and_bad_ranges(spark, warehouse):
    stored = rules_frame(spark, claims.sample_rules(), "Claims")
    assert rows(run(warehouse, rules=stored)) == rows(run(warehouse))
    with pytest.raises(ValueError):
        run(warehouse, start="2024-02-01", end="2024-01-01")
    assert run(warehouse, end="2024-01-02").count() == 4  # the end bounds nothing


def test_sql_table_function(spark, warehouse):
    claims.register_sql(spark, warehouse)
    got = spark.sql("SELECT * FROM extract_claim_transactions(:start)", args={"start": dt.datetime(2024, 1, 1)})
    assert rows(got) == rows(claims.extract_claim_transactions(warehouse, "2024-01-01"))


# --- sources and sinks ------------------------------------------------------------------------

def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == (named or spark.sparkContext.getCheckpointDir())
    assert scratch(spark, "a") != scratch(spark, "a")


def test_first_load_probe(spark, tmp_path):
    path = str(tmp_path / "t")
    assert is_first_load(spark, path) and is_first_load(spark, "no_such_table")
    spark.range(0).write.parquet(path)
    assert is_first_load(spark, path)
    spark.range(1).write.mode("overwrite").parquet(path)
    assert not is_first_load(spark, path)


def test_overwriting_what_is_read_loses_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    write_overwrite(spark.range(3), path)
    write_overwrite(spark.read.parquet(path).where("id > 0"), path)
    assert rows(spark.read.parquet(path)) == [(1,), (2,)]
    write_overwrite(spark.range(5), path)
    left, right = read_pair(spark, path, path)
    assert left.count() == right.count() == 5


def test_partitions_and_new_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.sql("SELECT explode(sequence(TIMESTAMP_NTZ'2023-12-30', TIMESTAMP_NTZ'2024-02-02', INTERVAL 1 DAY)) AS t")
    write_partitioned(df, path, "t", "month")
    write_partitioned(df.withColumn("x", F.lit(1)), path, "t", "month", mode="append")
    back = read_merged(spark, path)
    assert back.count() == 2 * df.count() and back.where("x IS NULL").count() == df.count()
    assert "PartitionFilters: [isnotnull(year" in plan_of(back.where("year = 2024"))
    write_partitioned(df, str(tmp_path / "d"), "t", "day")
    assert len([d for d in os.listdir(tmp_path / "d") if d.startswith("load_date=")]) == df.count()


def test_clustered_files_split_a_hot_key(spark, tmp_path):
    df = spark.range(0, 20_000, 1, 4).select(F.when(F.col("id") % 2 == 0, 5).otherwise(F.col("id")).alias("k"), "id")
    write_clustered(df, str(tmp_path / "t"), ["k"], 8)
    back = spark.read.parquet(str(tmp_path / "t"))
    per_file = back.groupBy(F.input_file_name()).count().collect()
    assert back.count() == 20_000 and max(r["count"] for r in per_file) < 6_000


def test_settings(spark):
    df = spark.sql("SELECT * FROM VALUES ('BatchSize', '1', '', TIMESTAMP'2024-01-01'), "
                   "('BatchSize', '2', '', TIMESTAMP'2024-02-01'), ('Cache', 'true', '', TIMESTAMP'2024-01-01') "
                   "AS t(SettingName, SettingValue, Description, LastUpdated)")
    assert load_settings(df) == {"BatchSize": "2", "Cache": "true"}


def test_tables_open_on_demand(spark):
    tables = read_tables(spark, SMALL, ["orders"])
    assert list(tables) == ["orders"] and len(tables) == 1 and tables["orders"] is tables["orders"]
    with pytest.raises(KeyError):
        tables["lineitem"]


def test_snapshot_versions(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path / "s"))
    assert store.read() is None
    one = spark.sql("SELECT 1 AS k, 'a' AS v UNION ALL SELECT 2, 'b'")
    assert upsert(store, one, ["k"]) == 0
    assert upsert(store, spark.sql("SELECT 2 AS k, 'c' AS v UNION ALL SELECT 3, 'd'"), ["k"], partitions=2) == 1
    assert rows(store.read()) == [(1, "a"), (2, "c"), (3, "d")] and rows(store.read(0)) == [(1, "a"), (2, "b")]
    # A run that died before its version was listed leaves the last one in force.
    spark.sql("SELECT 9 AS k, 'z' AS v").write.parquet(f"{store.root}/data/v000000000002-dead")
    assert store.version() == 1 and upsert(store, one, ["k"], version=2, run="r2") == 2
    other = spark.sql("SELECT 7 AS k, 'q' AS v")
    assert upsert(store, other, ["k"], version=2, run="r2") == 2  # replay of the same run
    assert rows(store.read()) == [(1, "a"), (2, "b"), (3, "d")]
    for late in ({"version": 2}, {"version": 2, "run": "r3"}, {"version": 0}):
        with pytest.raises(ValueError):
            upsert(store, other, ["k"], **late)
    assert store.retire(keep=1) == [1, 0] and rows(store.read()) == [(1, "a"), (2, "b"), (3, "d")]


def test_upsert_keeps_columns_of_both_sides(spark, tmp_path):
    store = Snapshots(spark, str(tmp_path / "s"))
    upsert(store, spark.sql("SELECT 1 AS k, 'h' AS HashValue, 10 AS m1"), ["k"])
    upsert(store, spark.sql("SELECT 2 AS k, 'g' AS HashValue, 7 AS m2"), ["k"])
    assert rows(store.read().select("k", "m1", "m2")) == [(1, 10, None), (2, None, 7)]
    with pytest.raises(TypeError, match="m1"):
        upsert(store, spark.sql("SELECT 3 AS k, 'g' AS HashValue, '7' AS m1"), ["k"])


def test_partition_columns_overwrite_no_data(spark, tmp_path):
    with pytest.raises(ValueError, match="year"):
        write_partitioned(spark.sql("SELECT 1999 AS year, DATE'2024-01-01' AS d"), str(tmp_path / "p"), "d", "year")


def test_a_foreign_stream_is_refused(spark, tmp_path):
    def start(checkpoint):
        source = spark.readStream.schema("k long, t long").parquet(str(tmp_path / "in"))
        stream_cdc(source, str(tmp_path / "out"), ["k"], ["t"], ["k", "t"], checkpoint=checkpoint).awaitTermination()

    spark.sql("SELECT 1L AS k, 1L AS t").write.parquet(str(tmp_path / "in"))
    start(str(tmp_path / "c1"))
    spark.sql("SELECT 2L AS k, 1L AS t").write.mode("append").parquet(str(tmp_path / "in"))
    with pytest.raises(Exception, match="belongs to stream"):
        start(str(tmp_path / "c2"))
    start(str(tmp_path / "c1"))
    assert rows(ChangeLog(spark, str(tmp_path / "out"), ["k"]).current().select("k")) == [(1,), (2,)]


def test_a_refused_delta_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "job")

    def job(keys):
        return lambda start, prior: spark.createDataFrame(
            [(k, "h", 1, dt.datetime(2024, 1, 1)) for k in keys],
            "k long, HashValue string, InsertUpdates int, LoadCreateDate timestamp")

    run_once(spark, root, "p", job([1, 2]), ["k"], "2024-01-01")
    with pytest.raises(QualityError):
        run_once(spark, root, "p", job([3, 3]), ["k"], "2024-02-01")
    assert rows(Snapshots(spark, f"{root}/snapshot").read().select("k")) == [(1,), (2,)]
    log = spark.read.parquet(f"{root}/log").orderBy("StartTime").collect()
    assert [r.ExecutionStatus for r in log] == ["SUCCESS", "FAILED"] and "does not pass" in log[1].ErrorMessage


def test_a_released_stage_leaves_no_files(spark):
    kept = stage(spark.range(5), mode="table")
    path = kept.df.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:").removeprefix("//")
    assert os.path.isdir(path)
    kept.release()
    assert not os.path.exists(path)


def test_flagship_filters_reach_both_scans(spark):
    from tidemark.plans.registered import sales_rows

    plan = plan_of(sales_rows(spark, SMALL))
    assert "GreaterThanOrEqual(l_shipdate" in plan and "GreaterThanOrEqual(o_orderdate" in plan


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "log")
    delta = spark.sql("SELECT * FROM VALUES (1), (0) AS t(InsertUpdates)")
    logged_run(spark, path, "job", "run_1", lambda: delta)
    with pytest.raises(ZeroDivisionError):
        logged_run(spark, path, "job", "run_2", lambda: 1 / 0)
    append_run(spark, path, {"ProcessName": "job", "ExecutionId": "run_3"})
    got = rows(spark.read.parquet(path).select("ExecutionId", "RecordsProcessed", "ExecutionStatus", "ErrorMessage"))
    assert got == [("run_1", 2, "SUCCESS", None), ("run_2", None, "FAILED", "division by zero"),
                   ("run_3", None, "SUCCESS", None)]
    with pytest.raises(ValueError):
        append_run(spark, path, {"Nope": 1})


# --- streams ----------------------------------------------------------------------------------

def events(spark, values, path, mode="append"):
    spark.createDataFrame(values, "k long, seq long, v string").coalesce(1).write.mode(mode).parquet(path)


def feed(spark, tmp_path, **options):
    stream = (spark.readStream.schema("k long, seq long, v string").option("maxFilesPerTrigger", 1)
              .parquet(str(tmp_path / "in")))
    stream_cdc(stream, str(tmp_path / "out"), ["k"], ["seq"], ["k", "seq", "v"], **options).awaitTermination()
    return ChangeLog(spark, str(tmp_path / "out"), ["k"])


@pytest.mark.parametrize("late, third", [("latest", "new"), ("readmit", "late")])
def test_stream_over_restarts_and_late_rows(spark, tmp_path, late, third):
    events(spark, [(1, 1, "a"), (1, 2, "b"), (2, 1, "x"), (3, 5, "new")], str(tmp_path / "in"))
    log = feed(spark, tmp_path, late=late, compact_every=2)
    assert rows(log.current().select("k", "v")) == [(1, "b"), (2, "x"), (3, "new")]
    created = {r.k: r.LoadCreateDate for r in log.current().collect()}
    events(spark, [(1, 3, "c"), (2, 1, "x"), (3, 4, "late"), (4, 1, "y")], str(tmp_path / "in"))
    log = feed(spark, tmp_path, late=late, compact_every=2)
    assert rows(log.current().select("k", "v")) == [(1, "c"), (2, "x"), (3, third), (4, "y")]
    assert log.base.version() == 1
    assert {r.k: r.LoadCreateDate for r in log.current().where("k < 4").collect()} == created
    labels = {r.k: r.InsertUpdates for r in log.current().collect()}
    assert labels[1] == 0 and labels[2] == 1 and labels[4] == 1


def test_stream_drops_repeats_within_a_delay(spark, tmp_path):
    spark.sql("SELECT 1L AS k, TIMESTAMP'2024-01-01' AS ts, 'a' AS v UNION ALL "
              "SELECT 1L, TIMESTAMP'2024-01-01', 'a'").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k long, ts timestamp, v string").parquet(str(tmp_path / "in"))
    stream_cdc(stream, str(tmp_path / "out"), ["k"], ["ts"], ["k", "v"],
               dedupe_within=("ts", "1 hour")).awaitTermination()
    assert ChangeLog(spark, str(tmp_path / "out"), ["k"]).current().count() == 1


# --- driver contract --------------------------------------------------------------------------

def test_entry_and_registration(spark):
    assert driver.entry(spark).count() == 412
    assert {q for q in driver.queries() if not q.startswith("op") and q != "pipeline"} <= set(driver.oracle_sql())
    assert set(driver.oracle_sql()) <= set(driver.queries())


QUICK = [n for n in driver.oracle_sql() if not n.startswith(("claim_measures_first", "stream"))]


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    from tools.check import TABLES, rows_of

    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    df = driver.queries()[name](spark, SMALL)
    cursor = db.execute(driver.oracle_sql()[name])
    theirs = cursor.fetchall()
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, df.collect()) == rows_of(names, theirs)
