import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL, plan_of, rows
from tidemark.operators import (
    Check,
    Lookup,
    Rule,
    RuleError,
    apply_delta,
    apply_measures,
    broadcast_if_fits,
    changed_since,
    check_keys,
    classify,
    conditional_measure,
    constant_measure,
    duplicate_keys,
    enrich,
    expect,
    gate,
    high_water_mark,
    latest_per_key,
    load_rules,
    match_rate,
    only_changes,
    only_inserts,
    plain_measure,
    profile,
    prune_prior,
    rate_duration,
    reconcile_hash,
    reconcile_rows,
    reconcile_totals,
    rules_frame,
    run_metrics,
    since_last_run,
    stage,
    stamp,
    standard_checks,
    star_join,
    status,
    used_lookups,
)
from tidemark.plans.registered import QUERIES, SALES, latest_lines, sales_prior, sales_rows

BATCH = "2024-06-01 12:00:00"


# --- latest row per key -----------------------------------------------------------------------

def test_latest_row_by_mixed_order_and_nulls(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 'a', 5, 1), (1, 'a', NULL, 2), (1, 'a', 5, 3), (2, 'b', NULL, 4)"
                   " AS t(p, s, ts, id)")
    assert rows(latest_per_key(df, ["p", "s"], ["ts desc", "id desc"]).select("id")) == [(3,), (4,)]
    assert rows(latest_per_key(df, ["p", "s"], ["ts", "id"]).select("id")) == [(2,), (4,)]


def test_retired_rows_are_left_out_before_ranking(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 1, 9), (1, 0, 5) AS t(p, retired, ts)")
    assert rows(latest_per_key(df, ["p"], ["ts desc"], where="retired = 0")) == [(1, 0, 5)]


def test_order_is_demanded(spark):
    with pytest.raises(ValueError):
        latest_per_key(spark.range(1), ["id"], [])


def test_hot_key_is_cut_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan_of(latest_lines(spark, SMALL))
    df = spark.range(0, 30_000, 1, 8).select((F.col("id") % 3).alias("k"), "id")
    top = latest_per_key(df.withColumn("k", F.when(F.col("k") == 0, 7).otherwise(F.col("id"))), ["k"], ["id desc"])
    assert top.where("k = 7").collect() == [(7, 29_997)]


# --- changed on either side -------------------------------------------------------------------

@pytest.fixture
def two_sides(spark):
    fact = spark.sql("""SELECT * FROM VALUES
        (1, 10, TIMESTAMP_NTZ'2024-01-05'), (2, 20, TIMESTAMP_NTZ'2020-01-01'), (3, 30, TIMESTAMP_NTZ'2020-01-01'),
        (4, 20, NULL), (5, 40, TIMESTAMP_NTZ'2024-01-05'), (6, 99, TIMESTAMP_NTZ'2024-01-05'),
        (1, 10, TIMESTAMP_NTZ'2024-01-05'), (7, 30, NULL), (8, NULL, TIMESTAMP_NTZ'2024-01-05') AS f(id, k, ts)""")
    dim = spark.sql("""SELECT * FROM VALUES
        (10, TIMESTAMP_NTZ'2020-01-01'), (20, TIMESTAMP_NTZ'2024-02-01'), (20, TIMESTAMP_NTZ'2019-01-01'),
        (30, TIMESTAMP_NTZ'2020-01-01'), (40, NULL) AS d(k, ts)""")
    return fact, dim


@pytest.mark.parametrize("strategy", ["or", "union", "auto"])
def test_change_on_either_side_counts(two_sides, strategy):
    got = changed_since(*two_sides, "k", "ts", "ts", "2024-01-01", strategy)
    assert [r[0] for r in rows(got)] == [1, 2, 4, 5]


def test_full_load_takes_everything_with_a_time(two_sides):
    got = changed_since(*two_sides, "k", "ts", "ts", "1900-01-01")
    assert [r[0] for r in rows(got)] == [1, 2, 3, 4, 5, 7]


def test_window_has_no_upper_bound(two_sides):
    later = two_sides[0].withColumn("ts", F.lit("2999-01-01").cast("timestamp_ntz"))
    assert changed_since(later, two_sides[1], "k", "ts", "ts", "2024-01-01").count() == 6  # all but the two without a dimension row


def test_filters_of_both_branches_reach_the_scans(spark):
    plan = plan_of(QUERIES["changed_either_side_union"](spark, SMALL))
    assert "GreaterThanOrEqual(l_shipdate" in plan and "GreaterThanOrEqual(o_orderdate" in plan


def test_high_water_mark(spark):
    log = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-03' AS done WHERE false")
    assert high_water_mark(log, "done") == dt.datetime(1900, 1, 1)
    source = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    marked = since_last_run(source, spark.sql("SELECT TIMESTAMP_NTZ'2001-01-01' AS done"), "l_shipdate", "done")
    assert "GreaterThanOrEqual(l_shipdate" in plan_of(marked)
    assert marked.count() == source.where("l_shipdate >= TIMESTAMP_NTZ'2001-01-01'").count()


# --- lookups ----------------------------------------------------------------------------------

@pytest.fixture
def star(spark):
    fact = spark.sql("SELECT * FROM VALUES (1, 10, 'F'), (2, 11, NULL), (3, NULL, NULL), (4, 12, NULL) AS t(id, pol, st)")
    claim = spark.sql("SELECT * FROM VALUES (1, 'G'), (2, 'G'), (3, 'G'), (4, NULL) AS t(id, st2)")
    policy = spark.sql("SELECT * FROM VALUES (10, 7, 1), (11, CAST(NULL AS INT), 2), (12, 8, 3) AS t(pol, agency, brand)")
    brand = spark.sql("SELECT * FROM VALUES (1, 'one'), (2, 'two') AS t(brand, bname)")
    state = spark.sql("SELECT * FROM VALUES (10, 'F', 100), (11, 'G', 110), (12, 'F', 120) AS t(pol, state, skey)")
    return fact, [
        Lookup("c", claim, ["id"], "inner"),
        Lookup("p", policy, ["pol"], take=["agency"], defaults={"agency": -1}),
        Lookup("b", brand, "p.brand = b.brand", take=["bname"]),
        Lookup("s", state, "fact.pol = s.pol AND coalesce(fact.st, c.st2) = s.state", take=["skey"],
               defaults={"skey": -1}, spread=("fact.pol", "s.pol")),
    ]


def test_star_and_snowflake_with_defaults(star):
    got = rows(enrich(*star).select("id", "agency", "bname", "skey"))
    assert got == [(1, 7, "one", 100), (2, -1, "two", 110), (3, -1, None, -1), (4, 8, None, -1)]


def test_unused_left_lookup_is_left_out(star):
    fact, lookups = star
    assert [x.name for x in used_lookups(lookups, ["s.skey"])] == ["c", "s"]
    assert [x.name for x in used_lookups(lookups, ["b.bname", "s.skey"])] == ["c", "p", "b", "s"]


def test_broadcast_only_after_a_size_check(spark, conf):
    conf(spark_sql_autoBroadcastJoinThreshold=-1)
    big, small = spark.range(2000), spark.range(5)
    assert "ResolvedHint" not in plan_of(broadcast_if_fits(big, 100))
    assert "broadcast" in plan_of(broadcast_if_fits(small, 100))


def test_hot_lookup_key_is_split_at_run_time(spark, conf):
    """A third of the fact on one key, another third without a key, and a lookup
    that was windowed by the same key: the join must still be split."""
    conf(spark_sql_autoBroadcastJoinThreshold=-1, spark_sql_shuffle_partitions=8,
         spark_sql_adaptive_skewJoin_skewedPartitionThresholdInBytes="20KB",
         spark_sql_adaptive_skewJoin_skewedPartitionFactor=2,
         spark_sql_adaptive_advisoryPartitionSizeInBytes="10KB",
         spark_sql_adaptive_coalescePartitions_parallelismFirst="false")
    fact = spark.range(0, 60_000, 1, 8).select(
        "id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id")).alias("pol"))
    versions = spark.range(0, 60_000, 1, 4).select(F.col("id").alias("pol"), (F.col("id") * 2).alias("skey"))
    current = latest_per_key(versions.unionByName(versions.withColumn("skey", F.col("skey") - 1)),
                             ["pol"], ["skey desc"])
    joined = enrich(fact, [Lookup("s", current, ["pol"], take=["skey"], defaults={"skey": -1},
                                  spread=("fact.pol", "s.pol"))])
    joined.write.format("noop").mode("overwrite").save()
    found = joined.groupBy("skey").count().where("skey IN (14, -1)")
    assert {tuple(r) for r in found.collect()} == {(14, 20_000 + 1), (-1, 20_000)}
    kept = joined.persist()
    kept.count()
    assert "skew=true" in plan_of(kept)
    kept.unpersist()


@pytest.mark.parametrize("strategy", ["or", "union"])
def test_hot_key_of_the_change_window_is_split(spark, conf, strategy):
    conf(spark_sql_autoBroadcastJoinThreshold=-1, spark_sql_shuffle_partitions=8,
         spark_sql_adaptive_autoBroadcastJoinThreshold=-1,
         spark_sql_adaptive_skewJoin_skewedPartitionThresholdInBytes="20KB",
         spark_sql_adaptive_skewJoin_skewedPartitionFactor=2,
         spark_sql_adaptive_advisoryPartitionSizeInBytes="10KB",
         spark_sql_adaptive_coalescePartitions_parallelismFirst="false")
    late = F.lit("2024-02-01").cast("timestamp_ntz")
    early = F.lit("2020-01-01").cast("timestamp_ntz")
    fact = spark.range(0, 60_000, 1, 8).select(
        "id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), early.alias("ts"))
    dim = spark.range(0, 60_000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), late.alias("ts"))
    found = changed_since(fact, dim, "k", "ts", "ts", "2024-01-01", strategy).persist()
    assert found.count() == 60_000
    assert "skew=true" in plan_of(found)
    found.unpersist()


# --- rules ------------------------------------------------------------------------------------

SCENARIOS = [("Payment", "Indemnity", 1000, 1000, 0), ("Incurred", "Medical", 2000, 0, 2000),
             ("Reserve", "Expense", 500, 0, 0), ("Recovery", "Subrogation", -300, 0, 0)]


def test_measure_scenarios(spark):
    df = spark.createDataFrame([s[:3] for s in SCENARIOS], "kind string, category string, amount int")
    rules = [conditional_measure("NetPaid", "amount", {"kind": "Payment"}),
             conditional_measure("NetIncurred", "amount", {"kind": "Incurred"}),
             conditional_measure("Quoted", "1", {"kind": "it's \\ fine"}),
             plain_measure("Gross", "amount"), constant_measure("None_")]
    got = apply_measures(df, rules).collect()
    assert [(r.NetPaid, r.NetIncurred, r.Gross, r.None_, r.Quoted) for r in got] == [
        (paid, incurred, amount, Decimal("0.00"), 0) for _, _, amount, paid, incurred in SCENARIOS]


def test_rules_come_in_name_order_for_one_source(spark):
    stored = rules_frame(spark, [Rule("b", "2"), Rule("a", "1")], "Claims").unionByName(
        rules_frame(spark, [Rule("c", "3")], "claims "))
    assert [r.name for r in load_rules(stored, "Claims")] == ["a", "b"]
    assert [r.name for r in load_rules(stored, "CLAIMS", ignore_case=True)] == ["a", "b", "c"]
    with pytest.raises(RuleError):
        load_rules(stored, "Claims", max_rules=1)


@pytest.mark.parametrize("rule, message", [
    (Rule("m", "1, 2"), "m"), (Rule("m", "nope + 1"), "nope"), (Rule("m", "sum(id)"), "m"),
    (Rule("m", "row_number() over (order by id)"), "window"), (Rule("m", "(select 1)"), "subqueries"),
    (Rule("m", "rand()"), "rand"), (Rule("m x", "1"), "legal"), (Rule("m", " "), "no logic"),
    (Rule("m", "1 AS x"), "m"), (Rule("m", "s.id) FROM t -- "), "m"),
])
def test_bad_rules_are_named(spark, rule, message):
    with pytest.raises(RuleError, match=message):
        apply_measures(spark.range(3), [Rule("ok", "id"), rule])


def test_ambiguous_name_in_a_rule(star):
    with pytest.raises(RuleError, match="rule m"):
        apply_measures(star_join(*star), [Rule("m", "pol + 1")], keep=["fact.id"])


def test_rule_added_removed_or_defined_twice(spark):
    df = spark.range(1)
    with pytest.raises(RuleError, match="missing"):
        apply_measures(df, [Rule("a", "1")], strict_names=["a", "b"])
    with pytest.raises(RuleError, match="not expected"):
        apply_measures(df, [Rule("a", "1"), Rule("z", "1")], strict_names=["a"])
    with pytest.raises(RuleError, match="twice"):
        apply_measures(df, [Rule("a", "1"), Rule("A", "1")])


# --- change detection -------------------------------------------------------------------------

@pytest.fixture
def cdc(spark):
    cur = spark.sql("SELECT * FROM VALUES (1, 0, 'new'), (2, 0, 'same'), (3, 0, 'hash456'), (4, 0, 'x')"
                    " AS t(k, rev, HashValue)")
    prior = spark.sql("""SELECT * FROM VALUES (2, 0, 'same', TIMESTAMP_NTZ'2020-01-01'),
        (3, 0, 'hash123', TIMESTAMP_NTZ'2020-01-01'), (4, 0, NULL, TIMESTAMP_NTZ'2020-01-01'),
        (9, 0, 'gone', TIMESTAMP_NTZ'2020-01-01') AS t(k, rev, HashValue, LoadCreateDate)""")
    return cur, prior


def test_labels(cdc):
    got = rows(classify(*cdc, ["k", "rev"]).select("k", "InsertUpdates", "AuditOperations"))
    assert got == [(1, 1, "Inserted"), (2, 3, None), (3, 0, "Updated"), (4, 3, None)]


def test_stored_null_hash_can_count_as_changed(cdc):
    got = rows(only_changes(classify(*cdc, ["k", "rev"], null_hash="update")).select("k"))
    assert got == [(1,), (3,), (4,)]


def test_delta_keeps_create_time_and_never_deletes(cdc):
    delta = stamp(only_changes(classify(*cdc, ["k", "rev"])), BATCH)
    now, old = dt.datetime(2024, 6, 1, 12), dt.datetime(2020, 1, 1)
    assert rows(delta.select("k", "LoadUpdateDate", "LoadCreateDate")) == [(1, now, now), (3, now, old)]
    after = apply_delta(cdc[1], delta, ["k", "rev"])
    assert rows(after.select("k", "HashValue")) == [
        (1, "new"), (2, "same"), (3, "hash456"), (4, None), (9, "gone")]
    assert only_changes(classify(cdc[0], after, ["k", "rev"])).count() == 0  # a second run finds nothing
    assert rows(only_inserts(*cdc, ["k", "rev"]).select("k")) == [(1,)]


def test_repeated_stored_key_fans_out(spark, cdc):
    twice = cdc[1].unionByName(cdc[1].where("k = 3").withColumn(
        "LoadCreateDate", F.lit("2021-01-01").cast("timestamp_ntz")))
    delta = stamp(only_changes(classify(cdc[0], twice, ["k", "rev"])), BATCH).distinct()
    assert delta.where("k = 3").count() == 2


def test_pruning_the_snapshot_changes_nothing(cdc):
    keys = ["k", "rev"]
    full = rows(classify(cdc[0], cdc[1], keys))
    assert rows(classify(cdc[0], prune_prior(cdc[1], cdc[0], keys), keys)) == full
    assert prune_prior(cdc[1], cdc[0], keys).count() == 3
    assert prune_prior(cdc[1], cdc[0], keys, max_keys=2) is cdc[1]


# --- golden counts of the flagship ------------------------------------------------------------

def test_flagship_golden_counts(spark):
    hashed = sales_rows(spark, SMALL).persist()
    got = classify(hashed, sales_prior(hashed), SALES.keys).groupBy("InsertUpdates").agg(
        F.count("*"), F.sum("m1"), F.sum("m2"))
    assert rows(got) == [
        (0, 203, Decimal("2236706.60"), Decimal("3289398.95")),
        (1, 209, Decimal("1358351.85"), Decimal("3457409.88")),
        (3, 1766, Decimal("13993723.89"), Decimal("28772418.61"))]
    hashed.unpersist()


def test_no_python_in_any_plan(spark):
    for name, query in QUERIES.items():
        if name in ("stream_cdc", "cdc_upsert_versions", "partitioned_roundtrip", "clustered_roundtrip"):
            continue
        plan = plan_of(query(spark, SMALL))
        for word in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "NestedLoop"):
            assert word not in plan, (name, word)


# --- quality ----------------------------------------------------------------------------------

def quality(spark, values):
    df = spark.sql(f"SELECT * FROM VALUES {values} AS t(k, HashValue, amount)")
    return profile(df, [*standard_checks(["k"], "HashValue", "amount"), Check("big", "amount > 5")], "amount")


@pytest.mark.parametrize("values, verdict", [
    ("(NULL, NULL, 0)", "FAIL: Null keys detected"), ("(1, NULL, 0)", "FAIL: Null hashes detected"),
    ("(1, 'h', 0), (2, 'h', 0), (3, 'h', 6)", "WARN: High zero amounts"),
    ("(1, 'h', 0), (2, 'h', 1)", "PASS"),
])
def test_quality_status_first_match_wins(spark, values, verdict):
    assert status(quality(spark, values)).first()["quality_status"] == verdict


def test_gate(spark):
    assert gate(quality(spark, "(1, 'h', -1), (2, 'h', 1)")).count() == 1
    assert gate(quality(spark, "(1, 'h', 1), (2, 'h', 1)")).count() == 0


def test_key_checks(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 0, 'a'), (1, 0, NULL), (2, NULL, 'b') AS t(k, rev, d)")
    got = check_keys(df, ["k", "rev"], ["d"]).first().asDict()
    assert got == {"total_records": 3, "distinct_keys": 2, "null_k": 0, "null_rev": 1, "null_d": 1,
                   "keys_unique": False, "all_present": False}
    assert rows(duplicate_keys(df, ["k", "rev"])) == [(1, 0, 2)]
    assert check_keys(df.where("false"), ["k"]).first()["total_records"] == 0
    assert check_keys(df, ["k"], approximate=True).first()["distinct_keys"] == 2


# --- reconciliation ---------------------------------------------------------------------------

def test_totals_and_an_empty_side(spark):
    a = spark.sql("SELECT CAST(10 AS DECIMAL(18,2)) AS amount")
    near = spark.sql("SELECT CAST(10 AS DECIMAL(18,2)) AS amount")
    assert reconcile_totals(a, near, "amount").first()["validation_status"] == "PASS"
    off = a.withColumn("amount", F.lit("10.01").cast("decimal(18,2)"))
    assert reconcile_totals(a, off, "amount").first()["validation_status"] == "FAIL"
    assert reconcile_totals(a, a.where("false"), "amount").first()["validation_status"] == "FAIL"


def test_rows_by_key(spark):
    a = spark.sql("SELECT * FROM VALUES (1, 'x', NULL), (2, 'x', 1), (3, 'x', 1), (5, 'p', 1), (5, 'q', 2) AS t(k, c, d)")
    b = spark.sql("SELECT * FROM VALUES (1, 'x', NULL), (2, 'y', NULL), (4, 'x', 1), (5, 'q', 2), (5, 'p', 1) AS t(k, c, d)")
    found = reconcile_rows(a, b, ["k"], ["c", "d"])
    assert rows(found) == [(1, 1, 1, "matched", ""), (2, 1, 1, "differs", "c,d"), (3, 1, 0, "left_only", None),
                           (4, 0, 1, "right_only", None), (5, 2, 2, "matched", None)]
    assert match_rate(found).first().asDict() == {
        "total_keys": 5, "matched_keys": 2, "match_rate": Decimal("40.0000"), "target_met": False}
    assert rows(reconcile_rows(a, b.where("c <> 'p'"), ["k"], ["c"]).where("k = 5").select("status")) == [("differs",)]
    hashes = reconcile_hash(a.withColumn("HashValue", F.col("c")), b.withColumn("HashValue", F.col("c")), ["k"])
    assert dict(rows(hashes)) == {"matched": 2, "differs": 1, "left_only": 1, "right_only": 1}


def test_expectations(spark):
    actual = spark.sql("SELECT * FROM VALUES ('a', 1), ('b', NULL), ('c', 2), ('d', 1) AS t(k, v)")
    expected = spark.sql("SELECT 'a' AS k, 1 AS v UNION ALL SELECT 'b', NULL UNION ALL SELECT 'c', 3 UNION ALL SELECT 'e', 1")
    assert [r[3] for r in rows(expect(actual, expected, ["k"], "v"))] == ["PASS", "PASS", "FAIL", "FAIL", "FAIL"]


# --- metrics and stages -----------------------------------------------------------------------

def test_run_metrics_and_rating(spark):
    delta = spark.sql("SELECT * FROM VALUES (1), (0), (0) AS t(InsertUpdates)")
    got = run_metrics(delta, "p", "e", BATCH, BATCH).first()
    assert (got.RecordsProcessed, got.RecordsInserted, got.RecordsUpdated, got.ErrorMessage) == (3, 1, 2, None)
    times = spark.range(4).selectExpr("TIMESTAMP'2024-01-01' AS a",
                                      "TIMESTAMP'2024-01-01' + make_dt_interval(0, 0, 0, 300 * (id + 1) * (id + 1)) AS b")
    assert [r[0] for r in rate_duration(times, "a", "b").orderBy("b").select("performance_rating").collect()] == [
        "EXCELLENT", "ACCEPTABLE", "NEEDS_OPTIMIZATION", "NEEDS_OPTIMIZATION"]


@pytest.mark.parametrize("mode", ["lazy", "persist", "checkpoint", "table"])
def test_stages_leave_nothing_behind(spark, mode):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    with stage(df, "stage_view", mode) as kept:
        assert spark.table("stage_view").count() == kept.count() == 10
    assert not spark.catalog.tableExists("stage_view")
    assert not kept.is_cached
