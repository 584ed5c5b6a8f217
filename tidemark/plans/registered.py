"""Registered queries: every operator on the sales tables, over whole tables.

Roles: lineitem is the fact (order key and line number are its key and revision,
ship date its update time, return flag its type, line status its category),
orders its transaction dimension and, by customer and status, a table of several
versions per key; customer, part, supplier, nation and region are lookups.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from tidemark.functions import (
    composite_id,
    concat_blank,
    effective_start,
    parse_time,
    row_hash,
    safe_key,
    with_defaults,
)
from tidemark.functions.scalars import time_literal
from tidemark.operators import (
    Check,
    Lookup,
    apply_delta,
    apply_measures,
    changed_since,
    check_keys,
    classify,
    conditional_measure,
    constant_measure,
    duplicate_keys,
    enrich,
    expect,
    gate,
    latest_per_key,
    load_rules,
    logged_run,
    match_rate,
    measure_sql,
    only_changes,
    only_inserts,
    plain_measure,
    prior_snapshot,
    profile,
    prune_prior,
    rate_duration,
    reconcile_hash,
    reconcile_rows,
    reconcile_totals,
    reconcile_tree,
    rules_frame,
    run_metrics,
    since_last_run,
    stack_rows,
    stage,
    stamp,
    standard_checks,
    status,
)
from tidemark.operators.changes import CLASS, LABEL, empty_prior
from tidemark.plans import claims
from tidemark.plans.incremental import run_once
from tidemark.plans.measure_job import MeasureJob, delta_of, measured_rows
from tidemark.session import scratch
from tidemark.sources import (
    CurrentState,
    KeyedSnapshots,
    Snapshots,
    read_merged,
    read_tables,
    upsert,
    write_clustered,
    write_partitioned,
    write_zordered,
)
from tidemark.streaming import ChangeLog, stream_cdc

START = "2000-01-01"
BATCH = "2024-06-01 12:00:00"
FIRST_BATCH = "2020-01-01 00:00:00"
LINE_KEYS = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate desc", "l_partkey desc", "l_suppkey desc", "l_extendedprice desc",
              "l_quantity desc"]


def first_time():
    return F.lit(FIRST_BATCH).cast("timestamp_ntz")


# --- the fact and its stored snapshot ---------------------------------------------------------

def latest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(read_tables(spark, sf_dir)["lineitem"], LINE_KEYS, LINE_ORDER)


def latest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(read_tables(spark, sf_dir)["orders"], ["o_custkey", "o_orderstatus"],
                          ["o_orderdate desc", "o_orderkey desc"],
                          where="o_orderpriority <> '5-LOW'")


def latest_orders_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same kept up over three deliveries that overlap, the last one first: late versions lose,
    repeated ones change nothing."""
    orders = read_tables(spark, sf_dir)["orders"]
    state = CurrentState(spark, scratch(spark, "current"), ["o_custkey", "o_orderstatus"],
                         ["o_orderdate desc", "o_orderkey desc"], where="o_orderpriority <> '5-LOW'", slices=4, buckets=4)
    year = F.year("o_orderdate")
    for run, part in enumerate([year >= 1999, year < 1996, year.between(1995, 1999)]):
        state.merge(orders.where(part), run=f"delivery {run}")
    return state.read()


def latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(read_tables(spark, sf_dir)["events"], ["user_id"],
                          ["ts desc", "event_id desc"])


def hashed_lines(spark: SparkSession, sf_dir: str, bits: int = 256) -> DataFrame:
    """Latest lines as rows of a fact, with their hash."""
    rows = latest_lines(spark, sf_dir).select(
        F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("rev"),
        F.col("l_partkey").alias("part"), F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
        F.col("l_returnflag").alias("kind"), F.col("l_linestatus").alias("category"),
        F.col("l_shipdate").alias("shipped"))
    return rows.withColumn("HashValue", row_hash(
        rows, ["k", "rev", "part", "amount", "kind", "category", "shipped"], bits=bits))


def stored_lines(rows: DataFrame, null_hash: bool = False) -> DataFrame:
    """A snapshot of the rows as an earlier run left it: the last year is missing,
    and open returned lines have another hash, or none at all."""
    old = F.concat(F.lit("x"), F.col("HashValue")) if not null_hash else F.lit(None).cast("string")
    changed = (F.col("kind") == "R") & (F.col("category") == "O")
    return rows.where(F.col("shipped") < F.lit("2001-01-01").cast("timestamp_ntz")).withColumns({
        "HashValue": F.when(changed, old).otherwise(F.col("HashValue")), "LoadCreateDate": first_time()})


def staged_lines(spark: SparkSession, sf_dir: str, bits: int = 256) -> DataFrame:
    """The hashed lines written out once, since run and snapshot both read them."""
    return stage(hashed_lines(spark, sf_dir, bits), mode="table", keys=["k", "rev"], dealt=True).df


# --- flagship ---------------------------------------------------------------------------------

SALES = MeasureJob(
    fact_alias="line",
    keys=("k", "rev"),
    attributes=(
        ("k", "line.l_orderkey"), ("rev", "line.l_linenumber"),
        ("rsk", "coalesce(state.o_orderkey, -1)"), ("agency", "coalesce(part.p_size, -1)"),
        ("amount", "CAST(line.l_extendedprice AS DECIMAL(18,2))"),
        ("returnflag", "line.l_returnflag"), ("linestatus", "line.l_linestatus"),
    ),
    hash_columns=("k", "rev", "rsk", "agency", "m1", "m2", "amount", "returnflag", "linestatus"),
    hash_bits=256,
)
SALES_OUTPUT = ("k", "rev", "rsk", "agency", "m1", "m2", "amount", "returnflag", "linestatus",
                "HashValue", "InsertUpdates", "AuditOperations", "LoadUpdateDate", "LoadCreateDate")


def sales_rules(spark: SparkSession):
    amount = "CAST(line.l_extendedprice AS DECIMAL(18,2))"
    rules = [conditional_measure("m2", amount, {"line.l_returnflag": "A"}),
             conditional_measure("m1", amount, {"line.l_returnflag": "A", "line.l_linestatus": "F"})]
    return load_rules(rules_frame(spark, rules, "Sales"), "Sales")


def sales_rows(spark: SparkSession, sf_dir: str, start=START, strategy: str = "auto") -> DataFrame:
    t = read_tables(spark, sf_dir)
    # The window comes before the ranking. That is the same only because the window's time leads the
    # ranking's order, descending, and its join key is a ranking key: if any row of a
    # key is in the window, so is the latest one. Both filters then reach their scans.
    facts = latest_per_key(
        changed_since(t["lineitem"], t["orders"], ("l_orderkey", "o_orderkey"), "l_shipdate",
                      "o_orderdate", start, strategy, assume_unique=True),
        LINE_KEYS, LINE_ORDER).select(
        *LINE_KEYS, "l_partkey", "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate")
    lookups = [
        Lookup("ord", t["orders"], "line.l_orderkey = ord.o_orderkey", "inner"),
        Lookup("cust", t["customer"], "ord.o_custkey = cust.c_custkey", "inner"),
        Lookup("part", t["part"], "line.l_partkey = part.p_partkey"),
        Lookup("state", latest_orders(spark, sf_dir),
               "ord.o_custkey = state.o_custkey AND "
               "coalesce(nullif(ord.o_orderstatus, 'P'), 'F') = state.o_orderstatus",
               spread=("ord.o_custkey", "state.o_custkey")),
    ]
    return measured_rows(facts, lookups, sales_rules(spark), SALES, ["m1", "m2"])


def sales_prior(rows: DataFrame) -> DataFrame:
    """The stored snapshot: no row of keys ending in 0, another hash where they end in 1."""
    digit = F.pmod("k", F.lit(10))
    stored = F.when(digit == 1, F.concat(F.lit("x"), F.col("HashValue"))).otherwise(F.col("HashValue"))
    return rows.where(digit != 0).select("k", "rev", stored.alias("HashValue"),
                                         first_time().alias("LoadCreateDate"))


def flagship_measures_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stage(sales_rows(spark, sf_dir), mode="table").df
    return delta_of(rows, sales_prior(rows), SALES.keys, BATCH).select(*SALES_OUTPUT)


# --- claims in 80 columns ---------------------------------------------------------------------

def claim_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The sales tables in the roles of a claims warehouse."""
    t = read_tables(spark, sf_dir)
    lines, suppliers = t["lineitem"], t["supplier"]
    state = "concat('S', CAST(s_nationkey AS STRING))"
    return {
        "fact_line": lines.selectExpr(
            "l_orderkey AS FactClaimTransactionLineWCKey", "nullif(l_linenumber, 7) AS RevisionNumber",
            "l_partkey AS PolicyWCKey", "l_suppkey AS ClaimWCKey",
            "l_linenumber AS ClaimTransactionLineCategoryKey", "l_orderkey AS ClaimTransactionWCKey",
            "nullif(l_suppkey, 1) AS ClaimCheckKey",
            "l_shipdate AS SourceTransactionLineItemCreateDate",
            "year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate)"
            " AS SourceTransactionLineItemCreateDateKey",
            "l_linestatus AS SourceSystem", "l_shipdate AS RecordEffectiveDate",
            "CAST(l_extendedprice AS DECIMAL(18,2)) AS TransactionAmount",
            "l_shipdate AS LoadUpdateDate",
            "CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END AS RetiredInd"),
        "transaction_dim": t["orders"].selectExpr(
            "o_orderkey AS ClaimTransactionWCKey", "o_orderdate AS LoadUpdateDate"),
        "transaction_descriptors": latest_per_key(
            lines, ["l_linenumber", "l_orderkey", "l_suppkey"],
            ["l_shipdate desc", "l_partkey desc", "l_extendedprice desc", "l_quantity desc",
             "l_discount desc"]).selectExpr(
            "l_linenumber AS ClaimTransactionLineCategoryKey", "l_orderkey AS ClaimTransactionWCKey",
            "l_suppkey AS ClaimWCKey", "l_shipdate AS SourceTransactionCreateDate",
            "l_shipdate AS TransactionSubmitDate",
            "CASE WHEN l_returnflag = 'A' THEN 'Payment' WHEN l_returnflag = 'N' THEN 'Incurred'"
            " WHEN l_linestatus = 'O' THEN 'Reserve' ELSE 'Recovery' END AS TransactionType",
            "CASE CAST(round(l_discount * 100) AS INT) WHEN 0 THEN 'Indemnity' WHEN 1 THEN 'Medical'"
            " WHEN 2 THEN 'Expense' WHEN 3 THEN 'EmployerLiability' WHEN 4 THEN 'Legal'"
            " WHEN 5 THEN 'Deductible' WHEN 6 THEN 'Overpayment' WHEN 7 THEN 'Subrogation'"
            " WHEN 8 THEN 'ApportionmentContribution' WHEN 9 THEN 'SecondInjuryFund' END AS LineCategory"),
        "claim_descriptors": suppliers.selectExpr(
            "s_suppkey AS ClaimWCKey",
            f"CASE WHEN s_acctbal > 5000 THEN {state} END AS EmploymentLocationState",
            f"CASE WHEN s_acctbal > 1000 THEN {state} END AS JurisdictionState"),
        "policy_descriptors": t["part"].where("p_size < 45").selectExpr(
            "p_partkey AS PolicyWCKey", "CAST(nullif(p_size, 10) AS BIGINT) AS AgencyKey",
            "CAST(substring(p_brand, 7) AS BIGINT) AS BrandKey"),
        "brand": t["part"].selectExpr("CAST(substring(p_brand, 7) AS BIGINT) AS BrandKey").distinct(),
        "policy_risk_state": lines.join(suppliers, lines.l_suppkey == suppliers.s_suppkey).selectExpr(
            "l_orderkey * 10 + l_linenumber AS PolicyRiskStateWCKey", "l_partkey AS PolicyWCKey",
            f"{state} AS RiskState", "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS RetiredInd",
            "l_shipdate AS RiskStateEffectiveDate", "l_shipdate AS RecordEffectiveDate",
            "l_shipdate AS LoadUpdateDate"),
    }


def claim_prior(rows: DataFrame) -> DataFrame:
    """What an earlier run stored: one hash per key, another one for revision 3, and
    nothing yet for revision 5."""
    found = rows.where("RevisionNumber <> 5").groupBy(*claims.KEYS).agg(F.max("HashValue").alias("h"))
    return found.select(
        *claims.KEYS,
        F.when(F.col("RevisionNumber") == 3, F.concat(F.lit("x"), "h")).otherwise(F.col("h"))
         .alias("HashValue"),
        first_time().alias("LoadCreateDate"))


def claim_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The claim tables with the current risk states written out once, as every share of the rows reads them."""
    tables = claim_tables(spark, sf_dir)
    states = claims.current_risk_states(tables["policy_risk_state"])
    return tables | {"current_risk_state": stage(states, mode="table").df}


def claim_rows(spark: SparkSession, sf_dir: str, bits: int = 256) -> DataFrame:
    tables = claim_sources(spark, sf_dir)
    facts = claims.extract_claim_transactions(tables, START)
    rules = load_rules(rules_frame(spark, claims.sample_rules(), claims.SOURCE_TYPE),
                       claims.SOURCE_TYPE)
    return claims.calculate_measures(facts, tables, rules, replace(claims.JOB, hash_bits=bits))


def staged_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The claim rows written out once, since run and snapshot both read them. Fact, transaction and descriptors
    are joined by the key of the shares, which then goes down to their scans."""
    return stage(claim_rows(spark, sf_dir), mode="table", keys=["ClaimTransactionWCKey"]).df


def claim_measures_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = staged_claims(spark, sf_dir)
    delta = delta_of(rows, claim_prior(rows), claims.KEYS, BATCH)
    return delta.select(*claims.OUTPUT_COLUMNS)


def claim_measures_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same delta against a stored snapshot of slices: the snapshot is not shuffled, and slices
    without a key of the run are not read."""
    rows = staged_claims(spark, sf_dir)
    store = KeyedSnapshots(spark, scratch(spark, "claims"), claims.KEYS)
    store.upsert(claim_prior(rows))
    delta = delta_of(rows, store.prior_of(rows), claims.KEYS, BATCH)
    found = stage(delta.select(*claims.OUTPUT_COLUMNS), mode="table", keys=claims.KEYS, most=4).df
    store.release()
    return found


def claim_measures_first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = claims.run_measures(claim_sources(spark, sf_dir), claims.sample_rules(), None,
                               "1900-01-01", BATCH, hash_bits=256)
    return stage(rows, mode="table", keys=["ClaimTransactionWCKey"]).df


# --- change windows ---------------------------------------------------------------------------

def _changed_lines(spark: SparkSession, sf_dir: str, start, strategy: str) -> DataFrame:
    t = read_tables(spark, sf_dir)
    return changed_since(t["lineitem"], t["orders"], ("l_orderkey", "o_orderkey"), "l_shipdate",
                         "o_orderdate", start, strategy)


def changed_either_side_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changed_lines(spark, sf_dir, START, "or")


def changed_either_side_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changed_lines(spark, sf_dir, START, "union")


def changed_since_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on tables in folders by year and month: the branches of new rows list new folders only."""
    t = read_tables(spark, sf_dir)
    lines, orders = scratch(spark, "lines-by-month"), scratch(spark, "orders-by-month")
    write_partitioned(latest_lines(spark, sf_dir), lines, "l_shipdate", "month")
    write_partitioned(t["orders"].select("o_orderkey", "o_orderdate"), orders, "o_orderdate", "month")
    rows = changed_since(spark.read.parquet(lines), spark.read.parquet(orders), ("l_orderkey", "o_orderkey"), "l_shipdate",
                         "o_orderdate", START, "union", dim_unique=True, assume_unique=True, fact_grain="month", dim_grain="month")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "year", "month")


def full_load_sentinel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changed_lines(spark, sf_dir, "1900-01-01", "auto")


def since_last_run_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = read_tables(spark, sf_dir)
    log = t["orders"].where("o_orderstatus = 'F'")
    return since_last_run(t["lineitem"], log, "l_shipdate", "o_orderdate")


# --- lookups ----------------------------------------------------------------------------------

def star_lookup_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = read_tables(spark, sf_dir)
    return enrich(t["lineitem"].select(*LINE_KEYS, "l_partkey", "l_shipdate"), [
        Lookup("ord", t["orders"], "line.l_orderkey = ord.o_orderkey", "inner",
               take=["o_orderstatus", "o_custkey"]),
        Lookup("cust", t["customer"].where("c_acctbal > 0"), "ord.o_custkey = cust.c_custkey",
               take=["c_mktsegment"], defaults={"c_mktsegment": "UNKNOWN"}),
        Lookup("part", t["part"].where("p_size <= 25"), "line.l_partkey = part.p_partkey",
               take=["p_size"], defaults={"p_size": -1}),
    ], alias="line")


def snowflake_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = read_tables(spark, sf_dir)
    # nation and region are fixed lists; the hint is given only if they are that short.
    return enrich(t["lineitem"].select(*LINE_KEYS, "l_suppkey", "l_extendedprice"), [
        Lookup("supp", t["supplier"].where("s_acctbal > 0"), "line.l_suppkey = supp.s_suppkey",
               take=["s_name"], defaults={"s_name": "UNKNOWN"}),
        Lookup("nat", t["nation"], "supp.s_nationkey = nat.n_nationkey", take=["n_name"],
               defaults={"n_name": "UNKNOWN"}, broadcast_rows=1000),
        Lookup("reg", t["region"], "nat.n_regionkey = reg.r_regionkey", take=["r_name"],
               defaults={"r_name": "UNKNOWN"}, broadcast_rows=1000),
    ], alias="line")


def coalesced_key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = read_tables(spark, sf_dir)
    current = latest_orders(spark, sf_dir).select(
        F.col("o_orderkey").alias("state_key"), F.col("o_custkey").alias("state_cust"),
        F.col("o_orderstatus").alias("state_status"))
    orders = t["orders"].select(
        "o_orderkey", "o_custkey", F.expr("nullif(o_orderstatus, 'P')").alias("own_state"),
        F.expr("CASE WHEN o_orderpriority <> '1-URGENT' THEN 'F' END").alias("other_state"))
    return enrich(orders, [Lookup(
        "state", current, "ord.o_custkey = state.state_cust AND "
        "coalesce(ord.own_state, ord.other_state) = state.state_status",
        take=["state_key"], defaults={"state_key": -1},
        spread=("ord.o_custkey", "state.state_cust"))], alias="ord")


def mismatched_key_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = read_tables(spark, sf_dir)
    text_key = F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("C"), "o_custkey")) \
                .otherwise(F.col("o_custkey").cast("string"))
    orders = t["orders"].select("o_orderkey", text_key.alias("cust_text")) \
                        .withColumn("c_custkey", safe_key("cust_text", "bigint"))
    # A fifth of the keys are NULL: they are dealt over many tasks.
    return enrich(orders, [Lookup("cust", t["customer"].select("c_custkey", "c_name"), ["c_custkey"],
                                  take=["c_name"], defaults={"c_name": "UNKNOWN"},
                                  spread=("c_custkey", "c_custkey"))])


# --- rules ------------------------------------------------------------------------------------

def rule_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = "CAST(l_extendedprice AS DECIMAL(18,2))"
    stored = rules_frame(spark, [
        conditional_measure("PaidOpen", amount, {"l_returnflag": "A", "l_linestatus": "O"}),
        conditional_measure("Paid", amount, {"l_returnflag": "A"}),
        conditional_measure("Returned", amount, {"l_returnflag": "R"}),
        plain_measure("Gross", amount),
        constant_measure("NonSubro"),
    ], "Sales").unionByName(rules_frame(spark, [plain_measure("Ignored", "1/0")], "Other"))
    lines = read_tables(spark, sf_dir)["lineitem"]
    return apply_measures(lines, load_rules(stored, "Sales"),
                          keep=["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
                          strict_names=["Gross", "NonSubro", "Paid", "PaidOpen", "Returned"])


def measure_rule_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules made from the types and categories that occur, as one select list."""
    kinds = read_tables(spark, sf_dir)["lineitem"].groupBy("l_returnflag", "l_linestatus").count()
    rules = kinds.select(
        F.lit("Sales").alias("SourceType"),
        F.concat_ws("_", F.lit("Amount"), "l_returnflag", "l_linestatus").alias("Measure_Name"),
        F.concat(F.lit("CASE WHEN l_returnflag = '"), "l_returnflag",
                 F.lit("' AND l_linestatus = '"), "l_linestatus",
                 F.lit("' THEN l_extendedprice ELSE 0 END")).alias("Logic"))
    return measure_sql(rules, "Sales")


# --- scalars and hashes -----------------------------------------------------------------------

def composite_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_tables(spark, sf_dir)["lineitem"]
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        composite_id("l_orderkey", F.expr("nullif(l_linenumber, 1)")).alias("composite_id"),
        concat_blank("l_orderkey", F.expr("nullif(l_linenumber, 1)")).alias("plain_id"))


def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_tables(spark, sf_dir)["orders"]
    early = F.lit("1995-01-03").cast("timestamp_ntz")
    asked = F.when(F.col("o_orderdate") < early, F.lit("1900-01-01").cast("timestamp_ntz")) \
             .otherwise(F.col("o_orderdate"))
    text = F.when(F.col("o_orderstatus") == "P", F.lit("no date")).otherwise(
        F.substring(F.col("o_orderdate").cast("string"), 1, 10))
    rows = orders.select(
        "o_orderkey", F.expr("nullif(o_orderpriority, '5-LOW')").alias("priority"),
        effective_start(asked).alias("start_time"),
        F.to_date(parse_time(text, "yyyy-MM-dd", strict=False)).alias("parsed_day"),
        F.abs(F.col("o_totalprice").cast("decimal(18,2)") - 250000).alias("distance"),
        safe_key(F.substring("o_orderpriority", 1, 1), "int").alias("priority_no"))
    return with_defaults(rows, {"priority": "none"})


def _hash_lines(spark: SparkSession, sf_dir: str, bits: int, style: str = "hex",
                nulls: str = "skip") -> DataFrame:
    lines = read_tables(spark, sf_dir)["lineitem"].select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
        F.expr("nullif(l_returnflag, 'N')").alias("kind"),
        F.expr("nullif(l_linestatus, 'O')").alias("category"), "l_shipdate")
    return lines.withColumn("HashValue", row_hash(lines, lines.columns, bits, nulls, style))


def row_hash_256(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hash_lines(spark, sf_dir, 256)


def row_hash_marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hash_lines(spark, sf_dir, 256, "0x", "mark")


def row_hash_512(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What can be told of 512-bit hashes without their text: length, style, and whether they
    group the lines as the hashed values do."""
    rows = _hash_lines(spark, sf_dir, 512, "0x")
    values = [c for c in rows.columns if c != "HashValue"]
    by_hash = rows.groupBy("HashValue").agg(F.count("*").alias("copies"), *[F.min(c).alias(c) for c in values])
    return by_hash.select(
        *values, "copies", F.length("HashValue").cast("long").alias("digits"),
        F.col("HashValue").rlike("^0x[0-9A-F]+$").alias("plain"))


# --- change detection -------------------------------------------------------------------------

LINE_RESULT = ["k", "rev", "part", "amount", "kind", "category", "shipped", "HashValue"]


def cdc_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = staged_lines(spark, sf_dir)
    prior = prior_snapshot(stored_lines(rows), ["k", "rev"])
    return classify(rows, prior, ["k", "rev"]).select(*LINE_RESULT, "InsertUpdates", "AuditOperations")


def cdc_classify_512(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on hashes of 512 bits, the production width, without their text."""
    rows = staged_lines(spark, sf_dir, 512)
    prior = prior_snapshot(stored_lines(rows), ["k", "rev"])
    return classify(rows, prior, ["k", "rev"]).select(*LINE_RESULT[:-1], "InsertUpdates", "AuditOperations")


def cdc_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = staged_lines(spark, sf_dir)
    return stamp(only_changes(classify(rows, stored_lines(rows), ["k", "rev"])), BATCH)


def cdc_delta_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = staged_lines(spark, sf_dir)
    recent = stage(rows.where("shipped >= TIMESTAMP_NTZ'2000-06-01'"), mode="table").df
    prior = prune_prior(prior_snapshot(stored_lines(rows), ["k", "rev"]), recent, ["k", "rev"])
    return stamp(only_changes(classify(recent, prior, ["k", "rev"])), BATCH)


def cdc_inserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = staged_lines(spark, sf_dir)
    return only_inserts(rows, stored_lines(rows), ["k", "rev"])


def cdc_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = staged_lines(spark, sf_dir)
    stored = stored_lines(rows).withColumn("LoadUpdateDate", first_time())
    delta = stamp(only_changes(classify(rows, stored, ["k", "rev"])), BATCH).drop(CLASS, LABEL)
    return apply_delta(stored.select(*LINE_RESULT, "LoadUpdateDate", "LoadCreateDate"),
                       delta, ["k", "rev"])


def cdc_upsert_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through stored snapshot versions: first load, delta, next version."""
    rows = staged_lines(spark, sf_dir)
    store = Snapshots(spark, scratch(spark, "snapshot"))
    first = stored_lines(rows).withColumn("LoadUpdateDate", first_time())
    store.commit(first.select(*LINE_RESULT, "LoadUpdateDate", "LoadCreateDate"))
    prior = prior_snapshot(store.read(), ["k", "rev"])
    delta = stamp(only_changes(classify(rows, prior, ["k", "rev"])), BATCH).drop(CLASS, LABEL)
    with stage(delta, mode="persist") as kept:
        upsert(store, kept, ["k", "rev"])
    return store.read()


def cdc_upsert_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through a store of slices, with the delta in two parts: each rewrites its own slices only."""
    rows = staged_lines(spark, sf_dir)
    store = KeyedSnapshots(spark, scratch(spark, "slices"), ["k", "rev"])
    first = stored_lines(rows).withColumn("LoadUpdateDate", first_time())
    store.upsert(first.select(*LINE_RESULT, "LoadUpdateDate", "LoadCreateDate"))
    for odd in (0, 1):
        part = rows.where(F.pmod("k", F.lit(2)) == odd)
        delta = stamp(only_changes(classify(part, store.prior_of(part), ["k", "rev"])), BATCH).drop(CLASS, LABEL)
        with stage(delta, mode="table", keys=["k", "rev"]) as kept:
            store.upsert(kept)
    store.release()
    return store.read()


def cdc_rule_added(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where the run has a measure that the stored version does not know yet."""
    rows = staged_lines(spark, sf_dir)
    store = Snapshots(spark, scratch(spark, "snapshot"))
    first = stored_lines(rows).withColumn("LoadUpdateDate", first_time())
    store.commit(first.select(*LINE_RESULT, "LoadUpdateDate", "LoadCreateDate"))
    grown = rows.withColumn("returned", F.when(F.col("kind") == "R", F.col("amount")))
    prior = prior_snapshot(store.read(), ["k", "rev"])
    delta = stamp(only_changes(classify(grown, prior, ["k", "rev"])), BATCH).drop(CLASS, LABEL)
    with stage(delta, mode="table") as kept:
        upsert(store, kept, ["k", "rev"])
    return store.read()


def incremental_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of the whole job on a growing source, and one with nothing new: the
    stored rows per create and update time, and the log's counts per run."""
    rows = staged_lines(spark, sf_dir)
    root = scratch(spark, "job")
    sources = [rows.where(F.col("shipped") < F.lit("2001-01-01").cast("timestamp_ntz")), rows, rows]
    times = ["2001-01-01 00:00:00", "2002-01-01 00:00:00", "2003-01-01 00:00:00"]
    for source, now in zip(sources, times, strict=True):
        def job(start, prior, source=source, now=now):
            rows = source.where(F.col("shipped") >= time_literal(effective_start(start), TimestampNTZType()))
            if prior is None:
                prior = empty_prior(rows, ["k", "rev"], time_type=TimestampNTZType())
            return delta_of(rows, prior, ["k", "rev"], now)

        run_once(spark, root, "lines", job, ["k", "rev"], now)
    stored = Snapshots(spark, f"{root}/snapshot").read().groupBy("LoadCreateDate", "LoadUpdateDate").agg(
        F.count("*").alias("n"), F.sum("amount").cast("decimal(28,2)").alias("total"))
    log = spark.read.parquet(f"{root}/log").select(
        F.col("StartTime").cast("timestamp_ntz").alias("LoadCreateDate"),
        F.lit(None).cast("timestamp_ntz").alias("LoadUpdateDate"), F.col("RecordsInserted").alias("n"),
        F.col("RecordsUpdated").cast("decimal(28,2)").alias("total"))
    return stored.withColumn("what", F.lit("stored")).unionByName(log.withColumn("what", F.lit("log")))


def cdc_null_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = staged_lines(spark, sf_dir)
    prior = stored_lines(rows, null_hash=True)
    ignored = classify(rows, prior, ["k", "rev"], null_hash="ignore")
    updated = classify(rows, prior, ["k", "rev"], null_hash="update")

    def counts(df: DataFrame, mode: str) -> DataFrame:
        return df.groupBy(F.lit(mode).alias("mode"), "InsertUpdates").agg(F.count("*").alias("n"))

    return stack_rows(counts(ignored, "ignore"), counts(updated, "update"))


# --- quality ----------------------------------------------------------------------------------

def _quality_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with gaps: no key on line 7, no hash on open returned lines, returned
    amounts negative, undiscounted ones zero."""
    return read_tables(spark, sf_dir)["lineitem"].selectExpr(
        "l_orderkey AS k", "nullif(l_linenumber, 7) AS rev",
        "CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN NULL ELSE"
        " sha2(CAST(l_orderkey AS STRING), 256) END AS HashValue",
        "CAST(CASE WHEN l_discount = 0 THEN 0 WHEN l_returnflag = 'R' THEN -l_extendedprice"
        " ELSE l_extendedprice END AS DECIMAL(18,2)) AS amount", "l_shipdate")


def _profile(spark: SparkSession, sf_dir: str, keys=("k", "rev")) -> DataFrame:
    # The mean is cut to four places, so that both engines round alike.
    rows = _quality_rows(spark, sf_dir)
    checks = [*standard_checks(keys, "HashValue", "amount"), Check("big_amounts", "amount > 90000")]
    found = profile(rows, checks, "amount", "l_shipdate",
                    since="l_shipdate >= TIMESTAMP_NTZ'1996-01-01'")
    return found.withColumn("avg_amount", F.round("avg_amount", 2).cast("decimal(18,2)"))


def dq_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profile(spark, sf_dir)


def dq_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate(_profile(spark, sf_dir, keys=("k",)))


def dq_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status(_profile(spark, sf_dir, keys=("k",))).select("total_records", "quality_status")


def dq_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(read_tables(spark, sf_dir)["lineitem"], LINE_KEYS)


def dq_check_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_keys(_quality_rows(spark, sf_dir), ["k", "rev"], ["l_shipdate"])


# --- reconciliation ---------------------------------------------------------------------------

def _two_systems(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The lines as they are, and as a second system kept them: shipments of the
    last half year missing, open lines dearer, accepted ones of another part."""
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_returnflag",
               "CAST(l_extendedprice AS DECIMAL(18,2)) AS amount", "l_shipdate"]
    rows = latest_lines(spark, sf_dir)
    left = rows.where("l_shipdate >= TIMESTAMP_NTZ'1995-06-01'").selectExpr(*columns)
    right = rows.where("l_shipdate < TIMESTAMP_NTZ'2001-06-01'").selectExpr(
        "l_orderkey", "l_linenumber",
        "CASE WHEN l_returnflag = 'A' THEN l_partkey + 1 ELSE l_partkey END AS l_partkey",
        "l_returnflag",
        "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) + CASE WHEN l_linestatus = 'O' AND"
        " l_returnflag <> 'N' THEN 0.01 ELSE 0.00 END AS DECIMAL(18,2)) AS amount", "l_shipdate")
    return left, right


def _reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = _two_systems(spark, sf_dir)
    return reconcile_rows(left, right, LINE_KEYS, ["l_partkey", "l_returnflag", "amount", "l_shipdate"])


def reconcile_totals_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = _two_systems(spark, sf_dir)
    found = reconcile_totals(left, right, "amount", ts="l_shipdate",
                             since=F.lit("1996-01-01").cast("timestamp_ntz"))
    return found.withColumns({c: F.col(c).cast("decimal(28,2)")
                              for c in ("left_sum", "right_sum", "sum_diff")})


def reconcile_rows_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reconciled(spark, sf_dir)


def reconcile_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines, keys repeating, against the latest line per key."""
    return reconcile_rows(read_tables(spark, sf_dir)["lineitem"], latest_lines(spark, sf_dir),
                          LINE_KEYS, ["l_partkey", "l_suppkey", "l_shipdate"])


def reconcile_tree_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that differ, compared only in leaves whose checksums differ."""
    return reconcile_tree(*_two_systems(spark, sf_dir), LINE_KEYS, ["l_partkey", "l_returnflag", "amount", "l_shipdate"])


def match_rate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match_rate(_reconciled(spark, sf_dir))


def reconcile_hash_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = _two_systems(spark, sf_dir)

    def hashed(df: DataFrame) -> DataFrame:
        columns = ["l_partkey", "l_returnflag", "amount", "l_shipdate"]
        return df.select(*LINE_KEYS, row_hash(df, columns, 256).alias("HashValue"))

    return reconcile_hash(hashed(left), hashed(right), LINE_KEYS)


def expectation_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changed lines per type by both window strategies; copies count only once, so a
    type with copies fails against the plain number of lines."""
    t = read_tables(spark, sf_dir)

    def counts(df: DataFrame, test: str) -> DataFrame:
        return df.groupBy(F.lit(test).alias("test"), "l_returnflag").agg(F.count("*").alias("n"))

    columns = ["l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate"]

    def window(strategy: str) -> DataFrame:
        return changed_since(t["lineitem"].select(*columns), t["orders"],
                             ("l_orderkey", "o_orderkey"), "l_shipdate", "o_orderdate", START, strategy)

    actual = stack_rows(counts(window("union"), "strategies"), counts(window("union"), "copies"))
    expected = stack_rows(
        counts(window("or"), "strategies"),
        counts(t["lineitem"].where("l_shipdate >= TIMESTAMP_NTZ'2000-01-01'"), "copies"))
    return expect(actual, expected, ["test", "l_returnflag"], "n")


# --- runs, files, streams ---------------------------------------------------------------------

def run_metrics_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql.types import TimestampNTZType

    return run_metrics(cdc_delta(spark, sf_dir), "sales_measures", "run_1", BATCH,
                       "2024-06-01 12:07:30", time_type=TimestampNTZType())


def run_metrics_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of a run taken while its delta is written, as its log holds them."""
    log = f"{scratch(spark, 'log')}/runs"
    logged_run(spark, log, "sales_measures", "run_1", lambda: cdc_delta(spark, sf_dir), keep=False)
    return spark.read.parquet(log).select("ProcessName", "ExecutionId", "RecordsProcessed", "RecordsInserted",
                                          "RecordsUpdated", "ExecutionStatus", "ErrorMessage")


def duration_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How long each user's events of an hour took."""
    events = read_tables(spark, sf_dir)["events"]
    spans = events.groupBy("user_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")).agg(
        F.min("ts").alias("start_time"), F.max("ts").alias("end_time"))
    return rate_duration(spans, "start_time", "end_time")


def partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written by year and month; later rows come with a new column."""
    orders = read_tables(spark, sf_dir)["orders"]
    path = scratch(spark, "orders")
    late = F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")
    write_partitioned(orders.where(~late), path, "o_orderdate", "month")
    write_partitioned(orders.where(late).withColumn("priority_no", safe_key(
        F.substring("o_orderpriority", 1, 1), "int")), path, "o_orderdate", "month", mode="append")
    return read_merged(spark, path).groupBy("year", "month").agg(
        F.count("*").alias("orders"), F.sum(F.col("o_totalprice").cast("decimal(18,2)"))
        .cast("decimal(28,2)").alias("total"), F.count("priority_no").alias("with_priority"),
        F.min(F.to_date("o_orderdate")).alias("first_day"))


def clustered_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "lines")
    write_clustered(read_tables(spark, sf_dir)["lineitem"], path, LINE_KEYS)
    return spark.read.parquet(path).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                           "l_shipdate")


def zorder_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "zordered")
    write_zordered(read_tables(spark, sf_dir)["lineitem"], path, ["l_partkey", "l_suppkey", "l_shipdate"])
    return spark.read.parquet(path).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")


def stream_cdc_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events through a file stream in several batches, in no special order: the
    stored result is the latest event per user."""
    import datetime as dt

    root = scratch(spark, "stream")
    events = read_tables(spark, sf_dir)["events"]
    events.withColumn("amount", F.col("value").cast("decimal(18,2)")).drop("value").repartition(
        F.pmod(F.xxhash64("event_id"), F.lit(16))).write.parquet(f"{root}/in")
    schema = spark.read.parquet(f"{root}/in").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 4).parquet(f"{root}/in")
    stream_cdc(stream, f"{root}/out", ["user_id"], ["ts", "event_id"],
               ["user_id", "event_id", "ts", "event_type", "amount", "props"],
               batch_time=lambda _: dt.datetime.fromisoformat(BATCH), time_type="timestamp_ntz",
               compact_every=2).awaitTermination()
    return ChangeLog(spark, f"{root}/out", ["user_id"]).current().select(
        "user_id", "event_id", "ts", "event_type", "amount", "props")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "flagship_measures_delta": flagship_measures_delta,
    "claim_measures_delta": claim_measures_delta,
    "claim_measures_pruned": claim_measures_pruned,
    "claim_measures_first_load": claim_measures_first_load,
    "latest_per_key_orders": latest_orders,
    "latest_orders_incremental": latest_orders_incremental,
    "latest_per_key_lines": latest_lines,
    "latest_event_per_user": latest_events,
    "changed_either_side_or": changed_either_side_or,
    "changed_either_side_union": changed_either_side_union,
    "changed_since_partitioned": changed_since_partitioned,
    "full_load_sentinel": full_load_sentinel,
    "since_last_run": since_last_run_lines,
    "star_lookup_defaults": star_lookup_defaults,
    "snowflake_lookup": snowflake_lookup,
    "coalesced_key_lookup": coalesced_key_lookup,
    "mismatched_key_join": mismatched_key_join,
    "rule_measures": rule_measures,
    "measure_rule_text": measure_rule_text,
    "composite_id": composite_ids,
    "scalar_functions": scalar_functions,
    "row_hash_256": row_hash_256,
    "row_hash_marked": row_hash_marked,
    "row_hash_512": row_hash_512,
    "cdc_classify": cdc_classify,
    "cdc_classify_512": cdc_classify_512,
    "cdc_delta": cdc_delta,
    "cdc_delta_pruned": cdc_delta_pruned,
    "cdc_inserts": cdc_inserts,
    "cdc_apply": cdc_apply,
    "cdc_upsert_versions": cdc_upsert_versions,
    "cdc_upsert_sliced": cdc_upsert_sliced,
    "cdc_rule_added": cdc_rule_added,
    "incremental_runs": incremental_runs,
    "cdc_null_hash": cdc_null_hash,
    "dq_profile": dq_profile,
    "dq_gate": dq_gate,
    "dq_status": dq_status,
    "dq_duplicate_keys": dq_duplicate_keys,
    "dq_check_keys": dq_check_keys,
    "reconcile_totals": reconcile_totals_lines,
    "reconcile_rows": reconcile_rows_lines,
    "reconcile_repeated": reconcile_repeated,
    "reconcile_tree": reconcile_tree_lines,
    "match_rate": match_rate_lines,
    "reconcile_hash": reconcile_hash_lines,
    "expectation_table": expectation_table,
    "run_metrics": run_metrics_lines,
    "run_metrics_observed": run_metrics_observed,
    "duration_rating": duration_rating,
    "partitioned_roundtrip": partitioned_roundtrip,
    "clustered_roundtrip": clustered_roundtrip,
    "zorder_roundtrip": zorder_roundtrip,
    "stream_cdc": stream_cdc_events,
}
