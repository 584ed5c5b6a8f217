"""Headline timings. Prints one JSON line.

Every query is built and run to the end into a sink that keeps nothing, twice; the
shorter time counts. BENCH_SF_DIR and BENCH_CPUS choose data and cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tidemark.plans import claims, registered  # noqa: E402
from tidemark.plans.measure_job import delta_of  # noqa: E402
from tidemark.session import local_session, scratch  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "latest_per_key_lines", "changed_either_side_or", "changed_either_side_union",
    "full_load_sentinel", "star_lookup_defaults", "snowflake_lookup", "coalesced_key_lookup",
    "rule_measures", "row_hash_512", "cdc_classify", "cdc_delta", "cdc_delta_pruned", "cdc_apply",
    "dq_profile", "dq_check_keys", "reconcile_totals", "reconcile_rows", "partitioned_roundtrip",
    "stream_cdc",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def jobs(spark):
    """Name and callable of each timing; what the callables read is stored beforehand."""
    tables = claims_on_disk(spark)
    stored = scratch(spark, "prior")
    first = claims.run_measures(tables, claims.sample_rules(), None, "1900-01-01",
                                registered.FIRST_BATCH)
    # What the last run left: without the newest lines, and some hashes out of date.
    older = first.where(F.col("RecordEffectiveDate") < F.lit("2001-06-01").cast("timestamp_ntz"))
    older = older.withColumn("HashValue", F.when(F.col("RevisionNumber") == 3, F.lit("0x")).otherwise(
        F.col("HashValue"))).dropDuplicates(list(claims.KEYS))
    older.write.parquet(stored)
    sales = scratch(spark, "prior")
    registered.sales_prior(registered.sales_rows(spark, FOLDER, "1900-01-01")).write.parquet(sales)

    def increment(**options):
        return lambda: run(claims.run_measures(
            tables, claims.sample_rules(), spark.read.parquet(stored), "2001-01-01",
            registered.BATCH, **options))

    yield "flagship_first_load", lambda: run(delta_of(
        registered.sales_rows(spark, FOLDER, "1900-01-01"),
        spark.read.parquet(sales).limit(0), registered.SALES.keys, registered.BATCH))
    yield "flagship_increment", lambda: run(delta_of(
        registered.sales_rows(spark, FOLDER), spark.read.parquet(sales),
        registered.SALES.keys, registered.BATCH))
    yield "claims_first_load", lambda: run(claims.run_measures(
        tables, claims.sample_rules(), None, "1900-01-01", registered.BATCH))
    yield "claims_increment", increment()
    yield "claims_increment_or", increment(strategy="or")
    for name in HEADLINE:
        yield name, lambda query=registered.QUERIES[name]: run(query(spark, FOLDER))


def claims_on_disk(spark):
    """The claim tables as files, so that timings start from scans as a real run does."""
    found = {}
    for name, df in registered.claim_tables(spark, FOLDER).items():
        path = scratch(spark, name)
        df.write.parquet(path)
        found[name] = spark.read.parquet(path)
    return found


def main() -> None:
    spark = local_session("bench", CPUS, spark_sql_shuffle_partitions=CPUS, spark_driver_memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    only = sys.argv[1:]
    timings = {}
    for name, job in jobs(spark):
        if only and name not in only:
            continue
        begin = time.time()
        job()
        first = time.time() - begin
        begin = time.time()
        job()
        timings[name] = round(min(first, time.time() - begin), 3)
        print(f"{name}: first {first:.2f}s, then {timings[name]:.2f}s", file=sys.stderr)
    rows = spark.read.parquet(f"{FOLDER}/lineitem.parquet").count()
    print(json.dumps({
        "metric": "total_time", "value": round(sum(timings.values()), 3), "unit": "sec",
        "timing": "shorter of 2 runs", "queries": timings, "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1], "fact_rows": rows,
        "fact_rows_per_sec": {n: round(rows / timings[n]) for n in timings},
    }))


if __name__ == "__main__":
    main()
