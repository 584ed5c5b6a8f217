"""Run metrics and the log they are kept in."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import elapsed_seconds, time_literal
from tidemark.operators.changes import CLASS, INSERTED, UPDATED
from tidemark.operators.staging import stage

RUN_SCHEMA = (
    "ProcessName string, ExecutionId string, StartTime timestamp, EndTime timestamp, "
    "RecordsProcessed long, RecordsInserted long, RecordsUpdated long, "
    "ExecutionStatus string, ErrorMessage string"
)


def run_metrics(delta: DataFrame, process: str, execution_id: str, start, end,
                status: str = "SUCCESS", error: str | None = None, time_type=None) -> DataFrame:
    """One row for the run log, counted in one pass over the delta."""
    from pyspark.sql.types import TimestampType

    time_type = time_type or TimestampType()
    return delta.agg(
        F.count("*").alias("RecordsProcessed"),
        F.count_if(F.col(CLASS) == INSERTED).alias("RecordsInserted"),
        F.count_if(F.col(CLASS) == UPDATED).alias("RecordsUpdated"),
    ).select(
        F.lit(process).alias("ProcessName"), F.lit(execution_id).alias("ExecutionId"),
        time_literal(start, time_type).alias("StartTime"),
        time_literal(end, time_type).alias("EndTime"),
        "RecordsProcessed", "RecordsInserted", "RecordsUpdated",
        F.lit(status).alias("ExecutionStatus"),
        F.lit(error).cast("string").alias("ErrorMessage"))


def observed(delta: DataFrame) -> tuple[DataFrame, Observation]:
    """The delta and an observation that counts its rows while they are written, in place of
    another pass over them: RecordsProcessed, RecordsInserted and RecordsUpdated, in ``observation.get``
    after the first action. Only whole actions count: nothing that stops early may read the delta first."""
    counts = Observation(f"run {uuid.uuid4().hex}")
    return delta.observe(
        counts, F.count(F.lit(1)).alias("RecordsProcessed"),
        F.count(F.when(F.col(CLASS) == INSERTED, 1)).alias("RecordsInserted"),
        F.count(F.when(F.col(CLASS) == UPDATED, 1)).alias("RecordsUpdated")), counts


def rate_duration(df: DataFrame, start: str, end: str) -> DataFrame:
    """Adds execution_time_seconds and performance_rating."""
    seconds = F.col("execution_time_seconds")
    return df.withColumn("execution_time_seconds", elapsed_seconds(start, end)).withColumn(
        "performance_rating",
        F.when(seconds <= 300, "EXCELLENT").when(seconds <= 600, "GOOD")
         .when(seconds <= 1200, "ACCEPTABLE").otherwise("NEEDS_OPTIMIZATION"))


def append_run(spark: SparkSession, path: str, record: dict) -> None:
    """Append one row to a run log, an error log or the like."""
    row = {"StartTime": None, "EndTime": None, "ExecutionStatus": "SUCCESS", **record}
    names = [part.strip().split(" ")[0] for part in RUN_SCHEMA.split(",")]
    unknown = set(row) - set(names)
    if unknown:
        raise ValueError(f"no such log columns: {sorted(unknown)}")
    spark.createDataFrame([tuple(row.get(n) for n in names)], RUN_SCHEMA).write.mode(
        "append").parquet(path)


def logged_run(spark: SparkSession, path: str, process: str, execution_id: str, job,
               write=None, start=None, keep: bool = True) -> DataFrame | None:
    """Run ``job()``, which returns a delta, store it, hand it to ``write`` and log the outcome.

    ``start`` defaults to now. The delta is computed once, as a table in the shared folder, and counted while
    it is written. With ``keep`` the table is returned; without, it is deleted at the end. A run is logged as
    a success after its write; a failure of either is logged with its whole message and raised again."""
    start = start or dt.datetime.now(dt.timezone.utc)
    base = {"ProcessName": process, "ExecutionId": execution_id, "StartTime": start}
    kept = None
    try:
        rows, counts = observed(job())
        kept = stage(rows, mode="table")
        if write:
            write(kept.df)
        counted = counts.get
    except Exception as problem:
        append_run(spark, path, {**base, "EndTime": dt.datetime.now(dt.timezone.utc),
                                 "ExecutionStatus": "FAILED", "ErrorMessage": str(problem)})
        if kept is not None:
            kept.release()
        raise
    append_run(spark, path, {
        **base, "EndTime": dt.datetime.now(dt.timezone.utc),
        **{n: counted[n] for n in ("RecordsProcessed", "RecordsInserted", "RecordsUpdated")}})
    if not keep:
        kept.release()
        return None
    return kept.df
