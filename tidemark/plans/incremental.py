"""One run of a stored job, from the mark of the last run to the log of this one."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import FULL_LOAD_REQUEST, as_datetime, run_id
from tidemark.operators.changes import CLASS, LABEL, prior_snapshot
from tidemark.operators.metrics import logged_run
from tidemark.operators.window import high_water_mark
from tidemark.sources.keyed import KeyedSnapshots
from tidemark.sources.snapshots import Snapshots, upsert
from tidemark.sources.tables import read_if_there


class QualityError(RuntimeError):
    """A delta that the quality gate refuses. Nothing of it is stored."""


def run_once(spark: SparkSession, root: str, process: str, job: Callable[[object, DataFrame | None], DataFrame],
             keys: Sequence[str], batch_ts, passes: Callable[[DataFrame], bool] | None = None,
             store: KeyedSnapshots | None = None) -> str:
    """Run ``job(start, prior)``, gate its delta, upsert it and log the run; its id.

    The start is the batch time of the last successful run in ``root``/log, or the request for a full
    load while nothing is stored. ``prior`` is the stored snapshot in ``root``/snapshot, or None. The delta
    is computed once, as a table. ``passes`` looks at it before it is stored; by default
    no key may be NULL or come twice. A run that fails leaves snapshot and mark as they were.

    With a ``store`` of slices that one takes the place of ``root``/snapshot, and the job gets the store itself
    as ``prior``, to read the slices its rows need (``store.prior_of``).
    """
    sliced = store is not None
    store = store if sliced else Snapshots(spark, f"{root}/snapshot")
    stored, log = store.read(), read_if_there(spark, f"{root}/log")
    if stored is None or log is None:
        start = FULL_LOAD_REQUEST
    else:
        start = high_water_mark(log.where((F.col("ProcessName") == process) & (
            F.col("ExecutionStatus") == "SUCCESS")), "StartTime")
    name = run_id(process)

    def delta() -> DataFrame:
        return job(start, None if stored is None else store if sliced else prior_snapshot(stored, keys))

    def write(rows: DataFrame) -> None:
        if not (passes or _sound(keys))(rows):
            raise QualityError(f"{process}: the delta of {name} does not pass")
        if stored is None or not rows.isEmpty():
            fresh = rows.drop(CLASS, LABEL)
            store.upsert(fresh, run=name) if sliced else upsert(store, fresh, keys, run=name)

    logged_run(spark, f"{root}/log", process, name, delta, write, start=as_datetime(batch_ts), keep=False)
    if sliced:
        store.release()
    return name


def _sound(keys: Sequence[str]) -> Callable[[DataFrame], bool]:
    def passes(rows: DataFrame) -> bool:
        missing = F.lit(False)
        for k in keys:
            missing = missing | F.col(k).isNull()
        twice = rows.groupBy(*keys).count().where(F.col("count") > 1)
        return rows.where(missing).isEmpty() and twice.isEmpty()

    return passes
