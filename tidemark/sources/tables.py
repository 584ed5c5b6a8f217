"""Reading tables. Everything is lazy; Catalyst prunes columns and pushes filters."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Tables(Mapping):
    """The tables of one folder by name, each opened when first asked for."""

    def __init__(self, spark: SparkSession, folder: str, names: Iterable[str] | None = None,
                 suffix: str = ".parquet"):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._suffix, self._names, self._open = suffix, tuple(names or ()), {}

    def __getitem__(self, name: str) -> DataFrame:
        if self._names and name not in self._names:
            raise KeyError(name)
        if name not in self._open:
            self._open[name] = self.spark.read.parquet(f"{self.folder}/{name}{self._suffix}")
        return self._open[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def read_tables(spark: SparkSession, folder: str, names: Iterable[str] | None = None) -> Tables:
    """Tables stored as ``folder/name.parquet``."""
    return Tables(spark, folder, names)


def read_pair(spark: SparkSession, left: str, right: str) -> tuple[DataFrame, DataFrame]:
    """Two extracts to be reconciled."""
    return spark.read.parquet(left), spark.read.parquet(right)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """A table whose files gained columns over time; absent ones read as NULL."""
    return spark.read.option("mergeSchema", True).parquet(path)


def read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at a path, or None where nothing was written yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def is_first_load(spark: SparkSession, target: str) -> bool:
    """Whether the target, a table name or a path, is absent or empty."""
    if "/" in target:
        stored = read_if_there(spark, target)
    else:
        stored = spark.table(target) if spark.catalog.tableExists(target) else None
    return stored is None or stored.isEmpty()


def load_settings(df: DataFrame, max_rows: int = 10_000) -> dict[str, str]:
    """Key/value settings; the latest value per name if there are several."""
    from tidemark.operators.latest import latest_per_key

    rows = (latest_per_key(df, ["SettingName"], ["LastUpdated desc", "SettingValue desc"])
            .select("SettingName", "SettingValue").limit(max_rows + 1).collect())
    if len(rows) > max_rows:
        raise ValueError(f"more than {max_rows} settings")
    return {r["SettingName"]: r["SettingValue"] for r in rows}


def project_output(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The result in its fixed column order."""
    return df.select(*[F.col(c) for c in columns])
