"""Measures whose definitions are rows of a table: (SourceType, Measure_Name, Logic)."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RULE_SCHEMA = "SourceType string, Measure_Name string, Logic string"

# Functions whose result is not a function of the row.
_UNSTABLE = (
    "current_date current_timestamp input_file_name localtimestamp monotonically_increasing_id "
    "now rand randn random randstr shuffle spark_partition_id uniform uuid"
).split()


class Rule(NamedTuple):
    name: str
    logic: str


class RuleError(ValueError):
    """A rule that cannot be used; the message names it."""


def conditional_measure(name: str, amount: str, where: Mapping[str, str],
                        otherwise: str = "0") -> Rule:
    """The amount where every column equals its value, else 0."""
    tests = " AND ".join(f"{column} = {_quoted(value)}" for column, value in where.items())
    return Rule(name, f"CASE WHEN {tests} THEN {amount} ELSE {otherwise} END")


def plain_measure(name: str, amount: str) -> Rule:
    """A column taken as it is."""
    return Rule(name, amount)


def constant_measure(name: str, value: object = 0, dtype: str = "DECIMAL(18,2)") -> Rule:
    """The same value on every row."""
    return Rule(name, f"CAST({value} AS {dtype})")


def rules_frame(spark: SparkSession, rules: Iterable[Rule], source_type: str) -> DataFrame:
    """Rules as a stored table holds them."""
    return spark.createDataFrame([(source_type, r.name, r.logic) for r in rules], RULE_SCHEMA)


def load_rules(df: DataFrame, source_type: str, ignore_case: bool = False,
               max_rules: int = 2000) -> list[Rule]:
    """The rules of one source type, ordered by name. Fetched to the driver, as they
    become expressions of the plan; more than ``max_rules`` is an error."""
    match = F.col("SourceType") == F.lit(source_type)
    if ignore_case:
        match = F.lower(F.rtrim("SourceType")) == F.lit(source_type.rstrip().lower())
    found = (df.where(match).select("Measure_Name", "Logic")
               .orderBy("Measure_Name").limit(max_rules + 1).collect())
    if len(found) > max_rules:
        raise RuleError(f"more than {max_rules} rules for {source_type!r}")
    return [Rule(r["Measure_Name"], r["Logic"]) for r in found]


def measure_sql(rules: DataFrame, source_type: str | None = None) -> DataFrame:
    """One row, one column ``measure_sql``: ``logic AS name`` for every rule, in name order."""
    if source_type is not None:
        rules = rules.where(F.col("SourceType") == F.lit(source_type))
    return rules.selectExpr(
        "listagg(coalesce(Logic, '') || ' AS ' || coalesce(Measure_Name, ''), ',')"
        " WITHIN GROUP (ORDER BY Measure_Name) AS measure_sql")


def check_rules(rules: Sequence[Rule], strict_names: Sequence[str] | None = None) -> None:
    """Names legal and unique, each logic text one plain row expression."""
    seen: set[str] = set()
    for rule in rules:
        if not re.fullmatch(r"[A-Za-z_]\w*", rule.name or ""):
            raise RuleError(f"rule {rule.name!r}: not a legal column name")
        if rule.name.lower() in seen:
            raise RuleError(f"rule {rule.name}: defined twice")
        seen.add(rule.name.lower())
        if not (rule.logic or "").strip():
            raise RuleError(f"rule {rule.name}: no logic")
        bare = re.sub(r"'(?:[^'\\]|\\.|'')*'|`[^`]*`|\"[^\"]*\"", " ", rule.logic).lower()
        if not _is_one_expression(bare):
            raise RuleError(f"rule {rule.name}: not one expression")
        if re.search(r"\bselect\b", bare):
            raise RuleError(f"rule {rule.name}: subqueries are not allowed")
        if re.search(r"\bover\s*[(\w]", bare):
            raise RuleError(f"rule {rule.name}: window functions are not allowed")
        called = set(re.findall(r"[a-z_]\w*", bare)) & set(_UNSTABLE)
        if called:
            raise RuleError(f"rule {rule.name}: {sorted(called)[0]} differs between runs")
    if strict_names is not None:
        wanted = {n.lower() for n in strict_names}
        absent = [n for n in strict_names if n.lower() not in seen]
        extra = [r.name for r in rules if r.name.lower() not in wanted]
        if absent or extra:
            raise RuleError(f"rule set differs: missing {absent}, not expected {extra}")


def apply_measures(df: DataFrame, rules: Sequence[Rule], keep: Sequence[str | Column] = ("*",),
                   strict_names: Sequence[str] | None = None) -> DataFrame:
    """The kept columns and one column per rule, in one projection.

    Rule text may use any alias of ``df``. A rule that does not resolve, or that
    aggregates, is reported by name.
    """
    check_rules(rules, strict_names)
    # In brackets, text that brings its own alias or a further clause is refused.
    measures = [F.expr(f"({rule.logic}\n)").alias(rule.name) for rule in rules]
    try:
        return df.select(*keep, *measures)
    except AnalysisException as problem:
        # Find the culprit; only the failing case pays for one analysis per rule.
        for rule, measure in zip(rules, measures):
            try:
                df.select(*keep, measure)
            except AnalysisException as cause:
                raise RuleError(f"rule {rule.name}: {cause.getMessage()}") from cause
        raise problem


def _is_one_expression(bare: str) -> bool:
    # Bracketed, a list of expressions would pass as a struct.
    depth = 0
    for sign in re.findall(r"[(),]", bare):
        depth += (sign == "(") - (sign == ")")
        if depth < 0 or (sign == "," and depth == 0):
            return False
    return depth == 0


def _quoted(value: str) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "''") + "'"
