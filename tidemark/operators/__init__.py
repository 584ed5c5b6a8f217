from tidemark.operators.changes import (
    apply_delta,
    classify,
    empty_prior,
    only_changes,
    only_inserts,
    prior_snapshot,
    prune_prior,
    stamp,
)
from tidemark.operators.latest import dedupe, latest_per_key
from tidemark.operators.lookup import Lookup, broadcast_if_fits, enrich, lookup_columns, star_join, used_lookups
from tidemark.operators.metrics import append_run, logged_run, observed, rate_duration, run_metrics
from tidemark.operators.quality import (
    Check,
    check_keys,
    duplicate_keys,
    fail_if,
    gate,
    profile,
    standard_checks,
    status,
)
from tidemark.operators.recon import (
    checksums,
    differing_leaves,
    expect,
    match_rate,
    reconcile_hash,
    reconcile_rows,
    reconcile_totals,
    reconcile_tree,
    stack_rows,
)
from tidemark.operators.rules import (
    Rule,
    RuleError,
    apply_measures,
    conditional_measure,
    constant_measure,
    load_rules,
    measure_sql,
    plain_measure,
    rules_frame,
)
from tidemark.operators.staging import Stage, stage
from tidemark.operators.window import changed_since, high_water_mark, since_last_run

__all__ = [
    "Check", "Lookup", "Rule", "RuleError", "Stage", "append_run", "apply_delta", "apply_measures",
    "broadcast_if_fits", "changed_since", "check_keys", "checksums", "classify", "conditional_measure",
    "constant_measure", "dedupe", "differing_leaves", "duplicate_keys", "empty_prior", "enrich", "expect", "fail_if",
    "gate", "high_water_mark", "latest_per_key", "load_rules", "logged_run", "lookup_columns",
    "match_rate", "measure_sql", "only_changes", "only_inserts", "plain_measure", "prior_snapshot",
    "profile", "prune_prior", "rate_duration", "reconcile_hash", "reconcile_rows",
    "observed", "reconcile_totals", "reconcile_tree", "rules_frame", "run_metrics", "since_last_run", "stack_rows", "stage",
    "stamp", "standard_checks", "star_join", "status", "used_lookups",
]
