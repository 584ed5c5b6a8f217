"""Claim transaction measures: the 80-column delta of a claims warehouse.

Tables, by role: ``fact_line``, ``transaction_dim``, ``transaction_descriptors``,
``claim_descriptors``, ``policy_descriptors``, ``brand``, ``policy_risk_state``. The result of
``current_risk_states`` may be given as ``current_risk_state``, where it is stored already.
Rule text refers to them by the aliases in ``ALIASES``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.scalars import check_range, composite_id, effective_start
from tidemark.operators.changes import empty_prior, prior_snapshot
from tidemark.operators.latest import latest_per_key
from tidemark.operators.lookup import Lookup
from tidemark.operators.rules import (
    Rule,
    conditional_measure,
    constant_measure,
    load_rules,
    plain_measure,
)
from tidemark.operators.staging import stage
from tidemark.operators.window import changed_since
from tidemark.plans.measure_job import MeasureJob, delta_of, measured_rows
from tidemark.sources.keyed import KeyedSnapshots
from tidemark.sources.tables import project_output

# The source type of the rules, and the aliases rule text may use.
SOURCE_TYPE = "Claims"
ALIASES = {
    "fact_line": "FactClaimTransactionLineWC",
    "transaction_descriptors": "ClaimTransactionDescriptors",
    "claim_descriptors": "ClaimDescriptors",
    "policy_descriptors": "polAgcy",
    "brand": "BK",
    "policy_risk_state": "rskState",
}

# The key columns of the result.
KEYS = ("FactClaimTransactionLineWCKey", "RevisionNumber")

# The fact columns that are read.
FACT_COLUMNS = tuple("""
FactClaimTransactionLineWCKey RevisionNumber PolicyWCKey ClaimWCKey
ClaimTransactionLineCategoryKey ClaimTransactionWCKey ClaimCheckKey
SourceTransactionLineItemCreateDate SourceTransactionLineItemCreateDateKey
SourceSystem RecordEffectiveDate TransactionAmount LoadUpdateDate RetiredInd
""".split())

# The 80 columns of the result, in order.
OUTPUT_COLUMNS = tuple("""
FactClaimTransactionLineWCKey RevisionNumber PolicyWCKey PolicyRiskStateWCKey ClaimWCKey
ClaimTransactionLineCategoryKey ClaimTransactionWCKey ClaimCheckKey AgencyKey
SourceClaimTransactionCreateDate SourceClaimTransactionCreateDateKey
TransactionCreateDate TransactionSubmitDate SourceSystem RecordEffectiveDate
SourceSystemIdentifier
GrossIncurredEmployerLiability GrossIncurredExpense GrossIncurredIndemnity GrossIncurredLegal
GrossIncurredLoss GrossIncurredLossAndExpense GrossIncurredMedical
GrossPaidEmployerLiability GrossPaidExpense GrossPaidIndemnity GrossPaidLegal
GrossPaidLoss GrossPaidLossAndExpense GrossPaidMedical
NetIncurredEmployerLiability NetIncurredExpense NetIncurredIndemnity NetIncurredLegal
NetIncurredLoss NetIncurredLossAndExpense NetIncurredMedical
NetPaidEmployerLiability NetPaidExpense NetPaidIndemnity NetPaidLegal
NetPaidLoss NetPaidLossAndExpense NetPaidMedical
RecoveryApportionmentContribution RecoveryDeductible RecoveryEmployerLiability RecoveryExpense
RecoveryIndemnity RecoveryLegal RecoveryLoss RecoveryLossAndExpense RecoveryMedical
RecoveryOverpayment RecoverySecondInjuryFund RecoverySubrogation
ReservesEmployerLiability ReservesExpense ReservesIndemnity ReservesLegal
ReservesLoss ReservesLossAndExpense ReservesMedical
RecoveryNonSubroNonSecondInjuryFundEmployerLiability RecoveryNonSubroNonSecondInjuryFundExpense
RecoveryNonSubroNonSecondInjuryFundIndemnity RecoveryNonSubroNonSecondInjuryFundLegal
RecoveryNonSubroNonSecondInjuryFundMedical
TransactionAmount
RecoveryDeductibleEmployerLiability RecoveryDeductibleExpense RecoveryDeductibleIndemnity
RecoveryDeductibleMedical RecoveryDeductibleLegal
HashValue RetiredInd InsertUpdates AuditOperations LoadUpdateDate LoadCreateDate
""".split())

# The 74 hashed columns, in order. RecordEffectiveDate is not one of them.
HASH_COLUMNS = tuple("""
FactClaimTransactionLineWCKey RevisionNumber PolicyWCKey PolicyRiskStateWCKey ClaimWCKey
ClaimTransactionLineCategoryKey ClaimTransactionWCKey ClaimCheckKey AgencyKey
SourceClaimTransactionCreateDate SourceClaimTransactionCreateDateKey
TransactionCreateDate TransactionSubmitDate
NetPaidIndemnity NetPaidMedical NetPaidExpense NetPaidEmployerLiability NetPaidLegal
NetPaidLoss NetPaidLossAndExpense
NetIncurredIndemnity NetIncurredMedical NetIncurredExpense NetIncurredEmployerLiability
NetIncurredLegal NetIncurredLoss NetIncurredLossAndExpense
ReservesIndemnity ReservesMedical ReservesExpense ReservesEmployerLiability ReservesLegal
ReservesLoss ReservesLossAndExpense
GrossPaidIndemnity GrossPaidMedical GrossPaidExpense GrossPaidEmployerLiability GrossPaidLegal
GrossPaidLoss GrossPaidLossAndExpense
GrossIncurredIndemnity GrossIncurredMedical GrossIncurredExpense GrossIncurredEmployerLiability
GrossIncurredLegal GrossIncurredLoss GrossIncurredLossAndExpense
RecoveryIndemnity RecoveryMedical RecoveryExpense RecoveryEmployerLiability RecoveryLegal
RecoveryDeductible RecoveryOverpayment RecoverySubrogation RecoveryApportionmentContribution
RecoverySecondInjuryFund RecoveryLoss RecoveryLossAndExpense
RecoveryNonSubroNonSecondInjuryFundEmployerLiability RecoveryNonSubroNonSecondInjuryFundExpense
RecoveryNonSubroNonSecondInjuryFundIndemnity RecoveryNonSubroNonSecondInjuryFundLegal
RecoveryNonSubroNonSecondInjuryFundMedical
SourceSystem SourceSystemIdentifier TransactionAmount
RecoveryDeductibleEmployerLiability RecoveryDeductibleExpense RecoveryDeductibleIndemnity
RecoveryDeductibleMedical RecoveryDeductibleLegal
RetiredInd
""".split())

_FACT = ALIASES["fact_line"]
_AMOUNT = f"{_FACT}.TransactionAmount"

JOB = MeasureJob(
    fact_alias=_FACT,
    keys=KEYS,
    attributes=(
        ("FactClaimTransactionLineWCKey", f"{_FACT}.FactClaimTransactionLineWCKey"),
        # A missing revision is 0 here; the composite id was built from the raw value.
        ("RevisionNumber", f"coalesce({_FACT}.RevisionNumber, 0)"),
        ("PolicyWCKey", f"{_FACT}.PolicyWCKey"),
        ("PolicyRiskStateWCKey", "coalesce(rskState.PolicyRiskStateWCKey, -1)"),
        ("ClaimWCKey", f"{_FACT}.ClaimWCKey"),
        ("ClaimTransactionLineCategoryKey", f"{_FACT}.ClaimTransactionLineCategoryKey"),
        ("ClaimTransactionWCKey", f"{_FACT}.ClaimTransactionWCKey"),
        ("ClaimCheckKey", f"{_FACT}.ClaimCheckKey"),
        ("AgencyKey", "coalesce(polAgcy.AgencyKey, -1)"),
        ("SourceClaimTransactionCreateDate", f"{_FACT}.SourceTransactionLineItemCreateDate"),
        ("SourceClaimTransactionCreateDateKey", f"{_FACT}.SourceTransactionLineItemCreateDateKey"),
        ("TransactionCreateDate", "ClaimTransactionDescriptors.SourceTransactionCreateDate"),
        ("TransactionSubmitDate", "ClaimTransactionDescriptors.TransactionSubmitDate"),
        ("SourceSystem", f"{_FACT}.SourceSystem"),
        ("RecordEffectiveDate", f"{_FACT}.RecordEffectiveDate"),
        ("SourceSystemIdentifier", f"{_FACT}.SourceSystemIdentifier"),
        ("TransactionAmount", _AMOUNT),
        ("RetiredInd", f"{_FACT}.RetiredInd"),
    ),
    hash_columns=HASH_COLUMNS,
    hash_style="0x",
)

# The measures are the hashed columns that are not attributes.
MEASURES = tuple(c for c in HASH_COLUMNS if c not in dict(JOB.attributes))


def sample_rules() -> list[Rule]:
    """A sample set with the 57 measure names. The texts of a production rule table
    are not public; these follow the published examples of them."""
    # Line categories, and the transaction type of each family.
    categories = ("Indemnity", "Medical", "Expense", "EmployerLiability", "Legal")
    recoveries = (*categories, "Deductible", "Overpayment", "Subrogation",
                  "ApportionmentContribution", "SecondInjuryFund")
    by_type = {"NetPaid": "Payment", "NetIncurred": "Incurred", "Reserves": "Reserve",
               "Recovery": "Recovery"}
    kind = "ClaimTransactionDescriptors.TransactionType"
    category = "ClaimTransactionDescriptors.LineCategory"

    rules = []
    for family, value in by_type.items():
        for name in recoveries if family == "Recovery" else categories:
            rules.append(conditional_measure(family + name, _AMOUNT, {kind: value, category: name}))
        for name in ("Loss", "LossAndExpense"):
            rules.append(conditional_measure(family + name, _AMOUNT, {kind: value}))
    for family in ("GrossPaid", "GrossIncurred"):
        rules += [plain_measure(family + name, _AMOUNT)
                  for name in (*categories, "Loss", "LossAndExpense")]
    for family in ("RecoveryNonSubroNonSecondInjuryFund", "RecoveryDeductible"):
        rules += [constant_measure(family + name) for name in categories]
    return sorted(rules)


def extract_claim_transactions(tables: Mapping[str, DataFrame], start, end=None,
                               strategy: str = "auto", assume_unique: bool = False,
                               dim_unique: bool = False) -> DataFrame:
    """Fact lines changed since ``start``, on the line or on its transaction, with the
    composite id. ``end`` is checked against ``start`` but bounds nothing."""
    check_range(effective_start(start), end)
    fact = tables["fact_line"].select(*FACT_COLUMNS)
    changed = changed_since(fact, tables["transaction_dim"], "ClaimTransactionWCKey",
                            "LoadUpdateDate", "LoadUpdateDate", start, strategy,
                            dim_unique=dim_unique, assume_unique=assume_unique)
    return changed.withColumn("SourceSystemIdentifier", composite_id(*KEYS))


def current_risk_states(states: DataFrame) -> DataFrame:
    """The current row per policy and state, retired rows left out."""
    return latest_per_key(
        states, ["PolicyWCKey", "RiskState"],
        ["RetiredInd", "RiskStateEffectiveDate desc", "RecordEffectiveDate desc",
         "LoadUpdateDate desc", "PolicyRiskStateWCKey desc"],
        where="RetiredInd = 0")


def lookups(tables: Mapping[str, DataFrame]) -> list[Lookup]:
    """The star around the fact; inner joins first, as they drop rows."""
    states = tables["current_risk_state"] if "current_risk_state" in tables else current_risk_states(tables["policy_risk_state"])
    found = [
        Lookup("ClaimTransactionDescriptors", tables["transaction_descriptors"],
               ["ClaimTransactionLineCategoryKey", "ClaimTransactionWCKey", "ClaimWCKey"], "inner"),
        Lookup("ClaimDescriptors", tables["claim_descriptors"], ["ClaimWCKey"], "inner"),
        Lookup("polAgcy", tables["policy_descriptors"], ["PolicyWCKey"]),
    ]
    if "brand" in tables:
        found.append(Lookup("BK", tables["brand"], "polAgcy.BrandKey = BK.BrandKey"))
    found.append(Lookup(
        "rskState", states,
        f"{_FACT}.PolicyWCKey = rskState.PolicyWCKey AND coalesce("
        "ClaimDescriptors.EmploymentLocationState, ClaimDescriptors.JurisdictionState)"
        " = rskState.RiskState",
        spread=(f"{_FACT}.PolicyWCKey", "rskState.PolicyWCKey")))
    return found


def calculate_measures(facts: DataFrame, tables: Mapping[str, DataFrame], rules: Sequence[Rule],
                       job: MeasureJob = JOB, strict: bool = True) -> DataFrame:
    """Attributes, measures and hash of extracted fact lines."""
    return measured_rows(facts, lookups(tables), rules, job, MEASURES if strict else None)


def run_measures(tables: Mapping[str, DataFrame], rules: DataFrame | Sequence[Rule],
                 prior: DataFrame | KeyedSnapshots | None, start, batch_ts, end=None, strict: bool = True,
                 hash_bits: int = 512, hash_style: str = "0x", null_hash: str = "ignore",
                 strategy: str = "auto", assume_unique: bool = False, dim_unique: bool = False) -> DataFrame:
    """The delta of one run: inserted and updated rows in 80 columns.

    ``prior`` is the stored table, or None for the first load. Of a store of slices only those with keys of
    the changed rows are read, and only these rows are shuffled; they are written out first, as the slices
    depend on them. ``dim_unique``: the transaction dimension holds each key once. Applying the delta
    is a separate step (``tidemark.sources.upsert``). With strict=False measures
    beyond the 57 are hashed too and follow the fixed columns.
    """
    if isinstance(rules, DataFrame):
        rules = load_rules(rules, SOURCE_TYPE)
    job = replace(JOB, hash_bits=hash_bits, hash_style=hash_style)
    facts = extract_claim_transactions(tables, start, end, strategy, assume_unique, dim_unique)
    rows = calculate_measures(facts, tables, rules, job, strict)
    time_type = tables["fact_line"].schema["LoadUpdateDate"].dataType
    if isinstance(prior, KeyedSnapshots):
        rows = stage(rows, mode="table").df
        prior = prior.prior_of(rows)
    stored = (empty_prior(rows, KEYS, time_type=time_type) if prior is None
              else prior_snapshot(prior, KEYS))
    delta = delta_of(rows, stored, KEYS, batch_ts, null_hash, assume_unique)
    extra = [c for c in job.hashed_columns(rules) if c not in HASH_COLUMNS]
    return project_output(delta, [*OUTPUT_COLUMNS, *extra])


def register_sql(spark: SparkSession, tables: Mapping[str, DataFrame]) -> None:
    """The extraction as a SQL table function:
    ``SELECT * FROM extract_claim_transactions(TIMESTAMP_NTZ'2024-01-01')``."""
    tables["fact_line"].select(*FACT_COLUMNS).createOrReplaceTempView("claim_fact_line")
    tables["transaction_dim"].createOrReplaceTempView("claim_transaction_dim")
    columns = ", ".join(f"f.{c}" for c in FACT_COLUMNS)
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}"
                      for f in tables["fact_line"].select(*FACT_COLUMNS).schema.fields)
    time_type = tables["fact_line"].schema["LoadUpdateDate"].dataType.simpleString()
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION extract_claim_transactions(start_time {time_type})
        RETURNS TABLE ({types}, SourceSystemIdentifier STRING)
        RETURN SELECT DISTINCT {columns},
                      concat_ws('~', f.FactClaimTransactionLineWCKey, f.RevisionNumber)
        FROM claim_fact_line f
        JOIN claim_transaction_dim t ON f.ClaimTransactionWCKey = t.ClaimTransactionWCKey
        WHERE f.LoadUpdateDate >= extract_claim_transactions.start_time
           OR t.LoadUpdateDate >= extract_claim_transactions.start_time""")
