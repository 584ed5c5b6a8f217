"""The registered queries as plain SQL, for checking results on another engine."""

from __future__ import annotations

from tidemark.plans import claims

_DEC = "DECIMAL(18,2)"


def _text_of(expression: str, kind: str) -> str:
    """Hash text of a value: d for decimals, t for times, else its plain text."""
    if kind == "d":
        return f"CAST(CAST({expression} AS {_DEC}) AS VARCHAR)"
    if kind == "t":
        return f"strftime({expression}, '%Y-%m-%d %H:%M:%S.%f')"
    return f"CAST({expression} AS VARCHAR)"


LATEST_LINES = """
latest_lines AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST,
               l_extendedprice DESC NULLS LAST, l_quantity DESC NULLS LAST) AS rn
    FROM lineitem) WHERE rn = 1)"""

LATEST_ORDERS = """
latest_orders AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus
      ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC NULLS LAST) AS rn
    FROM orders WHERE o_orderpriority <> '5-LOW') WHERE rn = 1)"""

_SALES_HASH = " || '~' || ".join([
    "CAST(k AS VARCHAR)", "CAST(rev AS VARCHAR)", "CAST(rsk AS VARCHAR)", "CAST(agency AS VARCHAR)",
    "CAST(m1 AS VARCHAR)", "CAST(m2 AS VARCHAR)", "CAST(amount AS VARCHAR)", "returnflag", "linestatus"])

FLAGSHIP_ROWS = f"""
WITH {LATEST_LINES}, {LATEST_ORDERS},
facts AS (
  SELECT DISTINCT l.* FROM latest_lines l JOIN orders o ON l.l_orderkey = o.o_orderkey
  WHERE l.l_shipdate >= TIMESTAMP '2000-01-01' OR o.o_orderdate >= TIMESTAMP '2000-01-01'),
main AS (
  SELECT DISTINCT l.l_orderkey AS k, l.l_linenumber AS rev, coalesce(s.o_orderkey, -1) AS rsk,
         coalesce(p.p_size, -1) AS agency, CAST(l.l_extendedprice AS {_DEC}) AS amount,
         CAST(CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN CAST(l.l_extendedprice AS {_DEC})
              ELSE 0 END AS {_DEC}) AS m1,
         CAST(CASE WHEN l_returnflag = 'A' THEN CAST(l.l_extendedprice AS {_DEC}) ELSE 0 END AS {_DEC}) AS m2,
         l_returnflag AS returnflag, l_linestatus AS linestatus
  FROM facts l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN latest_orders s ON o.o_custkey = s.o_custkey
       AND coalesce(nullif(o.o_orderstatus, 'P'), 'F') = s.o_orderstatus),
hashed AS (SELECT *, sha256({_SALES_HASH}) AS HashValue FROM main),
prior AS (
  SELECT k, rev, CASE WHEN k % 10 = 1 THEN 'x' || HashValue ELSE HashValue END AS HashValue,
         TIMESTAMP '2020-01-01' AS LoadCreateDate
  FROM hashed WHERE k % 10 <> 0)
"""

FLAGSHIP = f"""{FLAGSHIP_ROWS}
SELECT DISTINCT c.k, c.rev, c.rsk, c.agency, c.m1, c.m2, c.amount, c.returnflag, c.linestatus, c.HashValue,
  CASE WHEN p.k IS NULL THEN 1 WHEN c.HashValue <> p.HashValue THEN 0 ELSE 3 END AS InsertUpdates,
  CASE WHEN p.k IS NULL THEN 'Inserted' WHEN c.HashValue <> p.HashValue THEN 'Updated' END AS AuditOperations,
  TIMESTAMP '2024-06-01 12:00:00' AS LoadUpdateDate,
  coalesce(p.LoadCreateDate, TIMESTAMP '2024-06-01 12:00:00') AS LoadCreateDate
FROM hashed c LEFT JOIN prior p ON c.k = p.k AND c.rev = p.rev
WHERE p.k IS NULL OR c.HashValue <> p.HashValue
"""


# --- claims -----------------------------------------------------------------------------------

_TIMES = {"SourceClaimTransactionCreateDate", "TransactionCreateDate", "TransactionSubmitDate"}


def _claims(start: str, first_load: bool) -> str:
    attributes = [name for name, _ in claims.JOB.attributes]
    selected = ",\n".join(f"  {sql} AS {name}" for name, sql in claims.JOB.attributes)
    measures = ",\n".join(f"  CAST({r.logic} AS {_DEC}) AS {r.name}" for r in claims.sample_rules())
    kinds = {c: "d" for c in (*claims.MEASURES, "TransactionAmount")} | {c: "t" for c in _TIMES}
    hashed = ", ".join(_text_of(c, kinds.get(c, "s")) for c in claims.HASH_COLUMNS)
    output = ", ".join(f"c.{c}" for c in claims.OUTPUT_COLUMNS
                       if c in attributes or c in claims.MEASURES or c == "HashValue")
    prior = """SELECT CAST(NULL AS BIGINT) AS k, CAST(NULL AS INT) AS rev, '' AS HashValue,
      TIMESTAMP '2020-01-01' AS LoadCreateDate WHERE false""" if first_load else """
      SELECT FactClaimTransactionLineWCKey AS k, RevisionNumber AS rev,
             CASE WHEN RevisionNumber = 3 THEN 'x' || max(HashValue) ELSE max(HashValue) END AS HashValue,
             TIMESTAMP '2020-01-01' AS LoadCreateDate
      FROM hashed WHERE RevisionNumber <> 5 GROUP BY 1, 2"""
    return f"""
WITH fact AS (
  SELECT l_orderkey AS FactClaimTransactionLineWCKey, nullif(l_linenumber, 7) AS RevisionNumber,
    l_partkey AS PolicyWCKey, l_suppkey AS ClaimWCKey, l_linenumber AS ClaimTransactionLineCategoryKey,
    l_orderkey AS ClaimTransactionWCKey, nullif(l_suppkey, 1) AS ClaimCheckKey,
    l_shipdate AS SourceTransactionLineItemCreateDate,
    CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS INT)
      AS SourceTransactionLineItemCreateDateKey,
    l_linestatus AS SourceSystem, l_shipdate AS RecordEffectiveDate,
    CAST(l_extendedprice AS {_DEC}) AS TransactionAmount, l_shipdate AS LoadUpdateDate,
    CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END AS RetiredInd
  FROM lineitem),
FactClaimTransactionLineWC AS (
  SELECT DISTINCT f.*, concat_ws('~', f.FactClaimTransactionLineWCKey, f.RevisionNumber) AS SourceSystemIdentifier
  FROM fact f JOIN orders o ON f.ClaimTransactionWCKey = o.o_orderkey
  WHERE f.LoadUpdateDate >= TIMESTAMP '{start}' OR o.o_orderdate >= TIMESTAMP '{start}'),
ClaimTransactionDescriptors AS (
  SELECT l_linenumber AS ClaimTransactionLineCategoryKey, l_orderkey AS ClaimTransactionWCKey,
    l_suppkey AS ClaimWCKey, l_shipdate AS SourceTransactionCreateDate, l_shipdate AS TransactionSubmitDate,
    CASE WHEN l_returnflag = 'A' THEN 'Payment' WHEN l_returnflag = 'N' THEN 'Incurred'
         WHEN l_linestatus = 'O' THEN 'Reserve' ELSE 'Recovery' END AS TransactionType,
    CASE CAST(round(l_discount * 100) AS INT) WHEN 0 THEN 'Indemnity' WHEN 1 THEN 'Medical'
      WHEN 2 THEN 'Expense' WHEN 3 THEN 'EmployerLiability' WHEN 4 THEN 'Legal' WHEN 5 THEN 'Deductible'
      WHEN 6 THEN 'Overpayment' WHEN 7 THEN 'Subrogation' WHEN 8 THEN 'ApportionmentContribution'
      WHEN 9 THEN 'SecondInjuryFund' END AS LineCategory
  FROM (SELECT *, row_number() OVER (PARTITION BY l_linenumber, l_orderkey, l_suppkey
          ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_extendedprice DESC NULLS LAST,
                   l_quantity DESC NULLS LAST, l_discount DESC NULLS LAST) AS rn FROM lineitem)
  WHERE rn = 1),
ClaimDescriptors AS (
  SELECT s_suppkey AS ClaimWCKey, CASE WHEN s_acctbal > 5000 THEN 'S' || s_nationkey END AS EmploymentLocationState,
    CASE WHEN s_acctbal > 1000 THEN 'S' || s_nationkey END AS JurisdictionState FROM supplier),
polAgcy AS (
  SELECT p_partkey AS PolicyWCKey, CAST(nullif(p_size, 10) AS BIGINT) AS AgencyKey FROM part WHERE p_size < 45),
rskState AS (
  SELECT * FROM (
    SELECT l_orderkey * 10 + l_linenumber AS PolicyRiskStateWCKey, l_partkey AS PolicyWCKey,
      'S' || s_nationkey AS RiskState,
      row_number() OVER (PARTITION BY l_partkey, s_nationkey
        ORDER BY l_shipdate DESC NULLS LAST, l_orderkey * 10 + l_linenumber DESC NULLS LAST) AS rn
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_returnflag <> 'R') WHERE rn = 1),
main AS (
  SELECT DISTINCT
{selected},
{measures}
  FROM FactClaimTransactionLineWC
  JOIN ClaimTransactionDescriptors USING (ClaimTransactionLineCategoryKey, ClaimTransactionWCKey, ClaimWCKey)
  JOIN ClaimDescriptors ON FactClaimTransactionLineWC.ClaimWCKey = ClaimDescriptors.ClaimWCKey
  LEFT JOIN polAgcy ON FactClaimTransactionLineWC.PolicyWCKey = polAgcy.PolicyWCKey
  LEFT JOIN rskState ON FactClaimTransactionLineWC.PolicyWCKey = rskState.PolicyWCKey
    AND coalesce(ClaimDescriptors.EmploymentLocationState, ClaimDescriptors.JurisdictionState) = rskState.RiskState),
hashed AS (SELECT *, '0x' || upper(sha256(concat_ws('~', {hashed}))) AS HashValue FROM main),
prior AS ({prior})
SELECT DISTINCT {output},
  CASE WHEN p.k IS NULL THEN 1 WHEN c.HashValue <> p.HashValue THEN 0 ELSE 3 END AS InsertUpdates,
  CASE WHEN p.k IS NULL THEN 'Inserted' WHEN c.HashValue <> p.HashValue THEN 'Updated' END AS AuditOperations,
  TIMESTAMP '2024-06-01 12:00:00' AS LoadUpdateDate,
  coalesce(p.LoadCreateDate, TIMESTAMP '2024-06-01 12:00:00') AS LoadCreateDate
FROM hashed c LEFT JOIN prior p ON c.FactClaimTransactionLineWCKey = p.k AND c.RevisionNumber = p.rev
WHERE p.k IS NULL OR c.HashValue <> p.HashValue
"""


# --- windows and lookups ----------------------------------------------------------------------

CHANGED = """
SELECT DISTINCT l.* FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
WHERE l.l_shipdate >= TIMESTAMP '{start}' OR o.o_orderdate >= TIMESTAMP '{start}'
"""

STAR = """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_shipdate, o.o_orderstatus, o.o_custkey,
       coalesce(c.c_mktsegment, 'UNKNOWN') AS c_mktsegment, coalesce(p.p_size, -1) AS p_size
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON o.o_custkey = c.c_custkey
LEFT JOIN (SELECT * FROM part WHERE p_size <= 25) p ON l.l_partkey = p.p_partkey
"""

SNOWFLAKE = """
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_extendedprice, coalesce(s.s_name, 'UNKNOWN') AS s_name,
       coalesce(n.n_name, 'UNKNOWN') AS n_name, coalesce(r.r_name, 'UNKNOWN') AS r_name
FROM lineitem l
LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) s ON l.l_suppkey = s.s_suppkey
LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
"""

COALESCED = f"""
WITH {LATEST_ORDERS},
own AS (SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS own_state,
               CASE WHEN o_orderpriority <> '1-URGENT' THEN 'F' END AS other_state FROM orders)
SELECT o.o_orderkey, o.o_custkey, o.own_state, o.other_state, coalesce(s.o_orderkey, -1) AS state_key
FROM own o LEFT JOIN latest_orders s ON o.o_custkey = s.o_custkey
     AND coalesce(o.own_state, o.other_state) = s.o_orderstatus
"""

MISMATCHED = """
WITH o AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'C' || o_custkey
                                   ELSE CAST(o_custkey AS VARCHAR) END AS cust_text FROM orders)
SELECT o.o_orderkey, o.cust_text, TRY_CAST(o.cust_text AS BIGINT) AS c_custkey,
       coalesce(c.c_name, 'UNKNOWN') AS c_name
FROM o LEFT JOIN customer c ON TRY_CAST(o.cust_text AS BIGINT) = c.c_custkey
"""

RULES = f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, a AS Gross, CAST(0 AS {_DEC}) AS NonSubro,
  CAST(CASE WHEN l_returnflag = 'A' THEN a ELSE 0 END AS {_DEC}) AS Paid,
  CAST(CASE WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN a ELSE 0 END AS {_DEC}) AS PaidOpen,
  CAST(CASE WHEN l_returnflag = 'R' THEN a ELSE 0 END AS {_DEC}) AS Returned
FROM (SELECT *, CAST(l_extendedprice AS {_DEC}) AS a FROM lineitem)
"""

RULE_TEXT = """
SELECT string_agg('CASE WHEN l_returnflag = ''' || l_returnflag || ''' AND l_linestatus = ''' || l_linestatus
         || ''' THEN l_extendedprice ELSE 0 END AS Amount_' || l_returnflag || '_' || l_linestatus, ','
         ORDER BY l_returnflag, l_linestatus) AS measure_sql
FROM (SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem)
"""

SCALARS = f"""
SELECT o_orderkey, coalesce(nullif(o_orderpriority, '5-LOW'), 'none') AS priority,
  CASE WHEN o_orderdate < TIMESTAMP '1995-01-03' THEN TIMESTAMP '1700-01-01' ELSE o_orderdate END AS start_time,
  CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS parsed_day,
  CAST(abs(CAST(o_totalprice AS {_DEC}) - 250000) AS DECIMAL(19,2)) AS distance,
  CAST(substr(o_orderpriority, 1, 1) AS INT) AS priority_no
FROM orders
"""


def _hash_lines(template: str) -> str:
    parts = [_text_of(c, k) for c, k in [
        ("l_orderkey", "s"), ("l_linenumber", "s"), ("l_partkey", "s"), ("l_suppkey", "s"),
        ("amount", "d"), ("kind", "s"), ("category", "s"), ("l_shipdate", "t")]]
    return f"""
    SELECT *, {template.format(", ".join(parts), ", ".join(f"coalesce({p}, chr(0))" for p in parts))} AS HashValue
    FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_extendedprice AS {_DEC}) AS amount,
                 nullif(l_returnflag, 'N') AS kind, nullif(l_linestatus, 'O') AS category, l_shipdate
          FROM lineitem)"""


# --- change detection -------------------------------------------------------------------------

CDC_ROWS = f"""
WITH {LATEST_LINES},
plain AS (SELECT l_orderkey AS k, l_linenumber AS rev, l_partkey AS part,
                 CAST(l_extendedprice AS {_DEC}) AS amount, l_returnflag AS kind,
                 l_linestatus AS category, l_shipdate AS shipped FROM latest_lines),
cur AS (SELECT *, sha256(concat_ws('~', k, rev, part, CAST(amount AS VARCHAR), kind, category,
                 strftime(shipped, '%Y-%m-%d %H:%M:%S.%f'))) AS HashValue FROM plain),
prior AS (SELECT k, rev, part, amount, kind, category, shipped,
                 CASE WHEN kind = 'R' AND category = 'O' THEN 'x' || HashValue ELSE HashValue END AS HashValue,
                 TIMESTAMP '2020-01-01' AS LoadUpdateDate, TIMESTAMP '2020-01-01' AS LoadCreateDate
          FROM cur WHERE shipped < TIMESTAMP '2001-01-01'),
labelled AS (
  SELECT c.*, CASE WHEN p.k IS NULL THEN 1 WHEN c.HashValue <> p.HashValue THEN 0 ELSE 3 END AS InsertUpdates,
    CASE WHEN p.k IS NULL THEN 'Inserted' WHEN c.HashValue <> p.HashValue THEN 'Updated' END AS AuditOperations,
    TIMESTAMP '2024-06-01 12:00:00' AS LoadUpdateDate,
    coalesce(p.LoadCreateDate, TIMESTAMP '2024-06-01 12:00:00') AS LoadCreateDate
  FROM cur c LEFT JOIN prior p ON c.k = p.k AND c.rev = p.rev)
"""
CDC_APPLY = f"""{CDC_ROWS},
delta AS (SELECT * FROM labelled WHERE InsertUpdates <> 3)
SELECT k, rev, part, amount, kind, category, shipped, HashValue, LoadUpdateDate, LoadCreateDate FROM prior p
WHERE NOT EXISTS (SELECT 1 FROM delta d WHERE d.k = p.k AND d.rev = p.rev)
UNION ALL
SELECT k, rev, part, amount, kind, category, shipped, HashValue, LoadUpdateDate, LoadCreateDate FROM delta
"""
CDC_NULL = f"""{CDC_ROWS},
nulled AS (SELECT c.k, p.k AS pk, c.HashValue AS h,
                  CASE WHEN p.kind = 'R' AND p.category = 'O' THEN NULL ELSE p.HashValue END AS ph
           FROM cur c LEFT JOIN prior p ON c.k = p.k AND c.rev = p.rev)
SELECT 'ignore' AS mode, CASE WHEN pk IS NULL THEN 1 WHEN h <> ph THEN 0 ELSE 3 END AS InsertUpdates, count(*) AS n
FROM nulled GROUP BY 2
UNION ALL
SELECT 'update', CASE WHEN pk IS NULL THEN 1 WHEN h IS DISTINCT FROM ph THEN 0 ELSE 3 END, count(*)
FROM nulled GROUP BY 2
"""

# --- quality ----------------------------------------------------------------------------------

QUALITY = f"""
WITH rows_ AS (
  SELECT l_orderkey AS k, nullif(l_linenumber, 7) AS rev,
    CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN NULL ELSE sha256(CAST(l_orderkey AS VARCHAR)) END AS HashValue,
    CAST(CASE WHEN l_discount = 0 THEN 0 WHEN l_returnflag = 'R' THEN -l_extendedprice
         ELSE l_extendedprice END AS {_DEC}) AS amount, l_shipdate FROM lineitem),
prof AS (
  SELECT count(*) AS total_records, count(CASE WHEN {{keys}} THEN 1 END) AS null_keys,
    count(CASE WHEN HashValue IS NULL THEN 1 END) AS null_hashes,
    count(CASE WHEN amount = 0 THEN 1 END) AS zero_amounts,
    count(CASE WHEN amount < 0 THEN 1 END) AS negative_amounts,
    count(CASE WHEN amount > 90000 THEN 1 END) AS big_amounts,
    CAST(round(CAST(sum(amount) AS DECIMAL(28,2)) / count(*), 2) AS {_DEC}) AS avg_amount,
    min(l_shipdate) AS min_date, max(l_shipdate) AS max_date
  FROM rows_ WHERE l_shipdate >= TIMESTAMP '1996-01-01')
"""
_BOTH, _K = QUALITY.format(keys="k IS NULL OR rev IS NULL"), QUALITY.format(keys="k IS NULL")

CHECK_KEYS = f"""{_BOTH}
SELECT *, total_records = distinct_keys AS keys_unique,
       null_k = 0 AND null_rev = 0 AND null_l_shipdate = 0 AS all_present
FROM (SELECT (SELECT count(*) FROM rows_) AS total_records,
             (SELECT count(*) FROM (SELECT DISTINCT k, rev FROM rows_)) AS distinct_keys,
             (SELECT count(*) FROM rows_ WHERE k IS NULL) AS null_k,
             (SELECT count(*) FROM rows_ WHERE rev IS NULL) AS null_rev,
             (SELECT count(*) FROM rows_ WHERE l_shipdate IS NULL) AS null_l_shipdate)
"""

# --- reconciliation ---------------------------------------------------------------------------

SYSTEMS = f"""
WITH {LATEST_LINES},
a AS (SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, CAST(l_extendedprice AS {_DEC}) AS amount,
             l_shipdate FROM latest_lines WHERE l_shipdate >= TIMESTAMP '1995-06-01'),
b AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'A' THEN l_partkey + 1 ELSE l_partkey END AS l_partkey,
             l_returnflag, CAST(CAST(l_extendedprice AS {_DEC}) + CASE WHEN l_linestatus = 'O'
               AND l_returnflag <> 'N' THEN 0.01 ELSE 0.00 END AS {_DEC}) AS amount, l_shipdate
      FROM latest_lines WHERE l_shipdate < TIMESTAMP '2001-06-01'),
both_ AS (
  SELECT coalesce(a.l_orderkey, b.l_orderkey) AS l_orderkey, coalesce(a.l_linenumber, b.l_linenumber) AS l_linenumber,
    CAST(CASE WHEN a.l_orderkey IS NULL THEN 0 ELSE 1 END AS BIGINT) AS left_rows,
    CAST(CASE WHEN b.l_orderkey IS NULL THEN 0 ELSE 1 END AS BIGINT) AS right_rows,
    concat_ws(',', CASE WHEN a.l_partkey IS DISTINCT FROM b.l_partkey THEN 'l_partkey' END,
      CASE WHEN a.l_returnflag IS DISTINCT FROM b.l_returnflag THEN 'l_returnflag' END,
      CASE WHEN a.amount IS DISTINCT FROM b.amount THEN 'amount' END,
      CASE WHEN a.l_shipdate IS DISTINCT FROM b.l_shipdate THEN 'l_shipdate' END) AS unequal
  FROM a FULL OUTER JOIN b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber),
recon AS (
  SELECT l_orderkey, l_linenumber, left_rows, right_rows,
    CASE WHEN right_rows = 0 THEN 'left_only' WHEN left_rows = 0 THEN 'right_only'
         WHEN unequal = '' THEN 'matched' ELSE 'differs' END AS status,
    CASE WHEN left_rows = 1 AND right_rows = 1 THEN unequal END AS differing FROM both_)
"""

TOTALS = f"""{SYSTEMS},
x AS (SELECT count(*) AS n, CAST(sum(amount) AS DECIMAL(28,2)) AS s FROM a WHERE l_shipdate >= TIMESTAMP '1996-01-01'),
y AS (SELECT count(*) AS n, CAST(sum(amount) AS DECIMAL(28,2)) AS s FROM b WHERE l_shipdate >= TIMESTAMP '1996-01-01')
SELECT x.n AS left_count, y.n AS right_count, x.n - y.n AS count_diff, x.s AS left_sum, y.s AS right_sum,
  CAST(x.s - y.s AS DECIMAL(28,2)) AS sum_diff,
  CASE WHEN x.n = y.n AND abs(x.s - y.s) < 0.01 THEN 'PASS' ELSE 'FAIL' END AS validation_status
FROM x, y
"""

REPEATED = f"""
WITH {LATEST_LINES},
l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, count(*) AS n FROM lineitem GROUP BY ALL),
r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, count(*) AS n FROM latest_lines GROUP BY ALL),
per AS (
  SELECT l.l_orderkey, l.l_linenumber, CAST(sum(l.n) AS BIGINT) AS left_rows,
         CAST(sum(coalesce(r.n, 0)) AS BIGINT) AS right_rows, bool_and(l.n = coalesce(r.n, 0)) AS same
  FROM l LEFT JOIN r USING (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate) GROUP BY ALL)
SELECT l_orderkey, l_linenumber, left_rows, right_rows, CASE WHEN same THEN 'matched' ELSE 'differs' END AS status,
       CASE WHEN left_rows = 1 AND right_rows = 1 THEN '' END AS differing FROM per
"""

MATCH_RATE = f"""{SYSTEMS}
SELECT total_keys, matched_keys, match_rate, match_rate >= 99.99 AS target_met FROM (
  SELECT count(*) AS total_keys, count(CASE WHEN status = 'matched' THEN 1 END) AS matched_keys,
    CAST(round(count(CASE WHEN status = 'matched' THEN 1 END) * 100.0 / count(*), 4) AS DECIMAL(9,4)) AS match_rate
  FROM recon)
"""

EXPECTATIONS = """
WITH w AS (
  SELECT l_returnflag, count(*) AS n FROM (
    SELECT DISTINCT l.l_orderkey, l.l_linenumber, l.l_returnflag, l.l_shipdate
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
    WHERE l.l_shipdate >= TIMESTAMP '2000-01-01' OR o.o_orderdate >= TIMESTAMP '2000-01-01') GROUP BY 1),
c AS (SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01' GROUP BY 1)
SELECT 'strategies' AS test, l_returnflag, n AS expected, n AS actual, 'PASS' AS test_result FROM w
UNION ALL
SELECT 'copies', w.l_returnflag, c.n, w.n, CASE WHEN c.n = w.n THEN 'PASS' ELSE 'FAIL' END
FROM w JOIN c USING (l_returnflag)
"""

# --- runs and files ---------------------------------------------------------------------------

METRICS = f"""{CDC_ROWS}
SELECT 'sales_measures' AS ProcessName, 'run_1' AS ExecutionId, TIMESTAMP '2024-06-01 12:00:00' AS StartTime,
  TIMESTAMP '2024-06-01 12:07:30' AS EndTime, count(*) AS RecordsProcessed,
  count(CASE WHEN InsertUpdates = 1 THEN 1 END) AS RecordsInserted,
  count(CASE WHEN InsertUpdates = 0 THEN 1 END) AS RecordsUpdated,
  'SUCCESS' AS ExecutionStatus, CAST(NULL AS VARCHAR) AS ErrorMessage
FROM labelled WHERE InsertUpdates <> 3
"""

# Whole seconds that have passed, not second marks crossed: hence from microseconds.
DURATIONS = """
SELECT user_id, hour, start_time, end_time, secs AS execution_time_seconds,
  CASE WHEN secs <= 300 THEN 'EXCELLENT' WHEN secs <= 600 THEN 'GOOD' WHEN secs <= 1200 THEN 'ACCEPTABLE'
       ELSE 'NEEDS_OPTIMIZATION' END AS performance_rating
FROM (SELECT *, (epoch_us(end_time) - epoch_us(start_time)) // 1000000 AS secs FROM (
  SELECT user_id, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour, min(ts) AS start_time, max(ts) AS end_time
  FROM events GROUP BY 1, 2))
"""

PARTITIONED = f"""
SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month, count(*) AS orders,
  CAST(sum(CAST(o_totalprice AS {_DEC})) AS DECIMAL(28,2)) AS total,
  count(CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN 1 END) AS with_priority,
  min(CAST(o_orderdate AS DATE)) AS first_day
FROM orders GROUP BY 1, 2
"""

LATEST_EVENTS = """(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id
  ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn FROM events) WHERE rn = 1)"""

ORACLES: dict[str, str] = {
    "flagship_measures_delta": FLAGSHIP,
    "claim_measures_delta": _claims("2000-01-01", first_load=False),
    "claim_measures_pruned": _claims("2000-01-01", first_load=False),
    "claim_measures_first_load": _claims("1700-01-01", first_load=True),
    "latest_per_key_orders": f"WITH {LATEST_ORDERS} SELECT * FROM latest_orders",
    "latest_orders_incremental": f"WITH {LATEST_ORDERS} SELECT * FROM latest_orders",
    "latest_per_key_lines": f"WITH {LATEST_LINES} SELECT * FROM latest_lines",
    "latest_event_per_user": f"SELECT * FROM {LATEST_EVENTS}",
    "changed_either_side_or": CHANGED.format(start="2000-01-01"),
    "changed_either_side_union": CHANGED.format(start="2000-01-01"),
    "changed_since_partitioned": f"""WITH {LATEST_LINES}
        SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_shipdate, CAST(year(l.l_shipdate) AS INTEGER) AS year,
               CAST(month(l.l_shipdate) AS INTEGER) AS month
        FROM latest_lines l JOIN orders o ON l.l_orderkey = o.o_orderkey
        WHERE l.l_shipdate >= TIMESTAMP '2000-01-01' OR o.o_orderdate >= TIMESTAMP '2000-01-01'""",
    "full_load_sentinel": CHANGED.format(start="1700-01-01"),
    "since_last_run": """SELECT * FROM lineitem WHERE l_shipdate >=
        (SELECT coalesce(max(o_orderdate), TIMESTAMP '1900-01-01') FROM orders WHERE o_orderstatus = 'F')""",
    "star_lookup_defaults": STAR,
    "snowflake_lookup": SNOWFLAKE,
    "coalesced_key_lookup": COALESCED,
    "mismatched_key_join": MISMATCHED,
    "rule_measures": RULES,
    "measure_rule_text": RULE_TEXT,
    "composite_id": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
        concat_ws('~', l_orderkey, nullif(l_linenumber, 1)) AS composite_id,
        concat(l_orderkey, coalesce(CAST(nullif(l_linenumber, 1) AS VARCHAR), '')) AS plain_id FROM lineitem""",
    "scalar_functions": SCALARS,
    "row_hash_256": _hash_lines("sha256(concat_ws('~', {0}))"),
    "row_hash_marked": _hash_lines("'0x' || upper(sha256(concat_ws('~', {1})))"),
    "cdc_classify": f"{CDC_ROWS} SELECT * EXCLUDE (LoadUpdateDate, LoadCreateDate) FROM labelled",
    "cdc_classify_512": f"{CDC_ROWS} SELECT * EXCLUDE (HashValue, LoadUpdateDate, LoadCreateDate) FROM labelled",
    "cdc_delta": f"{CDC_ROWS} SELECT * FROM labelled WHERE InsertUpdates <> 3",
    "cdc_delta_pruned": f"""{CDC_ROWS} SELECT * FROM labelled
        WHERE InsertUpdates <> 3 AND shipped >= TIMESTAMP '2000-06-01'""",
    "cdc_inserts": f"""{CDC_ROWS} SELECT k, rev, part, amount, kind, category, shipped, HashValue
        FROM labelled WHERE InsertUpdates = 1""",
    "row_hash_512": f"""
        SELECT *, count(*) AS copies, 130 AS digits, true AS plain FROM (
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_extendedprice AS {_DEC}) AS amount,
               nullif(l_returnflag, 'N') AS kind, nullif(l_linestatus, 'O') AS category, l_shipdate
        FROM lineitem) GROUP BY ALL""",
    "cdc_rule_added": f"""{CDC_ROWS},
        delta AS (SELECT * FROM labelled WHERE InsertUpdates <> 3)
        SELECT k, rev, part, amount, kind, category, shipped, HashValue, LoadUpdateDate, LoadCreateDate,
               CAST(NULL AS {_DEC}) AS returned FROM prior p
        WHERE NOT EXISTS (SELECT 1 FROM delta d WHERE d.k = p.k AND d.rev = p.rev)
        UNION ALL SELECT k, rev, part, amount, kind, category, shipped, HashValue, LoadUpdateDate, LoadCreateDate,
               CASE WHEN kind = 'R' THEN amount END FROM delta""",
    "incremental_runs": f"""{CDC_ROWS},
        runs AS (SELECT amount, CASE WHEN shipped < TIMESTAMP '2001-01-01' THEN TIMESTAMP '2001-01-01'
                 ELSE TIMESTAMP '2002-01-01' END AS t FROM cur)
        SELECT t AS LoadCreateDate, t AS LoadUpdateDate, count(*) AS n, CAST(sum(amount) AS DECIMAL(28,2)) AS total,
               'stored' AS what FROM runs GROUP BY t
        UNION ALL SELECT t, NULL, count(amount), CAST(0 AS DECIMAL(28,2)), 'log' FROM (SELECT * FROM runs UNION ALL SELECT NULL, TIMESTAMP '2003-01-01')
        GROUP BY t""",
    "cdc_apply": CDC_APPLY,
    "cdc_upsert_versions": CDC_APPLY,
    "cdc_upsert_sliced": CDC_APPLY,
    "cdc_null_hash": CDC_NULL,
    "dq_profile": f"{_BOTH} SELECT * FROM prof",
    "dq_gate": f"{_K} SELECT * FROM prof WHERE null_keys > 0 OR negative_amounts > total_records * 0.1",
    "dq_status": f"""{_K} SELECT total_records, CASE WHEN null_keys > 0 THEN 'FAIL: Null keys detected'
        WHEN null_hashes > 0 THEN 'FAIL: Null hashes detected'
        WHEN zero_amounts > total_records * 0.5 THEN 'WARN: High zero amounts' ELSE 'PASS' END AS quality_status
        FROM prof""",
    "dq_duplicate_keys": """SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem
        GROUP BY 1, 2 HAVING count(*) > 1""",
    "dq_check_keys": CHECK_KEYS,
    "reconcile_totals": TOTALS,
    "reconcile_rows": f"{SYSTEMS} SELECT * FROM recon",
    "reconcile_tree": f"{SYSTEMS} SELECT * FROM recon WHERE status <> 'matched'",
    "reconcile_repeated": REPEATED,
    "match_rate": MATCH_RATE,
    "reconcile_hash": f"{SYSTEMS} SELECT status, count(*) AS keys FROM recon GROUP BY 1",
    "expectation_table": EXPECTATIONS,
    "run_metrics": METRICS,
    "run_metrics_observed": f"SELECT ProcessName, ExecutionId, RecordsProcessed, RecordsInserted, RecordsUpdated, ExecutionStatus, ErrorMessage FROM ({METRICS})",
    "duration_rating": DURATIONS,
    "partitioned_roundtrip": PARTITIONED,
    "clustered_roundtrip": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem",
    "zorder_roundtrip": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem",
    "stream_cdc": f"""SELECT user_id, event_id, ts, event_type, CAST(value AS {_DEC}) AS amount, props
        FROM {LATEST_EVENTS}""",
}
