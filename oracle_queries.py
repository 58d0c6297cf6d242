"""The same results as ``__spark_entry__.queries()``, written independently in plain SQL for DuckDB."""

from __future__ import annotations

# ---------------------------------------------------------------------------------------------------
# The ledger, step by step, as common table expressions
# ---------------------------------------------------------------------------------------------------

RAW = """
lines AS (
  SELECT l.*, o.o_custkey, o.o_orderpriority, c.c_mktsegment, s.s_name,
         (l.l_orderkey * 7 + l.l_linenumber * 13 + l.l_partkey) % 1000 AS slot,
         CAST(l.l_shipdate AS DATE) AS ship_day,
         floor(round(l.l_extendedprice * 100) / l.l_quantity) / 100 AS unit_price,
         CASE l.l_returnflag WHEN 'R' THEN 'Expense Reimbursement' WHEN 'A' THEN 'Procurement Contract'
              ELSE 'Vendor Invoice' END AS kind
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
planted AS (
  SELECT 'TXN-' || l_orderkey || '-' || l_linenumber AS transaction_id,
         CASE WHEN slot BETWEEN 26 AND 35 THEN
                CASE WHEN l_suppkey % 3 <> 0 THEN ship_day + CAST(7 - isodow(ship_day) AS INTEGER)
                     ELSE make_date(year(ship_day), 7, 4) END
              ELSE ship_day END AS day,
         'GL-' || l_returnflag || l_linestatus AS account_id,
         c_mktsegment AS department,
         'VND-' || l_suppkey AS vendor_id,
         ' ' || s_name || ' ' AS vendor_name,
         CASE WHEN slot < 12 THEN CASE l_suppkey % 8 WHEN 0 THEN 5000 WHEN 1 THEN 10000 WHEN 2 THEN 15000
                   WHEN 3 THEN 25000 WHEN 4 THEN 40000 WHEN 5 THEN 50000 WHEN 6 THEN 75000 ELSE 100000 END
              WHEN slot BETWEEN 12 AND 25 THEN CASE l_suppkey % 6 WHEN 0 THEN 4850 WHEN 1 THEN 4995
                   WHEN 2 THEN 9650 WHEN 3 THEN 9990 WHEN 4 THEN 48500 ELSE 49980 END
              WHEN slot BETWEEN 26 AND 35 THEN 18000 + (l_partkey * 7919 % 7700000) / 100.0
              WHEN slot BETWEEN 46 AND 53 THEN 4774 * (20 + l_partkey % 46)
              ELSE unit_price END::DOUBLE AS amount,
         CASE o_custkey % 20 WHEN 0 THEN '' WHEN 1 THEN 'EUR' WHEN 2 THEN ' GBP ' ELSE 'USD' END AS currency,
         o_orderpriority AS payment_method,
         CASE WHEN slot BETWEEN 36 AND 45 AND l_suppkey % 3 IN (1, 2) THEN NULL
              ELSE 'INV-' || l_orderkey END AS invoice_number,
         CASE WHEN slot BETWEEN 36 AND 45 AND l_suppkey % 3 IN (0, 2) THEN '  '
              ELSE 'EMP-' || substr(c_mktsegment, 1, 3) || '-' || (o_custkey % 3) END AS approver_id,
         kind AS transaction_type,
         kind || ' - ' || s_name AS description,
         CASE WHEN slot < 12 THEN 'ANOM_ROUND_AMOUNT' WHEN slot < 26 THEN 'ANOM_THRESHOLD_STRUCTURING'
              WHEN slot < 36 THEN 'ANOM_WEEKEND_HOLIDAY' WHEN slot < 46 THEN 'ANOM_MISSING_GOVERNANCE'
              WHEN slot < 54 THEN 'ANOM_STATISTICAL_OUTLIER' END AS anomaly_type,
         l_partkey * 1000000 + l_suppkey AS ingest_seq,
         slot, l_orderkey, l_linenumber, l_partkey, l_suppkey
  FROM lines
),
fed AS (
  SELECT transaction_id, day, account_id, department, vendor_id, vendor_name, amount, currency,
         payment_method, invoice_number, approver_id, transaction_type, description, anomaly_type, ingest_seq
  FROM planted
  UNION ALL
  SELECT 'TXN-DUP-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey,
         day + CAST(l_suppkey % 4 AS INTEGER), account_id, department, vendor_id, vendor_name, amount, currency,
         payment_method, invoice_number, approver_id, transaction_type, '[RE-SUBMITTED] ' || description,
         'ANOM_DUPLICATE_INVOICE', ingest_seq
  FROM planted WHERE slot BETWEEN 54 AND 63
  UNION ALL
  SELECT transaction_id, day, account_id, department, vendor_id, vendor_name, round(amount + 1.0, 2), currency,
         payment_method, invoice_number, approver_id, transaction_type,
         '[DUPLICATE_FEED_RECORD] ' || description, 'ANOM_DUPLICATE_TXN_ID', ingest_seq + 500000
  FROM planted WHERE slot BETWEEN 64 AND 68
),
raw AS (
  SELECT transaction_id, CAST(day AS VARCHAR) AS transaction_date, account_id, department, vendor_id,
         vendor_name, amount, currency, payment_method, invoice_number, approver_id, transaction_type,
         description, CASE WHEN anomaly_type IS NOT NULL THEN 1 END AS is_anomaly, anomaly_type, ingest_seq
  FROM fed
)"""

STAGED = RAW + """,
arrived AS (
  SELECT *, row_number() OVER (PARTITION BY transaction_id
                               ORDER BY ingest_seq, amount, transaction_date) AS arrival
  FROM raw
),
staged AS (
  SELECT transaction_id,
         CAST(transaction_date AS DATE) AS transaction_date,
         CAST(year(CAST(transaction_date AS DATE)) AS INTEGER) AS transaction_year,
         CAST(month(CAST(transaction_date AS DATE)) AS INTEGER) AS transaction_month,
         CAST(dayofweek(CAST(transaction_date AS DATE)) AS INTEGER) AS day_of_week,
         dayname(CAST(transaction_date AS DATE)) AS day_name,
         CASE WHEN dayofweek(CAST(transaction_date AS DATE)) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
         trim(account_id) AS account_id, trim(department) AS department, trim(vendor_id) AS vendor_id,
         trim(vendor_name) AS vendor_name, round(amount, 2) AS amount,
         coalesce(nullif(trim(currency), ''), 'USD') AS currency,
         trim(payment_method) AS payment_method,
         nullif(trim(invoice_number), '') AS invoice_number,
         nullif(trim(approver_id), '') AS approver_id,
         trim(transaction_type) AS transaction_type, trim(description) AS description,
         coalesce(is_anomaly, 0) AS ground_truth_anomaly,
         coalesce(anomaly_type, 'BENIGN_NORMAL') AS ground_truth_type
  FROM arrived
  WHERE arrival = 1 AND amount > 0
)"""

FLAGGED = STAGED + """,
baseline AS (SELECT department, avg(amount) AS mean FROM staged GROUP BY department),
judged AS (
  SELECT st.*, b.mean AS dept_baseline_mean,
         round(st.amount / b.mean, 2) AS dept_spend_multiplier,
         CASE WHEN st.invoice_number IS NOT NULL AND count(*) OVER
                (PARTITION BY st.vendor_id, st.invoice_number, st.amount) > 1 THEN 1 ELSE 0 END
           AS flag_duplicate_invoice,
         CASE WHEN st.amount >= 5000 AND st.amount = round(st.amount, 0)
                   AND CAST(st.amount AS BIGINT) % 5000 = 0 THEN 1 ELSE 0 END AS flag_round_amount,
         CASE WHEN st.amount BETWEEN 4800 AND 4999.99 OR st.amount BETWEEN 9500 AND 9999.99
                   OR st.amount BETWEEN 48000 AND 49999.99 THEN 1 ELSE 0 END AS flag_threshold_structuring,
         CASE WHEN st.is_weekend = 1 AND st.amount >= 15000 THEN 1 ELSE 0 END AS flag_weekend_posting,
         CASE WHEN st.approver_id IS NULL OR st.invoice_number IS NULL THEN 1 ELSE 0 END
           AS flag_missing_governance,
         CASE WHEN st.amount > 5.0 * b.mean THEN 1 ELSE 0 END AS flag_spend_spike
  FROM staged st JOIN baseline b ON st.department = b.department
),
totalled AS (
  SELECT *,
         flag_duplicate_invoice + flag_round_amount + flag_threshold_structuring + flag_weekend_posting
           + flag_missing_governance + flag_spend_spike AS total_rules_triggered,
         35 * flag_duplicate_invoice + 30 * flag_threshold_structuring + 25 * flag_missing_governance
           + 30 * flag_spend_spike + 20 * flag_round_amount + 20 * flag_weekend_posting AS points
  FROM judged
),
flagged AS (
  SELECT * EXCLUDE (points),
         CASE WHEN points > 100 THEN 100 ELSE points END AS risk_score,
         CASE WHEN points >= 60 THEN 'Critical' WHEN points >= 35 THEN 'High'
              WHEN points >= 20 THEN 'Medium' ELSE 'Low' END AS risk_tier,
         CASE WHEN flag_duplicate_invoice = 1 THEN 'Potential Duplicate Invoice Payment'
              WHEN flag_threshold_structuring = 1 THEN 'Approval Limit Structuring / Split Purchase'
              WHEN flag_spend_spike = 1 THEN 'Extreme Statistical Spend Outlier'
              WHEN flag_missing_governance = 1 THEN 'Unverified Transaction - Missing Governance'
              WHEN flag_round_amount = 1 THEN 'Suspicious Round-Sum Billing'
              WHEN flag_weekend_posting = 1 THEN 'High-Value Off-Hours / Weekend Posting'
              ELSE 'Normal Verified Business Spend' END AS primary_flag_reason
  FROM totalled
)"""

STATS = FLAGGED + """,
featured AS (
  SELECT *, ln(1 + amount) AS log_amount,
         least(abs(amount - 5000), abs(amount - 10000), abs(amount - 50000)) AS threshold_dist,
         CASE WHEN (amount >= 4800 AND amount < 5000) OR (amount >= 9500 AND amount < 10000)
                   OR (amount >= 48000 AND amount < 50000) THEN 1 ELSE 0 END AS is_structuring_candidate,
         CASE WHEN amount >= 1 THEN CAST(substr(CAST(CAST(floor(amount) AS BIGINT) AS VARCHAR), 1, 1) AS INTEGER)
              ELSE 0 END AS first_digit,
         CASE WHEN amount >= 1000 AND amount % 1000 = 0 THEN 1 ELSE 0 END AS is_clean_round_sum
  FROM flagged
),
quartiles AS (
  SELECT department, count(*) AS n, quantile_cont(amount, 0.25) AS q25, quantile_cont(amount, 0.5) AS med,
         quantile_cont(amount, 0.75) AS q75, stddev_samp(amount) AS sd
  FROM flagged GROUP BY department
),
spreads AS (
  SELECT f.department, quantile_cont(abs(f.amount - q.med), 0.5) AS mad
  FROM flagged f JOIN quartiles q ON f.department = q.department GROUP BY f.department
),
constants AS (
  SELECT q.*, q75 + 2.5 * (q75 - q25) AS upper, CASE WHEN s.mad = 0 THEN q.sd ELSE s.mad END AS mad
  FROM quartiles q JOIN spreads s ON q.department = s.department
),
measured AS (
  SELECT f.*, c.upper AS iqr_upper_bound,
         CASE WHEN f.amount > c.upper THEN 1 ELSE 0 END AS stat_iqr_flag,
         0.6745 * (f.amount - c.med) / (c.mad + 0.000001) AS stat_zscore,
         CASE WHEN 0.6745 * (f.amount - c.med) / (c.mad + 0.000001) > 4.5 THEN 1 ELSE 0 END AS stat_zscore_flag
  FROM featured f JOIN constants c ON f.department = c.department
),
verdicts AS (
  SELECT *, CASE WHEN risk_tier <> 'Low' THEN 1 ELSE 0 END AS rules,
         stat_iqr_flag AS iqr, stat_zscore_flag AS mad, ground_truth_anomaly AS truth
  FROM measured
)"""

MASTER = """
master AS (
  SELECT 'VND-' || s_suppkey AS vendor_id, s_name AS vendor_name,
         'NATION-' || s_nationkey AS primary_department,
         CASE WHEN s_acctbal < 0 THEN 'High' WHEN s_acctbal < 1000 THEN 'Medium' ELSE 'Low' END AS risk_tier
  FROM supplier
)"""

VENDORS = FLAGGED + "," + MASTER + """,
vendor_stats AS (
  SELECT vendor_id, sum(amount) AS invoiced, count(*) AS invoices,
         sum(flag_duplicate_invoice) AS duplicates,
         count(*) FILTER (WHERE risk_tier <> 'Low') AS flagged_rows, avg(risk_score) AS mean_score
  FROM flagged GROUP BY vendor_id
),
vendors AS (
  SELECT m.*, coalesce(invoiced, 0) AS invoiced, coalesce(invoices, 0) AS invoices,
         CAST(coalesce(duplicates, 0) AS BIGINT) AS duplicates, coalesce(flagged_rows, 0) AS flagged_rows,
         coalesce(mean_score, 0) AS mean_score
  FROM master m LEFT JOIN vendor_stats v ON m.vendor_id = v.vendor_id
)"""

EVENTS = """
event_ledger AS (
  SELECT event_id, ts, 'EVT-' || event_id AS transaction_id, CAST(ts AS DATE) AS transaction_date,
         event_type AS department, 'VND-' || user_id AS vendor_id, round(value * 100) AS amount,
         'INV-' || user_id || '-' || event_type || '-' || CAST(round(value * 100) AS BIGINT) AS invoice_number,
         'EMP-' || event_type AS approver_id
  FROM events
)"""

# columns of the staged and flagged results, as plain types
_STAGED_OUT = """transaction_id, CAST(transaction_date AS VARCHAR) AS transaction_date, transaction_year,
  transaction_month, day_of_week, day_name, is_weekend, account_id, department, vendor_id, vendor_name, amount,
  currency, payment_method, invoice_number, approver_id, transaction_type, description"""
_FLAGS = """flag_duplicate_invoice, flag_round_amount, flag_threshold_structuring, flag_weekend_posting,
  flag_missing_governance, flag_spend_spike"""

_MEASURES = """
  round(sum(amount), 2) AS total_spend,
  count(*) AS total_transactions,
  round(sum(CASE WHEN risk_tier IN ('Medium', 'High', 'Critical') THEN amount ELSE 0 END), 2) AS total_flagged_spend,
  round(sum(CASE WHEN risk_tier IN ('High', 'Critical') THEN amount ELSE 0 END), 2) AS value_at_risk,
  round(sum(CASE WHEN risk_tier IN ('Medium', 'High', 'Critical') THEN amount ELSE 0 END) / sum(amount), 6) AS anomaly_rate,
  round(sum(CASE WHEN risk_tier IN ('High', 'Critical') THEN amount ELSE 0 END) / sum(amount), 6) AS var_rate,
  count(*) FILTER (WHERE risk_tier IN ('High', 'Critical')) AS high_risk_transaction_count,
  count(*) FILTER (WHERE risk_tier = 'Critical') AS critical_risk_count,
  round(avg(amount), 2) AS average_transaction_amount,
  round(avg(risk_score), 4) AS average_risk_score,
  count(*) FILTER (WHERE flag_duplicate_invoice = 1) AS duplicate_invoice_count,
  round(sum(amount * flag_duplicate_invoice), 2) AS duplicate_invoice_exposure,
  count(*) FILTER (WHERE flag_threshold_structuring = 1) AS structuring_transaction_count,
  round(sum(amount * flag_threshold_structuring), 2) AS structuring_spend_exposure,
  count(*) FILTER (WHERE flag_weekend_posting = 1) AS weekend_flagged_count,
  round(sum(amount * flag_weekend_posting), 2) AS weekend_high_value_spend,
  count(*) FILTER (WHERE flag_missing_governance = 1) AS missing_governance_count,
  count(*) FILTER (WHERE flag_spend_spike = 1) AS statistical_spikes_count"""


_FEATURES = (
    "log_amount",
    "dept_spend_multiplier",
    "is_weekend",
    "is_clean_round_sum",
    "is_structuring_candidate",
    "day_of_week",
)
_K = range(len(_FEATURES))
_TREES, _SAMPLE, _DEPTH, _SEED = 150, 256, 8, 42
_CELLS = ", ".join(f"f{k}" for k in _K)


def _drawn(*parts: str) -> str:
    """Thirteen digits of an MD5 digest as a number."""
    return "CAST('0x' || substring(md5(" + " || ':' || ".join(f"CAST({p} AS VARCHAR)" for p in parts) + "), 1, 13) AS BIGINT)"


def _share(*parts: str) -> str:
    return f"({_drawn(*parts)} / 4503599627370496::DOUBLE)"


def _expected(n: str) -> str:
    """Mean depth of an unsuccessful search in a binary search tree."""
    return (
        f"CASE WHEN {n} <= 1 THEN 0::DOUBLE WHEN {n} = 2 THEN 1::DOUBLE "
        f"ELSE 2 * (ln({n}::DOUBLE - 1) + 0.5772156649015329::DOUBLE) - 2 * ({n}::DOUBLE - 1) / {n} END"
    )


def _forest_levels() -> str:
    """Trees grown level by level: all nodes of one depth are one grouped query over the rows that reached them."""
    parts = []
    for depth in range(_DEPTH + 1):
        lows, highs = (f"[{', '.join(f'{f}(f{k})' for k in _K)}]" for f in ("min", "max"))
        parts.append(
            f"""reached{depth} AS (SELECT tree, node, count(*) AS n, {lows} AS lows, {highs} AS highs FROM inside{depth} GROUP BY tree, node),
opened{depth} AS (SELECT *, [k FOR k IN range(0, {len(_K)}) IF highs[k + 1] > lows[k + 1]] AS open FROM reached{depth}),
drawn{depth} AS (
  SELECT tree, node, n, lows, highs,
         CASE WHEN {depth} < {_DEPTH} AND n > 1 AND len(open) > 0
              THEN open[{_drawn(str(_SEED), "tree", "node", "'feature'")} % len(open) + 1] END AS feature,
         {_share(str(_SEED), "tree", "node", "'cut'")} AS share
  FROM opened{depth}
),
nodes{depth} AS MATERIALIZED (
  SELECT tree, node, feature, lows[feature + 1] + share * (highs[feature + 1] - lows[feature + 1]) AS cut,
         CASE WHEN feature IS NULL THEN CAST(round(({depth} + {_expected("n")}) * 1e9) AS BIGINT) END AS path
  FROM drawn{depth}
)"""
        )
        if depth < _DEPTH:
            parts.append(
                f"""inside{depth + 1} AS (
  SELECT i.tree, 2 * i.node + CASE WHEN [{_CELLS}][s.feature + 1] > s.cut THEN 1 ELSE 0 END AS node, {_CELLS}
  FROM inside{depth} i JOIN nodes{depth} s ON s.tree = i.tree AND s.node = i.node WHERE s.feature IS NOT NULL
)"""
            )
    return ",\n".join(parts)


def _scored(name: str, source: str) -> str:
    """``{name}`` (transaction_id, score) of the rows of ``source``: each row goes down each tree, and stays in its leaf."""
    scaled = ", ".join(f"({f} - m{k}) / s{k} AS f{k}" for k, f in enumerate(_FEATURES))
    steps = [f"{name}_0 AS (SELECT transaction_id, CAST(t AS INTEGER) AS tree, 1 AS node, {scaled} FROM {source}, scaling, range({_TREES}) x(t))"]
    for depth in range(_DEPTH):
        right = "CASE s.feature " + " ".join(f"WHEN {k} THEN f{k}" for k in _K) + " END > s.cut"
        steps.append(
            f"""{name}_{depth + 1} AS (
  SELECT i.transaction_id, i.tree, {_CELLS},
         CASE WHEN s.feature IS NULL THEN i.node ELSE 2 * i.node + CASE WHEN {right} THEN 1 ELSE 0 END END AS node
  FROM {name}_{depth} i JOIN nodes s ON s.tree = i.tree AND s.node = i.node
)"""
        )
    steps.append(
        f"""{name} AS MATERIALIZED (
  SELECT i.transaction_id, pow(2::DOUBLE, -(sum(s.path)::DOUBLE / 1e9 / {_TREES}) / (SELECT {_expected("sample_rows")} FROM scaling)) AS score
  FROM {name}_{_DEPTH} i JOIN nodes s ON s.tree = i.tree AND s.node = i.node GROUP BY i.transaction_id
)"""
    )
    return ",\n".join(steps)


_VERDICT = """CASE WHEN s.score > c.cut THEN 1 ELSE 0 END AS ml_iso_forest_flag,
         CASE WHEN c.high > c.low THEN round_even((s.score - c.low) / (c.high - c.low) * 100, 1) ELSE 0::DOUBLE END AS ml_anomaly_score"""

TREES = (
    STATS
    + f""",
scaling AS MATERIALIZED (
  SELECT count(*) AS n, least(count(*), {_SAMPLE}) AS sample_rows,
         {", ".join(f"CAST(format('{{:.9e}}', avg({f})) AS DOUBLE) AS m{k}" for k, f in enumerate(_FEATURES))},
         {", ".join(f"CASE WHEN stddev_pop({f}) = 0 THEN 1 ELSE CAST(format('{{:.9e}}', stddev_pop({f})) AS DOUBLE) END AS s{k}" for k, f in enumerate(_FEATURES))}
  FROM featured
),
placed AS (
  SELECT transaction_id, {", ".join(f"({f} - m{k}) / s{k} AS f{k}" for k, f in enumerate(_FEATURES))},
         {_share(str(_SEED), "transaction_id")} * {_TREES} AS place,
         least(1::DOUBLE, {4 * _SAMPLE}::DOUBLE / n) * {_TREES} AS arc
  FROM featured, scaling
),
looking AS (
  SELECT transaction_id, {_CELLS},
         unnest(range(greatest(CAST(ceil(place - arc) AS BIGINT), CAST(floor(place) AS BIGINT) - {_TREES - 1}), CAST(floor(place) AS BIGINT) + 1)) AS t
  FROM placed
),
candidates AS (SELECT transaction_id, CAST((t % {_TREES} + {_TREES}) % {_TREES} AS INTEGER) AS tree, {_CELLS} FROM looking),
inside0 AS MATERIALIZED (
  SELECT tree, 1 AS node, {_CELLS} FROM candidates
  QUALIFY row_number() OVER (PARTITION BY tree ORDER BY {_share(str(_SEED), "tree", "transaction_id")}, transaction_id) <= {_SAMPLE}
),
{_forest_levels()},
nodes AS MATERIALIZED ({" UNION ALL ".join(f"SELECT * FROM nodes{d}" for d in range(_DEPTH + 1))})"""
)
ENRICHED = (
    TREES
    + f""",
{_scored("scores", "featured")},
calibration AS MATERIALIZED (SELECT quantile_cont(score, 0.955) AS cut, min(score) AS low, max(score) AS high FROM scores),
enriched AS (
  SELECT m.*, {_VERDICT} FROM verdicts m JOIN scores s ON s.transaction_id = m.transaction_id CROSS JOIN calibration c
)"""
)


def _q(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


_NARRATIVE = """
  coalesce(nullif(concat_ws('; ',
    CASE WHEN flag_duplicate_invoice = 1 THEN 'Duplicate invoice detected for vendor ''' || vendor_name || ''' ($'
         || format('{:,.2f}', amount) || ')' END,
    CASE WHEN flag_threshold_structuring = 1 THEN 'Amount $' || format('{:,.2f}', amount)
         || ' structured immediately below approval threshold' END,
    CASE WHEN flag_spend_spike = 1 OR stat_zscore_flag = 1 THEN 'Spend spike ('
         || format('{:.1f}', dept_spend_multiplier) || 'x department norm of $'
         || format('{:,.2f}', dept_baseline_mean) || ')' END,
    CASE WHEN flag_missing_governance = 1 THEN 'Missing mandatory approver ID or invoice voucher' END,
    CASE WHEN flag_weekend_posting = 1 THEN 'High-value post executed on ' || day_name END,
    CASE WHEN flag_round_amount = 1 THEN 'Unusual clean round-sum retainer billing' END
  ), ''), 'Elevated risk characteristics')"""

_REQUIRED = (
    "transaction_date transaction_year transaction_month day_of_week day_name is_weekend account_id department "
    "vendor_id vendor_name amount currency payment_method transaction_type"
).split()
_DETECTORS = ("rules", "iqr", "mad", "truth")


def _pairs(select: str) -> str:
    return "\nUNION ALL\n".join(select.format(a=a, b=b) for a in _DETECTORS for b in _DETECTORS)


ORACLE: dict[str, str] = {}


# --------------------------------------------------------------------------------------------------- sources
ORACLE["raw_ledger"] = _q(RAW, "SELECT * FROM raw")
ORACLE["feed_union"] = _q(
    RAW + "," + EVENTS,
    """SELECT feed, count(*) AS feed_rows, round(sum(amount), 2) AS feed_spend FROM (
         SELECT 'ledger' AS feed, amount FROM raw UNION ALL SELECT 'events', amount FROM event_ledger)
       GROUP BY feed""",
)
ORACLE["perturbation_labels"] = _q(
    RAW,
    """SELECT coalesce(anomaly_type, 'BENIGN_NORMAL') AS typology, count(*) AS typology_rows,
              round(sum(amount), 2) AS typology_spend, count(invoice_number) AS with_invoice,
              count(*) FILTER (WHERE trim(approver_id) = '') AS blank_approver,
              count(*) FILTER (WHERE dayofweek(CAST(transaction_date AS DATE)) IN (0, 6)) AS on_weekend
       FROM raw GROUP BY 1""",
)
ORACLE["vendor_master"] = _q(MASTER, "SELECT * FROM master")

# --------------------------------------------------------------------------------------------------- staging
ORACLE["stage_ledger"] = _q(STAGED, f"SELECT {_STAGED_OUT}, ground_truth_anomaly, ground_truth_type FROM staged")
ORACLE["stage_dedup_rejects"] = _q(
    STAGED,
    """SELECT transaction_id, ingest_seq, amount, transaction_date,
              CAST(count(*) OVER (PARTITION BY transaction_id) AS BIGINT) AS arrivals, arrival AS arrival_number
       FROM arrived QUALIFY arrival > 1""",
)
ORACLE["staged_count"] = _q(STAGED, "SELECT count(*) AS staged_transactions FROM staged")
ORACLE["quarantined_rows"] = _q(
    STAGED,
    "SELECT count(*) AS quarantined FROM staged WHERE " + " OR ".join(f"{c} IS NULL" for c in _REQUIRED),
)
ORACLE["dq_pk"] = _q(
    RAW,
    """SELECT transaction_id, count(*) AS occurrences FROM raw GROUP BY 1
       HAVING count(*) > 1 OR transaction_id IS NULL""",
)
ORACLE["dq_nulls"] = _q(
    STAGED,
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM staged"
        for c in [*_REQUIRED, "invoice_number", "approver_id"]
    ),
)
ORACLE["dq_vendor_nulls"] = _q(
    MASTER,
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM master"
        for c in ("vendor_name", "primary_department", "risk_tier")
    ),
)
# event users are checked against the supplier-based master: some have an entry, some have none
ORACLE["dq_orphans"] = _q(
    EVENTS + "," + MASTER,
    """SELECT e.vendor_id, count(*) AS ledger_rows FROM event_ledger e
       WHERE e.vendor_id NOT IN (SELECT vendor_id FROM master) GROUP BY 1""",
)
ORACLE["dq_known_vendors"] = _q(
    EVENTS + "," + MASTER,
    """SELECT e.vendor_id, count(*) AS ledger_rows FROM event_ledger e
       WHERE e.vendor_id IN (SELECT vendor_id FROM master) GROUP BY 1""",
)
ORACLE["dq_approver_gate"] = _q(
    STAGED,
    """SELECT transaction_id, department, vendor_id, amount FROM staged
       WHERE approver_id IS NULL AND amount > 1000""",
)

# --------------------------------------------------------------------------------------------------- reports on the staged ledger
ORACLE["duplicate_invoices"] = _q(
    STAGED,
    """SELECT transaction_id, CAST(transaction_date AS VARCHAR) AS transaction_date, vendor_id, vendor_name,
              invoice_number, amount,
              row_number() OVER (PARTITION BY vendor_id, invoice_number, amount
                                 ORDER BY transaction_date, transaction_id) AS duplicate_instance_num,
              count(*) OVER (PARTITION BY vendor_id, invoice_number, amount) AS total_duplicate_occurrences
       FROM staged WHERE invoice_number IS NOT NULL QUALIFY total_duplicate_occurrences > 1""",
)
ORACLE["structuring_sequences"] = _q(
    STAGED,
    """SELECT * FROM (
         SELECT transaction_id, CAST(transaction_date AS VARCHAR) AS transaction_date, department, approver_id, amount,
                CASE WHEN amount BETWEEN 4800 AND 4999.99 THEN 5000
                     WHEN amount BETWEEN 9500 AND 9999.99 THEN 10000
                     WHEN amount BETWEEN 48000 AND 49999.99 THEN 50000 END AS threshold_limit_targeted,
                lag(amount) OVER w AS prev_txn_amount,
                CAST(lag(transaction_date) OVER w AS VARCHAR) AS prev_txn_date,
                lead(amount) OVER w AS next_txn_amount
         FROM staged
         WINDOW w AS (PARTITION BY department, approver_id ORDER BY staged.transaction_date, transaction_id))
       WHERE threshold_limit_targeted IS NOT NULL""",
)
ORACLE["dept_percentile_profile"] = _q(
    STAGED,
    """SELECT transaction_id, CAST(transaction_date AS VARCHAR) AS transaction_date, department, vendor_name, amount,
              round(mean, 2) AS dept_avg_spend, round(amount / mean, 2) AS ratio_to_dept_avg,
              CAST(tile AS INTEGER) AS dept_amount_percentile, round(running, 2) AS dept_cumulative_ytd_spend
       FROM (SELECT *, avg(amount) OVER (PARTITION BY department) AS mean,
                    ntile(100) OVER (PARTITION BY department ORDER BY amount, transaction_id) AS tile,
                    sum(amount) OVER (PARTITION BY department ORDER BY transaction_date, transaction_id
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running
             FROM staged)
       WHERE tile >= 99""",
)
ORACLE["dept_profile"] = _q(
    STAGED,
    """SELECT department, count(*) AS total_transactions, round(sum(amount), 2) AS total_spend,
              round(avg(amount), 2) AS avg_transaction_amount, round(min(amount), 2) AS min_amount,
              round(max(amount), 2) AS max_amount,
              count(*) FILTER (WHERE is_weekend = 1) AS weekend_transaction_count,
              count(*) FILTER (WHERE approver_id IS NULL) AS unapproved_transaction_count,
              round(sum(CASE WHEN is_weekend = 1 THEN amount ELSE 0 END), 2) AS weekend_spend_total
       FROM staged GROUP BY department""",
)
ORACLE["dept_range"] = _q(
    STAGED,
    """SELECT department, round(avg(amount), 2) AS dept_avg_spend, min(amount) AS dept_min_spend,
              max(amount) AS dept_max_spend FROM staged GROUP BY department""",
)
ORACLE["vendor_concentration"] = _q(
    STAGED,
    """, totals AS (SELECT vendor_id, vendor_name, department, count(*) AS transaction_count,
                           round(sum(amount), 2) AS spend FROM staged GROUP BY ALL)
       SELECT vendor_id, vendor_name, department, transaction_count, spend AS total_vendor_spend,
              round(spend * 100.0 / sum(spend) OVER (), 2) AS pct_of_global_spend,
              round(sum(spend) OVER (ORDER BY spend DESC) * 100.0 / sum(spend) OVER (), 2) AS cumulative_spend_pct
       FROM totals ORDER BY spend DESC, vendor_id, department LIMIT 25""",
)
ORACLE["monthly_velocity"] = _q(
    STAGED,
    """SELECT transaction_year, transaction_month, count(*) AS transaction_volume,
              round(sum(amount), 2) AS monthly_spend, round(avg(amount), 2) AS monthly_avg_ticket,
              round((sum(amount) - lag(sum(amount)) OVER w) * 100.0 / lag(sum(amount)) OVER w, 2) AS mom_growth_pct
       FROM staged GROUP BY transaction_year, transaction_month
       WINDOW w AS (ORDER BY transaction_year, transaction_month)""",
)
ORACLE["payment_exposure"] = _q(
    STAGED,
    """SELECT payment_method, count(*) AS total_transactions, round(sum(amount), 2) AS total_amount,
              round(avg(amount), 2) AS avg_amount,
              round(sum(amount) * 100.0 / (SELECT sum(amount) FROM staged), 2) AS spend_share_pct
       FROM staged GROUP BY payment_method""",
)
ORACLE["currency_mix"] = _q(
    STAGED, "SELECT currency, count(*) AS transactions, round(sum(amount), 2) AS spend FROM staged GROUP BY 1"
)
ORACLE["ledger_profile"] = _q(
    RAW,
    """SELECT count(*) AS total_rows, min(transaction_date) AS first_date, max(transaction_date) AS last_date,
              round(sum(amount), 2) AS gross_spend, round(avg(amount), 2) AS mean_amount,
              round(median(amount), 2) AS median_amount FROM raw""",
)
ORACLE["typology_mix"] = _q(
    RAW,
    """SELECT coalesce(anomaly_type, 'BENIGN_NORMAL') AS typology, count(*) AS typology_rows,
              round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS typology_pct FROM raw GROUP BY 1""",
)
ORACLE["boxplot_stats"] = _q(
    STAGED,
    """, q AS (SELECT department, quantile_cont(amount, 0.25) AS q25, median(amount) AS med,
                      quantile_cont(amount, 0.75) AS q75 FROM staged GROUP BY 1)
       SELECT s.department, round(max(q25), 4) AS q25, round(max(med), 4) AS median, round(max(q75), 4) AS q75,
              min(amount) FILTER (WHERE amount BETWEEN q25 - (q75 - q25) * 1.5 AND q75 + (q75 - q25) * 1.5) AS whisker_low,
              max(amount) FILTER (WHERE amount BETWEEN q25 - (q75 - q25) * 1.5 AND q75 + (q75 - q25) * 1.5) AS whisker_high,
              count(*) FILTER (WHERE NOT amount BETWEEN q25 - (q75 - q25) * 1.5 AND q75 + (q75 - q25) * 1.5) AS outside
       FROM staged s JOIN q ON s.department = q.department GROUP BY 1""",
)
_BENFORD = """, digits AS (SELECT CAST(unnest(range(1, 10)) AS INTEGER) AS d),
  seen AS (SELECT CAST(substr(CAST(CAST(floor(amount) AS BIGINT) AS VARCHAR), 1, 1) AS INTEGER) AS d, count(*) AS n
           FROM staged WHERE amount >= 1 GROUP BY 1),
  shares AS (SELECT digits.d, 100 * log10(1 + 1.0 / digits.d) AS expected,
                    100.0 * coalesce(n, 0) / (SELECT sum(n) FROM seen) AS actual
             FROM digits LEFT JOIN seen ON digits.d = seen.d)
"""
ORACLE["benford"] = _q(
    STAGED,
    _BENFORD
    + """SELECT d AS "Digit", round_even(expected, 2) AS "Expected_Benford_Pct",
                round_even(actual, 2) AS "Actual_Observed_Pct",
                round_even(round_even(actual, 2) - round_even(expected, 2), 2) AS "Deviation_Pct" FROM shares""",
)
ORACLE["benford_notebook"] = _q(
    STAGED,
    _BENFORD
    + """SELECT d AS "Digit", round_even(expected, 2) AS "Expected_Benford_Pct",
                round_even(actual, 2) AS "Actual_Observed_Pct",
                round_even(actual - expected, 2) AS "Variance_Pct" FROM shares""",
)
_ROLLING = """, days AS (
    SELECT vendor_id, department, transaction_date AS day, sum(amount) AS spend, count(*) AS n, max(amount) AS largest,
           count(*) FILTER (WHERE amount BETWEEN 4800 AND 4999.99 OR amount BETWEEN 9500 AND 9999.99
                            OR amount BETWEEN 48000 AND 49999.99) AS near
    FROM staged GROUP BY ALL),
  rolled AS (
    SELECT vendor_id, department, CAST(day AS VARCHAR) AS transaction_date,
           round(sum(spend) OVER w, 2) AS rolling_spend, CAST(sum(n) OVER w AS BIGINT) AS rolling_transactions,
           max(largest) OVER w AS largest_payment, CAST(sum(near) OVER w AS BIGINT) AS near_limit_payments
    FROM days WINDOW w AS (PARTITION BY vendor_id, department ORDER BY day
                           RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)),
  evading AS (
    SELECT *, CASE WHEN rolling_spend >= 50000 AND largest_payment < 50000 THEN 50000
                   WHEN rolling_spend >= 10000 AND largest_payment < 10000 THEN 10000
                   WHEN rolling_spend >= 5000 AND largest_payment < 5000 THEN 5000 END AS evaded_limit
    FROM rolled)
"""
ORACLE["rolling_7d_spend"] = _q(
    STAGED, _ROLLING + "SELECT * EXCLUDE (evaded_limit), coalesce(evaded_limit, 0) AS evaded_limit FROM evading"
)
ORACLE["split_purchase_alerts"] = _q(STAGED, _ROLLING + "SELECT * FROM evading WHERE evaded_limit IS NOT NULL")

# --------------------------------------------------------------------------------------------------- rules and statistics
ORACLE["flagged"] = _q(
    FLAGGED,
    f"""SELECT {_STAGED_OUT}, round(dept_baseline_mean, 6) AS dept_baseline_mean, dept_spend_multiplier, {_FLAGS},
               total_rules_triggered, risk_score, risk_tier, primary_flag_reason, ground_truth_anomaly,
               ground_truth_type FROM flagged""",
)
ORACLE["tier_summary"] = _q(
    FLAGGED,
    """SELECT risk_tier, count(*) AS txn_count, round(sum(amount), 2) AS total_spend,
              round(avg(risk_score), 1) AS avg_risk_score FROM flagged GROUP BY risk_tier""",
)
ORACLE["flagged_count"] = _q(
    FLAGGED,
    """SELECT count(*) FILTER (WHERE risk_tier IN ('Medium', 'High', 'Critical')) AS flagged_transactions,
              count(*) AS staged_transactions,
              round(count(*) FILTER (WHERE risk_tier IN ('Medium', 'High', 'Critical')) * 100.0 / count(*), 2)
                AS flagged_pct FROM flagged""",
)
ORACLE["kpi_row"] = _q(
    FLAGGED,
    """SELECT count(*) AS "Total_Transactions", round(sum(amount), 2) AS "Total_Spend_USD",
              count(*) FILTER (WHERE risk_tier <> 'Low') AS "Total_Flagged_Transactions",
              round(sum(amount) FILTER (WHERE risk_tier <> 'Low'), 2) AS "Total_Flagged_Spend_USD",
              count(*) FILTER (WHERE risk_tier = 'Critical') AS "Critical_Risk_Count",
              round(sum(amount) FILTER (WHERE risk_tier = 'Critical'), 2) AS "Critical_Risk_Spend_USD",
              count(*) FILTER (WHERE risk_tier = 'High') AS "High_Risk_Count",
              round(sum(amount) FILTER (WHERE risk_tier = 'High'), 2) AS "High_Risk_Spend_USD",
              CAST(sum(flag_duplicate_invoice) AS BIGINT) AS "Duplicate_Invoices_Count",
              CAST(sum(flag_threshold_structuring) AS BIGINT) AS "Structuring_Anomalies_Count",
              CAST(sum(flag_weekend_posting) AS BIGINT) AS "Weekend_Spend_Anomalies_Count" FROM flagged""",
)
ORACLE["monthly_flagged"] = _q(
    FLAGGED,
    """SELECT transaction_year, transaction_month, round(sum(amount), 2) AS total_spend,
              round(sum(CASE WHEN risk_tier <> 'Low' THEN amount ELSE 0 END), 2) AS flagged_spend,
              transaction_year || '-' || lpad(CAST(transaction_month AS VARCHAR), 2, '0') AS "Period"
       FROM flagged GROUP BY transaction_year, transaction_month""",
)
ORACLE["tier_share"] = _q(
    FLAGGED,
    """SELECT risk_tier, count(*) AS tier_rows, round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS tier_pct
       FROM flagged GROUP BY risk_tier""",
)
ORACLE["features"] = _q(
    STATS,
    """SELECT transaction_id, amount, round(log_amount, 6) AS log_amount, round(threshold_dist, 2) AS threshold_dist,
              is_structuring_candidate, first_digit, is_clean_round_sum FROM featured""",
)
ORACLE["standardized_features"] = _q(
    STATS,
    "SELECT transaction_id, "
    + ", ".join(
        f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 5) AS {c}_std"
        for c in (
            "log_amount",
            "dept_spend_multiplier",
            "is_weekend",
            "is_clean_round_sum",
            "is_structuring_candidate",
            "day_of_week",
        )
    )
    + " FROM featured",
)
ORACLE["dept_quantiles"] = _q(
    STATS,
    """SELECT department, n, round(q25, 4) AS q25, round(med, 4) AS median, round(q75, 4) AS q75 FROM quartiles""",
)
ORACLE["iqr_outliers"] = _q(
    STATS,
    """SELECT transaction_id, department, amount, stat_iqr_flag, round(iqr_upper_bound, 4) AS iqr_upper_bound
       FROM measured""",
)
ORACLE["mad_outliers"] = _q(
    STATS,
    "SELECT transaction_id, department, amount, round(stat_zscore, 4) AS stat_zscore, stat_zscore_flag FROM measured",
)
ORACLE["outlier_counts"] = _q(
    STATS,
    "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS method, CAST(sum({c}) AS BIGINT) AS flagged_rows,
                   round(sum({c}) * 100.0 / count(*), 2) AS flagged_pct FROM measured"""
        for c in ("stat_iqr_flag", "stat_zscore_flag")
    ),
)
ORACLE["detector_corr"] = _q(
    STATS,
    _pairs("SELECT '{a}' AS detector, '{b}' AS other, round(corr({a}, {b}), 4) AS correlation FROM verdicts"),
)
ORACLE["detector_overlap"] = _q(
    STATS,
    """SELECT rules, iqr, mad, truth, count(*) AS overlap_rows, round(sum(amount), 2) AS overlap_spend
       FROM verdicts GROUP BY rules, iqr, mad, truth""",
)
ORACLE["detector_backtest"] = _q(
    STATS,
    "\nUNION ALL\n".join(
        f"""SELECT ground_truth_type AS typology, '{d}' AS detector, count(*) AS label_rows,
                   CAST(sum({d}) AS BIGINT) AS flagged_rows,
                   CASE WHEN ground_truth_type <> 'BENIGN_NORMAL' THEN round(sum({d}) * 1.0 / count(*), 4) END AS recall
            FROM verdicts GROUP BY ground_truth_type"""
        for d in ("rules", "iqr", "mad")
    ),
)
ORACLE["detector_quality"] = _q(
    STATS,
    "\nUNION ALL\n".join(
        f"""SELECT '{d}' AS detector, count(*) FILTER (WHERE {d} = 1 AND truth = 1) AS true_positives,
                   count(*) FILTER (WHERE {d} = 1 AND truth = 0) AS false_positives,
                   count(*) FILTER (WHERE {d} = 0 AND truth = 1) AS misses,
                   round(sum({d} * truth) * 1.0 / sum({d}), 4) AS precision,
                   round(sum({d} * truth) * 1.0 / sum(truth), 4) AS recall FROM verdicts"""
        for d in ("rules", "iqr", "mad")
    ),
)
_TOP = "ORDER BY risk_score DESC, amount DESC, transaction_id LIMIT {k}"
ORACLE["top50_rules"] = _q(
    STATS,
    """SELECT transaction_id, CAST(transaction_date AS VARCHAR) AS transaction_date, department, vendor_name, amount,
              risk_tier, risk_score, primary_flag_reason FROM measured """
    + _TOP.format(k=50),
)
ORACLE["top15_rules"] = ORACLE["top50_rules"].replace("LIMIT 50", "LIMIT 15")
ORACLE["top10_rules"] = ORACLE["top50_rules"].replace("LIMIT 50", "LIMIT 10")
ORACLE["narrative_rules"] = _q(
    STATS,
    f"""SELECT transaction_id, CAST(transaction_date AS VARCHAR) AS transaction_date, department, vendor_name, amount,
               risk_tier, risk_score, primary_flag_reason, {_NARRATIVE} AS audit_investigation_narrative
        FROM measured """
    + _TOP.format(k=50),
)
ORACLE["narrative_all_rows"] = _q(
    STATS, f"SELECT transaction_id, {_NARRATIVE} AS audit_investigation_narrative FROM measured"
)

# --------------------------------------------------------------------------------------------------- star schema
_CALENDAR = """, span AS (SELECT min(transaction_date) AS a, max(transaction_date) AS b FROM flagged),
  calendar AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS d FROM span)
"""
ORACLE["dim_date"] = _q(
    FLAGGED,
    _CALENDAR
    + """SELECT CAST(d AS VARCHAR) AS "Date", CAST(strftime(d, '%Y%m%d') AS INTEGER) AS "DateKey",
                CAST(year(d) AS INTEGER) AS "Year", 'Q' || quarter(d) AS "Quarter",
                CAST(month(d) AS INTEGER) AS "MonthNumber", strftime(d, '%B') AS "MonthName",
                strftime(d, '%b %Y') AS "MonthYear", CAST(day(d) AS INTEGER) AS "DayOfMonth",
                CAST(isodow(d) AS INTEGER) AS "DayOfWeekNumber", dayname(d) AS "DayOfWeekName",
                CASE WHEN isodow(d) IN (6, 7) THEN 1 ELSE 0 END AS "IsWeekend", 'FY' || year(d) AS "FiscalYear"
         FROM calendar""",
)
ORACLE["dim_department"] = _q(
    FLAGGED,
    """SELECT department, round(sum(amount), 2) AS "Total_Spend", count(transaction_id) AS "Transaction_Count",
              round(avg(amount), 4) AS "Avg_Transaction_Size",
              count(*) FILTER (WHERE risk_tier IN ('High', 'Critical')) AS "High_Risk_Transactions",
              row_number() OVER (ORDER BY department) AS "DepartmentKey",
              round_even(count(*) FILTER (WHERE risk_tier IN ('High', 'Critical')) * 100.0 / count(*), 2)
                AS "Risk_Concentration_Pct"
       FROM flagged GROUP BY department""",
)
ORACLE["dim_vendor"] = _q(
    VENDORS,
    """SELECT vendor_id, vendor_name, primary_department, risk_tier, round(invoiced, 2) AS "Total_Invoiced",
              invoices AS "Invoice_Count", duplicates AS "Duplicate_Invoice_Count", flagged_rows AS "Flagged_Count",
              round(mean_score, 6) AS "Avg_Risk_Score" FROM vendors""",
)
ORACLE["fact"] = _q(
    STATS,
    f"""SELECT transaction_id, CAST(strftime(transaction_date, '%Y%m%d') AS INTEGER) AS "DateKey",
               CAST(transaction_date AS VARCHAR) AS transaction_date, account_id, department, vendor_id, vendor_name,
               amount, currency, payment_method, invoice_number, approver_id, transaction_type, is_weekend,
               dept_spend_multiplier, risk_score, risk_tier, primary_flag_reason, {_FLAGS}, stat_iqr_flag,
               stat_zscore_flag, ground_truth_anomaly, ground_truth_type FROM measured""",
)

# --------------------------------------------------------------------------------------------------- measures and report pages
ORACLE["measures_all"] = _q(FLAGGED, f"SELECT {_MEASURES} FROM flagged")
ORACLE["measures_by_department"] = _q(FLAGGED, f"SELECT department, {_MEASURES} FROM flagged GROUP BY department")
ORACLE["measures_by_month"] = _q(
    FLAGGED,
    f"""SELECT transaction_year, transaction_month, {_MEASURES} FROM flagged
        GROUP BY transaction_year, transaction_month""",
)
ORACLE["measures_sliced"] = _q(
    FLAGGED,
    f"""SELECT department, {_MEASURES} FROM flagged
        WHERE year(transaction_date) IN (1996, 1997) AND quarter(transaction_date) IN (1, 4)
          AND risk_tier IN ('High', 'Critical') GROUP BY department""",
)
for _name, _key, _values in (
    ("vendor", "vendor_id", "'VND-3', 'VND-5', 'VND-8'"),
    ("reason", "primary_flag_reason", "'Suspicious Round-Sum Billing', 'Extreme Statistical Spend Outlier'"),
    ("approver", "approver_id", "'EMP-MAC-0', 'EMP-BUI-1'"),
):
    ORACLE[f"measures_by_{_name}_slice"] = _q(
        FLAGGED,
        f"""SELECT {_key}, {_MEASURES} FROM flagged WHERE {_key} IN ({_values})
            {"AND department IN ('MACHINERY', 'BUILDING')" if _name == "approver" else ""} GROUP BY {_key}""",
    )
_MONTHS = """, months AS (SELECT CAST(year(transaction_date) AS INTEGER) AS y,
                                 CAST(month(transaction_date) AS INTEGER) AS m, sum(amount) AS spend
                          FROM flagged GROUP BY 1, 2)
"""
ORACLE["yoy_spend"] = _q(
    FLAGGED,
    _MONTHS
    + """SELECT a.y AS "Year", a.m AS "MonthNumber", round(a.spend, 2) AS total_spend,
                round(b.spend, 2) AS spend_previous_year,
                coalesce(round((a.spend - b.spend) / b.spend, 6), 0) AS yoy_spend_growth
         FROM months a LEFT JOIN months b ON a.y = b.y + 1 AND a.m = b.m""",
)
ORACLE["mom_spend"] = _q(
    FLAGGED,
    _MONTHS
    + """SELECT a.y AS "Year", a.m AS "MonthNumber", round(a.spend, 2) AS total_spend,
                round(b.spend, 2) AS spend_previous_month,
                coalesce(round((a.spend - b.spend) / b.spend, 6), 0) AS mom_spend_growth
         FROM months a LEFT JOIN months b ON a.y * 12 + a.m = b.y * 12 + b.m + 1""",
)
ORACLE["yoy_spend_by_year"] = _q(
    FLAGGED,
    """, years AS (SELECT CAST(year(transaction_date) AS INTEGER) AS y, sum(amount) AS spend FROM flagged GROUP BY 1)
       SELECT a.y AS "Year", round(a.spend, 2) AS total_spend, round(b.spend, 2) AS spend_previous_year,
              coalesce(round((a.spend - b.spend) / b.spend, 6), 0) AS yoy_spend_growth
       FROM years a LEFT JOIN years b ON a.y = b.y + 1""",
)
ORACLE["mom_spend_by_department"] = _q(
    FLAGGED,
    """, months AS (SELECT department, CAST(year(transaction_date) AS INTEGER) AS y,
                           CAST(month(transaction_date) AS INTEGER) AS m, sum(amount) AS spend
                    FROM flagged GROUP BY 1, 2, 3)
       SELECT a.department, a.y AS "Year", a.m AS "MonthNumber", round(a.spend, 2) AS total_spend,
              round(b.spend, 2) AS spend_previous_month,
              coalesce(round((a.spend - b.spend) / b.spend, 6), 0) AS mom_spend_growth
       FROM months a LEFT JOIN months b
         ON a.department = b.department AND a.y * 12 + a.m = b.y * 12 + b.m + 1""",
)
ORACLE["rpt_cards"] = _q(
    FLAGGED,
    """SELECT round(sum(amount), 2) AS total_spend,
              round(sum(amount) FILTER (WHERE risk_tier IN ('High', 'Critical')), 2) AS value_at_risk,
              round(sum(amount) FILTER (WHERE risk_tier <> 'Low') / sum(amount), 6) AS anomaly_rate,
              count(*) FILTER (WHERE risk_tier = 'Critical') AS critical_risk_count,
              count(*) FILTER (WHERE flag_duplicate_invoice = 1) AS duplicate_invoice_count FROM flagged""",
)
ORACLE["rpt_spend_by_tier"] = _q(
    FLAGGED,
    """SELECT risk_tier, round(sum(amount), 2) AS total_spend, count(*) AS total_transactions
       FROM flagged GROUP BY risk_tier""",
)
ORACLE["rpt_monthly_exposure"] = _q(
    FLAGGED,
    _CALENDAR
    + """SELECT CAST(year(d) AS INTEGER) AS "Year", CAST(month(d) AS INTEGER) AS "MonthNumber",
                strftime(d, '%b %Y') AS "MonthYear", round(coalesce(sum(amount), 0), 2) AS total_spend,
                round(coalesce(sum(amount) FILTER (WHERE risk_tier <> 'Low'), 0), 2) AS total_flagged_spend
         FROM calendar LEFT JOIN flagged ON d = transaction_date GROUP BY 1, 2, 3""",
)
ORACLE["rpt_department_exposure"] = _q(
    FLAGGED,
    """SELECT department, round(sum(CASE WHEN risk_tier IN ('High', 'Critical') THEN amount ELSE 0 END), 2)
                AS value_at_risk, round(sum(amount), 2) AS total_spend FROM flagged GROUP BY department""",
)
ORACLE["rpt_payment_by_tier"] = _q(
    FLAGGED,
    """SELECT payment_method, risk_tier, round(sum(amount), 2) AS total_spend, count(*) AS total_transactions
       FROM flagged GROUP BY payment_method, risk_tier""",
)
ORACLE["rpt_exposure_by_reason"] = _q(
    FLAGGED,
    """SELECT primary_flag_reason, round(sum(amount), 2) AS total_spend, count(*) AS total_transactions,
              round(avg(amount), 2) AS average_transaction_amount FROM flagged GROUP BY primary_flag_reason""",
)
ORACLE["rpt_amount_score"] = _q(
    FLAGGED,
    """SELECT department, amount, risk_score, count(*) AS point_rows FROM flagged
       WHERE amount BETWEEN 0 AND 60000 GROUP BY department, amount, risk_score""",
)
ORACLE["rpt_weekend_by_day"] = _q(
    FLAGGED,
    """SELECT CAST(isodow(transaction_date) AS INTEGER) AS "DayOfWeekNumber", day_name AS "DayOfWeekName",
              round(sum(amount), 2) AS weekend_high_value_spend, count(*) AS weekend_flagged_count
       FROM flagged WHERE flag_weekend_posting = 1 GROUP BY 1, 2""",
)
ORACLE["rpt_rules_against_iqr"] = _q(
    STATS, "SELECT rules, iqr, count(*) AS overlap_rows, round(sum(amount), 2) AS overlap_spend FROM verdicts GROUP BY 1, 2"
)
ORACLE["rpt_vendor_quadrants"] = _q(
    VENDORS,
    """, split AS (SELECT median(invoiced) AS mid FROM vendors)
       SELECT vendor_id, vendor_name, round(invoiced, 2) AS "Total_Invoiced", round(mean_score, 4) AS "Avg_Risk_Score",
              duplicates AS "Duplicate_Invoice_Count", round(mid, 4) AS median_spend,
              (CASE WHEN round(invoiced, 4) > round(mid, 4) THEN 'high spend' ELSE 'low spend' END) || ', '
                || (CASE WHEN mean_score > 40 THEN 'high risk' ELSE 'low risk' END) AS quadrant
       FROM vendors, split""",
)
ORACLE["rpt_top_vendors"] = _q(
    VENDORS,
    """SELECT vendor_id, vendor_name, primary_department, round(invoiced, 2) AS "Total_Invoiced",
              duplicates AS "Duplicate_Invoice_Count", round(mean_score, 4) AS "Avg_Risk_Score", risk_tier
       FROM vendors ORDER BY round(invoiced, 2) DESC, vendor_id LIMIT 20""",
)
ORACLE["rpt_approvals"] = _q(
    FLAGGED,
    """SELECT department, flag_missing_governance, count(*) AS transactions, round(sum(amount), 2) AS spend
       FROM flagged GROUP BY department, flag_missing_governance""",
)
ORACLE["investigation_ledger"] = _q(
    FLAGGED,
    """SELECT transaction_id, CAST(transaction_date AS VARCHAR) AS transaction_date, department, vendor_name, amount,
              risk_score, risk_tier, primary_flag_reason, approver_id, invoice_number FROM flagged""",
)
ORACLE["investigation_critical"] = _q(
    FLAGGED,
    """SELECT transaction_id, CAST(transaction_date AS VARCHAR) AS transaction_date, department, vendor_name, amount,
              risk_score, risk_tier, primary_flag_reason, approver_id, invoice_number FROM flagged
       WHERE risk_tier IN ('Critical') AND department IN ('MACHINERY', 'BUILDING')""",
)

# --------------------------------------------------------------------------------------------------- streams
ORACLE["stream_rolling_7d"] = _q(
    EVENTS,
    """, bounds AS (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 DAY AS mark FROM event_ledger),
       placed AS (SELECT transaction_date - CAST(k AS INTEGER) AS start, vendor_id, department, amount
                  FROM event_ledger, (SELECT unnest(range(0, 7)) AS k)),
       windows AS (SELECT start, vendor_id, department, round(sum(amount), 2) AS spend, count(*) AS n,
                          max(amount) AS largest FROM placed GROUP BY 1, 2, 3)
       SELECT CAST(start AS VARCHAR) AS window_start, vendor_id, department, spend AS window_spend,
              n AS window_transactions, largest AS largest_payment,
              CASE WHEN spend >= 50000 AND largest < 50000 THEN 50000
                   WHEN spend >= 10000 AND largest < 10000 THEN 10000
                   WHEN spend >= 5000 AND largest < 5000 THEN 5000 ELSE 0 END AS evaded_limit
       FROM windows, bounds WHERE start + INTERVAL 7 DAY <= mark""",
)
ORACLE["stream_duplicate_block"] = _q(
    EVENTS,
    """SELECT transaction_id, vendor_id, invoice_number, amount,
              CASE WHEN row_number() OVER (PARTITION BY vendor_id, invoice_number, amount
                                           ORDER BY ts, transaction_id) = 1 THEN 'released' ELSE 'blocked' END AS decision
       FROM event_ledger""",
)
ORACLE["stream_block_deliveries"] = _q(
    EVENTS,
    """, sent AS (SELECT *, hour(ts) // 5 AS delivery FROM event_ledger
                 UNION ALL SELECT *, hour(ts) // 5 + 1 FROM event_ledger WHERE department = 'click')
       SELECT transaction_id, vendor_id, invoice_number, amount,
              CASE WHEN row_number() OVER (PARTITION BY vendor_id, invoice_number, amount
                                           ORDER BY delivery, ts, transaction_id) = 1
                   THEN 'released' ELSE 'blocked' END AS decision
       FROM sent""",
)
ORACLE["stream_rolling_corrected"] = _q(
    EVENTS + ", staged AS (SELECT * FROM event_ledger)",
    _ROLLING
    + """, touched AS (
    SELECT e.vendor_id, e.department, CAST(e.transaction_date AS VARCHAR) AS transaction_date,
           count(DISTINCT hour(r.ts) // 5) AS versions
    FROM (SELECT DISTINCT vendor_id, department, transaction_date FROM event_ledger) e JOIN event_ledger r
      ON r.vendor_id = e.vendor_id AND r.department = e.department
         AND r.transaction_date BETWEEN e.transaction_date - 6 AND e.transaction_date
         AND hour(r.ts) // 5 >= (SELECT min(hour(o.ts) // 5) FROM event_ledger o WHERE o.vendor_id = e.vendor_id
                                 AND o.department = e.department AND o.transaction_date = e.transaction_date)
    GROUP BY ALL)
  SELECT evading.* EXCLUDE (evaded_limit), coalesce(evaded_limit, 0) AS evaded_limit, versions
  FROM evading JOIN touched USING (vendor_id, department, transaction_date)""",
)
ORACLE["stream_first_payments"] = _q(
    EVENTS, "SELECT DISTINCT vendor_id, invoice_number, amount FROM event_ledger"
)
ORACLE["stream_rules"] = _q(
    EVENTS,
    """, means AS (SELECT department, avg(amount) AS mean FROM event_ledger GROUP BY department)
       SELECT transaction_id, CAST(transaction_date AS VARCHAR) AS transaction_date, e.department, vendor_id, amount,
              round(amount / mean, 2) AS dept_spend_multiplier,
              CASE WHEN amount >= 5000 AND amount % 5000 = 0 THEN 1 ELSE 0 END AS flag_round_amount,
              CASE WHEN amount BETWEEN 4800 AND 4999.99 OR amount BETWEEN 9500 AND 9999.99
                        OR amount BETWEEN 48000 AND 49999.99 THEN 1 ELSE 0 END AS flag_threshold_structuring,
              CASE WHEN dayofweek(transaction_date) IN (0, 6) AND amount >= 15000 THEN 1 ELSE 0 END
                AS flag_weekend_posting,
              CASE WHEN approver_id IS NULL OR invoice_number IS NULL THEN 1 ELSE 0 END AS flag_missing_governance,
              CASE WHEN amount > 5 * mean THEN 1 ELSE 0 END AS flag_spend_spike,
              CASE WHEN approver_id IS NULL AND amount > 1000 THEN 1 ELSE 0 END AS blocked_unapproved
       FROM event_ledger e JOIN means m ON e.department = m.department""",
)

# --------------------------------------------------------------------------------------------------- model
_ML = "ml_iso_forest_flag, ml_anomaly_score"
_FIVE = ("rules", "iqr", "mad", "ml_iso_forest_flag", "truth")


def _called(detector: str) -> str:
    return "forest" if detector == "ml_iso_forest_flag" else detector


ORACLE["iforest_trees"] = _q(
    TREES,
    f"""SELECT tree, {_DEPTH} AS depth, CAST(any_value(sample_rows) AS INTEGER) AS sample_rows, CAST(count(*) AS INTEGER) AS nodes,
               round(max(path) / 1e9, 6) AS longest_path FROM nodes, scaling GROUP BY tree""",
)
ORACLE["iforest_scores"] = _q(ENRICHED, f"SELECT transaction_id, {_ML} FROM enriched")
ORACLE["enriched"] = _q(
    ENRICHED,
    f"""SELECT {_STAGED_OUT}, ground_truth_anomaly, ground_truth_type, round(dept_baseline_mean, 6) AS dept_baseline_mean,
               dept_spend_multiplier, {_FLAGS}, total_rules_triggered, risk_score, risk_tier, primary_flag_reason,
               round(log_amount, 6) AS log_amount, round(threshold_dist, 2) AS threshold_dist, is_structuring_candidate,
               first_digit, is_clean_round_sum, stat_iqr_flag, round(iqr_upper_bound, 4) AS iqr_upper_bound,
               round(stat_zscore, 4) AS stat_zscore, stat_zscore_flag, {_ML} FROM enriched""",
)
ORACLE["fact_with_ml"] = _q(ENRICHED, ORACLE["fact"].split(STATS)[1].replace("FROM measured", f", {_ML} FROM enriched"))
_TOP_ML = "ORDER BY risk_score DESC, ml_anomaly_score DESC, amount DESC, transaction_id LIMIT {k}"
_NARRATIVE_ML = _NARRATIVE.replace(
    "'Unusual clean round-sum retainer billing' END",
    """'Unusual clean round-sum retainer billing' END,
    CASE WHEN ml_iso_forest_flag = 1 THEN 'High ML Isolation Forest score (' || format('{:.1f}', ml_anomaly_score) || '/100)' END""",
)
for _k in (50, 15, 10):
    ORACLE["top50" if _k == 50 else f"top{_k}_ml"] = _q(
        ENRICHED,
        f"""SELECT transaction_id, CAST(transaction_date AS VARCHAR) AS transaction_date, department, vendor_name, amount,
                   risk_tier, risk_score, ml_anomaly_score, primary_flag_reason,
                   {_NARRATIVE_ML} AS audit_investigation_narrative FROM enriched """
        + _TOP_ML.format(k=_k),
    )
ORACLE["narrative_with_ml"] = _q(
    ENRICHED, f"SELECT transaction_id, {_NARRATIVE_ML} AS audit_investigation_narrative FROM enriched"
)
ORACLE["outlier_counts_with_ml"] = _q(
    ENRICHED,
    "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS method, CAST(sum({c}) AS BIGINT) AS flagged_rows,
                   round(sum({c}) * 100.0 / count(*), 2) AS flagged_pct FROM enriched"""
        for c in ("stat_iqr_flag", "stat_zscore_flag", "ml_iso_forest_flag")
    ),
)
ORACLE["correlation_with_ml"] = _q(
    ENRICHED.replace("enriched AS (", "enriched AS MATERIALIZED ("),
    "\nUNION ALL\n".join(
        f"SELECT '{_called(a)}' AS detector, '{_called(b)}' AS other, round(corr({a}, {b}), 4) AS correlation FROM enriched"
        for a in _FIVE
        for b in _FIVE
    ),
)
ORACLE["backtest_with_ml"] = _q(
    ENRICHED.replace("enriched AS (", "enriched AS MATERIALIZED ("),
    "\nUNION ALL\n".join(
        f"""SELECT ground_truth_type AS typology, '{_called(d)}' AS detector, count(*) AS label_rows,
                   CAST(sum({d}) AS BIGINT) AS flagged_rows,
                   CASE WHEN ground_truth_type <> 'BENIGN_NORMAL' THEN round(sum({d}) * 1.0 / count(*), 4) END AS recall
            FROM enriched GROUP BY ground_truth_type"""
        for d in _FIVE[:-1]
    ),
)
ORACLE["measures_with_ml"] = _q(
    ENRICHED, f"SELECT {_MEASURES}, count(*) FILTER (WHERE ml_iso_forest_flag = 1) AS ml_detections FROM enriched"
)
ORACLE["rpt_rules_against_model"] = _q(
    ENRICHED, "SELECT rules, ml_iso_forest_flag AS forest, count(*) AS overlap_rows FROM enriched GROUP BY 1, 2"
)
ORACLE["investigation_with_ml"] = _q(
    ENRICHED,
    """SELECT transaction_id, CAST(transaction_date AS VARCHAR) AS transaction_date, department, vendor_name, amount,
              risk_score, ml_anomaly_score, risk_tier, primary_flag_reason, approver_id, invoice_number
       FROM enriched WHERE risk_tier IN ('Critical', 'High')""",
)
ORACLE["stream_forest_screen"] = _q(
    ENRICHED
    + ","
    + EVENTS
    + f""",
means AS (SELECT department, avg(amount) AS mean FROM event_ledger GROUP BY department),
screened AS (
  SELECT transaction_id, transaction_date, vendor_id, amount, ln(1 + amount) AS log_amount,
         round(amount / mean, 2) AS dept_spend_multiplier,
         CASE WHEN dayofweek(transaction_date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
         CASE WHEN amount >= 1000 AND amount % 1000 = 0 THEN 1 ELSE 0 END AS is_clean_round_sum,
         CASE WHEN (amount >= 4800 AND amount < 5000) OR (amount >= 9500 AND amount < 10000)
                   OR (amount >= 48000 AND amount < 50000) THEN 1 ELSE 0 END AS is_structuring_candidate,
         dayofweek(transaction_date) AS day_of_week
  FROM event_ledger e JOIN means m ON e.department = m.department
),
{_scored("screen_scores", "screened")}""",
    f"""SELECT e.transaction_id, CAST(transaction_date AS VARCHAR) AS transaction_date, vendor_id, amount, {_VERDICT}
        FROM screened e JOIN screen_scores s ON s.transaction_id = e.transaction_id CROSS JOIN calibration c""",
)

# --------------------------------------------------------------------------------------------------- faulty feed, refresh
_FAULTY = RAW + """,
faulty AS (
  SELECT *, ingest_seq % 101 = 0 AS no_date, ingest_seq % 107 = 0 AS no_amount, ingest_seq % 103 = 0 AS no_department,
         row_number() OVER (PARTITION BY transaction_id ORDER BY ingest_seq) AS arrival
  FROM raw
),
held AS (
  SELECT transaction_id,
         concat_ws(',', CASE WHEN no_date THEN 'transaction_date,transaction_year,transaction_month,day_of_week,day_name' END,
                   CASE WHEN no_department THEN 'department' END, CASE WHEN no_amount THEN 'amount' END) AS missing_columns
  FROM faulty WHERE arrival = 1 AND (no_amount OR amount > 0) AND (no_date OR no_amount OR no_department)
)"""
ORACLE["source_faulty_quarantine"] = _q(_FAULTY, "SELECT * FROM held")
ORACLE["source_faulty_counts"] = _q(
    _FAULTY,
    """SELECT count(*) AS raw_rows,
              count(*) FILTER (WHERE arrival = 1 AND amount > 0 AND NOT (no_date OR no_amount OR no_department)) AS staged_rows,
              (SELECT count(*) FROM held) AS quarantined_rows, count(*) FILTER (WHERE arrival > 1) AS repeated_rows,
              count(*) FILTER (WHERE arrival = 1 AND amount <= 0 AND NOT no_amount) AS dropped_rows FROM faulty""",
)
ORACLE["sink_refresh_months"] = _q(
    FLAGGED,
    """SELECT transaction_year, transaction_month, round(sum(amount), 2) AS spend, count(*) AS transactions,
              CASE WHEN transaction_year = 1996 THEN 0 ELSE 1 END AS kept_files FROM flagged GROUP BY 1, 2""",
)

# ------------------------------------------------------------------------- round trips and a run's outputs
for _name, _same_as in {
    "source_ledger_csv": "stage_ledger",
    "source_ledger_parquet": "stage_ledger",
    "source_vendor_csv": "vendor_master",
    "source_enriched_csv": "enriched",
    "sink_append_batches": "stage_ledger",
    "source_flagged": "flagged",
    "sink_view": "stage_ledger",
    "sink_fact_by_month": "fact",
    "sink_investigation_csv": "investigation_ledger",
    "run_staged": "stage_ledger",
    "run_kpis": "kpi_row",
    "run_tiers": "tier_summary",
}.items():
    ORACLE[_name] = ORACLE[_same_as]
