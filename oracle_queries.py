"""The registered queries in SQL, written for DuckDB over the `events` view.

Written on purpose in another form than the operators: range joins where they
sweep a timeline, full joins and unions where they group once.
"""

from __future__ import annotations

from counterfoil.operators.corrections import DEFINITIONS

CLIENT = """
client AS (
  SELECT concat('e', event_id) AS event_id, concat('u', user_id) AS user_id, ts AS event_at,
    CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'add_to_cart'
      WHEN 'purchase' THEN 'purchase_intent' ELSE event_type END AS event_name,
    value AS event_value, '' AS product_id, '' AS page_url, '' AS traffic_source,
    concat('{"k":', json_extract_string(props, '$.k'), ',"value":', value, '}') AS properties_raw,
    'client' AS _source, event_type = 'purchase' AS is_conversion_client
  FROM events)
"""

TRANSACTIONS = """
transactions AS (
  SELECT event_id, event_type, user_id, value,
    ts + ((event_id * 37) % 700 - 50) * INTERVAL '1' SECOND AS tx_at
  FROM events
  WHERE event_type = 'purchase' OR (event_type = 'signup' AND event_id % 4 <= 1)),
logs AS (
  SELECT event_id AS n, concat('tx', event_id) AS tx_id, concat('u', user_id) AS user_id, tx_at,
    CASE WHEN day(tx_at) = 20 THEN NULL
      WHEN event_type = 'signup' THEN
        CASE WHEN event_id % 2 = 0 THEN concat('e', event_id - 1) END
      WHEN event_id % 5 = 0 THEN NULL
      WHEN event_id % 41 = 0 THEN '  '
      ELSE concat('e', event_id) END AS ext_id,
    CASE WHEN event_id % 10 = 3 THEN round(value + 1.25, 2) ELSE value END AS amount,
    CASE WHEN day(tx_at) = 15 THEN 'failed'
      WHEN event_id % 97 = 0 THEN NULL
      WHEN event_id % 20 IN (1, 2, 7) THEN 'failed'
      WHEN event_id % 20 = 4 THEN 'refunded'
      WHEN event_id % 20 = 6 THEN 'pending'
      ELSE 'completed' END AS status
  FROM transactions)
"""

SERVER = f"""
{TRANSACTIONS},
server AS (
  SELECT tx_id AS transaction_id, user_id,
    CASE WHEN trim(ext_id) <> '' THEN ext_id END AS client_event_id,
    tx_at AS transaction_at, amount AS transaction_amount, status AS transaction_status,
    'server' AS _source, status = 'completed' AS is_completed, status = 'failed' AS is_failed,
    status = 'refunded' AS is_refunded, status = 'completed' AS is_revenue_recognized
  FROM logs)
"""

STAGED = f"{CLIENT}, {SERVER}"

MART = f"""
{STAGED},
mart AS (
  SELECT s.transaction_id, s.user_id, s.transaction_at, s.transaction_status,
    s.transaction_amount AS server_amount, c.event_value AS client_reported_amount,
    coalesce(s.transaction_amount, 0) - coalesce(c.event_value, 0) AS variance,
    coalesce(s.transaction_amount, 0) = coalesce(c.event_value, 0) AS is_reconciled,
    c.event_id IS NOT NULL AS has_client_event, c.event_id AS client_event_id,
    c.event_id IS NOT NULL AS conversion_definition_marketing,
    s.is_revenue_recognized AS conversion_definition_finance,
    CASE WHEN s.is_revenue_recognized IS NULL THEN 'neither'
      WHEN c.event_id IS NOT NULL THEN
        CASE WHEN s.is_revenue_recognized THEN 'both' ELSE 'marketing_only' END
      WHEN s.is_revenue_recognized THEN 'finance_only'
      ELSE 'neither' END AS attribution_category
  FROM server s
  LEFT JOIN (SELECT * FROM client WHERE event_name = 'purchase_intent') c
    ON s.client_event_id = c.event_id)
"""


def money(amount: str, where: str = "true") -> str:
    """Exact sum of the rows that satisfy a condition."""
    return f"sum(CAST({amount} AS DECIMAL(24,6))) FILTER (WHERE {where})"


def cents(total: str) -> str:
    return f"CAST(round(coalesce({total}, 0), 2) AS DOUBLE)"


REPORTED = "coalesce(client_reported_amount, 0)"


def daily(source: str, definition: str, amount: str) -> str:
    return f"""
  SELECT CAST(transaction_at AS DATE) AS report_date, '{source}' AS revenue_source,
    count(*) AS transaction_count,
    CAST({money(amount)} AS DOUBLE) AS gross_revenue,
    CAST(coalesce({money(amount, 'is_reconciled')}, 0) AS DOUBLE) AS reconciled_revenue,
    CAST(coalesce({money(amount, 'NOT is_reconciled')}, 0) AS DOUBLE) AS unreconciled_revenue,
    count(*) FILTER (WHERE {definition}) AS conversion_count
  FROM mart WHERE {definition} GROUP BY 1"""


FINANCE_DAILY = daily("finance", "conversion_definition_finance", "server_amount")
MARKETING_DAILY = daily("marketing", "conversion_definition_marketing", REPORTED)


def summary(report_date: str) -> str:
    gap = (
        "CAST(CAST(f.gross_revenue AS DECIMAL(24,6)) "
        "- CAST(m.gross_revenue AS DECIMAL(24,6)) AS DOUBLE)"
    )
    return f"""
WITH {MART}, f AS ({FINANCE_DAILY}), m AS ({MARKETING_DAILY})
SELECT {report_date} AS report_date,
  f.transaction_count AS finance_transaction_count,
  m.transaction_count AS marketing_transaction_count,
  f.gross_revenue AS finance_revenue, m.gross_revenue AS marketing_revenue,
  {gap} AS revenue_variance,
  f.reconciled_revenue AS finance_reconciled_revenue,
  m.reconciled_revenue AS marketing_reconciled_revenue,
  f.conversion_count AS finance_conversions, m.conversion_count AS marketing_conversions,
  m.conversion_count - f.conversion_count AS conversion_count_variance,
  CASE WHEN f.gross_revenue > 0 THEN
    CAST(round(CAST(100.0 * {gap} / f.gross_revenue AS DECIMAL(28,6)), 2) AS DOUBLE)
  END AS revenue_variance_pct
FROM f FULL JOIN m ON f.report_date = m.report_date
ORDER BY 1"""


JOURNEY_COLUMNS = """
  c.event_id, c.user_id, c.event_at, c.event_name, c.event_value, c.product_id, c.page_url,
  c.traffic_source, c.is_conversion_client,
  s.transaction_id, s.transaction_at, s.transaction_amount, s.transaction_status,
  s.client_event_id AS server_reported_event_id,
  s.is_completed, s.is_failed, s.is_refunded, s.is_revenue_recognized,
  abs(epoch_us(c.event_at) - epoch_us(s.transaction_at)) / 1e6 AS time_delta_seconds,
  s.transaction_id IS NULL AS is_unmatched_client_event,
  coalesce(s.client_event_id <> c.event_id, false) AS has_conflicting_ext_id
"""

JOURNEY = f"""
SELECT {JOURNEY_COLUMNS}
FROM client c LEFT JOIN server s
  ON c.user_id = s.user_id
  AND abs(epoch_us(c.event_at) - epoch_us(s.transaction_at)) <= 300000000
QUALIFY row_number() OVER (PARTITION BY c.event_id
  ORDER BY abs(epoch_us(c.event_at) - epoch_us(s.transaction_at)) NULLS LAST,
    s.transaction_at, s.transaction_id) = 1
"""

LINK_FIRST = f"""
WITH {STAGED},
candidates AS (
  SELECT c.event_id AS for_event, true AS linked, s.transaction_id, s.transaction_at,
    abs(epoch_us(c.event_at) - epoch_us(s.transaction_at)) AS gap
  FROM client c JOIN server s ON s.client_event_id = c.event_id
  UNION ALL
  SELECT c.event_id, false, s.transaction_id, s.transaction_at,
    abs(epoch_us(c.event_at) - epoch_us(s.transaction_at))
  FROM client c JOIN server s ON s.client_event_id IS NULL AND c.user_id = s.user_id
    AND abs(epoch_us(c.event_at) - epoch_us(s.transaction_at)) <= 300000000),
best AS (
  SELECT for_event, transaction_id AS best_tx FROM candidates
  QUALIFY row_number() OVER (PARTITION BY for_event
    ORDER BY linked DESC, gap, transaction_at, transaction_id) = 1)
SELECT {JOURNEY_COLUMNS}
FROM client c
LEFT JOIN best b ON b.for_event = c.event_id
LEFT JOIN server s ON s.transaction_id = b.best_tx
"""

SESSION_CHECK = f"""
WITH {CLIENT},
before AS (
  SELECT p.event_id, count(e.event_id) AS n
  FROM client p LEFT JOIN client e
    ON e.user_id = p.user_id AND e.event_at < p.event_at
    AND e.event_at >= p.event_at - INTERVAL '60' MINUTE
    AND e.event_name IN ('page_view', 'add_to_cart')
  WHERE p.event_name = 'purchase_intent'
  GROUP BY p.event_id)
SELECT p.*, b.n > 0 AS has_preceding_session_activity, b.n AS preceding_event_count
FROM client p JOIN before b ON p.event_id = b.event_id
"""


def definition(label: str, amount: str, where: str, note: str) -> str:
    return f"""
SELECT '{label}' AS revenue_definition, count(*) AS transaction_count,
  CAST(round({money(amount)}, 2) AS DOUBLE) AS total_revenue, '{note}' AS definition_note
FROM mart WHERE {where}"""


DECOMPOSITION = f"WITH {MART}" + " UNION ALL ".join(
    definition(label, amount, where, DEFINITIONS[label])
    for label, amount, where in (
        ("finance_completed", "server_amount", "conversion_definition_finance"),
        ("marketing_purchase_intents", REPORTED, "conversion_definition_marketing"),
        (
            "variance_dark_revenue",
            "server_amount",
            "attribution_category = 'finance_only' AND conversion_definition_finance",
        ),
        ("variance_failed_but_tracked", REPORTED, "attribution_category = 'marketing_only'"),
    )
)

# --- raw records ------------------------------------------------------------------

RAW_CLIENT = """
deliveries AS (
  SELECT 0 AS delivery, event_id AS n, concat('e', event_id) AS event_id, ts, user_id AS u,
    event_type, props FROM events
  UNION ALL
  SELECT 1, event_id, concat('again-e', event_id), ts, user_id, event_type, props
  FROM events WHERE event_type = 'purchase'),
raw AS (
  SELECT delivery, n, event_id, event_type,
    CASE WHEN event_type = 'signup' THEN strftime(ts, '%d/%m/%Y %H:%M:%S.%f')
      ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS sent,
    CASE WHEN event_type = 'error' THEN CAST(u AS VARCHAR)
      ELSE concat('u', u) END AS user_id,
    event_type = 'error' AS numeric_user,
    CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'add_to_cart'
      WHEN 'purchase' THEN 'purchase_intent' ELSE event_type END AS event_name,
    CASE WHEN event_type <> 'error' THEN CAST(json(props) AS VARCHAR) END AS properties
  FROM deliveries),
kept AS (
  SELECT * FROM raw
  QUALIFY row_number() OVER (PARTITION BY user_id, event_name, sent ORDER BY delivery, n) = 1)
"""


def quoted(text: str) -> str:
    return f"""'"' || {text} || '"'"""


def client_fields(properties: str = "properties") -> str:
    return f"""
  {quoted('event_id')} AS event_id, {quoted('sent')} AS timestamp,
  CASE WHEN numeric_user THEN user_id ELSE {quoted('user_id')} END AS user_id,
  {quoted('event_name')} AS event_name, {properties} AS properties"""


RAW_SERVER = f"""
{TRANSACTIONS},
deliveries AS (
  SELECT 0 AS delivery, * FROM logs
  UNION ALL
  SELECT 1, n, tx_id, user_id, tx_at, ext_id, amount + 1, status FROM logs
  WHERE status = 'failed'),
raw AS (
  SELECT delivery, n, tx_id, strftime(tx_at, '%Y-%m-%dT%H:%M:%S.%fZ') AS sent, user_id,
    CASE WHEN status = 'pending' THEN 'On Hold' ELSE status END AS status,
    CAST(amount AS VARCHAR) AS amount, status = 'refunded' AS text_amount, ext_id
  FROM deliveries),
kept AS (
  SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY tx_id ORDER BY delivery, n) = 1)
"""

SERVER_FIELDS = f"""
  {quoted('tx_id')} AS tx_id, {quoted('sent')} AS timestamp, {quoted('user_id')} AS user_id"""
AMOUNT = f"CASE WHEN text_amount THEN {quoted('amount')} ELSE amount END AS amount"

CLIENT_NAMES = (
    "['add_to_cart', 'checkout', 'page_view', 'purchase', 'purchase_intent', "
    "'search', 'session_start']"
)
SERVER_STATUSES = "['completed', 'failed', 'pending', 'refunded']"


def sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def violation(source, rec, kind, field, value, expected, actual, message, table, where) -> str:
    return f"""
SELECT '{source}' AS source, {rec} AS rec_id, '{kind}' AS kind, '{field}' AS field,
  {value} AS value, {expected} AS expected, {actual} AS actual, {message} AS message
FROM {table} WHERE {where}"""


def unknown_name(table: str) -> str:
    return violation(
        "client_events", "event_id", "UNKNOWN_ENUM", "event_name",
        "'''' || event_name || ''''", sql_text(CLIENT_NAMES), "'str'",
        "'UNKNOWN_ENUM field=event_name value=''' || event_name || ''' allowed=' || "
        f"{sql_text(CLIENT_NAMES)} || ' record=' || event_id",
        table, "event_name IN ('signup', 'error')",
    )


def bad_time(table: str) -> str:
    return violation(
        "client_events", "event_id", "BAD_TIMESTAMP", "timestamp",
        "'''' || sent || ''''", "'ISO 8601'", "'str'",
        "'BAD_TIMESTAMP value=''' || sent || ''' record=' || event_id",
        table, "event_type = 'signup'",
    )


DRIFT_CLIENT = f"WITH {RAW_CLIENT}" + " UNION ALL ".join(
    [
        violation(
            "client_events", "event_id", "MISSING_FIELD", "properties", "NULL", "'dict'", "NULL",
            "'MISSING_FIELD field=properties record=' || event_id",
            "kept", "properties IS NULL",
        ),
        violation(
            "client_events", "event_id", "TYPE_MISMATCH", "user_id", "user_id", "'str'", "'int'",
            "'TYPE_MISMATCH field=user_id expected=str actual=int record=' || event_id",
            "kept", "numeric_user",
        ),
        unknown_name("kept"),
        bad_time("kept"),
    ]
)

DRIFT_SERVER = f"WITH {RAW_SERVER}" + " UNION ALL ".join(
    [
        violation(
            "server_logs", "tx_id", "TYPE_MISMATCH", "amount",
            "'''' || amount || ''''", "'int/float'", "'str'",
            "'TYPE_MISMATCH field=amount expected=int/float actual=str record=' || tx_id",
            "kept", "text_amount",
        ),
        violation(
            "server_logs", "tx_id", "UNKNOWN_ENUM", "status",
            "'''' || status || ''''", sql_text(SERVER_STATUSES), "'str'",
            "'UNKNOWN_ENUM field=status value=''' || status || ''' allowed=' || "
            f"{sql_text(SERVER_STATUSES)} || ' record=' || tx_id",
            "kept", "status = 'On Hold'",
        ),
    ]
)

STATS = f"""
WITH c AS (
  WITH {RAW_CLIENT}
  SELECT 'client_events' AS source, (SELECT count(*) FROM raw) AS total_ingested,
    (SELECT count(*) FROM kept) AS clean,
    (SELECT count(*) FILTER (WHERE properties IS NULL) + count(*) FILTER (WHERE numeric_user)
       + count(*) FILTER (WHERE event_name IN ('signup', 'error'))
       + count(*) FILTER (WHERE event_type = 'signup') FROM kept) AS found),
s AS (
  WITH {RAW_SERVER}
  SELECT 'server_logs' AS source, (SELECT count(*) FROM raw) AS total_ingested,
    (SELECT count(*) FROM kept) AS clean,
    (SELECT count(*) FILTER (WHERE text_amount) + count(*) FILTER (WHERE status = 'On Hold')
     FROM kept) AS found)
SELECT source, total_ingested, total_ingested - clean AS duplicates_removed,
  found AS schema_violations, clean AS clean_records_written
FROM (SELECT * FROM c UNION ALL SELECT * FROM s)
"""

# --- findings -----------------------------------------------------------------------

FINDINGS = f"""
{MART},
totals AS (
  SELECT count(*) AS n,
    count(*) FILTER (WHERE attribution_category = 'marketing_only') AS n_failed,
    {cents(money('client_reported_amount', "attribution_category = 'marketing_only'"))} AS failed,
    count(*) FILTER (WHERE attribution_category = 'finance_only') AS n_dark,
    {cents(money('server_amount', "attribution_category = 'finance_only'"))} AS dark,
    CAST(round(coalesce({money('server_amount', 'conversion_definition_finance')}, 0)
      - coalesce({money('client_reported_amount', 'conversion_definition_marketing')}, 0), 2)
      AS DOUBLE) AS gap,
    (SELECT count(*) FROM client WHERE event_name = 'session_start') AS starts
  FROM mart),
findings AS (
  SELECT 'R-ATTR' AS rule_id, n_failed AS n, failed AS amount,
    printf('%d transactions without a completed payment have a purchase event;'
      || ' marketing counts %.2f for them.', n_failed, failed) AS description,
    'high' AS severity, 'ATTRIBUTION_ERROR' AS category,
    printf('%.2f of conversion credit without revenue.', failed) AS financial_impact,
    'Count a purchase event as a conversion only once its payment is completed.' AS recommended_fix,
    'The event fires at checkout, the payment is decided afterwards.' AS why
  FROM totals WHERE n_failed > 0
  UNION ALL
  SELECT 'R-DARK', n_dark, dark,
    printf('%d completed transactions worth %.2f have no purchase event.', n_dark, dark),
    'high', 'DARK_REVENUE', printf('%.2f of revenue without attribution.', dark),
    'Record the sales channel when a transaction is created.',
    'These transactions were created outside the browser.'
  FROM totals WHERE n_dark > 0
  UNION ALL
  SELECT 'R-GAP', starts, NULL,
    printf('The client feed holds %d session_start events.', starts),
    'medium', 'TRACKING_GAP', 'Session to purchase rates cannot be computed.',
    'Send session_start from the browser and check that no filter removes it.',
    'The event is not part of what the browser sends.'
  FROM totals WHERE starts = 0
  UNION ALL
  SELECT 'R-VAR', n, gap,
    printf('Over %d transactions, recognised revenue exceeds reported revenue by %.2f.', n, gap),
    'high', 'REVENUE_VARIANCE', printf('%.2f between the two reports.', gap),
    'Report both definitions with the categories that separate them.',
    'Untracked revenue and unpaid purchase events do not cancel out.'
  FROM totals WHERE gap <> 0)
"""

# Verified from the staging tables with semi and anti joins.
VERIFIED = f"""
{FINDINGS},
intents AS (SELECT event_id, event_value FROM client WHERE event_name = 'purchase_intent'),
unpaid AS (
  SELECT count(*) AS n, {cents(money('event_value'))} AS amount
  FROM server JOIN intents ON client_event_id = event_id WHERE NOT is_revenue_recognized),
dark AS (
  SELECT count(*) AS n, {cents(money('transaction_amount'))} AS amount
  FROM server WHERE is_revenue_recognized
    AND NOT EXISTS (SELECT 1 FROM intents WHERE event_id = client_event_id)),
gap AS (
  SELECT (SELECT count(*) FROM server) AS n, CAST(round(
    (SELECT {money('transaction_amount')} FROM server WHERE is_revenue_recognized)
    - (SELECT {money('event_value')} FROM server JOIN intents ON client_event_id = event_id),
    2) AS DOUBLE) AS amount),
sources AS (
  SELECT 'R-ATTR' AS rule_id, n AS source_n, amount AS source_amount FROM unpaid
  UNION ALL SELECT 'R-DARK', n, amount FROM dark
  UNION ALL SELECT 'R-GAP', count(*), NULL FROM client WHERE event_name = 'session_start'
  UNION ALL SELECT 'R-VAR', n, amount FROM gap),
judged AS (
  SELECT f.*, s.*  EXCLUDE (rule_id),
    n = source_n AND amount IS NOT DISTINCT FROM source_amount AS verified
  FROM findings f JOIN sources s ON f.rule_id = s.rule_id),
verified AS (
  SELECT rule_id, n, amount, description, severity, category, financial_impact, recommended_fix,
    verified, CASE WHEN verified THEN 'confirmed' ELSE 'modeling_artifact' END AS verdict,
    CASE WHEN source_amount IS NULL THEN printf('Sources: %d rows.', source_n)
      ELSE printf('Sources: %d rows, %.2f.', source_n, source_amount) END AS raw_evidence,
    CASE WHEN verified THEN why
      ELSE 'The staged sources do not show the figures of the mart.' END AS explanation,
    CASE WHEN verified THEN 'high' ELSE 'low' END AS confidence
  FROM judged)
"""


def report(where: str) -> str:
    return f"""
WITH {VERIFIED}
SELECT printf('A%03d', row_number() OVER (ORDER BY rule_id)) AS anomaly_id, description, severity,
  category, financial_impact, verified, verdict, raw_evidence, explanation, confidence,
  recommended_fix, 1 AS iteration
FROM verified WHERE {where}"""


def first_three(category: str) -> str:
    return f"""
WITH {MART} SELECT * FROM mart WHERE attribution_category = '{category}'
ORDER BY transaction_at, transaction_id LIMIT 3"""


READ_RECORDS = f"WITH {RAW_CLIENT} SELECT {client_fields()} FROM raw"
CLEAN_PROPERTIES = "coalesce(properties, '{}')"

ORACLES: dict[str, str] = {
    "read_records": READ_RECORDS,
    "dedup_client": f"WITH {RAW_CLIENT} SELECT {client_fields()} FROM kept",
    "dedup_server": f"""
WITH {RAW_SERVER}
SELECT {SERVER_FIELDS}, coalesce({quoted('status')}, 'null') AS status, {AMOUNT},
  CASE WHEN ext_id IS NULL THEN 'null' ELSE '{{"ext_id":"' || ext_id || '"}}' END AS meta
FROM kept""",
    "drift_client": DRIFT_CLIENT,
    "drift_server": DRIFT_SERVER,
    "drift_enum": f"WITH {CLIENT}" + unknown_name("client"),
    "drift_timestamp": f"WITH {RAW_CLIENT}" + bad_time("raw"),
    "normalize_client": f"""
WITH {RAW_CLIENT} SELECT {client_fields(CLEAN_PROPERTIES)}, 'client' AS _source FROM raw""",
    "normalize_server": f"""
WITH {RAW_SERVER}
SELECT {SERVER_FIELDS}, {quoted('status')} AS status, {AMOUNT}, {quoted('ext_id')} AS ext_id,
  'server' AS _source
FROM raw""",
    "extraction_stats": STATS,
    "total_violations": f"""
SELECT CAST(sum(schema_violations) AS BIGINT) AS total_schema_violations FROM ({STATS})""",
    "write_clean": f"""
WITH {RAW_CLIENT} SELECT {client_fields(CLEAN_PROPERTIES)}, 'client' AS _source FROM kept""",
    "write_drift": DRIFT_SERVER,
    "stg_client_events": f"WITH {CLIENT} SELECT * FROM client",
    "stg_server_logs": f"WITH {SERVER} SELECT * FROM server",
    "int_user_journey": f"WITH {STAGED} {JOURNEY}",
    "journey_link_first": LINK_FIRST,
    "mart_reconciliation": f"WITH {MART} SELECT * FROM mart",
    "finance_daily": f"WITH {MART} {FINANCE_DAILY}",
    "marketing_daily": f"WITH {MART} {MARKETING_DAILY}",
    "revenue_by_source": f"WITH {MART} {FINANCE_DAILY} UNION ALL {MARKETING_DAILY}",
    "mart_revenue_summary": summary("coalesce(f.report_date, m.report_date)"),
    "mart_revenue_summary_reference_dates": summary("f.report_date"),
    "attribution_snapshot": f"""
WITH {MART}
SELECT attribution_category, count(*) AS transactions,
  CAST(round({money('server_amount')}, 2) AS DOUBLE) AS server_revenue,
  CAST(round({money(REPORTED)}, 2) AS DOUBLE) AS client_revenue
FROM mart GROUP BY 1 ORDER BY transactions DESC, attribution_category""",
    "model_row_counts": f"""
WITH {MART}, journey AS ({JOURNEY}),
days AS (
  SELECT DISTINCT CAST(transaction_at AS DATE) FROM mart
  WHERE conversion_definition_finance OR conversion_definition_marketing)
SELECT 'stg_client_events' AS model, count(*) AS row_count FROM client
UNION ALL SELECT 'stg_server_logs', count(*) FROM server
UNION ALL SELECT 'int_user_journey', count(*) FROM journey
UNION ALL SELECT 'mart_reconciliation', count(*) FROM mart
UNION ALL SELECT 'mart_revenue_summary', count(*) FROM days""",
    "write_mart": f"WITH {MART} SELECT * FROM mart",
    "save_models": f"""
WITH {MART} SELECT attribution_category, transaction_status, count(*) AS transactions
FROM mart GROUP BY ALL""",
    "summary_by_category": f"""
WITH {MART}
SELECT attribution_category, count(*) AS count,
  CAST(coalesce({money('server_amount')}, 0) AS DOUBLE) AS server_total,
  CAST(coalesce({money('client_reported_amount')}, 0) AS DOUBLE) AS client_total
FROM mart GROUP BY 1""",
    "summary_mart": f"""
WITH {MART}
SELECT count(*) AS total_transactions,
  {cents(money('server_amount', 'conversion_definition_finance'))} AS finance_revenue_completed,
  {cents(money('client_reported_amount', 'conversion_definition_marketing'))}
    AS marketing_revenue_purchase_intents,
  CAST(round(coalesce({money('server_amount', 'conversion_definition_finance')}, 0)
    - coalesce({money('client_reported_amount', 'conversion_definition_marketing')}, 0), 2)
    AS DOUBLE) AS net_revenue_gap_finance_minus_marketing,
  count(*) FILTER (WHERE attribution_category = 'marketing_only')
    AS failed_transactions_with_client_tracking,
  {cents(money('client_reported_amount', "attribution_category = 'marketing_only'"))}
    AS failed_value_marketing_claims,
  count(*) FILTER (WHERE attribution_category = 'finance_only')
    AS dark_transactions_no_client_event,
  {cents(money('server_amount', "attribution_category = 'finance_only'"))}
    AS dark_revenue_finance_sees
FROM mart""",
    "sample_failed_but_tracked": first_three("marketing_only"),
    "sample_dark_revenue": first_three("finance_only"),
    "client_event_counts": f"""
WITH {CLIENT} SELECT event_name, count(*) AS events FROM client GROUP BY 1""",
    "summary_client": f"""
WITH {CLIENT}
SELECT count(*) AS total_events,
  count(*) FILTER (WHERE event_name = 'session_start') > 0 AS has_session_start_events,
  count(*) FILTER (WHERE event_name = 'purchase_intent') AS purchase_intent_count,
  {cents(money('event_value', "event_name = 'purchase_intent'"))} AS purchase_intent_value_total
FROM client""",
    "repeated_event_ids": f"""
WITH {RAW_CLIENT}
SELECT event_id, count(*) AS records
FROM (SELECT event_id FROM raw UNION ALL SELECT event_id FROM raw)
GROUP BY 1 HAVING count(*) > 1""",
    "server_status_counts": f"""
WITH {TRANSACTIONS} SELECT status, count(*) AS transactions FROM logs GROUP BY 1""",
    "summary_server": f"""
WITH {TRANSACTIONS}
SELECT count(*) AS total_transactions, count(ext_id) AS transactions_with_client_link,
  count(*) FILTER (WHERE ext_id IS NULL) AS transactions_without_client_link,
  {cents(money('amount', "ext_id IS NULL AND status = 'completed'"))}
    AS revenue_without_client_link
FROM logs""",
    "mart_reconciliation_corrected": f"""
WITH {MART}
SELECT *,
  CASE WHEN conversion_definition_finance = false THEN false
    ELSE conversion_definition_marketing END AS conversion_definition_marketing_corrected,
  conversion_definition_marketing AND NOT conversion_definition_finance
    AS was_overcounted_by_marketing
FROM mart""",
    "server_logs_with_channel": f"""
WITH {SERVER}
SELECT *, CASE WHEN client_event_id IS NULL THEN 'unattributed' ELSE 'client_tracked' END
    AS attribution_channel,
  client_event_id IS NULL AS is_dark_transaction
FROM server""",
    "session_check": SESSION_CHECK,
    "revenue_decomposition": DECOMPOSITION,
    "audit_findings": f"WITH {FINDINGS} SELECT * EXCLUDE (why) FROM findings",
    "audit_verified": f"WITH {VERIFIED} SELECT * FROM verified",
    "new_findings": report("rule_id NOT IN ('R-ATTR', 'R-GAP')"),
    "write_report": report("true"),
    "report_counts": f"""
WITH {VERIFIED}
SELECT count(*) AS findings, count(*) FILTER (WHERE verified) AS verified_findings
FROM verified""",
    "missing_event_types": f"""
WITH {CLIENT},
expected AS (SELECT unnest({CLIENT_NAMES}) AS event_name)
SELECT event_name FROM expected WHERE event_name NOT IN (SELECT event_name FROM client)""",
    "stream_dedup": f"""
WITH {RAW_CLIENT}
SELECT DISTINCT CASE WHEN numeric_user THEN user_id ELSE {quoted('user_id')} END AS user_id,
  {quoted('event_name')} AS event_name, {quoted('sent')} AS timestamp
FROM raw""",
    "stream_landed_journey": f"WITH {STAGED} {JOURNEY}",
    "stream_journey": f"WITH {STAGED} {JOURNEY}",
    "stream_matched_journey": f"WITH {STAGED} {JOURNEY}",
}

# A stream that takes all files in keeps what batch keeps.
ORACLES["stream_upsert"] = ORACLES["dedup_client"]
# A published version holds what session views hold.
ORACLES["save_models_db"] = ORACLES["save_models"]
# Arrays hold what lines hold.
ORACLES["read_array"] = ORACLES["read_records"]
