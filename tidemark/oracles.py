"""The same results as plain SQL over the given tables, for comparison.

Written independently of the Spark side: common table expressions rebuild the
layers, and averages are integer arithmetic on cents.
"""

from tidemark.schemas import CREDIT_TYPES, DEBIT_TYPES

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"


def _texts(values):
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _by(*columns):
    """Ascending order with NULL first, as Spark has it."""
    return ", ".join(f"{c} NULLS FIRST" for c in columns)


def _top(relation, n, order, columns, condition="true"):
    """The first ``n`` rows; equal ones are told apart by the shown columns."""
    names = [c.strip() for c in columns.split(",")]
    return f"SELECT {columns} FROM {relation} WHERE {condition} ORDER BY {order}, {_by(*names)} LIMIT {n}"


# -- building blocks -----------------------------------------------------------------

AMOUNT = """CASE WHEN event_id % 101 = 0 THEN -value
                 WHEN event_id % 103 = 0 THEN 0.0
                 WHEN event_id % 50 = 0 THEN value * 1000
                 ELSE value END"""

DELIVERIES = f"""
copies AS (
    SELECT *, 0 AS copy FROM events
    UNION ALL
    SELECT *, 1 AS copy FROM events WHERE event_id % 20 = 0
),
deliveries AS (
    SELECT *,
        (user_id * 3 + event_id) % 10 AS place,
        event_id * 2 + copy AS "offset",
        CAST(user_id % 3 AS INTEGER) AS "partition",
        CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS BIGINT) AS _batch_id,
        'TXN-' || event_id AS transaction_id,
        strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS "timestamp",
        'ACC' || (1000 + user_id) AS account_id,
        CASE event_type WHEN 'purchase' THEN 'PURCHASE' WHEN 'view' THEN 'WITHDRAWAL'
             WHEN 'signup' THEN 'DEPOSIT' WHEN 'click' THEN 'TRANSFER' WHEN 'error' THEN 'PAYMENT' END AS transaction_type,
        CASE WHEN copy = 1 AND event_id % 60 = 0 THEN ({AMOUNT}) + 1 ELSE ({AMOUNT}) END AS amount,
        'USD' AS currency,
        CASE WHEN event_type IN ('purchase', 'error') AND event_id % 37 <> 0
             THEN 'MERCH-' || ((user_id * 7 + event_id) % 14) END AS merchant,
        'CUST' || (100 + user_id) AS customer_id,
        event_id % 50 = 0 AS is_fraud,
        CASE WHEN event_id % 11 = 0 THEN 'DECLINED' WHEN event_id % 7 = 0 THEN 'FAILED'
             WHEN event_id % 5 = 0 THEN 'COMPLETED' ELSE 'PENDING' END AS status,
        CASE event_id % 4 WHEN 0 THEN 'mobile' WHEN 1 THEN 'web' WHEN 2 THEN 'atm' ELSE 'pos' END AS device_type,
        ts + CASE WHEN copy = 1 THEN INTERVAL 90 SECOND ELSE INTERVAL 30 SECOND END AS ingestion_timestamp,
        strftime(ts, '%Y-%m-%d') AS date_partition
    FROM copies
),
bronze AS (
    SELECT *, CAST(amount AS DECIMAL(18,2)) AS money, CAST(amount AS DECIMAL(24,6)) AS exact FROM deliveries
)
"""

SILVER = (
    DELIVERIES
    + f""",
ranked AS (
    SELECT *, row_number() OVER (
        PARTITION BY date_partition, transaction_id
        ORDER BY {_by("ingestion_timestamp", '"timestamp"', "account_id", "transaction_type", "amount", "merchant", "status")}
    ) AS delivery
    FROM bronze
),
silver AS (
    SELECT transaction_id, account_id, transaction_type, money AS amount, currency, merchant,
        ts AS transaction_timestamp, status, amount > 10000 AS is_flagged, 'VALID' AS validation_status,
        {AS_OF} AS processing_timestamp, CAST(date_partition AS DATE) AS date_partition
    FROM ranked
    WHERE delivery = 1 AND amount > 0 AND status IN ('COMPLETED', 'PENDING', 'FAILED')
)
"""
)

DEBITS = f"SUM(CASE WHEN transaction_type IN {_texts(DEBIT_TYPES)} THEN amount ELSE 0 END)"
CREDITS = f"SUM(CASE WHEN transaction_type IN {_texts(CREDIT_TYPES)} THEN amount ELSE 0 END)"
NET = f"SUM(CASE WHEN transaction_type IN {_texts(CREDIT_TYPES)} THEN amount ELSE -amount END)"


def _total(expression):
    return f"CAST({expression} AS DECIMAL(28,2))"


def _ratio(numerator, denominator, scale):
    """numerator / denominator in units of 10**-scale, half away from zero."""
    n, d = f"(abs({numerator}) * {10**scale}::HUGEINT)", f"({denominator})"
    return f"((2 * {n} + {d}) // (2 * {d}))"


def _mean(column, scale=2):
    """Average of decimals: first to ``scale`` + 4 digits, then to cents."""
    units = f"SUM(CAST({column} * {10**scale} AS HUGEINT))"
    fine = _ratio(units, f"COUNT({column})", 4)
    step = 10 ** (scale + 2)
    return f"CAST(sign({units}) * (({fine} + {step // 2}) // {step}) / 100.0 AS DECIMAL(18,2))"


GOLD = (
    SILVER
    + f""",
accounts AS (
    SELECT account_id, date_partition AS transaction_date,
        COUNT(*) AS total_transactions,
        CAST({DEBITS} AS DECIMAL(18,2)) AS total_debits,
        CAST({CREDITS} AS DECIMAL(18,2)) AS total_credits,
        CAST({NET} AS DECIMAL(18,2)) AS net_amount,
        {_mean("amount")} AS avg_transaction_amount,
        MAX(amount) AS max_transaction_amount,
        MIN(amount) AS min_transaction_amount,
        COUNT(DISTINCT merchant) AS distinct_merchants,
        COUNT(*) FILTER (WHERE is_flagged) AS flagged_transactions,
        {AS_OF} AS processing_timestamp
    FROM silver GROUP BY account_id, date_partition
),
merchants AS (
    SELECT merchant, date_partition AS transaction_date,
        COUNT(*) AS total_transactions,
        CAST(SUM(amount) AS DECIMAL(18,2)) AS total_amount,
        {_mean("amount")} AS avg_amount,
        COUNT(DISTINCT account_id) AS unique_accounts,
        {AS_OF} AS processing_timestamp
    FROM silver WHERE merchant IS NOT NULL GROUP BY merchant, date_partition
)
"""
)

FLAT = """transaction_id, "timestamp", account_id, transaction_type, amount, currency, merchant,
    'City-' || place AS city, 'State-' || (place % 7) AS state, 'US' AS country,
    CAST(place + 25 AS DOUBLE) AS latitude, CAST(-place - 65 AS DOUBLE) AS longitude,
    customer_id, 'Customer ' || user_id AS name, 'c' || user_id || '@example.com' AS email, '555-' || user_id AS phone,
    is_fraud, status, device_type, '10.0.0.' || (event_id % 256) AS ip_address, 'S-' || event_id AS session_id"""


def _json(**fields):
    """JSON object text; fields whose value is NULL are left out."""
    parts = " || ".join(f"""coalesce(',"{name}":' || {value}, '')""" for name, value in fields.items())
    return f"('{{' || substr({parts}, 2) || '}}')"


def _quoted(expression):
    return f"""'"' || {expression} || '"'"""


JSON = _json(
    transaction_id=_quoted("transaction_id"),
    timestamp=_quoted('"timestamp"'),
    account_id=_quoted("account_id"),
    transaction_type=_quoted("transaction_type"),
    amount="CAST(amount AS VARCHAR)",
    currency=_quoted("currency"),
    merchant=_quoted("merchant"),
    location=_json(
        city=_quoted("'City-' || place"),
        state=_quoted("'State-' || (place % 7)"),
        country=_quoted("'US'"),
        latitude="(place + 25) || '.0'",
        longitude="(-place - 65) || '.0'",
    ),
    customer=_json(
        customer_id=_quoted("customer_id"),
        name=_quoted("'Customer ' || user_id"),
        email=_quoted("'c' || user_id || '@example.com'"),
        phone=_quoted("'555-' || user_id"),
    ),
    is_fraud="CAST(is_fraud AS VARCHAR)",
    status=_quoted("status"),
    metadata=_json(
        device_type=_quoted("device_type"),
        ip_address=_quoted("'10.0.0.' || (event_id % 256)"),
        session_id=_quoted("'S-' || event_id"),
    ),
)
KEYS = "transaction_id, account_id, amount, ingestion_timestamp, date_partition, _batch_id"
DAMAGED = 'coalesce("offset" % 97 = 0, false)'

BUCKETS = (10, 50, 100, 500)
COUNTERS = ("n", "volume", *[f"le_{b}" for b in BUCKETS])

SAMPLES = f"""
per_minute AS (
    SELECT coalesce(event_type, '') AS kind, coalesce('kafka-' || (event_id % 3 + 1), '') AS broker_host,
        date_trunc('minute', ts) AS ts, COUNT(*) AS n, coalesce(SUM(CAST(value AS DECIMAL(18,6))), 0) AS volume,
        {", ".join(f"COUNT(*) FILTER (WHERE value <= {b}) AS le_{b}" for b in BUCKETS)}
    FROM events WHERE ts IS NOT NULL GROUP BY ALL
),
filled AS (
    SELECT *,
        broker_host = 'kafka-2' AND ts >= TIMESTAMP '2024-01-16' AS epoch
    FROM per_minute
),
counters AS (
    SELECT kind, broker_host, ts,
        {", ".join(f"CAST(SUM({c}) OVER (PARTITION BY kind, broker_host, epoch ORDER BY ts) AS DOUBLE) AS {c}" for c in COUNTERS)}
    FROM filled
),
samples AS (
    SELECT 'messages_total' AS metric, kind, broker_host, '' AS mode, '' AS le, ts, n AS value FROM counters
    UNION ALL SELECT 'bytes_total', kind, broker_host, '', '', ts, volume FROM counters
    {" ".join(f"UNION ALL SELECT 'duration_bucket', kind, broker_host, '', '{b}', ts, le_{b} FROM counters" for b in BUCKETS)}
    UNION ALL SELECT 'duration_bucket', kind, broker_host, '', '+Inf', ts, n FROM counters
),
latest AS (
    SELECT metric, kind, broker_host, mode, le, max(ts) AS ts, arg_max(value, ts) AS value
    FROM samples GROUP BY ALL
)
"""


def _rates(seconds):
    """Growth between neighbouring samples, credited to the later one's window."""
    return (
        SAMPLES
        + f""",
steps AS (
    SELECT *, lag(value) OVER (PARTITION BY metric, kind, broker_host, mode, le ORDER BY ts) AS before
    FROM samples
),
rates AS (
    SELECT metric, kind, broker_host, mode, le,
        make_timestamp((CAST(floor(epoch(ts) / {seconds}) AS BIGINT) * {seconds}) * 1000000) AS window_start,
        CAST(SUM(CAST(CASE WHEN before IS NULL THEN 0 WHEN value >= before THEN value - before ELSE value END
            AS DECIMAL(38,6))) AS DOUBLE) / {float(seconds)} AS rate
    FROM steps GROUP BY ALL
)
"""
    )


def _at_steps(value):
    """Every sample counts in the five minutes that end within five minutes behind it."""
    return f"""WITH {SAMPLES},
        steps AS (
            SELECT *, lag(value) OVER (PARTITION BY metric, kind, broker_host, mode, le ORDER BY ts) AS before FROM samples
        ),
        spread AS (SELECT *, unnest(range(1, 6)) AS k FROM steps)
        SELECT kind, broker_host, make_timestamp((CAST(floor(epoch(ts) / 60) AS BIGINT) + k) * 60 * 1000000) AS "at", {value}
        FROM spread"""


EXACT_RATE = "CAST(SUM(CAST(rate AS DECIMAL(38,12))) AS DOUBLE)"

QUANTILE = (
    _rates(86400)
    + f""",
buckets AS (
    SELECT broker_host, window_start,
        CASE WHEN le = '+Inf' THEN CAST('inf' AS DOUBLE) ELSE CAST(le AS DOUBLE) END AS le,
        {EXACT_RATE} AS upto
    FROM rates WHERE metric = 'duration_bucket' GROUP BY ALL
),
ordered AS (
    SELECT *, lag(upto) OVER w AS below, lag(le) OVER w AS lower,
        max(upto) OVER (PARTITION BY broker_host, window_start) * CAST(0.99 AS DOUBLE) AS wanted
    FROM buckets WINDOW w AS (PARTITION BY broker_host, window_start ORDER BY le)
)
SELECT broker_host, window_start,
    CASE WHEN isinf(le) THEN lower
         ELSE coalesce(lower, 0.0::DOUBLE) + (le - coalesce(lower, 0.0::DOUBLE))
              * (wanted - coalesce(below, 0.0::DOUBLE)) / (upto - coalesce(below, 0.0::DOUBLE)) END AS quantile
FROM ordered
WHERE wanted > 0 AND upto >= wanted AND (below IS NULL OR below < wanted)
"""
)

# Columns of the top-n reports.
SAMPLE = 'transaction_id, "timestamp", account_id, transaction_type, amount, currency, is_fraud, status'
RECENT = 'transaction_id, "timestamp", account_id, transaction_type, amount, merchant, is_fraud'
INGESTED = 'transaction_id, "timestamp", account_id, transaction_type, amount, is_fraud, ingestion_timestamp'
FLAGGED = "account_id, transaction_type, amount, merchant, transaction_timestamp, is_flagged"
LATEST = "transaction_id, transaction_timestamp, account_id, transaction_type, amount, merchant, is_flagged"
ACCOUNT_DAY = """account_id, transaction_date, total_transactions, total_debits, total_credits, net_amount,
    flagged_transactions"""
MERCHANT_DAY = "merchant, transaction_date, total_transactions, total_amount, avg_amount, unique_accounts"
SILVER_COLUMNS = """transaction_id, account_id, transaction_type, amount, currency, merchant, transaction_timestamp,
    status, is_flagged, validation_status, processing_timestamp, date_partition"""

ORACLES = {
    # sources and streams
    "envelope_batch_read": f"""WITH {DELIVERIES}
        SELECT account_id AS key, {JSON} AS value, 'transactions.raw' AS topic, "partition", "offset",
            ingestion_timestamp AS "timestamp" FROM bronze""",
    "decode_transactions": f"WITH {DELIVERIES} SELECT {FLAT} FROM bronze",
    "bronze_enrich": f"""WITH {DELIVERIES}
        SELECT {FLAT}, TIMESTAMP '2024-02-01 00:00:00' AS ingestion_timestamp, date_partition FROM bronze""",
    "encode_envelope": f"WITH {DELIVERIES} SELECT account_id AS key, {JSON} AS value FROM bronze",
    "stream_bronze_ingest": f"""WITH {DELIVERIES}
        SELECT {FLAT}, TIMESTAMP '2024-02-01 00:00:00' AS ingestion_timestamp, date_partition FROM bronze""",
    "dead_letter_split": f"""WITH {DELIVERIES}
        SELECT account_id AS key, "partition", "offset", {DAMAGED} AS dead FROM bronze""",
    "stream_dead_letters": f"""WITH {DELIVERIES}
        SELECT account_id AS key, 'garbage' AS value, "partition", "offset"
        FROM bronze WHERE {DAMAGED}""",
    "stream_dedup": f"""WITH {DELIVERIES},
        told AS (
            SELECT *, row_number() OVER (
                PARTITION BY transaction_id ORDER BY ingestion_timestamp NULLS FIRST, "partition" NULLS FIRST, "offset"
            ) AS delivery FROM bronze WHERE transaction_id IS NOT NULL
        )
        SELECT transaction_id, "timestamp", account_id, amount, status FROM told WHERE delivery = 1""",
    "stream_shared_ingest": f"""WITH {DELIVERIES}
        SELECT {FLAT}, TIMESTAMP '2024-02-01 00:00:00' AS ingestion_timestamp, date_partition FROM bronze""",
    "stream_commit_log": f"""WITH {DELIVERIES}
        SELECT TIMESTAMP '2024-02-01 00:00:00' AS committed_at, CAST(0 AS BIGINT) AS snapshot_id, 'append' AS operation,
            COUNT(*) AS records_added FROM bronze GROUP BY coalesce(event_id % 2 <> 0, false)""",
    "stream_unique": f"""WITH {DELIVERIES},
        told AS (
            SELECT *, row_number() OVER (
                PARTITION BY transaction_id ORDER BY ingestion_timestamp NULLS FIRST, "partition" NULLS FIRST, "offset"
            ) AS delivery FROM bronze WHERE transaction_id IS NOT NULL
        )
        SELECT transaction_id, "timestamp", account_id, amount, status FROM told WHERE delivery = 1""",
    "stream_minute_board": f"""WITH {DELIVERIES}
        SELECT date_trunc('minute', ts) AS minute, COUNT(*) AS count FROM bronze
        WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00' GROUP BY 1""",
    "stream_tx_per_minute": f"""WITH {DELIVERIES}
        SELECT date_trunc('minute', ts) AS minute, COUNT(*) AS count FROM bronze WHERE ts IS NOT NULL GROUP BY 1""",
    "stream_open_fields": f"""WITH {DELIVERIES}
        SELECT transaction_id, amount, CASE WHEN "offset" % 3 = 0 THEN 'CH-' || ("offset" % 5) END AS channel,
            CASE WHEN "offset" % 4 = 1 THEN "offset" % 7 END AS app_version,
            COALESCE("offset" % 3 = 0 OR "offset" % 4 = 1, false) AS has_more
        FROM bronze""",
    "enrich_customers": f"""WITH {DELIVERIES}
        SELECT transaction_id, ingestion_timestamp, customer_id, c_name AS customer_name, c_mktsegment AS segment,
            CAST(c_nationkey AS BIGINT) AS nation_key
        FROM bronze LEFT JOIN customer ON 'CUST' || (c_custkey + 100) = customer_id""",
    "enrich_customers_as_of": f"""WITH {DELIVERIES},
        changes AS (
            SELECT 'CUST' || (user_id + 100) AS customer_id, ts AS valid_from, 'PLAN-' || (event_id % 4) AS plan
            FROM events WHERE event_type = 'signup'
            UNION ALL SELECT 'CUST' || (c_custkey + 100), TIMESTAMP '2024-01-02', 'BASIC' FROM customer
        ),
        versions AS (
            SELECT customer_id, valid_from, max(plan) AS plan FROM changes
            WHERE customer_id IS NOT NULL AND valid_from IS NOT NULL GROUP BY 1, 2
        )
        SELECT transaction_id, ingestion_timestamp, b.customer_id, plan, valid_from
        FROM bronze b ASOF LEFT JOIN versions v ON b.customer_id = v.customer_id AND b.ts >= v.valid_from""",
    # layers
    "dedup_transactions": f"""WITH {SILVER}
        SELECT transaction_id, amount, status, ingestion_timestamp, date_partition FROM ranked WHERE delivery = 1""",
    "silver_transactions": f"WITH {SILVER} SELECT {SILVER_COLUMNS} FROM silver",
    "silver_for_date": f"WITH {SILVER} SELECT {SILVER_COLUMNS} FROM silver WHERE date_partition = DATE '2024-01-15'",
    "default_yesterday_filter": f"""WITH {SILVER}
        SELECT {SILVER_COLUMNS} FROM silver WHERE date_partition = DATE '2024-01-30'""",
    "gold_daily_account_summary": f"WITH {GOLD} SELECT * FROM accounts",
    "gold_merchant_summary": f"WITH {GOLD} SELECT * FROM merchants",
    **{
        f"gold_{name}_summary": f"""WITH {GOLD}
            SELECT CAST(date_trunc('{unit}', transaction_date) AS DATE) AS {unit}_start,
                CAST(SUM(total_transactions) AS BIGINT) AS total_transactions,
                {_total("SUM(total_debits)")} AS total_debits, {_total("SUM(total_credits)")} AS total_credits,
                {_total("SUM(net_amount)")} AS net_amount,
                CAST(SUM(flagged_transactions) AS BIGINT) AS flagged_transactions
            FROM accounts GROUP BY 1"""
        for name, unit in (("weekly", "week"), ("monthly", "month"))
    },
    "gold_caught_up": f"WITH {GOLD} SELECT * FROM accounts",
    "gold_weekly_distinct": f"""WITH {SILVER}
        SELECT CAST(date_trunc('week', date_partition) AS DATE) AS week_start,
            COUNT(DISTINCT merchant) AS distinct_merchants, COUNT(DISTINCT account_id) AS distinct_accounts
        FROM silver GROUP BY 1""",
    "account_monthly_merchants": f"""WITH {SILVER}
        SELECT account_id, CAST(date_trunc('month', date_partition) AS DATE) AS month_start,
            COUNT(DISTINCT merchant) AS distinct_merchants
        FROM silver WHERE merchant IS NOT NULL GROUP BY ALL""",
    "layers_backfilled": f"""WITH {GOLD}
        SELECT transaction_date, a.transactions, a.net_amount, m.merchant_amount
        FROM (SELECT transaction_date, CAST(SUM(total_transactions) AS BIGINT) AS transactions,
                  {_total("SUM(net_amount)")} AS net_amount FROM accounts GROUP BY 1) a
        LEFT JOIN (SELECT transaction_date, {_total("SUM(total_amount)")} AS merchant_amount FROM merchants GROUP BY 1) m
        USING (transaction_date) WHERE transaction_date IS NOT NULL""",
    # bronze reports
    "bronze_count": f"WITH {DELIVERIES} SELECT COUNT(*) AS total_records FROM bronze",
    "bronze_sample": f"WITH {DELIVERIES} {_top('bronze', 10, 'transaction_id NULLS FIRST', SAMPLE)}",
    "bronze_type_summary": f"""WITH {DELIVERIES}
        SELECT transaction_type, COUNT(*) AS count, {_mean("exact", 6)} AS avg_amount, MIN(money) AS min_amount,
            MAX(money) AS max_amount FROM bronze GROUP BY transaction_type""",
    "bronze_fraud_summary": f"""WITH {DELIVERIES}
        SELECT is_fraud, COUNT(*) AS count, {_mean("exact", 6)} AS avg_amount FROM bronze GROUP BY is_fraud""",
    "bronze_type_totals": f"""WITH {DELIVERIES}
        SELECT transaction_type, COUNT(*) AS count, {_total("SUM(exact)")} AS total_amount FROM bronze GROUP BY 1""",
    "type_totals_last_7d": f"""WITH {DELIVERIES}
        SELECT transaction_type, COUNT(*) AS count, {_total("SUM(exact)")} AS total_amount
        FROM bronze WHERE date_partition >= '2024-01-24' GROUP BY 1""",
    "bronze_type_counts": f"WITH {DELIVERIES} SELECT transaction_type, COUNT(*) AS count FROM bronze GROUP BY 1",
    "bronze_freshness": f"WITH {DELIVERIES} SELECT MAX(ingestion_timestamp) AS latest_ingestion FROM bronze",
    "bronze_partition_totals": f"""WITH {DELIVERIES}
        SELECT date_partition, COUNT(*) AS transaction_count, {_total("SUM(exact)")} AS total_amount
        FROM bronze GROUP BY 1""",
    "bronze_day_count": f"WITH {DELIVERIES} SELECT COUNT(*) AS bronze_count FROM bronze WHERE date_partition = '2024-01-30'",
    "bronze_recent": f"""WITH {DELIVERIES} {_top('bronze', 100, '"timestamp" DESC', RECENT)}""",
    "bronze_recently_ingested": f"WITH {DELIVERIES} {_top('bronze', 10, 'ingestion_timestamp DESC', INGESTED)}",
    "fraud_by_customer": f"""WITH {DELIVERIES}
        SELECT customer_id, COUNT(*) AS suspicious_txn_count, {_total("SUM(exact)")} AS total_amount,
            MAX(date_partition) AS last_date
        FROM bronze WHERE is_fraud AND date_partition >= '2024-01-30' GROUP BY customer_id""",
    "bronze_merchant_totals": f"""WITH {DELIVERIES}
        SELECT merchant, COUNT(*) AS count, {_total("SUM(exact)")} AS total_amount
        FROM bronze WHERE merchant IS NOT NULL GROUP BY merchant""",
    "bronze_hourly_by_type": f"""WITH {DELIVERIES}
        SELECT date_trunc('hour', ts) AS hour, transaction_type, COUNT(*) AS count, {_mean("exact", 6)} AS avg_amount
        FROM bronze WHERE ts > {AS_OF} - INTERVAL 24 HOUR AND ts <= {AS_OF} GROUP BY 1, 2""",
    "bronze_last_hour": f"""WITH {DELIVERIES}
        SELECT COUNT(*) AS count, {_total("SUM(exact)")} AS total_amount
        FROM bronze WHERE ts > {AS_OF} - INTERVAL 1 HOUR AND ts <= {AS_OF}""",
    **{
        key: f"WITH {DELIVERIES} SELECT {FLAT}, ingestion_timestamp, date_partition FROM bronze WHERE {condition}"
        for key, condition in (
            ("bronze_partition_scan", "date_partition = '2024-01-17'"),
            ("bronze_prefix_scan", "\"timestamp\" LIKE '2024-01-17%'"),
        )
    },
    # silver reports
    "silver_daily_volume": f"""WITH {SILVER}
        SELECT date_partition AS date, COUNT(*) AS transactions, {_total("SUM(amount)")} AS total_amount
        FROM silver GROUP BY 1""",
    "silver_range_filter": f"""WITH {SILVER}
        SELECT {SILVER_COLUMNS} FROM silver
        WHERE transaction_timestamp >= TIMESTAMP '2024-01-10 06:00:00'
          AND transaction_timestamp < TIMESTAMP '2024-01-20 18:00:00' AND account_id = 'ACC1007'""",
    "silver_type_totals": f"""WITH {SILVER}
        SELECT transaction_type, COUNT(*) AS count, {_total("SUM(amount)")} AS total_amount FROM silver GROUP BY 1""",
    "silver_flag_counts": f"WITH {SILVER} SELECT is_flagged, COUNT(*) AS count FROM silver GROUP BY 1",
    "silver_flagged_count": f"WITH {SILVER} SELECT COUNT(*) AS flagged FROM silver WHERE is_flagged",
    "silver_top_flagged": f"WITH {SILVER} {_top('silver', 50, 'amount DESC', FLAGGED, 'is_flagged')}",
    "silver_latest_hour": f"""WITH {SILVER}
        {_top('silver', 100, 'transaction_timestamp DESC', LATEST, f'transaction_timestamp > {AS_OF} - INTERVAL 1 HOUR')}""",
    "flagged_accounts": f"""WITH {SILVER}
        SELECT account_id, COUNT(*) AS flagged_count, {_total("SUM(amount)")} AS total_flagged_amount,
            MAX(amount) AS max_transaction
        FROM silver WHERE is_flagged AND transaction_timestamp > TIMESTAMP '2024-01-01 00:00:00'
        GROUP BY account_id HAVING COUNT(*) > 3""",
    "busy_accounts": f"WITH {SILVER} SELECT account_id, COUNT(*) AS cnt FROM silver GROUP BY 1 HAVING COUNT(*) > 50",
    "silver_account_totals": f"""WITH {SILVER}
        SELECT account_id, COUNT(*) AS count, {_total("SUM(amount)")} AS total_amount FROM silver GROUP BY 1""",
    "account_debit_credit_check": f"""WITH {SILVER}
        SELECT account_id, COUNT(*) AS tx_count, {_total(DEBITS)} AS debits, {_total(CREDITS)} AS credits
        FROM silver GROUP BY 1""",
    # gold reports and joins
    "gold_accounts_top": f"WITH {GOLD} {_top('accounts', 100, 'transaction_date DESC, net_amount DESC', ACCOUNT_DAY)}",
    "gold_account_totals": f"""WITH {GOLD}
        SELECT CAST(SUM(total_transactions) AS BIGINT) AS total_tx, {_total("SUM(total_debits)")} AS total_debits,
            {_total("SUM(total_credits)")} AS total_credits FROM accounts""",
    "gold_top_merchants": f"""WITH {GOLD}
        {_top("merchants", 20, "total_amount DESC", MERCHANT_DAY, "transaction_date = DATE '2024-01-30'")}""",
    "gold_top_merchants_all": f"WITH {GOLD} {_top('merchants', 10, 'total_amount DESC', MERCHANT_DAY)}",
    "merchants_over_threshold": f"WITH {GOLD} {_top('merchants', 20, 'total_amount DESC', MERCHANT_DAY, 'total_amount > 1000')}",
    "merchant_trend": f"""WITH {GOLD}
        SELECT merchant, transaction_date, total_transactions, total_amount FROM merchants""",
    "merchant_cross_layer": f"""WITH {GOLD}
        SELECT m.merchant, m.total_transactions, COUNT(DISTINCT s.account_id) AS unique_customers,
            {_total("SUM(s.amount)")} AS total_revenue
        FROM merchants m JOIN silver s ON m.merchant = s.merchant
        GROUP BY m.merchant, m.total_transactions
        ORDER BY total_revenue DESC, m.merchant, m.total_transactions LIMIT 10""",
    "merchant_weekly_growth": f"""WITH {GOLD},
        current_week AS (
            SELECT merchant, SUM(total_amount) AS amount FROM merchants
            WHERE transaction_date >= DATE '2024-01-24' GROUP BY merchant
        ),
        previous_week AS (
            SELECT merchant, SUM(total_amount) AS amount FROM merchants
            WHERE transaction_date >= DATE '2024-01-17' AND transaction_date < DATE '2024-01-24' GROUP BY merchant
        ),
        cents AS (
            SELECT c.merchant, c.amount AS c, p.amount AS p, CAST((c.amount - p.amount) * 100 AS HUGEINT) AS d,
                nullif(CAST(p.amount * 100 AS HUGEINT), 0) AS b
            FROM current_week c LEFT JOIN previous_week p ON c.merchant = p.merchant
        )
        SELECT merchant, {_total("c")} AS current_week_revenue, {_total("p")} AS previous_week_revenue,
            CAST(sign(d) * (({_ratio("d", "b", 8)} + 5000) // 10000) / 100.0 AS DECIMAL(18,2)) AS growth_pct
        FROM cents ORDER BY c DESC, merchant LIMIT 20""",
    # dashboards and metrics of the layers
    "kpi_tiles": f"""WITH {DELIVERIES}
        SELECT COUNT(*) AS total_transactions, {_total("SUM(exact)")} AS total_amount, {_mean("exact", 6)} AS avg_amount,
            COUNT(*) FILTER (WHERE is_fraud) AS fraud_count FROM bronze""",
    "tx_daily": f"""WITH {SILVER}
        SELECT date_partition AS day, COUNT(*) AS count, {_total("SUM(amount)")} AS total_amount FROM silver GROUP BY 1""",
    "tx_daily_by_type": f"""WITH {SILVER}
        SELECT date_partition AS day, transaction_type, COUNT(*) AS count FROM silver GROUP BY 1, 2""",
    "tx_detail_table": f"""WITH {SILVER}
        SELECT account_id, merchant, transaction_type, COUNT(*) AS count, {_total("SUM(amount)")} AS total_amount,
            {_mean("amount")} AS avg_amount
        FROM silver WHERE date_partition BETWEEN DATE '2024-01-05' AND DATE '2024-01-25' AND amount >= 10
        GROUP BY 1, 2, 3""",
    "tx_per_minute": f"""WITH {DELIVERIES}
        SELECT date_trunc('minute', ts) AS minute, COUNT(*) AS count
        FROM bronze WHERE ts > {AS_OF} - INTERVAL 1 HOUR AND ts <= {AS_OF} GROUP BY 1""",
    "tx_hourly_board": f"""WITH {DELIVERIES},
        steps AS (
            SELECT hour, transaction_type
            FROM (SELECT unnest(generate_series(
                    TIMESTAMP '2024-01-30 00:00:00', TIMESTAMP '2024-01-30 23:00:00', INTERVAL 1 HOUR)) AS hour),
                (SELECT unnest({sorted(DEBIT_TYPES + CREDIT_TYPES)}) AS transaction_type)
        ),
        counts AS (
            SELECT date_trunc('hour', ts) AS hour, transaction_type, COUNT(*) AS n FROM bronze
            WHERE ts >= TIMESTAMP '2024-01-30 00:00:00' AND ts <= TIMESTAMP '2024-01-30 23:30:00' GROUP BY 1, 2
        )
        SELECT hour, transaction_type, COALESCE(n, 0) AS count FROM steps FULL JOIN counts USING (hour, transaction_type)""",
    "tx_daily_trend": f"""WITH {SILVER},
        days AS (SELECT CAST(unnest(generate_series(
            TIMESTAMP '2024-01-20', TIMESTAMP '2024-02-08', INTERVAL 1 DAY)) AS DATE) AS day),
        found AS (SELECT date_partition AS day, COUNT(*) AS n, SUM(amount) AS amount FROM silver GROUP BY 1)
        SELECT day, COALESCE(n, 0) AS count, CAST(COALESCE(amount, 0) AS DECIMAL(28,2)) AS total_amount
        FROM days LEFT JOIN found USING (day)""",
    "fraud_by_type": f"""WITH {DELIVERIES}
        SELECT transaction_type, COUNT(*) AS fraud_count FROM bronze WHERE is_fraud GROUP BY 1""",
    "fraud_by_location": f"""WITH {DELIVERIES}
        SELECT 'State-' || (place % 7) AS state, 'City-' || place AS city, COUNT(*) AS fraud_count,
            {_total("SUM(exact)")} AS total_amount, CAST(place + 25 AS DOUBLE) AS latitude,
            CAST(-place - 65 AS DOUBLE) AS longitude
        FROM bronze WHERE is_fraud GROUP BY place""",
    "today_counts": f"""WITH {SILVER}
        SELECT COUNT(*) AS total_transactions, COUNT(*) FILTER (WHERE is_flagged) AS flagged_transactions
        FROM silver WHERE date_partition = DATE '2024-01-30'""",
    "metric_fraud_rate": f"""WITH {DELIVERIES}
        SELECT CAST(COUNT(*) FILTER (WHERE is_fraud) AS DOUBLE) / COUNT(*) AS fraud_rate FROM bronze""",
    "metric_avg_value": f"WITH {SILVER} SELECT {_mean('amount')} AS avg_transaction_value FROM silver",
    "metric_revenue": f"""WITH {DELIVERIES}
        SELECT {_total("SUM(CASE WHEN transaction_type IN ('PURCHASE', 'PAYMENT') THEN exact ELSE 0 END)")} AS revenue
        FROM bronze""",
    # data quality
    "dq_duplicate_audit": f"""WITH {DELIVERIES}
        SELECT COUNT(*) AS total, COUNT(DISTINCT transaction_id) AS unique_ids FROM bronze""",
    "dq_silver_duplicate_audit": f"""WITH {SILVER}
        SELECT COUNT(*) AS total, COUNT(DISTINCT transaction_id) AS unique_ids FROM silver""",
    "dq_validation_counts": f"WITH {SILVER} SELECT validation_status, COUNT(*) AS count FROM silver GROUP BY 1",
    "dq_amount_bounds": f"""WITH {SILVER}
        SELECT MIN(amount) AS min_amount, MAX(amount) AS max_amount, {_mean("amount")} AS avg_amount FROM silver""",
    "dq_pass_rate": f"""WITH {SILVER}
        SELECT date_partition, COUNT(*) AS record_count,
            CAST(COUNT(*) FILTER (WHERE validation_status = 'VALID') AS DOUBLE) / COUNT(*) AS pass_rate
        FROM silver GROUP BY 1""",
    "dq_gold_matches_silver": f"""WITH {GOLD},
        s AS (SELECT date_partition AS transaction_date, COUNT(*) AS silver_rows FROM silver GROUP BY 1),
        g AS (SELECT transaction_date, CAST(SUM(total_transactions) AS BIGINT) AS gold_rows FROM accounts GROUP BY 1)
        SELECT transaction_date, silver_rows, gold_rows, silver_rows IS NOT DISTINCT FROM gold_rows AS agrees
        FROM s FULL JOIN g USING (transaction_date)""",
    # table history
    "table_snapshots": f"""WITH {DELIVERIES}
        SELECT MAX(ingestion_timestamp) AS committed_at, _batch_id AS snapshot_id, 'append' AS operation,
            COUNT(*) AS records_added
        FROM bronze GROUP BY _batch_id""",
    "bronze_as_of_timestamp": f"""WITH {DELIVERIES},
        committed AS (SELECT _batch_id, MAX(ingestion_timestamp) AS committed_at FROM bronze GROUP BY 1)
        SELECT {KEYS} FROM bronze JOIN committed USING (_batch_id)
        WHERE committed_at <= TIMESTAMP '2024-01-16 00:00:00'""",
    "bronze_as_of_version": f"WITH {DELIVERIES} SELECT {KEYS} FROM bronze WHERE _batch_id <= 9",
    "bronze_incremental": f"WITH {DELIVERIES} SELECT {KEYS} FROM bronze WHERE _batch_id > 24",
    "table_partitions": f"WITH {DELIVERIES} SELECT date_partition, COUNT(*) AS record_count FROM bronze GROUP BY 1",
    "schema_evolution_union": f"""WITH {DELIVERIES}
        SELECT transaction_id, amount, date_partition, CASE WHEN _batch_id >= 15 THEN device_type END AS new_field
        FROM bronze""",
    "table_files": f"""WITH {DELIVERIES}
        SELECT date_partition, COUNT(*) AS record_count, true AS has_size FROM bronze GROUP BY 1""",
    "latest_by_key": f"""WITH {DELIVERIES},
        newest AS (
            SELECT *, row_number() OVER (
                PARTITION BY account_id ORDER BY "offset" DESC, ingestion_timestamp DESC, "partition" NULLS FIRST
            ) AS r FROM bronze
        )
        SELECT account_id AS key, "partition", "offset", ingestion_timestamp AS "timestamp" FROM newest WHERE r = 1""",
    # metric time series
    "metric_latest": f"WITH {SAMPLES} SELECT kind, broker_host, metric, mode, le, ts, value FROM latest",
    "metric_label_filter": f"""WITH {SAMPLES}
        SELECT kind, broker_host, ts, value FROM samples
        WHERE metric = 'messages_total' AND broker_host = 'kafka-1' AND kind <> ''
          AND regexp_full_match(kind, 'c.*|view')""",
    "metric_rate": f"""WITH {_rates(300)}
        SELECT kind, broker_host, window_start, rate FROM rates
        WHERE metric = 'messages_total' AND regexp_full_match(broker_host, 'kafka-.*')""",
    "metric_rate_by_label": f"""WITH {_rates(300)}
        SELECT broker_host, window_start, {EXACT_RATE} AS rate FROM rates
        WHERE metric = 'bytes_total' GROUP BY 1, 2""",
    "metric_rate_at_steps": _at_steps(
        """CAST(SUM(CAST(CASE WHEN before IS NULL THEN 0 WHEN value >= before THEN value - before ELSE value END
            AS DECIMAL(38,6))) AS DOUBLE) / 300.0::DOUBLE AS rate"""
    )
    + " WHERE metric = 'messages_total' GROUP BY ALL",
    "metric_values_at_steps": _at_steps("arg_max(value, ts) AS value") + " WHERE metric = 'bytes_total' GROUP BY ALL",
    "metric_current": f"""WITH {SAMPLES}
        SELECT metric, kind, broker_host, le, max(ts) AS ts, arg_max(value, ts) AS value FROM samples
        WHERE ts > TIMESTAMP '2024-01-30 23:00:00' AND ts <= TIMESTAMP '2024-01-30 23:30:00' GROUP BY ALL""",
    "metric_topk": f"""WITH {SAMPLES}
        SELECT kind, broker_host, value FROM latest WHERE metric = 'bytes_total' AND kind <> ''
        ORDER BY value DESC, broker_host, kind LIMIT 5""",
    "metric_histogram_quantile": f"WITH {QUANTILE}",
    "metric_alerts": f"""WITH {SAMPLES}
        SELECT kind, broker_host, alert, metric, value, CAST(threshold AS DOUBLE) AS threshold
        FROM latest JOIN (VALUES ('too_many_messages', 'messages_total', 50), ('heavy_traffic', 'bytes_total', 2000))
            AS rules(alert, metric, threshold) USING (metric)
        WHERE value > threshold""",
}

# The same results by another way of storing or reading.
for _name, _plain in (
    ("bronze_count_footers", "bronze_count"),
    ("table_partitions_footers", "table_partitions"),
    ("silver_account_lookup", "silver_range_filter"),
):
    ORACLES[_name] = ORACLES[_plain]
