"""Column lists and fixed business values of the three table layers.

Schemas are DDL strings: Spark accepts them wherever a schema is expected
(``spark.read.schema``, ``from_json``, ``CREATE TABLE``).
"""

# The JSON document carried by one transaction event.
TRANSACTION = """
    transaction_id STRING,
    timestamp STRING,
    account_id STRING,
    transaction_type STRING,
    amount DOUBLE,
    currency STRING,
    merchant STRING,
    location STRUCT<city: STRING, state: STRING, country: STRING, latitude: DOUBLE, longitude: DOUBLE>,
    customer STRUCT<customer_id: STRING, name: STRING, email: STRING, phone: STRING>,
    is_fraud BOOLEAN,
    status STRING,
    metadata STRUCT<device_type: STRING, ip_address: STRING, session_id: STRING>
"""

# What a keyed topic hands to its readers.
ENVELOPE = """
    key BINARY,
    value BINARY,
    topic STRING,
    partition INT,
    offset BIGINT,
    timestamp TIMESTAMP
"""

# The stored layers.
BRONZE = TRANSACTION + """,
    ingestion_timestamp TIMESTAMP,
    date_partition STRING
"""

SILVER = """
    transaction_id STRING,
    account_id STRING,
    transaction_type STRING,
    amount DECIMAL(18,2),
    currency STRING,
    merchant STRING,
    transaction_timestamp TIMESTAMP,
    status STRING,
    is_flagged BOOLEAN,
    validation_status STRING,
    processing_timestamp TIMESTAMP,
    date_partition DATE
"""

DAILY_ACCOUNT_SUMMARY = """
    account_id STRING,
    transaction_date DATE,
    total_transactions BIGINT,
    total_debits DECIMAL(18,2),
    total_credits DECIMAL(18,2),
    net_amount DECIMAL(18,2),
    avg_transaction_amount DECIMAL(18,2),
    max_transaction_amount DECIMAL(18,2),
    min_transaction_amount DECIMAL(18,2),
    distinct_merchants BIGINT,
    flagged_transactions BIGINT,
    processing_timestamp TIMESTAMP
"""

MERCHANT_SUMMARY = """
    merchant STRING,
    transaction_date DATE,
    total_transactions BIGINT,
    total_amount DECIMAL(18,2),
    avg_amount DECIMAL(18,2),
    unique_accounts BIGINT,
    processing_timestamp TIMESTAMP
"""

# Business rules.
DEBIT_TYPES = ("WITHDRAWAL", "PAYMENT", "PURCHASE")
CREDIT_TYPES = ("DEPOSIT", "TRANSFER")
REVENUE_TYPES = ("PURCHASE", "PAYMENT")
ACCEPTED_STATUSES = ("COMPLETED", "PENDING", "FAILED")
FLAG_ABOVE = 10000

# layer -> (table name, columns, partition column)
LAYERS = {
    "bronze": ("bronze.transactions", BRONZE, "date_partition"),
    "silver": ("silver.transactions", SILVER, "date_partition"),
    "daily_account_summary": ("gold.daily_account_summary", DAILY_ACCOUNT_SUMMARY, "transaction_date"),
    "merchant_summary": ("gold.merchant_summary", MERCHANT_SUMMARY, "transaction_date"),
}
