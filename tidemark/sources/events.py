"""The given ``events`` and ``customer`` tables seen as transactions.

Every expression is integer or text arithmetic on the event id, so any SQL
engine derives the same rows.  Each event is one delivery; every twentieth is
delivered twice, every sixtieth with a conflicting amount in the second copy.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TRANSACTION_COLUMNS = (
    "transaction_id",
    "timestamp",
    "account_id",
    "transaction_type",
    "amount",
    "currency",
    "merchant",
    "location",
    "customer",
    "is_fraud",
    "status",
    "metadata",
)
TOPIC = "transactions.raw"

# Schemas of the given tables: no job has to read footers to infer them.
EVENTS = """
    event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING
"""
CUSTOMER = """
    c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING
"""


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def stream_events(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """The events table as a file stream; a glob serves one file and a folder alike."""
    return spark.readStream.schema(EVENTS).options(**options).parquet(f"{sf_dir}/event[s].parquet")


def read_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer dimension keyed like ``customer.customer_id``."""
    return (
        spark.read.schema(CUSTOMER)
        .parquet(f"{sf_dir}/customer.parquet")
        .selectExpr(
            "concat('CUST', c_custkey + 100) AS customer_id",
            "c_name AS customer_name",
            "c_mktsegment AS segment",
            "CAST(c_nationkey AS BIGINT) AS nation_key",
        )
    )


def customer_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plans of customers over time: the basic one from 2 January, another with every sign-up event."""
    signed = read_events(spark, sf_dir).filter("event_type = 'signup'").selectExpr(
        "concat('CUST', user_id + 100) AS customer_id", "CAST(ts AS TIMESTAMP) AS valid_from",
        "concat('PLAN-', event_id % 4) AS plan",
    )
    basic = read_customers(spark, sf_dir).selectExpr("customer_id", "TIMESTAMP'2024-01-02' AS valid_from", "'BASIC' AS plan")
    return signed.unionByName(basic).groupBy("customer_id", "valid_from").agg(F.max("plan").alias("plan"))


def deliveries(events: DataFrame) -> DataFrame:
    """Transaction columns plus delivery time, offset and batch number."""
    copies = events.selectExpr(
        "*", "explode(CASE WHEN event_id % 20 = 0 THEN array(0, 1) ELSE array(0) END) AS copy"
    ).selectExpr(
        "*",
        """CASE WHEN event_id % 101 = 0 THEN -value WHEN event_id % 103 = 0 THEN 0.0D
                WHEN event_id % 50 = 0 THEN value * 1000 ELSE value END AS first_amount""",
        "(user_id * 3 + event_id) % 10 AS place",
    )
    return copies.selectExpr(
        "concat('TXN-', event_id) AS transaction_id",
        """date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'") AS timestamp""",
        "concat('ACC', user_id + 1000) AS account_id",
        """CASE event_type WHEN 'purchase' THEN 'PURCHASE' WHEN 'view' THEN 'WITHDRAWAL' WHEN 'signup' THEN 'DEPOSIT'
                WHEN 'click' THEN 'TRANSFER' WHEN 'error' THEN 'PAYMENT' END AS transaction_type""",
        "CASE WHEN copy = 1 AND event_id % 60 = 0 THEN first_amount + 1 ELSE first_amount END AS amount",
        "'USD' AS currency",
        """CASE WHEN event_type IN ('purchase', 'error') AND event_id % 37 <> 0
                THEN concat('MERCH-', (user_id * 7 + event_id) % 14) END AS merchant""",
        """struct(concat('City-', place) AS city, concat('State-', place % 7) AS state, 'US' AS country,
                CAST(place + 25 AS DOUBLE) AS latitude, CAST(-place - 65 AS DOUBLE) AS longitude) AS location""",
        """struct(concat('CUST', user_id + 100) AS customer_id, concat('Customer ', user_id) AS name,
                concat('c', user_id, '@example.com') AS email, concat('555-', user_id) AS phone) AS customer""",
        "event_id % 50 = 0 AS is_fraud",
        """CASE WHEN event_id % 11 = 0 THEN 'DECLINED' WHEN event_id % 7 = 0 THEN 'FAILED'
                WHEN event_id % 5 = 0 THEN 'COMPLETED' ELSE 'PENDING' END AS status""",
        """struct(CASE event_id % 4 WHEN 0 THEN 'mobile' WHEN 1 THEN 'web' WHEN 2 THEN 'atm' ELSE 'pos' END AS device_type,
                concat('10.0.0.', event_id % 256) AS ip_address, concat('S-', event_id) AS session_id) AS metadata""",
        """CAST(ts + CASE WHEN copy = 1 THEN INTERVAL 90 SECONDS ELSE INTERVAL 30 SECONDS END AS TIMESTAMP)
                AS ingestion_timestamp""",
        "date_format(ts, 'yyyy-MM-dd') AS date_partition",
        "event_id * 2 + copy AS offset",
        "CAST(user_id % 3 AS INT) AS partition",
        "CAST(datediff(ts, DATE'2024-01-01') AS BIGINT) AS _batch_id",
    )


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deliveries(read_events(spark, sf_dir)).drop("offset", "partition", "_batch_id")


def versioned_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze with the commit number each row arrived in: one commit a day."""
    return deliveries(read_events(spark, sf_dir)).drop("offset", "partition")


def as_envelope(events: DataFrame) -> DataFrame:
    """The deliveries as topic records; works on streams too."""
    return deliveries(events).select(
        F.col("account_id").cast("binary").alias("key"),
        F.to_json(F.struct(*TRANSACTION_COLUMNS)).cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        "partition",
        "offset",
        F.col("ingestion_timestamp").alias("timestamp"),
    )


def with_added_fields(events: DataFrame) -> DataFrame:
    """Topic records of a newer producer: some have a field more, at the top or in ``metadata``."""
    version = F.when(F.col("offset") % 4 == 1, F.col("offset") % 7)
    newer = deliveries(events).withColumn("metadata", F.col("metadata").withField("app_version", version))
    newer = newer.withColumn("channel", F.when(F.col("offset") % 3 == 0, F.concat(F.lit("CH-"), F.col("offset") % 5)))
    return newer.select(
        F.col("account_id").cast("binary").alias("key"),
        F.to_json(F.struct(*TRANSACTION_COLUMNS, "channel")).cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        "partition",
        "offset",
        F.col("ingestion_timestamp").alias("timestamp"),
    )


def with_damage(envelope: DataFrame) -> DataFrame:
    """Every 97th record unreadable text, every 89th without a value."""
    return envelope.withColumn(
        "value",
        F.when(F.col("offset") % 97 == 0, F.lit("garbage").cast("binary")).when(
            F.col("offset") % 89 != 0, F.col("value")
        ),
    )


# Upper bounds of the duration histogram.
BUCKETS = (10, 50, 100, 500)


def metric_samples(events: DataFrame, *wanted: str) -> DataFrame:
    """Counters scraped once a minute: ``(ts, metric, labels, value)``.

    Events are first summed per series and minute, so the running totals scan
    one row per series and minute whatever the number of events.  The counters
    of one broker restart from zero on 16 January.  Only ``wanted`` metrics
    are produced, all by default.  Events without a time are no samples.
    """
    per_minute = events.filter("ts IS NOT NULL").groupBy(
        F.expr("coalesce(event_type, '')").alias("kind"),
        F.expr("coalesce(concat('kafka-', event_id % 3 + 1), '')").alias("broker_host"),
        F.expr("date_trunc('minute', CAST(ts AS TIMESTAMP))").alias("ts"),
    ).agg(
        F.expr("count(*)").alias("n"),
        F.expr("coalesce(sum(CAST(value AS DECIMAL(18,6))), 0)").alias("volume"),
        *[F.expr(f"count_if(value <= {le})").alias(f"le_{le}") for le in BUCKETS],
    )
    per_minute = per_minute.selectExpr(
        "*",
        "broker_host = 'kafka-2' AND ts >= TIMESTAMP '2024-01-16' AS epoch",
    )
    so_far = "OVER (PARTITION BY kind, broker_host, epoch ORDER BY ts ROWS UNBOUNDED PRECEDING)"
    counters = ["n", "volume", *[f"le_{le}" for le in BUCKETS]]
    running = per_minute.selectExpr(
        "kind", "broker_host", "ts", *[f"CAST(sum({c}) {so_far} AS DOUBLE) AS {c}" for c in counters]
    )
    columns = [
        ("messages_total", "n", {}),
        ("bytes_total", "volume", {}),
        *[("duration_bucket", f"le_{le}", {"le": str(le)}) for le in BUCKETS],
        ("duration_bucket", "n", {"le": "+Inf"}),
    ]
    samples = [
        "struct('{0}' AS metric, map('kind', kind, 'broker_host', broker_host{1}) AS labels, {2} AS value)".format(
            metric, "".join(f", '{k}', '{v}'" for k, v in labels.items()), column
        )
        for metric, column, labels in columns
        if not wanted or metric in wanted
    ]
    return running.selectExpr("ts", f"inline(array({', '.join(samples)}))")
