"""Report queries over bronze (amount is a double, timestamp is ISO text)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import day_text, iso_timestamp, today, within
from tidemark.functions.money import average, money, total
from tidemark.operators.pick import top


def in_last(bronze: DataFrame, hours: int, as_of=None) -> DataFrame:
    return bronze.filter(within(iso_timestamp("timestamp"), F.col("date_partition"), as_of, hours=hours))


def row_count(bronze: DataFrame) -> DataFrame:
    return bronze.agg(F.count(F.lit(1)).alias("total_records"))


SAMPLE = ["transaction_id", "timestamp", "account_id", "transaction_type", "amount", "currency", "is_fraud", "status"]
RECENT = ["transaction_id", "timestamp", "account_id", "transaction_type", "amount", "merchant", "is_fraud"]
INGESTED = ["transaction_id", "timestamp", "account_id", "transaction_type", "amount", "is_fraud", "ingestion_timestamp"]


def sample(bronze: DataFrame, n=10, ordered=True) -> DataFrame:
    """``n`` rows; the unordered form stops at the first rows it finds."""
    return top(bronze, n, ["transaction_id"], SAMPLE) if ordered else bronze.select(*SAMPLE).limit(n)


def type_summary(bronze: DataFrame) -> DataFrame:
    return (
        bronze.groupBy("transaction_type")
        .agg(
            F.count(F.lit(1)).alias("count"),
            average("amount").alias("avg_amount"),
            F.min(money("amount")).alias("min_amount"),
            F.max(money("amount")).alias("max_amount"),
        )
        .orderBy(F.desc("count"), "transaction_type")
    )


def fraud_summary(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("is_fraud").agg(
        F.count(F.lit(1)).alias("count"), average("amount").alias("avg_amount")
    )


def type_totals(rows: DataFrame) -> DataFrame:
    """Count and sum by type, largest sum first; bronze or silver rows."""
    return (
        rows.groupBy("transaction_type")
        .agg(F.count(F.lit(1)).alias("count"), total("amount").alias("total_amount"))
        .orderBy(F.desc("total_amount"), "transaction_type")
    )


def type_totals_since(bronze: DataFrame, days=7, as_of=None) -> DataFrame:
    first_day = day_text(F.date_sub(today(as_of), days))
    return type_totals(bronze.filter(F.col("date_partition") >= first_day))


def type_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("transaction_type").agg(F.count(F.lit(1)).alias("count"))


def freshness(bronze: DataFrame) -> DataFrame:
    return bronze.agg(F.max("ingestion_timestamp").alias("latest_ingestion"))


def partition_totals(bronze: DataFrame) -> DataFrame:
    return (
        bronze.groupBy("date_partition")
        .agg(F.count(F.lit(1)).alias("transaction_count"), total("amount").alias("total_amount"))
        .orderBy(F.desc("date_partition"))
    )


def day_count(bronze: DataFrame, as_of=None) -> DataFrame:
    """Rows of the default processing day (yesterday)."""
    yesterday = day_text(F.date_sub(today(as_of), 1))
    return bronze.filter(F.col("date_partition") == yesterday).agg(F.count(F.lit(1)).alias("bronze_count"))


def recent(bronze: DataFrame, n=100) -> DataFrame:
    return top(bronze, n, [F.desc("timestamp")], RECENT)


def recently_ingested(bronze: DataFrame, n=10) -> DataFrame:
    return top(bronze, n, [F.desc("ingestion_timestamp")], INGESTED)


def fraud_by_customer(bronze: DataFrame, days=1, as_of=None) -> DataFrame:
    first_day = day_text(F.date_sub(today(as_of), days))
    return (
        bronze.filter(F.col("is_fraud") & (F.col("date_partition") >= first_day))
        .groupBy(F.col("customer.customer_id").alias("customer_id"))
        .agg(
            F.count(F.lit(1)).alias("suspicious_txn_count"),
            total("amount").alias("total_amount"),
            F.max("date_partition").alias("last_date"),
        )
        .orderBy(F.desc("total_amount"), "customer_id")
    )


def merchant_totals(bronze: DataFrame) -> DataFrame:
    return (
        bronze.filter(F.col("merchant").isNotNull())
        .groupBy("merchant")
        .agg(F.count(F.lit(1)).alias("count"), total("amount").alias("total_amount"))
        .orderBy(F.desc("total_amount"), "merchant")
    )


def hourly_by_type(bronze: DataFrame, hours=24, as_of=None) -> DataFrame:
    return (
        in_last(bronze, hours, as_of)
        .groupBy(F.date_trunc("hour", iso_timestamp("timestamp")).alias("hour"), "transaction_type")
        .agg(F.count(F.lit(1)).alias("count"), average("amount").alias("avg_amount"))
        .orderBy(F.desc("hour"), F.desc("count"), "transaction_type")
    )


def last_hour(bronze: DataFrame, as_of=None) -> DataFrame:
    return in_last(bronze, 1, as_of).agg(
        F.count(F.lit(1)).alias("count"), total("amount").alias("total_amount")
    )


def partition_scan(bronze: DataFrame, day: str) -> DataFrame:
    """The fast form: reads one partition."""
    return bronze.filter(F.col("date_partition") == F.lit(day))


def prefix_scan(bronze: DataFrame, prefix: str) -> DataFrame:
    """The slow form: a text prefix on the event time of every row."""
    return bronze.filter(F.col("timestamp").startswith(prefix))
