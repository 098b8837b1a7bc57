"""Silver to gold.

Each summary is one aggregation: partial sums before the shuffle, and the
exact distinct count planned as two levels, so a hot account or merchant
reaches its final task as a handful of partial rows.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import now
from tidemark.functions.money import credit, debit, signed


def _cents(column):
    # Overflow of the stored type must fail loudly, hence no try_cast.
    return column.cast("decimal(18,2)")


def daily_account_summary(silver: DataFrame, processed_at=None) -> DataFrame:
    return (
        silver.groupBy("account_id", F.col("date_partition").alias("transaction_date"))
        .agg(
            F.count(F.lit(1)).alias("total_transactions"),
            _cents(F.sum(debit())).alias("total_debits"),
            _cents(F.sum(credit())).alias("total_credits"),
            _cents(F.sum(signed())).alias("net_amount"),
            _cents(F.avg("amount")).alias("avg_transaction_amount"),
            F.max("amount").alias("max_transaction_amount"),
            F.min("amount").alias("min_transaction_amount"),
            F.count_distinct("merchant").alias("distinct_merchants"),
            F.count_if("is_flagged").alias("flagged_transactions"),
        )
        .withColumn("processing_timestamp", now(processed_at))
    )


def merchant_summary(silver: DataFrame, processed_at=None) -> DataFrame:
    return (
        silver.filter(F.col("merchant").isNotNull())
        .groupBy("merchant", F.col("date_partition").alias("transaction_date"))
        .agg(
            F.count(F.lit(1)).alias("total_transactions"),
            _cents(F.sum("amount")).alias("total_amount"),
            _cents(F.avg("amount")).alias("avg_amount"),
            F.count_distinct("account_id").alias("unique_accounts"),
        )
        .withColumn("processing_timestamp", now(processed_at))
    )


def _rolled_up(daily: DataFrame, unit: str, name: str) -> DataFrame:
    return daily.groupBy(F.to_date(F.date_trunc(unit, "transaction_date")).alias(name)).agg(
        F.sum("total_transactions").alias("total_transactions"),
        F.sum("total_debits").cast("decimal(28,2)").alias("total_debits"),
        F.sum("total_credits").cast("decimal(28,2)").alias("total_credits"),
        F.sum("net_amount").cast("decimal(28,2)").alias("net_amount"),
        F.sum("flagged_transactions").alias("flagged_transactions"),
    )


def weekly_summary(daily: DataFrame) -> DataFrame:
    """Weeks start on Monday."""
    return _rolled_up(daily, "week", "week_start").orderBy("week_start")


def monthly_summary(daily: DataFrame) -> DataFrame:
    return _rolled_up(daily, "month", "month_start").orderBy("month_start")
