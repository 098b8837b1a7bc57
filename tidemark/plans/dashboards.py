"""Datasets behind dashboard charts, and the reusable metrics."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import iso_timestamp, now
from tidemark.functions.money import average, exact, total
from tidemark.operators import calendar
from tidemark.plans.bronze_reports import in_last
from tidemark.schemas import CREDIT_TYPES, DEBIT_TYPES, REVENUE_TYPES


def _share(condition):
    """Fraction of all rows; true division, NULL counts as no."""
    return F.avg(F.coalesce(condition, F.lit(False)).cast("double"))


def kpi_tiles(bronze: DataFrame) -> DataFrame:
    return bronze.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        total("amount").alias("total_amount"),
        average("amount").alias("avg_amount"),
        F.count_if("is_fraud").alias("fraud_count"),
    )


def daily(silver: DataFrame) -> DataFrame:
    return (
        silver.groupBy(F.col("date_partition").alias("day"))
        .agg(F.count(F.lit(1)).alias("count"), F.sum("amount").cast("decimal(28,2)").alias("total_amount"))
        .orderBy("day")
    )


def daily_by_type(silver: DataFrame) -> DataFrame:
    return (
        silver.groupBy(F.col("date_partition").alias("day"), "transaction_type")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("day", "transaction_type")
    )


def detail_table(silver: DataFrame, first_day=None, last_day=None, min_amount=None, max_amount=None) -> DataFrame:
    """Count, sum, average by account, merchant and type, optionally filtered."""
    rows = silver
    if first_day is not None:
        rows = rows.filter(F.col("date_partition") >= F.lit(first_day).cast("date"))
    if last_day is not None:
        rows = rows.filter(F.col("date_partition") <= F.lit(last_day).cast("date"))
    if min_amount is not None:
        rows = rows.filter(F.col("amount") >= F.lit(min_amount))
    if max_amount is not None:
        rows = rows.filter(F.col("amount") <= F.lit(max_amount))
    return rows.groupBy("account_id", "merchant", "transaction_type").agg(
        F.count(F.lit(1)).alias("count"),
        F.sum("amount").cast("decimal(28,2)").alias("total_amount"),
        F.avg("amount").cast("decimal(18,2)").alias("avg_amount"),
    )


def fraud_by_type(bronze: DataFrame) -> DataFrame:
    return bronze.filter("is_fraud").groupBy("transaction_type").agg(F.count(F.lit(1)).alias("fraud_count"))


def fraud_by_location(bronze: DataFrame) -> DataFrame:
    return (
        bronze.filter("is_fraud")
        .groupBy(F.col("location.state").alias("state"), F.col("location.city").alias("city"))
        .agg(
            F.count(F.lit(1)).alias("fraud_count"),
            total("amount").alias("total_amount"),
            F.avg("location.latitude").alias("latitude"),
            F.avg("location.longitude").alias("longitude"),
        )
    )


def today_counts(silver: DataFrame, day=None) -> DataFrame:
    """All and flagged transactions of one day (today)."""
    wanted = F.current_date() if day is None else F.lit(day).cast("date")
    return silver.filter(F.col("date_partition") == wanted).agg(
        F.count(F.lit(1)).alias("total_transactions"), F.count_if("is_flagged").alias("flagged_transactions")
    )


def per_minute(bronze: DataFrame, as_of=None, hours=1) -> DataFrame:
    """Transactions per minute over the last hour(s)."""
    return (
        in_last(bronze, hours, as_of)
        .groupBy(F.window(iso_timestamp("timestamp"), "1 minute").alias("w"))
        .agg(F.count(F.lit(1)).alias("count"))
        .select(F.col("w.start").alias("minute"), "count")
        .orderBy("minute")
    )


def hourly_board(bronze: DataFrame, hours=24, as_of=None) -> DataFrame:
    """Transactions by hour and type of the current hour and those before it, idle ones with zero.

    Types that the business does not know have rows only where they occur.
    """
    last = F.date_trunc("hour", now(as_of))
    first = last - F.expr(f"INTERVAL {hours - 1} HOURS")
    at = iso_timestamp("timestamp")
    rows = in_last(bronze, hours, as_of).filter(at >= first).select(F.date_trunc("hour", at).alias("hour"), "transaction_type")
    types = sorted(DEBIT_TYPES + CREDIT_TYPES)
    steps = calendar.grid(bronze.sparkSession, first, last, "1 HOUR", "hour", transaction_type=types)
    return calendar.counted(rows, steps).orderBy("hour", "transaction_type")


def daily_trend(silver: DataFrame, first_day=None, last_day=None) -> DataFrame:
    """Count and sum of every day of a range (the 30 days up to today), days without transactions included."""
    last = F.current_date() if last_day is None else F.lit(last_day).cast("date")
    first = F.date_sub(last, 29) if first_day is None else F.lit(first_day).cast("date")
    day = F.col("date_partition").alias("day")
    rows = silver.filter((F.col("date_partition") >= first) & (F.col("date_partition") <= last))
    summed = rows.groupBy(day).agg(F.count(F.lit(1)).alias("count"), F.sum("amount").cast("decimal(28,2)").alias("total_amount"))
    idle = calendar.grid(silver.sparkSession, first, last, "1 DAY", "day")
    idle = idle.select("day", F.lit(0).cast("long").alias("count"), F.lit(0).cast("decimal(28,2)").alias("total_amount"))
    both = summed.unionByName(idle).groupBy("day")
    total_amount = F.coalesce(F.sum("total_amount"), F.lit(0)).cast("decimal(28,2)")
    return both.agg(F.sum("count").alias("count"), total_amount.alias("total_amount")).orderBy("day")


def fraud_rate(bronze: DataFrame) -> DataFrame:
    return bronze.agg(_share(F.col("is_fraud")).alias("fraud_rate"))


def avg_value(rows: DataFrame) -> DataFrame:
    """Sum over count of all rows."""
    value = F.try_divide(F.sum(exact("amount")), F.count(F.lit(1)))
    return rows.agg(value.cast("decimal(18,2)").alias("avg_transaction_value"))


def revenue(rows: DataFrame) -> DataFrame:
    counted = F.when(F.col("transaction_type").isin(*REVENUE_TYPES), F.col("amount")).otherwise(0)
    return rows.agg(total(counted).alias("revenue"))
