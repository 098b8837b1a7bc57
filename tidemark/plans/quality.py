"""Data-quality probes."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_audit(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.count(F.lit(1)).alias("total"), F.count_distinct("transaction_id").alias("unique_ids")
    )


def validation_counts(silver: DataFrame) -> DataFrame:
    return silver.groupBy("validation_status").agg(F.count(F.lit(1)).alias("count"))


def amount_bounds(silver: DataFrame) -> DataFrame:
    return silver.agg(
        F.min("amount").alias("min_amount"),
        F.max("amount").alias("max_amount"),
        F.avg("amount").cast("decimal(18,2)").alias("avg_amount"),
    )


def pass_rate(silver: DataFrame) -> DataFrame:
    """Rows, latest processing-day and share of VALID rows, per day."""
    valid = F.coalesce(F.col("validation_status") == "VALID", F.lit(False))
    return (
        silver.groupBy("date_partition")
        .agg(F.count(F.lit(1)).alias("record_count"), F.avg(valid.cast("double")).alias("pass_rate"))
        .orderBy("date_partition")
    )


def gold_matches_silver(silver: DataFrame, daily: DataFrame) -> DataFrame:
    """Per day: silver's rows, gold's transaction count, and whether they agree."""
    rows = silver.groupBy(F.col("date_partition").alias("transaction_date")).agg(
        F.count(F.lit(1)).alias("silver_rows")
    )
    summed = daily.groupBy("transaction_date").agg(F.sum("total_transactions").alias("gold_rows"))
    return rows.join(summed, "transaction_date", "full").withColumn(
        "agrees", F.col("silver_rows").eqNullSafe(F.col("gold_rows"))
    )
