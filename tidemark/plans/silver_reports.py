"""Report queries over silver."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import now, within
from tidemark.functions.money import credit, debit
from tidemark.operators.pick import top


def _sum(column):
    return F.sum(column).cast("decimal(28,2)")


def time_range(silver: DataFrame, start: str, end: str, account_id=None) -> DataFrame:
    """Rows of [start, end), of one account if given.

    The partition predicate is a day wider on both sides, see ``within``.
    """
    at, day = F.col("transaction_timestamp"), F.col("date_partition")
    first, last = now(start), now(end)
    rows = silver.filter(
        (day >= F.date_sub(F.to_date(first), 1))
        & (day <= F.date_add(F.to_date(last), 1))
        & (at >= first)
        & (at < last)
    )
    return rows if account_id is None else rows.filter(F.col("account_id") == F.lit(account_id))


def daily_volume(silver: DataFrame) -> DataFrame:
    return (
        silver.groupBy(F.to_date("date_partition").alias("date"))
        .agg(F.count(F.lit(1)).alias("transactions"), _sum("amount").alias("total_amount"))
        .orderBy(F.desc("date"))
    )


def flag_counts(silver: DataFrame) -> DataFrame:
    return silver.groupBy("is_flagged").agg(F.count(F.lit(1)).alias("count"))


def flagged_count(silver: DataFrame) -> DataFrame:
    return silver.filter("is_flagged").agg(F.count(F.lit(1)).alias("flagged"))


FLAGGED = ["account_id", "transaction_type", "amount", "merchant", "transaction_timestamp", "is_flagged"]
LATEST = ["transaction_id", "transaction_timestamp", "account_id", "transaction_type", "amount", "merchant", "is_flagged"]


def top_flagged(silver: DataFrame, n=50) -> DataFrame:
    return top(silver.filter("is_flagged"), n, [F.desc("amount")], FLAGGED)


def latest_in_hour(silver: DataFrame, n=100, as_of=None) -> DataFrame:
    rows = silver.filter(within(F.col("transaction_timestamp"), F.col("date_partition"), as_of, hours=1))
    return top(rows, n, [F.desc("transaction_timestamp")], LATEST)


def flagged_accounts(silver: DataFrame, since: str | None = None, more_than=3) -> DataFrame:
    """Accounts with several flagged transactions after ``since`` (else today)."""
    start = F.current_date().cast("timestamp") if since is None else now(since)
    return (
        silver.filter(
            F.col("is_flagged")
            & (F.col("date_partition") >= F.date_sub(F.to_date(start), 1))
            & (F.col("transaction_timestamp") > start)
        )
        .groupBy("account_id")
        .agg(
            F.count(F.lit(1)).alias("flagged_count"),
            _sum("amount").alias("total_flagged_amount"),
            F.max("amount").alias("max_transaction"),
        )
        .filter(F.col("flagged_count") > more_than)
        .orderBy(F.desc("total_flagged_amount"), "account_id")
    )


def busy_accounts(silver: DataFrame, more_than=100) -> DataFrame:
    return (
        silver.groupBy("account_id")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .filter(F.col("cnt") > more_than)
    )


def account_totals(silver: DataFrame) -> DataFrame:
    return silver.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("count"), _sum("amount").alias("total_amount")
    )


def debit_credit_check(silver: DataFrame) -> DataFrame:
    """Debits and credits recomputed per account, to compare with gold."""
    return silver.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("tx_count"),
        _sum(debit()).alias("debits"),
        _sum(credit()).alias("credits"),
    )
