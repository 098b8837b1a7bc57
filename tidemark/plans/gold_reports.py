"""Report queries over gold, and the joins between layers."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import today
from tidemark.operators.pick import top


ACCOUNT_DAY = [
    "account_id",
    "transaction_date",
    "total_transactions",
    "total_debits",
    "total_credits",
    "net_amount",
    "flagged_transactions",
]
MERCHANT_DAY = ["merchant", "transaction_date", "total_transactions", "total_amount", "avg_amount", "unique_accounts"]


def accounts_top(daily: DataFrame, n=100) -> DataFrame:
    return top(daily, n, [F.desc("transaction_date"), F.desc("net_amount")], ACCOUNT_DAY)


def account_grand_totals(daily: DataFrame) -> DataFrame:
    return daily.agg(
        F.sum("total_transactions").alias("total_tx"),
        F.sum("total_debits").cast("decimal(28,2)").alias("total_debits"),
        F.sum("total_credits").cast("decimal(28,2)").alias("total_credits"),
    )


def top_merchants(merchants: DataFrame, n=20, day=None, min_total=None) -> DataFrame:
    """Largest totals, of one day or of all, above ``min_total`` if given."""
    rows = merchants
    if day is not None:
        rows = rows.filter(F.col("transaction_date") == F.lit(day).cast("date"))
    if min_total is not None:
        rows = rows.filter(F.col("total_amount") > F.lit(min_total))
    return top(rows, n, [F.desc("total_amount")], MERCHANT_DAY)


def merchant_trend(merchants: DataFrame) -> DataFrame:
    return merchants.select("merchant", "transaction_date", "total_transactions", "total_amount").orderBy(
        "merchant", "transaction_date"
    )


def merchant_cross_layer(merchants: DataFrame, silver: DataFrame, n=10) -> DataFrame:
    """Gold days joined to all silver rows of the merchant, top ``n`` by revenue.

    Every gold row meets every silver row of its merchant, so a group's
    revenue is the merchant's silver total times the group's number of gold
    rows, and its customers are the merchant's.  Both sides are therefore
    reduced to one row per merchant (and count) before they meet; the
    row-by-row product never exists.
    """
    customers = (
        silver.filter(F.col("merchant").isNotNull())
        .groupBy("merchant")
        .agg(F.count_distinct("account_id").alias("unique_customers"), F.sum("amount").alias("revenue"))
    )
    days = merchants.groupBy("merchant", "total_transactions").agg(F.count(F.lit(1)).alias("days"))
    return (
        days.join(customers, "merchant")
        .select(
            "merchant",
            "total_transactions",
            "unique_customers",
            (F.col("revenue") * F.col("days")).cast("decimal(28,2)").alias("total_revenue"),
        )
        .orderBy(F.desc("total_revenue"), "merchant", "total_transactions")
        .limit(n)
    )


def merchant_weekly_growth(merchants: DataFrame, as_of=None, n=20) -> DataFrame:
    """Revenue of the last 7 days against the 7 before, top ``n`` merchants.

    Both weeks come out of one scan and one aggregation by merchant, which is
    the left join of two per-week sums without the join: a merchant without a
    previous week keeps NULL growth, one without a current week is dropped.
    """
    day = F.col("transaction_date")
    week, fortnight = F.date_sub(today(as_of), 7), F.date_sub(today(as_of), 14)
    this_week = F.when(day >= week, F.col("total_amount"))
    last_week = F.when(day < week, F.col("total_amount"))
    current, previous = F.col("current_week_revenue"), F.col("previous_week_revenue")
    growth = F.try_divide((current - previous) * 100, previous)
    return (
        merchants.filter(day >= fortnight)
        .groupBy("merchant")
        .agg(
            F.sum(this_week).cast("decimal(28,2)").alias("current_week_revenue"),
            F.sum(last_week).cast("decimal(28,2)").alias("previous_week_revenue"),
            F.count_if(day >= week).alias("_days"),
        )
        .filter(F.col("_days") > 0)
        .select("merchant", current, previous, F.round(growth, 2).cast("decimal(18,2)").alias("growth_pct"))
        .orderBy(F.desc("current_week_revenue"), "merchant")
        .limit(n)
    )
