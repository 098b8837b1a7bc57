"""The daily job: bronze -> silver -> gold, safe to run again."""

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark.functions.clock import yesterday_text
from tidemark.operators.history import BATCH, STREAM
from tidemark.plans.gold import daily_account_summary, merchant_summary
from tidemark.plans.silver import clean, for_day
from tidemark.schemas import BRONZE, DAILY_ACCOUNT_SUMMARY, MERCHANT_SUMMARY, SILVER
from tidemark.storage import is_path, overwrite_days, overwrite_range, path_exists, read_layer, replace_day


def run_day(spark: SparkSession, bronze: str, silver: str, accounts: str, merchants: str, day=None, processed_at=None):
    """Process one date (yesterday) and return the rows written per layer.

    Gold reads the stored silver partition, not the bronze lineage again.
    Each layer's partition of that day is replaced, so a second run changes
    nothing.  Rows are counted in the stored partition, from file footers:
    no transform runs twice for the sake of a number.
    """
    day = day or yesterday_text()

    def store(df, target, columns, partition_col):
        replace_day(df, target, partition_col, day)
        return read_layer(spark, target, columns).filter(F.col(partition_col) == F.lit(day).cast("date")).count()

    cleaned = clean(for_day(read_layer(spark, bronze, BRONZE), day), processed_at)
    rows = {"silver": store(cleaned, silver, SILVER, "date_partition")}
    cleaned = for_day(read_layer(spark, silver, SILVER), day)
    for name, summary, target, columns in (
        ("daily_account_summary", daily_account_summary, accounts, DAILY_ACCOUNT_SUMMARY),
        ("merchant_summary", merchant_summary, merchants, MERCHANT_SUMMARY),
    ):
        rows[name] = store(summary(cleaned, processed_at), target, columns, "transaction_date")
    return rows


def backfill(
    spark: SparkSession, bronze: str, silver: str, accounts: str, merchants: str, first_day, last_day, processed_at=None
):
    """All dates of a range in one pass per layer.

    A date that has lost its rows is emptied in every layer, so a second run leaves
    nothing of the first.
    """
    day = F.col("date_partition")
    raw = read_layer(spark, bronze, BRONZE).filter((day >= F.lit(first_day)) & (day <= F.lit(last_day)))
    overwrite_range(clean(raw, processed_at), silver, "date_partition", first_day, last_day)
    cleaned = read_layer(spark, silver, SILVER).filter(
        (day >= F.lit(first_day).cast("date")) & (day <= F.lit(last_day).cast("date"))
    )
    overwrite_range(daily_account_summary(cleaned, processed_at), accounts, "transaction_date", first_day, last_day)
    overwrite_range(merchant_summary(cleaned, processed_at), merchants, "transaction_date", first_day, last_day)


MARK = f"{STREAM} STRING, newest BIGINT"


def catch_up(spark: SparkSession, bronze: str, silver: str, accounts: str, merchants: str, mark: str, processed_at=None):
    """Work on what came in since the last run: recompute the dates that new commits touched, and no others.

    ``mark`` is a folder that keeps, per stream, the newest commit that is worked in.  It is
    written last: a run that fails, even in that write, is done again by the next.  Returns the
    dates recomputed.
    """
    raw = spark.read.schema(BRONZE).parquet(bronze) if is_path(bronze) else spark.table(bronze)
    stream = F.coalesce(F.col(STREAM) if STREAM in raw.columns else F.lit(None), F.lit("")).alias(STREAM)
    # partition columns alone: no column of a file is read
    commits = raw.select("date_partition", stream, F.col(BATCH).cast("bigint").alias(BATCH)).distinct()
    newest = commits.groupBy(STREAM).agg(F.max(BATCH).alias("newest")).collect()
    done = spark.read.schema(MARK).parquet(mark) if path_exists(spark, mark) else spark.createDataFrame([], MARK)
    past = {r[STREAM]: r.newest for r in done.collect()}
    fresh = commits.join(done, STREAM, "left").filter(F.col("newest").isNull() | (F.col(BATCH) > F.col("newest")))
    days = sorted(r.day for r in fresh.select(F.col("date_partition").cast("string").alias("day")).distinct().collect() if r.day)
    if days:
        day = F.col("date_partition")
        overwrite_days(clean(raw.filter(day.isin(days)), processed_at), silver, "date_partition", days)
        cleaned = read_layer(spark, silver, SILVER).filter(day.isin([F.lit(d).cast("date") for d in days]))
        overwrite_days(daily_account_summary(cleaned, processed_at), accounts, "transaction_date", days)
        overwrite_days(merchant_summary(cleaned, processed_at), merchants, "transaction_date", days)
    if newest:
        rows = [(r[STREAM], max(r.newest, past.get(r[STREAM], -1))) for r in newest if r.newest is not None]
        spark.createDataFrame(rows, MARK).coalesce(1).write.mode("overwrite").parquet(mark)
    return days
