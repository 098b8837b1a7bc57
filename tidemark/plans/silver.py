"""Bronze to silver."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import day_text, iso_timestamp, now, today
from tidemark.functions.money import money
from tidemark.operators.pick import TIE_BREAK, dedup_transactions
from tidemark.schemas import ACCEPTED_STATUSES, FLAG_ABOVE


def for_day(layer: DataFrame, day=None, as_of=None) -> DataFrame:
    """One date partition: the given day, else yesterday.

    Works on the text dates of bronze and the DATE column of silver; both
    compare the bare partition column with a foldable value, so it prunes.
    """
    wanted = F.lit(day) if day else day_text(F.date_sub(today(as_of), 1))
    if dict(layer.dtypes)["date_partition"] == "date":
        wanted = wanted.cast("date")
    return layer.filter(F.col("date_partition") == wanted)


def clean(bronze: DataFrame, processed_at=None) -> DataFrame:
    """Deduplicate, apply the quality rules, flag, type.

    Deduplication comes first on purpose: when the earliest copy of an id is
    invalid the id is gone, even if a later copy is valid.  The flag looks at
    the raw amount, before rounding to cents.
    """
    amount = F.col("amount")
    return (
        dedup_transactions(bronze, TIE_BREAK)
        .filter((amount > 0) & F.col("status").isin(*ACCEPTED_STATUSES))
        .select(
            "transaction_id",
            "account_id",
            "transaction_type",
            money("amount").alias("amount"),
            "currency",
            "merchant",
            iso_timestamp("timestamp").alias("transaction_timestamp"),
            "status",
            F.when(amount > FLAG_ABOVE, True).otherwise(False).alias("is_flagged"),
            F.when(amount > 0, "VALID").otherwise("INVALID").alias("validation_status"),
            now(processed_at).alias("processing_timestamp"),
            F.col("date_partition").try_cast("date").alias("date_partition"),
        )
    )
