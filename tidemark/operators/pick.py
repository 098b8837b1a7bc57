"""One row per key: deduplication and latest-state reads."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys, order) -> DataFrame:
    """Keep the first row of every key under ``order``; NULL is a key too.

    ``row_number() = 1`` is planned with a group limit before the shuffle, so
    each map task sends at most one row per key.  A key holding a third of
    the table (all NULL ids, say) costs one row per task, not one huge task.
    """
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def top(rows: DataFrame, n: int, order, output) -> DataFrame:
    """The first ``n`` rows under ``order``, reduced to ``output``.

    Rows equal under ``order`` are told apart by what is shown, so the answer
    is the same on every run.  Each task keeps ``n`` rows; nothing is sorted
    as a whole.
    """
    return rows.orderBy(*order, *output).select(*output).limit(n)


# What silver reads: equal in all of these means equal for every consumer.
TIE_BREAK = (
    "timestamp",
    "account_id",
    "transaction_type",
    "amount",
    "currency",
    "merchant",
    "status",
)


EVERY_COLUMN = (*TIE_BREAK, "is_fraud", "location", "customer", "metadata")


def dedup_transactions(bronze: DataFrame, tie_break=EVERY_COLUMN) -> DataFrame:
    """Earliest delivery of each transaction id within each date partition.

    Deliveries of one time are told apart by ``tie_break``, all columns unless the
    caller reads fewer.  The id leads the sort key: its first bytes already decide most
    comparisons, while the date text starts alike everywhere.
    """
    return first_per_key(
        bronze,
        ["transaction_id", "date_partition"],
        ["ingestion_timestamp", *tie_break],
    )


def latest_by_key(envelope: DataFrame) -> DataFrame:
    """Compacted-topic view: the record of every key with the highest offset.

    A topic keeps a key in one partition; should it not, the newest time decides
    between partitions that have equal offsets.
    """
    order = [F.col("offset").desc(), F.col("timestamp").desc(), F.col("partition")]
    return first_per_key(envelope, ["key"], order)
