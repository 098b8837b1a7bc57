"""Streams over topic records that are right in any order of arrival.

No stream here keeps state or a watermark: every micro-batch stores its own part, and
reading puts the parts together.  A backlog in any order, in one trigger or many, and a
repeated batch give the same rows.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.clock import iso_timestamp
from tidemark.operators.asof import as_of_join
from tidemark.operators.history import BATCH
from tidemark.operators.pick import first_per_key
from tidemark.schemas import TRANSACTION
from tidemark.sources.envelope import DOCUMENT, parsed
from tidemark.streaming.ingest import refuse_foreign_target, write_folder

DELIVERY = ("_delivered_at", "_partition", "_offset")


def _start(stream: DataFrame, part, target: str, checkpoint: str, trigger):
    refuse_foreign_target(stream.sparkSession, target, checkpoint)
    return (
        stream.writeStream.foreachBatch(lambda batch, batch_id: write_folder(part(batch), batch_id, target))
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "30 seconds"}))
        .start()
    )


def first_deliveries(envelope: DataFrame) -> DataFrame:
    """The earliest delivery of every transaction id, with its delivery coordinates.

    Records without an id are left to the dead letters.  A hot id sends one row per
    task (see ``first_per_key``).
    """
    rows = parsed(envelope).filter(F.col(f"{DOCUMENT}.transaction_id").isNotNull())
    rows = rows.select(
        f"{DOCUMENT}.*",
        F.col("timestamp").alias("_delivered_at"),
        F.col("partition").alias("_partition"),
        F.col("offset").alias("_offset"),
    )
    return first_per_key(rows, ["transaction_id"], DELIVERY)


def start_dedup(envelope: DataFrame, target: str, checkpoint: str, trigger=None):
    """Store each micro-batch's first deliveries in a folder of its own."""
    return _start(envelope, first_deliveries, target, checkpoint, trigger)


def read_unique(spark: SparkSession, target: str) -> DataFrame:
    """One row per transaction id: the earliest delivery of all batches."""
    columns = f"{TRANSACTION}, _delivered_at TIMESTAMP, _partition INT, _offset BIGINT, {BATCH} BIGINT"
    rows = spark.read.schema(columns).parquet(target)
    return first_per_key(rows, ["transaction_id"], DELIVERY).drop(*DELIVERY, BATCH)


def per_minute(transactions: DataFrame) -> DataFrame:
    """Transactions per minute of event time; those without one belong to no minute."""
    minute = F.date_trunc("minute", iso_timestamp("timestamp"))
    return transactions.groupBy(minute.alias("minute")).agg(F.count(F.lit(1)).alias("count")).filter("minute IS NOT NULL")


def start_minute_board(transactions: DataFrame, target: str, checkpoint: str, trigger=None):
    """Store each micro-batch's counts per minute in a folder of its own."""
    return _start(transactions, per_minute, target, checkpoint, trigger)


def read_minute_board(spark: SparkSession, target: str) -> DataFrame:
    """The counts of all batches, added up."""
    parts = spark.read.schema(f"minute TIMESTAMP, count BIGINT, {BATCH} BIGINT").parquet(target)
    return parts.groupBy("minute").agg(F.sum("count").alias("count"))


def enrich_customers(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """Customer attributes next to each transaction, batch or stream.

    Rows without a customer id cannot match and do not meet in the join; they are added
    back.  Whether the dimension is broadcast is Spark's size check, a hot customer is
    split by its skew join.
    """
    fact = transactions.withColumn("customer_id", F.col("customer.customer_id"))
    known = fact.filter("customer_id IS NOT NULL").join(customers, "customer_id", "left")
    return known.unionByName(fact.filter("customer_id IS NULL"), allowMissingColumns=True)


def enrich_as_of(transactions: DataFrame, versions: DataFrame, valid_from: str, slice_seconds=3600) -> DataFrame:
    """Customer attributes as they were at the time of the event, for a batch or inside ``foreachBatch``.

    ``versions`` has a row per change of a customer, by ``customer_id`` and ``valid_from``.
    """
    fact = transactions.withColumn("customer_id", F.col("customer.customer_id"))
    fact = fact.withColumn("_event_time", iso_timestamp("timestamp"))
    return as_of_join(fact, versions, "customer_id", "_event_time", valid_from, slice_seconds).drop("_event_time")
