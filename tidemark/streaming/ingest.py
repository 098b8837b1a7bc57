"""Topic to bronze in replay-safe micro-batches.

A batch is named by the stream that wrote it and its number there.  The stream's name is
the id that Structured Streaming keeps in the checkpoint: it survives restarts, and another
checkpoint has another one.  So several streams can fill one table, and a batch that is
written again replaces its own first attempt and nothing else.
"""

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.history import BATCH, STREAM
from tidemark.schemas import BRONZE, ENVELOPE
from tidemark.sources.envelope import DOCUMENT, EXTRA, enrich, is_dead, parsed, unknown_fields
from tidemark.storage import is_path, path_exists, spread

DAY = "date_partition"
#: Stands for the stream where a batch is written by hand.
UNNAMED = "unnamed"


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream that owns a checkpoint; written before its first batch."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def write_folder(rows: DataFrame, batch_id: int, target: str, compression="snappy", stream=None):
    """Put one micro-batch into its own folder, replacing an earlier attempt."""
    folder = f"{target}/{STREAM}={stream}" if stream else target
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", compression)
    writer.parquet(f"{folder}/{BATCH}={batch_id}")


def write_batch(rows: DataFrame, batch_id: int, target: str, compression="snappy", stream=None):
    """Put one micro-batch into bronze, a folder or a catalog table.

    The layout is date, then stream (where one is named), then batch: a read of one date
    lists no other.  Streams call back at least once; a repeated batch overwrites the
    partitions of its first attempt, so bronze holds every record once.  Rows of a date
    are gathered to files of the advisory size.
    """
    if not stream and not is_path(target) and STREAM in rows.sparkSession.table(target).columns:
        stream = UNNAMED
    names = {**({STREAM: F.lit(stream)} if stream else {}), BATCH: F.lit(batch_id).cast("bigint")}
    rows = spread(rows.withColumns(names), DAY)
    if is_path(target):
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", compression)
        writer.partitionBy(DAY, *names).parquet(target)
        return
    columns = rows.sparkSession.table(target).columns
    if columns[-1 - len(names) :] != [DAY, *names]:
        raise ValueError(f"{target} is not partitioned by {DAY} and {', '.join(names)}; see create_layers")
    writer = rows.select(*columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.insertInto(target)


def tells_streams_apart(spark: SparkSession, target: str) -> bool:
    """Whether a target has the stream among its partitions; a new one will."""
    if not is_path(target):
        return STREAM in spark.table(target).columns
    if not path_exists(spark, target):
        return True
    # of a filled folder this finds the partition columns, of an empty one none
    columns = spark.read.schema("transaction_id STRING").parquet(target).columns
    return STREAM in columns or BATCH not in columns


def refuse_foreign_target(spark: SparkSession, target: str, checkpoint: str):
    """A new checkpoint on a filled target would take in all its records once more.

    Where batches are not named by stream, it would also replace those of the same numbers.
    """
    if path_exists(spark, checkpoint):
        return
    filled = path_exists(spark, target) if is_path(target) else not spark.table(target).isEmpty()
    if filled:
        raise ValueError(f"{target} holds batches of another checkpoint; start from an empty target or share it")


def start_ingest(
    envelope: DataFrame,
    target: str,
    checkpoint: str,
    trigger=None,
    dead_letters: str | None = None,
    compression="snappy",
    ingested_at=None,
    shared=False,
    log: str | None = None,
    open_fields=False,
):
    """Start the stream ``envelope`` -> bronze ``target``, a folder or a catalog table.

    Without ``dead_letters`` unreadable records are stored with NULL columns; with it
    they go, unchanged, to that folder instead.  Every value is decoded once per output.

    ``shared`` lets a further stream (another topic, another region) write into a filled
    target; all rows of all streams are kept.  ``log`` names a folder that gets a row per
    commit, counted while the batch is written.  ``open_fields`` keeps the fields that the
    schema does not know in a VARIANT column ``extra`` (a catalog table must have it).
    """
    spark = envelope.sparkSession
    if not is_path(target) and not spark.catalog.tableExists(target):
        raise ValueError(f"{target} is neither a folder nor an existing table")
    if open_fields and not is_path(target) and EXTRA not in spark.table(target).columns:
        raise ValueError(f"{target} has no column {EXTRA} for unknown fields")
    if dead_letters and not is_path(dead_letters):
        raise ValueError(f"{dead_letters} is neither a folder nor an existing table")
    apart = tells_streams_apart(spark, target)
    for place in filter(None, (target, dead_letters)):
        if not (shared and apart):
            refuse_foreign_target(spark, place, checkpoint)
    named = []

    def store(batch: DataFrame, batch_id: int):
        session = batch.sparkSession
        if apart and not named:
            named.append(stream_id(session, checkpoint))
        stream = named[0] if apart else None
        rows = parsed(batch)
        if dead_letters:
            write_folder(rows.filter(is_dead()).drop(DOCUMENT), batch_id, dead_letters, compression, stream)
            rows = rows.filter(~is_dead())
        extra = [unknown_fields("value").alias(EXTRA)] if open_fields else []
        rows = enrich(rows.select(f"{DOCUMENT}.*", *extra), ingested_at)
        # an empty batch is no commit, and nothing is observed in it
        logged = log and not rows.isEmpty()
        seen = Observation()
        if logged:
            rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), F.max("ingestion_timestamp").alias("committed_at"))
        write_batch(rows, batch_id, target, compression, stream)
        if logged:
            entry = session.createDataFrame([(seen.get["committed_at"], seen.get["rows"])], "committed_at TIMESTAMP, rows BIGINT")
            write_folder(entry.coalesce(1), batch_id, log, compression, stream or UNNAMED)

    return (
        envelope.writeStream.foreachBatch(store)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "30 seconds"}))
        .start()
    )


def read_bronze(spark: SparkSession, target: str, open_fields=False) -> DataFrame:
    """The ingested layer with its commit number, and the unknown fields (NULL in files written without)."""
    extra = f", {EXTRA} VARIANT" if open_fields else ""
    return spark.read.schema(f"{BRONZE}{extra}, {BATCH} BIGINT").parquet(target)


def read_dead_letters(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.schema(f"{ENVELOPE}, {BATCH} BIGINT").parquet(target)


def start_console(envelope_text: DataFrame, rows=5, trigger=None):
    """Diagnostic: print the newest records."""
    return (
        envelope_text.writeStream.format("console")
        .outputMode("append")
        .option("truncate", "false")
        .option("numRows", str(rows))
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )


def preview(envelope_text: DataFrame, rows=5) -> int:
    """Diagnostic: show a few records and return how many there are."""
    envelope_text.show(rows, truncate=False)
    return envelope_text.agg(F.count(F.lit(1))).first()[0]
