"""Streams whose stored result is settled period by period, whatever order records come in.

A micro-batch adds its part to the periods (of event time) that it touches.  Once the
newest event seen is ``delay`` past a period's end, the period is settled: its parts are put
together and stored, so reading it needs no shuffle.  A late record opens its period again;
the next batch settles that period anew from its parts and replaces it, and no other.

What is kept between batches is one small file per batch: the newest event seen and the
periods still open.  A repeated batch starts from its predecessor's file, replaces its own
parts and settles the same periods, so it changes nothing.

Two results are kept this way: one row per transaction id, and counts per minute.
"""

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.clock import iso_timestamp
from tidemark.operators.history import BATCH
from tidemark.operators.pick import first_per_key
from tidemark.schemas import TRANSACTION
from tidemark.storage import path_exists, spread
from tidemark.streaming.ingest import refuse_foreign_target
from tidemark.streaming.live import DELIVERY, first_deliveries

PERIOD = "_period"
#: Period of records without a readable event time; it never ends.
TIMELESS = "none"
#: Files of state kept behind the newest one.
KEPT = 100


@dataclass(frozen=True)
class Settled:
    """What a batch adds (``part``, with the event time in ``at``) and how parts are put together (``merge``)."""

    columns: str
    at: str
    part: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame], DataFrame]
    unit: str = "day"
    delay: str = "1 hour"

    def period(self):
        return F.coalesce(F.date_format(F.date_trunc(self.unit, self.at), "yyyy-MM-dd'T'HH"), F.lit(TIMELESS))


def _state(spark: SparkSession, target: str, batch_id: int) -> dict:
    path = f"{target}/state/{BATCH}={batch_id}"
    if batch_id < 0 or not path_exists(spark, path):
        return {"newest": None, "open": []}
    return json.loads(spark.read.text(path).first()[0])


def _newest_state(spark: SparkSession, target: str) -> dict:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/state")
    listed = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    names = [status.getPath().getName() for status in listed]
    numbers = [int(n.split("=")[1]) for n in names if n.startswith(f"{BATCH}=")]
    return _state(spark, target, max(numbers, default=-1))


def _forget(spark: SparkSession, target: str, batch_id: int):
    old = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/state/{BATCH}={batch_id - KEPT}")
    old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)


def _parts(spark: SparkSession, target: str, kind: Settled, periods) -> DataFrame:
    """Parts of some periods: only their folders are listed."""
    paths = [f"{target}/parts/{PERIOD}={p}" for p in periods]
    columns = f"{kind.columns}, {BATCH} BIGINT, {PERIOD} STRING"
    return spark.read.schema(columns).option("basePath", f"{target}/parts").parquet(*paths)


def _settle(spark: SparkSession, target: str, kind: Settled, periods):
    """Replace the settled rows of ``periods``; within each, nothing but its own parts counts."""
    rows = kind.merge(_parts(spark, target, kind, periods).drop(BATCH))
    writer = spread(rows, PERIOD).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(PERIOD).parquet(f"{target}/settled")


def _over(spark: SparkSession, kind: Settled, newest, periods) -> list:
    """The periods that ended ``delay`` before the newest event."""
    if newest is None or not periods:
        return []
    rows = spark.createDataFrame([(p,) for p in periods if p != TIMELESS], "period STRING")
    start = F.to_timestamp("period", "yyyy-MM-dd'T'HH")
    end = start + F.expr(f"INTERVAL 1 {kind.unit}") + F.expr(f"INTERVAL {kind.delay}")
    return sorted(r.period for r in rows.filter(end <= F.lit(newest).cast("timestamp")).collect())


def start(stream: DataFrame, target: str, checkpoint: str, kind: Settled, trigger=None):
    """Keep ``target`` from ``stream``; a hot period's batch is written by as many tasks as it needs."""
    refuse_foreign_target(stream.sparkSession, target, checkpoint)

    def store(batch: DataFrame, batch_id: int):
        spark = batch.sparkSession
        before = _state(spark, target, batch_id - 1)
        rows = kind.part(batch).withColumn(PERIOD, kind.period()).withColumn(BATCH, F.lit(batch_id).cast("bigint"))
        rows = rows.persist()
        try:
            # one row per period of the batch
            seen = rows.groupBy(PERIOD).agg(F.max(F.col(kind.at).cast("string")).alias("newest")).collect()
            writer = spread(rows, PERIOD).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(PERIOD, BATCH).parquet(f"{target}/parts")
        finally:
            rows.unpersist()
        newest = max((t for t in [before["newest"], *(r.newest for r in seen)] if t is not None), default=None)
        waiting = sorted({*before["open"], *(r[PERIOD] for r in seen)})
        over = _over(spark, kind, newest, waiting)
        if over:
            _settle(spark, target, kind, over)
        after = {"newest": newest, "open": [p for p in waiting if p not in set(over)]}
        line = spark.createDataFrame([(json.dumps(after),)], "value STRING").coalesce(1)
        line.write.mode("overwrite").option("partitionOverwriteMode", "static").text(f"{target}/state/{BATCH}={batch_id}")
        _forget(spark, target, batch_id)

    return (
        stream.writeStream.foreachBatch(store)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "30 seconds"}))
        .start()
    )


def read(spark: SparkSession, target: str, kind: Settled, first=None, last=None) -> DataFrame:
    """All rows, or those of the periods ``first`` to ``last`` (text as in the folder names).

    Settled periods are scanned as they lie; only open ones are put together here.
    """
    waiting = _newest_state(spark, target)["open"]
    columns = f"{kind.columns}, {PERIOD} STRING"
    between = F.lit(True)
    if first is not None:
        between = between & (F.col(PERIOD) >= first)
    if last is not None:
        between = between & (F.col(PERIOD) <= last)
    rows = None
    if path_exists(spark, f"{target}/settled"):
        rows = spark.read.schema(columns).parquet(f"{target}/settled")
        rows = rows.filter(between & ~F.col(PERIOD).isin(waiting)) if waiting else rows.filter(between)
    if waiting:
        fresh = kind.merge(_parts(spark, target, kind, waiting).drop(BATCH).filter(between))
        rows = fresh if rows is None else rows.unionByName(fresh)
    return rows if rows is not None else spark.createDataFrame([], columns)


def settle_all(spark: SparkSession, target: str, kind: Settled):
    """Settle what is still open, e.g. after a backlog; later records open their periods again.

    Not while the stream runs.  The stream goes on knowing these periods as open and settles
    them once more, with the same rows, when they are over.
    """
    waiting = _newest_state(spark, target)["open"]
    if waiting:
        _settle(spark, target, kind, waiting)


# -- the two results ------------------------------------------------------------------


def _earliest(rows: DataFrame) -> DataFrame:
    return first_per_key(rows, [PERIOD, "transaction_id"], DELIVERY)


def _first_deliveries(envelope: DataFrame) -> DataFrame:
    rows = first_deliveries(envelope)
    return rows.withColumn("_event_time", iso_timestamp("timestamp"))


#: One row per transaction id: of its deliveries, the earliest.  Copies carry the time of their event.
UNIQUE = Settled(
    columns=f"{TRANSACTION}, _delivered_at TIMESTAMP, _partition INT, _offset BIGINT, _event_time TIMESTAMP",
    at="_event_time",
    part=_first_deliveries,
    merge=_earliest,
)


def _minutes(transactions: DataFrame) -> DataFrame:
    minute = F.date_trunc("minute", iso_timestamp("timestamp"))
    return transactions.groupBy(minute.alias("minute")).agg(F.count(F.lit(1)).alias("count")).filter("minute IS NOT NULL")


#: Transactions per minute of event time; those without one belong to no minute.  A day has at most 1440 rows.
MINUTES = Settled(
    columns="minute TIMESTAMP, count BIGINT",
    at="minute",
    part=_minutes,
    merge=lambda parts: parts.groupBy(PERIOD, "minute").agg(F.sum("count").alias("count")).select("minute", "count", PERIOD),
    delay="10 minutes",
)


def start_unique(envelope: DataFrame, target: str, checkpoint: str, trigger=None, kind=UNIQUE):
    """Records with an id become one row each; the rest is left to the dead letters."""
    return start(envelope, target, checkpoint, kind, trigger)


def read_unique(spark: SparkSession, target: str, first=None, last=None, kind=UNIQUE) -> DataFrame:
    return read(spark, target, kind, first, last).drop(*DELIVERY, "_event_time", PERIOD)


def start_minutes(transactions: DataFrame, target: str, checkpoint: str, trigger=None, kind=MINUTES):
    return start(transactions, target, checkpoint, kind, trigger)


def read_minutes(spark: SparkSession, target: str, first=None, last=None, kind=MINUTES) -> DataFrame:
    return read(spark, target, kind, first, last).drop(PERIOD)
