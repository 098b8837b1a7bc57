"""Table history of an append-only layer whose rows carry ``_batch_id``.

Every micro-batch is one commit and its number is a partition column, so
version reads are partition-pruned filters.  Where several streams write one
table, ``_stream`` tells their commits apart: numbers count per stream.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import now

BATCH, STREAM = "_batch_id", "_stream"


def _commit(table: DataFrame):
    """What names a commit: the number, and the stream where the table has several."""
    streams = [F.col(STREAM).alias("stream")] if STREAM in table.columns else []
    return [*streams, F.col(BATCH).alias("snapshot_id")]


def snapshots(table: DataFrame) -> DataFrame:
    """Commit log: time, number, operation and summary of every batch.

    Scans two columns of the table; ``read_log`` has the same rows from the log that ingest writes.
    """
    commits = table.groupBy(*_commit(table)).agg(
        F.max("ingestion_timestamp").alias("committed_at"), F.count(F.lit(1)).alias("rows")
    )
    return _log_entry(commits)


def _log_entry(commits: DataFrame) -> DataFrame:
    return commits.select(
        "committed_at",
        *[c for c in ("stream", "snapshot_id") if c in commits.columns],
        F.lit("append").alias("operation"),
        F.create_map(F.lit("added-records"), F.col("rows").cast("string")).alias("summary"),
    )


def read_log(spark, log: str) -> DataFrame:
    """The commit log that ingest keeps beside its table: a row per commit, no scan of the table."""
    columns = f"committed_at TIMESTAMP, rows BIGINT, {STREAM} STRING, {BATCH} BIGINT"
    commits = spark.read.schema(columns).parquet(log)
    return _log_entry(commits.select(*_commit(commits), "committed_at", "rows"))


def snapshot_report(table: DataFrame | None, n=None, log: DataFrame | None = None) -> DataFrame:
    """The log (of the table, or as ingest kept it) newest first, with the added records as a column."""
    report = (
        (log if log is not None else snapshots(table))
        .select("committed_at", "snapshot_id", "operation", F.col("summary")["added-records"].alias("records_added"))
        .orderBy(F.desc("committed_at"), F.desc("snapshot_id"))
    )
    return report if n is None else report.limit(n)


def as_of_batch(table: DataFrame, batch_id: int) -> DataFrame:
    """The table after commit ``batch_id``."""
    return table.filter(F.col(BATCH) <= batch_id)


def as_of_time(table: DataFrame, moment, log: DataFrame | None = None) -> DataFrame:
    """The table at a time: all commits up to the newest one made by then, of each stream.

    The newest commit comes from the commit ``log`` that ingest keeps, a row per
    commit, or else from a scan of two columns of the table.  Of one stream it is
    a scalar subquery whose value prunes the partitions of the main read; of
    several it is a table with a row per stream, whose join prunes at run time.
    """
    made = (log if log is not None else snapshots(table)).filter(F.col("committed_at") <= now(moment))
    if STREAM not in table.columns:
        return table.filter(F.col(BATCH) <= made.agg(F.max("snapshot_id")).scalar())
    newest = made.groupBy(F.col("stream").alias(STREAM)).agg(F.max("snapshot_id").alias("_newest"))
    return table.join(newest, STREAM).filter(F.col(BATCH) <= F.col("_newest")).select(*table.columns)


def since_batch(table: DataFrame, last_seen: int) -> DataFrame:
    """Incremental read: commits after ``last_seen``."""
    return table.filter(F.col(BATCH) > last_seen)


def partitions(table: DataFrame) -> DataFrame:
    return table.groupBy("date_partition").agg(F.count(F.lit(1)).alias("record_count")).orderBy("date_partition")


def files(scan: DataFrame, n=None) -> DataFrame:
    """Data files of a file-backed scan with rows and size, largest first."""
    report = (
        scan.groupBy(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("bytes"))
        .agg(F.count(F.lit(1)).alias("record_count"))
        .select("file_path", "record_count", (F.col("bytes") / 1024 / 1024).alias("size_mb"))
        .orderBy(F.desc("record_count"), "file_path")
    )
    return report if n is None else report.limit(n)


def evolve(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both shapes; a column one side lacks is NULL there."""
    return old.unionByName(new, allowMissingColumns=True)


def read_evolved(spark, path: str, schema: str) -> DataFrame:
    """Read files written before and after columns were added.

    ``schema`` is the table's with the new columns: no footer is read to infer it, and
    date text stays text.  Older files give NULL for what they lack.
    """
    return spark.read.schema(schema).parquet(path)
