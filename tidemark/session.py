"""Session settings the library relies on."""

from pyspark.sql import SparkSession

# UTC: ISO text dates and parsed instants must fall on the same day.
# AQE: joins, skew and partition counts are decided from run-time sizes.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # An overwrite replaces the partitions it has rows of; tables take this from the session only.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Counts over the V2 file source come from footers (operators.footers).
    "spark.sql.parquet.aggregatePushdown": "true",
    # Stream state on executor disk with changelog checkpoints, not on the heap.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark):
    """Apply the settings to a session somebody else has built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)


def build_session(app_name="tidemark", master=None, shuffle_partitions=None, extra=None):
    """Session with the settings above.

    ``shuffle_partitions`` is the upper bound AQE coalesces down from: about
    shuffled bytes / 128 MB, so some 20 000 for a few TB of shuffled columns.
    """
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
