"""Reading and writing layer tables, addressed by path or catalog name.

A target holding a ``/`` is a directory of Parquet files, anything else a
catalog table.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def is_path(target: str) -> bool:
    return "/" in target


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return file_system.exists(jvm_path)


def delete_folder(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that the driver and every executor see.

    Below ``spark.checkpoint.dir``, or else below the warehouse folder, which
    all sessions of a cluster share.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root}/tidemark/{purpose}-{uuid.uuid4().hex}"


def read_layer(spark: SparkSession, target: str, schema: str) -> DataFrame:
    """Scan a layer; the schema keeps date text from being inferred as DATE."""
    if is_path(target):
        return spark.read.schema(schema).parquet(target)
    return spark.table(target)


def spread(df: DataFrame, partition_col: str) -> DataFrame:
    """Group rows by output partition, splitting the ones that are too big.

    The rebalance hint lets AQE cut a hot date into several tasks of the
    advisory size and merge small ones, so neither one task per date nor one
    tiny file per task and date results.
    """
    return df.hint("rebalance", F.col(partition_col))


def _in_table_order(df: DataFrame, table: str) -> DataFrame:
    """Tables take columns by position, with the partition column last."""
    return df.select(*df.sparkSession.table(table).columns)


def overwrite_partitions(df: DataFrame, target: str, partition_col: str, compression="snappy"):
    """Replace exactly the partitions present in ``df``."""
    if not is_path(target):
        df = _in_table_order(df, target)
    out = spread(df, partition_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if is_path(target):
        out.option("compression", compression).partitionBy(partition_col).parquet(target)
    else:
        out.insertInto(target)


def overwrite_clustered(df: DataFrame, target: str, partition_col: str, by: str, distinct=100_000, compression="snappy"):
    """Replace the partitions present in ``df`` with files that hold ranges of ``by``.

    A lookup of one value then reads the row groups whose range holds it; a Bloom filter (for
    about ``distinct`` values a row group) rules out the others inside the range.  Parquet
    keeps none where a dictionary holds all values, which tells as much.  Rows of a hot value
    are told apart by a hash of their columns, so that they fill as many tasks as they need.
    """
    if not is_path(target):
        raise ValueError(f"{target} is no folder: a table's Bloom filters are options of the table")
    ranges = df.repartitionByRange(F.col(partition_col), F.col(by), F.xxhash64(*df.columns))
    (
        ranges.sortWithinPartitions(partition_col, by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .option(f"parquet.bloom.filter.enabled#{by}", "true")
        .option(f"parquet.bloom.filter.expected.ndv#{by}", str(distinct))
        .partitionBy(partition_col)
        .parquet(target)
    )


def _newest_files(spark, target: str, partition_col: str, wanted) -> dict:
    """Per stored date that is ``wanted``, the greatest file name: it changes when the date is rewritten."""
    if is_path(target):
        if not path_exists(spark, target):
            return {}
        stored = spark.read.schema(f"{partition_col} STRING").parquet(target)
    else:
        stored = spark.table(target)
    day = F.col(partition_col).cast("string")
    files = stored.filter(wanted(day)).groupBy(day.alias("day"))
    return {r["day"]: r["file"] for r in files.agg(F.max("_metadata.file_name").alias("file")).collect()}


def _overwrite_dates(df: DataFrame, target: str, partition_col: str, wanted, compression):
    spark = df.sparkSession
    before = _newest_files(spark, target, partition_col, wanted)
    overwrite_partitions(df, target, partition_col, compression)
    after = _newest_files(spark, target, partition_col, wanted) if before else {}
    for day in sorted(d for d, file in before.items() if after.get(d) == file):
        replace_day(df.limit(0), target, partition_col, day, compression)


def overwrite_range(df: DataFrame, target: str, partition_col: str, first_day: str, last_day: str, compression="snappy"):
    """Replace a range of dates: those ``df`` has rows of, and the others with nothing."""
    _overwrite_dates(df, target, partition_col, lambda day: (day >= first_day) & (day <= last_day), compression)


def overwrite_days(df: DataFrame, target: str, partition_col: str, days, compression="snappy"):
    """Replace single dates: those ``df`` has rows of, and the others of ``days`` with nothing."""
    _overwrite_dates(df, target, partition_col, lambda day: day.isin(list(days)), compression)


def replace_day(df: DataFrame, target: str, partition_col: str, day: str, compression="snappy"):
    """Replace one date partition with ``df``, also when ``df`` is empty.

    One partition needs no redistribution: the tasks of the last shuffle,
    coalesced by AQE, write the files.
    """
    if is_path(target):
        (
            df.drop(partition_col)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .option("compression", compression)
            .parquet(f"{target}/{partition_col}={day}")
        )
    else:
        rows = _in_table_order(df, target).drop(partition_col)
        df.sparkSession.sql(
            f"INSERT OVERWRITE TABLE {target} PARTITION ({partition_col} = '{day}') SELECT * FROM {{rows}}", rows=rows
        )


def append_partitions(df: DataFrame, target: str, partition_col: str, compression="snappy"):
    """Plain append, for callers who want every run kept."""
    if not is_path(target):
        df = _in_table_order(df, target)
    out = spread(df, partition_col).write.mode("append")
    if is_path(target):
        out.option("compression", compression).partitionBy(partition_col).parquet(target)
    else:
        out.insertInto(target)
