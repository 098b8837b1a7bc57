"""Row counts of stored layers from Parquet footers: no column is read.

Spark answers a count over its V2 file source from the footers' row counts, also by all
partition columns; ``spark.sql.parquet.aggregatePushdown`` (session settings) lets it.
Filters may name partition columns only, others make it read the table as usual.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import BRONZE

_V1 = "spark.sql.sources.useV1SourceList"


def scan(spark: SparkSession, path: str, schema: str = BRONZE) -> DataFrame:
    """A folder of Parquet files through the V2 source; the session's own choice is put back."""
    before = spark.conf.get(_V1)
    spark.conf.set(_V1, ",".join(s for s in before.split(",") if s.strip().lower() != "parquet"))
    try:
        return spark.read.schema(schema).parquet(path)
    finally:
        spark.conf.set(_V1, before)


def row_count(layer: DataFrame) -> DataFrame:
    return layer.agg(F.count(F.lit(1)).alias("total_records"))


def partition_counts(layer: DataFrame, partition_cols: list[str], by: str) -> DataFrame:
    """Rows by one of the partition columns.

    Only a count by all of them, in their order, comes from the footers; its few rows are
    added up by ``by``.
    """
    parts = layer.groupBy(*partition_cols).agg(F.count(F.lit(1)).alias("n"))
    return parts.groupBy(by).agg(F.sum("n").alias("record_count"))
