"""Distinct counts that add up: exact bitmaps per day, merged by any longer unit.

A count of distinct values can't be added over days, the set of values can.  Values get
small dense numbers from a dictionary, a day's set is the bitmap of its numbers, and sets
of several days are united by OR.  All of it is hash aggregation with partial results.
"""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Numbers are dealt in this many lanes, so that no single task counts all values.
LANES = 1024


def extend_dictionary(spark, values: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Entries ``(value, id)`` for the ``values`` (one column) that ``known`` lacks; NULL gets none.

    The n-th value of a lane gets n * LANES + lane: dense up to the lanes' unevenness,
    never changed later, and every lane is ranked for itself.
    """
    name = values.columns[0]
    lane = F.pmod(F.xxhash64("value"), F.lit(LANES))
    fresh = values.select(F.col(name).alias("value")).filter("value IS NOT NULL").distinct()
    if known is None:
        known = spark.createDataFrame([], T.StructType([*fresh.schema, T.StructField("id", T.LongType())]))
    fresh = fresh.join(known, "value", "left_anti").withColumn("lane", lane)
    taken = known.groupBy(F.pmod("id", F.lit(LANES)).alias("lane")).agg(F.count(F.lit(1)).alias("taken"))
    place = F.row_number().over(W.partitionBy("lane").orderBy("value")) - 1 + F.coalesce("taken", F.lit(0))
    return fresh.join(taken, "lane", "left").select("value", (place * LANES + F.col("lane")).alias("id"))


def bitmaps(rows: DataFrame, keys, value: str, dictionary: DataFrame) -> DataFrame:
    """The set of ``value`` per ``keys``: ``keys, bucket, bitmap``, a bitmap for every 32 768 numbers."""
    pairs = rows.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("value")).distinct()
    numbered = pairs.join(dictionary, "value").withColumn("bucket", F.bitmap_bucket_number("id"))
    return numbered.groupBy(*keys, "bucket").agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bitmap"))


def united(sets: DataFrame, keys) -> DataFrame:
    """Sets with the same ``keys`` as one; what comes out can be united again."""
    return sets.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def counted(sets: DataFrame, keys, name="distinct") -> DataFrame:
    """Members of the union of all sets with the same ``keys``."""
    return united(sets, keys).groupBy(*keys).agg(F.sum(F.bitmap_count("bitmap")).alias(name))
